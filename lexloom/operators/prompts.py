"""Prompt building and batched model calls."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import Any, Protocol

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

# The layout of a request, with `{}` slots filled per article, and
# its limit in characters.
USER_TEMPLATE = (
    "<genre>\n{genre}: {genre_description}\n\n</genre>\n\n"
    "<length>{length}: {length_instruction}</length>\n\n"
    "<language_level>{level}: {level_instruction}</language_level>\n\n"
    "<wikipedia_excerpt>\n{title}\n\n{text}\n</wikipedia_excerpt>"
)
MAX_CHARS = 6144

SYSTEM_PROMPT = (
    "From the excerpt write 5 self-contained texts in the given genre, length and language level. "
    "Choose exactly 15 shared labels for their meaning, not their words. Give every text 1 to 5 labels that "
    "hold and 8 to 15 that plausibly might but do not, all from the shared ones; every shared label must hold "
    "for one text and fail for another. Reply with one JSON object: "
    '{"shared_labels": [...], "examples": [{"text": "...", "labels": [...], "not_labels": [...]}]}'
)


def build_prompts(
    df: DataFrame, template: str = USER_TEMPLATE, system: str = SYSTEM_PROMPT, max_chars: int = MAX_CHARS
) -> DataFrame:
    """Fill the template from the article and its conditions; cut the request to `max_chars` characters.

    Adds `messages`, `genre` and `language_level`; expects the columns of `assign_conditions`.
    """
    slots = {
        "genre": "genre_name",
        "genre_description": "genre_description",
        "length": "length_label",
        "length_instruction": "length_instruction",
        "level": "level_label",
        "level_instruction": "level_instruction",
        "title": "title",
        "text": "text",
    }
    pieces, rest = [], template
    while "{" in rest:
        before, _, after = rest.partition("{")
        name, _, rest = after.partition("}")
        pieces += [F.lit(before), F.coalesce(F.col(slots[name]), F.lit(""))]
    pieces.append(F.lit(rest))
    user = F.substring(F.concat(*pieces), 1, max_chars)

    def message(role: str, content) -> Any:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    return df.withColumns(
        {
            "messages": F.array(message("system", F.lit(system)), message("user", user)),
            "genre": F.col("genre_name"),
            "language_level": F.col("level_label"),
        }
    )


class Client(Protocol):
    """What a caller's model client must offer. Transport trouble is signalled by
    ConnectionError or TimeoutError, which are retried; anything else is final."""

    def complete(self, messages: list[dict[str, str]], **params: Any) -> str | None: ...


def complete(
    df: DataFrame,
    client_factory: Callable[[], Client],
    model: str,
    temperature: float = 0.9,
    max_tokens: int = 3072,
    top_p: float = 0.95,
    top_k: int = 64,
    attempts: int = 5,
    concurrency: int = 16,
    wait: Callable[[int], float] = lambda attempt: 2.0**attempt,
) -> DataFrame:
    """Add `response`: one model call per row of `messages`, null when it failed.

    Each task makes one client and keeps `concurrency` calls in flight over one
    Arrow batch at a time. A retried task calls again, so write the result to a
    table before using it twice, and leave speculation off.
    """
    params = dict(model=model, temperature=temperature, max_tokens=max_tokens, top_p=top_p, top_k=top_k)

    def call(client: Client, messages: Any) -> str | None:
        chat = [{"role": m["role"], "content": m["content"]} for m in messages]
        for attempt in range(attempts):
            try:
                return client.complete(chat, **params)
            except (ConnectionError, TimeoutError) as problem:
                if attempt == attempts - 1:
                    logging.debug("call failed after %d attempts: %s", attempts, problem)
                    return None
                time.sleep(wait(attempt))
            except Exception as problem:  # the row fails, not the job
                logging.debug("unexpected error: %s", problem)
                return None
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client, rows, failed = client_factory(), 0, 0
        with ThreadPoolExecutor(concurrency) as pool:
            for batch in batches:
                replies = list(pool.map(lambda m: call(client, m), batch["messages"]))
                rows, failed = rows + len(replies), failed + replies.count(None)
                yield batch.assign(response=replies)
        if failed:
            logging.warning("%d of %d calls of this task gave no reply", failed, rows)

    schema = T.StructType([*df.schema.fields, T.StructField("response", T.StringType())])
    return df.mapInPandas(run, schema)
