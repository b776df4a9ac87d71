"""URL verdicts: host and path rules first, gradient-boosted trees on lexical features for the rest."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lexloom.llm import trees
from lexloom.llm.common import smallest

#: Labelled urls that a model is fitted on, at most.
TRAIN_ROWS = 20_000
#: Rules live in the plan, so their number is bounded.
MAX_RULES = 1_000
#: Hosts that must share a suffix for its block rate to count.
SHARED = 3
#: A url is blocked at this score or above.
BLOCK = 0.5

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """`where` is a host, then a path from its first slash on."""

    verdict: str
    where: str

    @property
    def host(self) -> str:
        return self.where.partition("/")[0]

    @property
    def path(self) -> str:
        return self.where[len(self.host):]


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; empty without one."""
    return F.coalesce(F.translate(F.regexp_extract(url, _PARTS, 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[Rule], give=lambda r: r.where) -> Column:
    """What `give` says of the longest rule that fits; null without one."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    out = None
    for r in sorted(rules, key=lambda r: (-len(r.where), r.where)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        out = F.when(fits, F.lit(give(r))) if out is None else out.when(fits, F.lit(give(r)))
    return F.lit(None).cast("string") if out is None else out


@dataclass
class UrlModel:
    """Trees and the smoothed block rate of suffixes."""

    forest: trees.Forest
    suffixes: dict[str, tuple[int, int]]
    share: float


def suffixes_of(url: str) -> list[str]:
    """The last label, and the last two labels, of the host; the last label with the first part of the path."""
    rest = url.partition("://")[2]
    labels = re.split(r"[/?#]", rest, maxsplit=1)[0].lower().split(".")
    section = re.match(r"[^/?#]*/([^/?#]*)/", rest)
    return [labels[-1], ".".join(labels[-2:]), f"{labels[-1]}/{section[1] if section else ''}"]


def _entropy(s: str) -> float:
    n = len(s)
    return -sum(c / n * math.log2(c / n) for c in Counter(s).values()) if n else 0.0


def lexical(url: str | None, model: UrlModel) -> list[float]:
    """Lexical features of a url, with the block rates of its suffixes."""
    url = url or ""
    scheme, _, rest = url.partition("://")
    m = re.match(r"([^/?#]*)([^?#]*)(?:\?([^#]*))?", rest)
    host, path, query = m[1], m[2], m[3] or ""
    digits = sum(map(str.isdigit, url))
    runs = re.findall(r"\d+", url)
    row = [
        len(url), len(host), len(path), len(query), path.count("/"), host.count("."), host.count("-"),
        digits / len(url) if url else 0, max(map(len, runs), default=0), _entropy(url), _entropy(host),
        query.count("&") + 1 if query else 0, query.count("="), url.count("%"), scheme == "https", "#" in rest,
        "." in path.rpartition("/")[2], path.endswith("/"), max(map(len, re.split(r"[./-]", host)), default=0),
    ]
    for suffix in suffixes_of(url):
        n, bad = model.suffixes.get(suffix, (0, 0))
        row += [(bad + 4 * model.share) / (n + 4), math.log1p(max(n, 0))]
    return row


def fit_urls(labelled: DataFrame, url: str = "url", label: str = "y", bound: int = TRAIN_ROWS) -> UrlModel:
    """Fit on distinct labelled urls (1: block); above `bound` rows those with the smallest hash.

    One half of them, by checksum, gives the suffix rates, the other half the trees, so
    that no tree sees a rate that holds its own label.
    Rows without url or label take no part. Without any, every url scores one half.
    """
    known = labelled.select(F.col(url).alias("u"), F.col(label).cast("int").alias("y"))
    rows = smallest(known.where(F.col("u").isNotNull() & F.col("y").isNotNull()), bound, "u")
    halves = ([r for r in rows if zlib.crc32(r["u"].encode("utf-8", "replace")) & 1 == h] for h in (0, 1))
    counted, trained = halves
    counts: dict[str, list[int]] = {}
    hosts: dict[str, set[str]] = {}
    for r in counted:
        host = re.split(r"[/?#]", r["u"].partition("://")[2], maxsplit=1)[0].lower()
        for s in suffixes_of(r["u"]):
            hosts.setdefault(s, set()).add(host)
            c = counts.setdefault(s, [0, 0])
            c[0] += 1
            c[1] += r["y"]
    suffixes = {s: (n, bad) for s, (n, bad) in counts.items() if len(hosts[s]) >= SHARED}
    share = (sum(r["y"] for r in rows) + 0.5) / (len(rows) + 1)
    model = UrlModel(trees.fit(np.zeros((0, 1)), np.zeros(0)), suffixes, share)
    if rows:
        used = trained or counted
        x = np.array([lexical(r["u"], model) for r in used], float)
        model.forest = trees.fit(x, np.array([r["y"] for r in used], float))
    return model


def judge_urls(
    pages: DataFrame, rules: Sequence[Rule], key: str = "page_id", url: str = "url", bound: int = TRAIN_ROWS,
    model: UrlModel | None = None,
) -> DataFrame:
    """(key, host, path, rule, verdict, score) of every url.

    The longest fitting rule decides; `score`, the trees' probability of block, decides
    the rest. Without a model, one is fitted on the urls that rules decide. A null url,
    or one without `://`, has empty host and path, fits no rule and is scored like any
    other. Repeated rows are judged each; other columns are not read.
    """
    base = pages.select(F.col(key), F.col(url).alias("_url"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    base = base.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    base = base.withColumn("_said", rule_of(F.col("host"), F.col("path"), rules, lambda r: r.verdict))
    if model is None:
        labelled = base.where(F.col("_said").isNotNull()).select("_url", (F.col("_said") == "block").cast("int").alias("y"))
        model = fit_urls(labelled, "_url", "y", bound)

    @F.pandas_udf("double")
    def score(urls: pd.Series) -> pd.Series:
        x = np.array([lexical(u, model) for u in urls], float)
        return pd.Series([*model.forest.score(x)] if len(x) else [], dtype=float)

    out = base.withColumn("score", score("_url"))
    verdict = F.coalesce(F.col("_said"), F.when(F.col("score") >= BLOCK, "block").otherwise("allow"))
    return out.select(key, "host", "path", "rule", verdict.alias("verdict"), "score")
