"""Document quality by histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

import math
import operator
import zlib
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from lexloom.llm import trees
from lexloom.llm.common import sampled_texts

#: Labelled documents that a model is fitted on, at most.
TRAIN_ROWS = 20_000
#: A document is kept at this score or above.
KEEP = 0.3

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "space": b" \t\r\x0b\x0c",
    "newline": b"\n",
    "stop": b".?",
    "bang": b"!",
    "comma": b",;:'\"-",
    "mark": b"#$%&*@^~_=+",
    "bar": b"|",
    "bracket": b"()[]{}<>/\\`",
    "wide": bytes(range(128, 256)),
    "control": bytes([*range(0, 9), *range(14, 32), 127]),
}
_MEMBERS = np.zeros((256, len(_CLASSES)))
for _k, _members in enumerate(_CLASSES.values()):
    _MEMBERS[list(_members), _k] = 1
WIDTH = len(_CLASSES) + 14


def statistics(text: str | None) -> np.ndarray:
    """One row of document statistics; null counts as empty."""
    out = np.zeros(WIDTH)
    if not text:
        return out
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    k = len(_CLASSES)
    out[:k] = counts @ _MEMBERS / len(raw)
    share = counts[counts > 0] / len(raw)
    out[k] = math.log1p(len(raw))
    out[k + 1] = -(share * np.log2(share)).sum()
    out[k + 2] = (raw[1:] == raw[:-1]).mean() if len(raw) > 1 else 0
    words = text.split()
    n = len(words)
    if n:
        kinds = Counter(words)
        out[k + 3] = math.log1p(n)
        out[k + 4] = len(raw) / n
        out[k + 5] = len(kinds) / n
        out[k + 6] = len(kinds) / math.sqrt(n)
        out[k + 7] = max(kinds.values()) / n
        out[k + 8] = sum(map(operator.eq, words, words[1:])) / n
        out[k + 9] = sum(map(str.isupper, words)) / n
        out[k + 10] = sum(map(str.isalpha, words)) / n
        out[k + 11] = max(map(len, kinds))
    lines = text.split("\n")
    out[k + 12] = 1 - len(set(lines)) / len(lines)
    out[k + 13] = n / len(lines)
    return out


def matrix(texts: pd.Series) -> np.ndarray:
    return np.stack([statistics(t) for t in texts]) if len(texts) else np.zeros((0, WIDTH))


def fit_quality(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    bound: int = TRAIN_ROWS,
) -> trees.Forest:
    """Fit on at most `bound` labelled documents that are not held out.

    Statistics are computed on executors; the driver sees one row of numbers per
    sampled document. Of documents repeated under one key, that of
    the smallest hash of the text counts.
    """
    sample = sampled_texts(docs, key, text, labels, label, bound)

    def measure(batches):
        for b in batches:
            yield pd.DataFrame({"x": list(matrix(b["text"])), "y": b["y"], "t": b["text"].map(hash_of)})

    rows = sample.mapInPandas(measure, "x array<double>, y int, t long").collect()
    rows.sort(key=lambda r: (r["t"], r["x"], r["y"]))
    x = np.array([r["x"] for r in rows]).reshape(-1, WIDTH)
    return trees.fit(x, np.array([r["y"] for r in rows], float))


def hash_of(text: str | None) -> int:
    return zlib.crc32((text or "").encode("utf-8", "replace"))


def quality_score(model: trees.Forest):
    """A vectorised function text -> probability of label 1."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([*model.score(matrix(texts))], dtype=float)

    return score


def classify_quality(
    docs: DataFrame, model: trees.Forest, key: str = "doc_id", text: str = "text", keep: float = KEEP
) -> DataFrame:
    """(key, score, predicted) of every row of `docs`, whole texts.

    Null and empty texts get the score the model gives to all-zero statistics; repeated
    rows are scored each; other columns of `docs` are not read.
    """
    out = docs.select(F.col(key), quality_score(model)(F.col(text)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= keep).cast("int"))


def drop_low_quality(docs: DataFrame, model: trees.Forest, text: str = "text", keep: float = KEEP) -> DataFrame:
    """Rows of `docs` scored `keep` or more, with all their columns."""
    return docs.where(quality_score(model)(F.col(text)) >= keep)
