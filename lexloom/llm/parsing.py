"""Document fingerprints from locally consistent parsing."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

#: Levels of the phrase hierarchy; names from level SIGN on make the fingerprint of a text of any length.
LEVELS = 5
SIGN = 2
#: Bins of the fingerprint, one byte each.
BINS = 128
#: Characters of texts held for an answer, and parsed together.
BATCH_CHARS, PARSE_CHARS = 500_000, 50_000

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def _toss_table(size: int) -> np.ndarray:
    """Label of every (left, own) pair of labels below `size`: where they first differ, and the own bit there."""
    left, own = np.meshgrid(np.arange(size), np.arange(size), indexing="ij")
    x = left ^ own
    at = np.where(x == 0, 0, np.bitwise_count((x & -x) - 1))
    return (2 * at + ((own >> at) & 1)).astype(np.uint8)


_TOSS = _toss_table(128)


def _coin_labels(s: np.ndarray, heads: np.ndarray) -> np.ndarray:
    """Deterministic coin tossing down to labels below 6; neighbours that differ keep different labels.

    The first symbol of each text is tossed against zero, so no text depends on the one before it.
    """
    left = np.empty_like(s)
    left[1:] = s[:-1]
    left[heads] = 0
    x = s ^ left
    one = s.dtype.type(1)
    at = np.bitwise_count((x & (~x + one)) - one).astype(s.dtype)
    at[x == 0] = 0
    label = (at * s.dtype.type(2) + ((s >> at) & one)).astype(np.uint8)
    before = np.empty_like(label)
    for _ in range(3):
        before[1:] = label[:-1]
        before[heads] = 0
        label = _TOSS[before, label]
    return label


def parse_level(s: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level for many texts laid end to end: (names of phrases, start of each text among them).

    Runs of one symbol become one symbol. Among the rest, where neighbours differ, a
    phrase begins at every local maximum of the coin labels. A label depends on four
    symbols to its left, so phrases away from the ends of equal substrings are equal.
    """
    first = np.zeros(len(s), bool)
    first[starts] = True
    fresh = np.ones(len(s), bool)
    fresh[1:] = (s[1:] != s[:-1]) | first[1:]
    at = np.nonzero(fresh)[0]
    names = s[at].astype(np.uint64)
    run = np.diff(np.append(at, len(s)))
    long = run > 1
    if long.any():
        names[long] = _mixed(names[long] * _M1 + run[long].astype(np.uint64))
    heads = first[at]
    symbols = names if s.dtype == np.uint64 or long.any() else s[at]
    label = _coin_labels(symbols, heads)
    label[heads] = 6
    cut = heads.copy()
    if len(label) > 2:
        cut[1:-1] |= (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    begin = np.nonzero(cut)[0]
    place = np.arange(len(names), dtype=np.uint64) - np.repeat(begin, np.diff(np.append(begin, len(names)))).astype(np.uint64)
    phrases = _mixed(np.add.reduceat(_mixed(names + (place + np.uint64(1)) * _M1), begin))
    return phrases, np.nonzero(heads[begin])[0]


def fingerprint_batch(texts: list[str]) -> np.ndarray:
    """[texts, BINS] bytes: per bin the tag of the smallest name, 0 where no name falls."""
    out = np.zeros((len(texts), BINS), np.uint8)
    full = [i for i, t in enumerate(texts) if t]
    if not full:
        return out
    sizes = np.array([len(texts[i]) for i in full])
    s = np.frombuffer("".join(texts[i] for i in full).encode("utf-32-le", "replace"), "<u4")
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    lowest = np.full((len(full), BINS), np.iinfo(np.uint64).max)
    for level in range(1, LEVELS + 1):
        s, starts = parse_level(s, starts)
        owner = np.repeat(np.arange(len(full)), np.diff(np.append(starts, len(s))))
        if level < SIGN:
            continue
        h = _mixed(s + np.uint64(level))
        slot = owner * BINS + (h & np.uint64(BINS - 1)).astype(np.int64)
        np.minimum.at(lowest.reshape(-1), slot, h >> np.uint64(7))
    tag = (_mixed(lowest) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    tag[lowest == np.iinfo(np.uint64).max] = 0
    out[full] = tag
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of the bins either uses in which two fingerprints agree; 1 for two without names."""
    either = ((a > 0) | (b > 0)).sum(-1)
    same = ((a == b) & (a > 0)).sum(-1)
    return np.where(either == 0, 1.0, same / np.maximum(either, 1))


def batches_of(texts: list[str], chars: int = PARSE_CHARS):
    at, size = 0, 0
    for i, t in enumerate(texts):
        if i > at and size + len(t) > chars:
            yield at, i
            at, size = i, 0
        size += len(t)
    if at < len(texts):
        yield at, len(texts)


def _all(texts: list[str]) -> np.ndarray:
    parts = [fingerprint_batch(texts[a:b]) for a, b in batches_of(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, BINS), np.uint8)


def fingerprint(text: Column) -> Column:
    """Fingerprint of each whole text in hex; a null counts as empty. Equal texts have equal ones."""

    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([bytes(f).hex() for f in _all([t or "" for t in texts])], dtype=object)

    return run(text)


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fingerprint) of every row; other columns are not read."""
    return docs.select(F.col(key), fingerprint(F.col(text)).alias("fingerprint"))


def in_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, bucket, ahead): rows by ascending key, a run of keys to each partition.

    The first row of a run is also sent to the run before it, marked `ahead`, so that each
    partition sees its successor; the first of all goes to the last. Runs are cut at keys
    found by one range shuffle of the keys alone; texts are shuffled once. Rows without key
    come first; rows with equal keys stand in the order of their texts, in one partition.
    """
    spark = docs.sparkSession
    count = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = docs.select(F.col(key).cast("long").alias("k")).where("k is not null").repartitionByRange(count, "k")
    low = np.array(sorted(r["k"] for r in ranges.groupBy(F.spark_partition_id()).agg(F.min("k").alias("k")).collect()), np.int64)
    runs = max(1, len(low))
    if docs.where(F.col(key).isNull()).limit(1).count():
        lead = None
    else:
        lead = int(low[0]) if len(low) else None

    @F.pandas_udf("array<int>")
    def places(keys: pd.Series) -> pd.Series:
        known = keys.notna().to_numpy()
        k = np.array([int(v) for v in keys[known]], np.int64)
        bucket = np.zeros(len(keys), np.int64)
        head = np.zeros(len(keys), bool)
        bucket[known] = np.maximum(np.searchsorted(low, k, "right") - 1, 0)
        head[known] = np.isin(k, low if lead is not None else low[1:])
        head |= ~known
        return pd.Series([[b, (b - 1) % runs] if h else [b] for b, h in zip(bucket.tolist(), head.tolist())], dtype=object)

    rows = docs.select(F.col(key).cast("string").alias("key"), F.col(key).cast("long").alias("k"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("key", "k", "text", F.posexplode(places(F.col("k").cast("string"))).alias("ahead", "bucket"))
    rows = rows.repartitionById(runs, F.col("bucket"))
    return rows.sortWithinPartitions("bucket", "ahead", F.asc_nulls_first("k"), "text").drop("k")


def compare_edited(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint every text, the text edited, and compare both and the next document.

    The edited text has its last floor(n/4) code points replaced by the first as many (or
    all) of the next document by ascending key; after the last comes the first. Returns
    (key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).
    A null text counts as empty; a single row is its own successor; null keys come first.
    """
    kind = docs.schema[key].dataType.simpleString()
    schema = (
        "key string, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )

    def answer(keys: list, texts: list[str]) -> pd.DataFrame:
        """For all but the last text, whose place is that of a successor."""
        edited = [t[: len(t) - len(t) // 4] + after[: len(t) // 4] for t, after in zip(texts, texts[1:])]
        own = _all(texts)
        new = _all(edited)
        return pd.DataFrame({
            "key": keys[:-1],
            "n_chars": [len(t) for t in texts[:-1]],
            "edited_sha256": [hashlib.sha256(e.encode("utf-8", "replace")).hexdigest() for e in edited],
            "fingerprint": [bytes(f).hex() for f in own[:-1]],
            "edited_fingerprint": [bytes(f).hex() for f in new],
            "near_edited": likeness(own[:-1], new),
            "near_next": likeness(own[:-1], own[1:]),
        })

    def run(batches):
        keys, texts, size, ended = [], [], 0, False
        for b in batches:
            for k, t, ahead in zip(b["key"], b["text"], b["ahead"]):
                if ahead and ended:
                    continue
                keys.append(k)
                texts.append(t)
                size += len(t)
                ended = bool(ahead)
                if (size > BATCH_CHARS or ended) and len(texts) > 1:
                    yield answer(keys, texts)
                    keys, texts, size = keys[-1:], texts[-1:], len(texts[-1])

    out = in_order(docs, key, text).select("key", "text", "ahead").mapInPandas(run, schema)
    return out.withColumn("key", F.col("key").cast(kind)).withColumnRenamed("key", key)
