"""Hard negatives: exact integer scores by matrix products modulo small primes, then a window on scores."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lexloom.llm.common import saved

#: float32 holds integers exactly up to this.
EXACT = 1 << 24
#: Components that one product adds up, at most.
DEPTH = 1_024
#: Rows in one block of candidates, and of anchors.
ROWS, ANCHORS = 4_096, 16_384
#: Scores held at once in a task, about.
CELLS = 1 << 20
#: Vectors of a larger squared length take no part: their scores need not fit a long.
LONGEST = float(1 << 62)
_LOW = np.iinfo(np.int64).min


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % d for d in range(2, isqrt(n) + 1))


def moduli(width: int, bound: int) -> list[int]:
    """Odd primes, the largest that keep a product of `width` components exact, as many as scores up to `bound` need."""
    p = 2 * isqrt(EXACT // max(1, min(width, DEPTH)))
    out, reach = [], 1
    while reach <= 2 * bound:
        while not _is_prime(p):
            p -= 1
        out.append(p)
        reach *= p
        p -= 1
    return out


def centred(x: np.ndarray, p: int) -> np.ndarray:
    """The remainder by p that lies nearest to zero."""
    r = x % p
    return np.where(r > p // 2, r - p, r)


def residues(x: np.ndarray, primes: list[int]) -> list[np.ndarray]:
    return [centred(x, p).astype(np.float32) for p in primes]


def products(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """Exact inner products of all rows of a and b, given as residues of each prime.

    Each prime's product is taken in float32, DEPTH components at a time. The remainders are
    turned into digits of a mixed base of the primes, each digit nearest to zero, so that
    their sum is the signed score itself.
    """
    total = np.zeros((len(a[0]), len(b[0])), np.int64)
    digits: list[np.ndarray] = []
    base = 1
    for p, x, y in zip(primes, a, b):
        rest = np.zeros(total.shape, np.int32)
        for s in range(0, x.shape[1], DEPTH):
            rest += centred((x[:, s : s + DEPTH] @ y[:, s : s + DEPTH].T).astype(np.int32), p)
        unit = 1
        for q, d in zip(primes, digits):
            rest -= d * (unit % p)
            rest %= p
            unit *= q
        digit = centred(rest * pow(unit, -1, p), p).astype(np.int32)
        digits.append(digit)
        total += digit.astype(np.int64) * base
        base *= p
    return total


def best(scores: np.ndarray, ok: np.ndarray, ids: np.ndarray, limit: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k best of each row among those `ok` and not below `limit`: highest first, ties by smaller id."""
    held = np.where(ok, scores, _LOW)
    if held.shape[1] > k:
        limit = np.maximum(limit, np.partition(held, held.shape[1] - k, 1)[:, held.shape[1] - k])
    r, c = np.nonzero(ok & (held >= limit[:, None]))
    order = np.lexsort((ids[c], -held[r, c], r))
    r, c = r[order], c[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    return r[rank < k], c[rank < k]


class Tops:
    """The best `k` (score, id) seen of each of `n` lists, in order."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.scores = np.full((n, k), _LOW, np.int64)
        self.ids = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.there = np.zeros((n, k), bool)

    def add(self, at: np.ndarray, scores: np.ndarray, ok: np.ndarray, ids: np.ndarray) -> None:
        """Rows of scores for the lists `at`."""
        r, c = best(scores, ok, ids, np.where(self.there[at, -1], self.scores[at, -1], _LOW), self.k)
        if not len(r):
            return
        touched, r = np.unique(r, return_inverse=True)
        lists = at[touched]
        old = np.nonzero(self.there[lists])
        scores_, ids_ = self.scores[lists], self.ids[lists]
        rows = np.concatenate([old[0], r])
        s = np.concatenate([scores_[old], scores[touched[r], c]])
        i = np.concatenate([ids_[old], ids[c]])
        order = np.lexsort((i, -s, rows))
        rows, s, i = rows[order], s[order], i[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        rows, s, i, rank = (x[rank < self.k] for x in (rows, s, i, rank))
        self.there[lists] = False
        self.scores[lists[rows], rank], self.ids[lists[rows], rank], self.there[lists[rows], rank] = s, i, True


def usable(vector: Column) -> Column:
    """Not null, all components there and finite."""
    return vector.isNotNull() & ~F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))


def packed(rows: DataFrame, blocks: int) -> DataFrame:
    """(block, ids, uids, labels, parts): rows dealt by their hash to `blocks` blocks, vectors of a block in one array."""

    def pack(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["id", "uid"])
        return pd.DataFrame({
            "block": g["block"].iloc[:1], "ids": [g["id"].to_numpy()], "uids": [g["uid"].to_numpy()],
            "labels": [g["label"].to_numpy()], "parts": [np.stack(g["v"].to_numpy()).astype("<i4").tobytes()],
        })

    dealt = rows.withColumn("block", F.pmod(F.hash("uid"), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(pack, "block int, ids array<long>, uids array<long>, labels array<long>, parts binary")


def vectors(row, width: int) -> np.ndarray:
    return np.frombuffer(row.parts, "<i4").reshape(-1, width).astype(np.int64)


def sweep(
    anchors: DataFrame, blocks: DataFrame, counts: tuple[int, int], stripes: int, width: int, primes: list[int],
    lists: int, k: int, fits: Callable, name: str,
) -> DataFrame:
    """The best `k` rows of each of `lists` lists of every anchor, over all blocks.

    A block of anchors meets a stripe of the blocks of rows in one task, one block at a time:
    it keeps the best seen and hands on one row per list and stripe. `fits` tells, list by
    list, which scores of some anchors and rows belong to it.
    """
    n_anchors, n_blocks = counts
    stripe = F.pmod("block", F.lit(stripes))
    head = anchors.select(F.col("block").alias("a"), F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))).alias("s"), F.lit(-1).alias("block"), "ids", "uids", "labels", "parts", "windows")
    body = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(n_anchors - 1))).alias("a"), stripe.alias("s"), "block", "ids", "uids", "labels", "parts", F.lit(None).cast("array<long>").alias("windows"))
    rows = head.unionByName(body).repartition(n_anchors * stripes, "a", "s").sortWithinPartitions("a", "s", "block")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        row = tops = x = None

        def result() -> Iterator[pd.DataFrame]:
            at = np.nonzero(tops.there.any(1))[0]
            for start in range(0, len(at), 20_000):
                some = at[start : start + 20_000]
                yield pd.DataFrame({
                    "anchor": np.asarray(row.ids)[some // lists], "uid": np.asarray(row.uids)[some // lists], "list": some % lists,
                    "scores": [tops.scores[i][tops.there[i]] for i in some], "ids": [tops.ids[i][tops.there[i]] for i in some],
                })

        for b in batches:
            for r in b.itertuples(index=False):
                if r.block < 0:
                    if tops is not None:
                        yield from result()
                    row, tops, x = r, Tops(len(r.ids) * lists, k), residues(vectors(r, width), primes)
                    continue
                if row is None or row.a != r.a:
                    continue
                y, ids = residues(vectors(r, width), primes), np.asarray(r.ids)
                step = max(1, CELLS // len(ids))
                for s in range(0, len(row.ids), step):
                    upto = min(len(row.ids), s + step)
                    scores = products([z[s:upto] for z in x], y, primes)
                    for i in range(lists):
                        tops.add(np.arange(s, upto) * lists + i, scores, fits(row, r, slice(s, upto), scores, i), ids)
        if tops is not None:
            yield from result()

    found = rows.mapInPandas(run, "anchor long, uid long, list int, scores array<long>, ids array<long>")
    near = F.transform(F.arrays_zip("scores", "ids"), lambda x: F.struct((-x["scores"]).alias("low"), x["ids"].alias("id")))
    merged = found.groupBy("anchor", "uid", "list").agg(F.slice(F.sort_array(F.flatten(F.collect_list(near))), 1, k).alias("near"))
    return saved(merged, name)


def mine(
    rows: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding", label: str | Column = "label",
    positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), scale: int = 256,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every row that `asked` holds for.

    Scores are inner products of floor(scale * component), exact; higher ones come first,
    ties by smaller key. An anchor's positives are its first `positives` other rows of its
    label. For each, the first `negatives` rows of other labels whose score lies between
    window[0] and window[1] hundredths of the positive's, both included.

    Rows without key, label or vector, with null or non-finite components, or of another width
    than the most frequent one (ties: the smaller) take no part; nor do vectors too long for
    their scores to fit a long. Rows equal in key, label and vector count once; rows of one
    key that differ are rows of their own. An anchor without positives, or a positive without
    rows in its window, gives no rows, nor does an empty table.
    """
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    label = F.col(label) if isinstance(label, str) else label
    base = rows.select(F.col(key).cast("long").alias("id"), label.cast("long").alias("label"), F.col(vector).alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    base = base.where(F.col("id").isNotNull() & F.col("label").isNotNull() & usable(F.col("v")))
    base = base.withColumn("v", F.transform("v", lambda x: F.floor(x.cast("double") * scale).cast("double")))
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    base = base.withColumn("square", square).where(F.col("square") < LONGEST)
    widths = base.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    if not widths or not widths[0]["w"]:
        return empty
    width = widths[0]["w"]
    base = base.where(F.size("v") == width).withColumn("v", F.col("v").cast("array<int>"))
    base = base.groupBy("id", "label", "v").agg(F.max("asked").alias("asked"), F.max("square").alias("square"))
    base = saved(base.withColumn("uid", F.xxhash64("id", "label", "v")), "rows")
    total, n_asked, longest = base.agg(F.count("*"), F.count_if("asked"), F.max("square")).first()
    if not n_asked:
        return empty
    primes = moduli(width, int(longest * (1 + 1e-9)) + 1)
    cores = spark.sparkContext.defaultParallelism
    n_blocks = -(-total // ROWS)
    n_anchors = -(-n_asked // min(ANCHORS, max(256, -(-n_asked // cores))))
    stripes = min(n_blocks, -(-2 * cores // n_anchors))
    blocks = saved(packed(base, n_blocks), "blocks")
    asked_blocks = saved(packed(base.where("asked"), n_anchors), "anchors")
    counts = (n_anchors, n_blocks)

    def same(row, r, part, scores, i):
        mine = np.asarray(row.labels)[part][:, None] == np.asarray(r.labels)[None]
        return mine & (np.asarray(row.uids)[part][:, None] != np.asarray(r.uids)[None])

    none = F.lit(None).cast("array<long>").alias("windows")
    found = sweep(asked_blocks.select("*", none), blocks, counts, stripes, width, primes, 1, positives, same, "positives")

    # Windows travel with the block: lowest and highest score of each of an anchor's positives.
    low, high = window
    part = F.pmod(F.hash("uid"), F.lit(n_anchors)).alias("block")
    scores = F.transform("near", lambda x: -x["low"])
    by_block = found.groupBy(part).agg(F.sort_array(F.collect_list(F.struct("anchor", "uid", scores.alias("scores")))).alias("found"))

    def windows(g: pd.DataFrame) -> Iterator[pd.DataFrame]:
        for b in g:
            out = []
            for uids, some in zip(b["uids"], b["found"]):
                table = np.full((len(uids), positives, 2), 1, np.int64)
                table[:, :, 1] = 0
                at = {u: i for i, u in enumerate(uids)}
                for one in some if some is not None else []:
                    for j, s in enumerate(map(int, one["scores"])):
                        table[at[one["uid"]], j] = -(-low * s // 100), high * s // 100
                out.append(table.ravel())
            b["windows"] = out
            yield b[["block", "ids", "uids", "labels", "parts", "windows"]]

    ready = asked_blocks.join(by_block, "block", "left").mapInPandas(windows, "block int, ids array<long>, uids array<long>, labels array<long>, parts binary, windows array<long>")

    def other(row, r, part, scores, i):
        limits = np.asarray(row.windows).reshape(-1, positives, 2)[part, i]
        ok = (scores >= limits[:, :1]) & (scores <= limits[:, 1:])
        return ok & (np.asarray(row.labels)[part][:, None] != np.asarray(r.labels)[None])

    hard = sweep(saved(ready, "windows"), blocks, counts, stripes, width, primes, positives, negatives, other, "negatives")
    each = found.select("anchor", "uid", F.posexplode("near").alias("list", "p"))
    out = hard.select("anchor", "uid", "list", F.posexplode("near").alias("_rank", "n")).join(each, ["anchor", "uid", "list"])
    return out.select(
        F.col("anchor").alias("anchor_id"), F.col("p.id").alias("positive_id"), (F.col("_rank") + 1).cast("int").alias("rank"),
        F.col("n.id").alias("negative_id"), (-F.col("p.low")).alias("positive_score"), (-F.col("n.low")).alias("negative_score"),
    )
