"""Approximate nearest neighbours: inverted lists scanned with adaptive numbers of dimensions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from lexloom.llm.common import saved

#: Vectors that lists, rotation and number of probes are fitted on, at most.
FIT_ROWS = 16_384
#: Of those, vectors whose distances bound a query's search from the start.
SEED_ROWS = 2_048
#: Lists, at most: their centres are sent to every task.
MAX_LISTS = 4_096
#: Neighbours of fitted vectors that the probed lists must hold.
COVER = 0.98
#: Columns that are added to a partial distance between two tests.
BLOCK = 16
#: Width of the test, as a multiple of the error's scale: 1 + WIDTH / sqrt(dimensions seen).
TEST_WIDTH = 2.1
#: Vectors, and queries, that meet in one group at most, about.
CHUNK = 4_096


@dataclass
class Index:
    """Rotation, list centres (rotated), lists to probe, and sample vectors (rotated)."""

    rotation: np.ndarray
    centres: np.ndarray
    probes: int
    seeds: np.ndarray

    def order(self, rotated: np.ndarray, count: int) -> np.ndarray:
        """The `count` nearest lists of each row."""
        d = (self.centres**2).sum(1)[None] - 2 * rotated @ self.centres.T
        if count >= d.shape[1]:
            return np.argsort(d, 1)
        part = np.argpartition(d, count - 1, 1)[:, :count]
        return part


def usable(vector: Column) -> Column:
    """Not null, not zero, all components there and finite."""
    wrong = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~wrong & F.exists(vector, lambda x: x != 0)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T, 0)


def fit_index(sample: np.ndarray, rows: int, k: int, seed: int = 7) -> Index:
    """Rotation by a random orthogonal matrix, lists by k-means, probes by measured coverage.

    There are about sqrt(rows) lists. Probes are the fewest lists that hold COVER of the k
    nearest neighbours of sampled vectors among the sample.
    """
    rng = np.random.default_rng(seed)
    n, width = sample.shape
    rotation = np.linalg.qr(rng.normal(size=(width, width)))[0]
    x = sample @ rotation
    lists = int(min(MAX_LISTS, max(1, round(rows**0.5)), max(1, n // 8)))
    centres = x[rng.choice(n, lists, replace=False)]
    for _ in range(8):
        own = np.concatenate([_squares(x[a : a + 2048], centres).argmin(1) for a in range(0, n, 2048)])
        count = np.bincount(own, minlength=lists)
        total = np.stack([np.bincount(own, x[:, d], lists) for d in range(width)], 1)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    index = Index(rotation, centres, lists, x[:SEED_ROWS])
    asked = x[rng.choice(n, min(256, n), replace=False)]
    own = np.concatenate([_squares(x[a : a + 2048], centres).argmin(1) for a in range(0, n, 2048)])
    near = np.argsort(_squares(asked, x), 1)[:, 1 : k + 1]
    if near.size:
        place = np.empty((len(asked), lists), np.int64)
        np.put_along_axis(place, np.argsort(_squares(asked, centres), 1), np.arange(lists)[None], 1)
        needed = np.sort(np.take_along_axis(place, own[near], 1).ravel())
        index.probes = int(needed[min(len(needed) - 1, int(np.ceil(COVER * len(needed))) - 1)]) + 1
    return index


def scan(queries: np.ndarray, bound: np.ndarray, vectors: np.ndarray, k: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per rotated query (positions of candidates left, squared distances) among rotated vectors.

    Column blocks are added one after the other; after each, a candidate is abandoned if
    its partial distance, scaled to all dimensions, exceeds the bound by more than chance
    allows. The bound is the k-th smallest distance seen, and never above that given.
    """
    m, width = queries.shape
    # Room for rounding, so that vectors at the bound itself stay.
    tiny = 1e-12 * ((queries**2).sum(1).max(initial=0) + (vectors**2).sum(1).max(initial=0))
    limit = bound + tiny
    kept: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(m)]
    for start in range(0, len(vectors), 1024):
        part = vectors[start : start + 1024]
        partial = _squares(queries[:, :BLOCK], part[:, :BLOCK])
        seen = min(BLOCK, width)
        slack = (1 + TEST_WIDTH / seen**0.5) ** 2 if seen < width else 1 + 1e-9
        q, c = np.nonzero(partial * (width / seen) <= limit[:, None] * slack)
        d = partial[q, c]
        while seen < width and len(q):
            upto = min(width, seen + BLOCK)
            d = d + ((queries[q, seen:upto] - part[c, seen:upto]) ** 2).sum(1)
            seen = upto
            slack = (1 + TEST_WIDTH / seen**0.5) ** 2 if seen < width else 1 + 1e-9
            ok = d * (width / seen) <= limit[q] * slack
            q, c, d = q[ok], c[ok], d[ok]
        edges = np.searchsorted(q, np.arange(m + 1))
        for i in np.nonzero(np.diff(edges))[0]:
            a, b = edges[i], edges[i + 1]
            kept[i].append((c[a:b] + start, d[a:b]))
            if sum(len(x) for x, _ in kept[i]) > 4 * k:
                at = np.concatenate([x for x, _ in kept[i]])
                far = np.concatenate([x for _, x in kept[i]])
                edge = np.partition(far, k - 1)[k - 1]
                limit[i] = min(limit[i], edge + tiny)
                ok = far <= edge * (1 + 1e-9) + tiny
                kept[i] = [(at[ok], far[ok])]
    nothing = (np.zeros(0, np.int64), np.zeros(0))
    return [(np.concatenate([x for x, _ in p]), np.concatenate([y for _, y in p])) if p else nothing for p in kept]


def nearest(
    vectors: DataFrame, asked: Column, key: str = "vec_id", vector: str = "embedding", k: int = 10,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found of every row that `asked` holds for.

    Nearness is Euclidean distance in double precision, ties go to the smaller key, a row
    is no neighbour of itself. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do rows without key or with another width than the most
    frequent one. Equal vectors are searched and found once, with the k + 1 smallest keys
    of each, so copies do not multiply work. Every row is indexed. Lists larger than CHUNK
    are split, and so are the queries that probe them. Queries whose probed lists hold fewer
    than k others are sought in all lists, so fewer come back only if there are fewer.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    base = vectors.where(usable(F.col(vector)) & F.col(key).isNotNull())
    base = base.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    widths = base.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).collect()
    if not widths:
        return spark.createDataFrame([], schema)
    base = base.where(F.size("v") == widths[0]["w"])
    copies = Window.partitionBy("v").orderBy("id")
    few = base.withColumn("_n", F.row_number().over(copies)).where(F.col("_n") <= k + 1)
    classes = few.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    classes = saved(classes.withColumn("rep", F.col("ids")[0]), "vectors")
    queries = saved(base.where("asked").groupBy("v").agg(F.min("id").alias("query")), "queries")
    n_queries = queries.count()
    rows, n_ids = classes.agg(F.count("*"), F.sum(F.size("ids"))).first()
    if not n_queries:
        return spark.createDataFrame([], schema)
    drawn = classes.select("v", "rep")
    if rows > FIT_ROWS:
        part = int(min(1.0, 1.2 * FIT_ROWS / rows) * (1 << 20)) + 1
        drawn = drawn.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < part)
    drawn = drawn.orderBy(F.xxhash64("rep"), "rep").limit(FIT_ROWS).collect()
    index = fit_index(np.array([r["v"] for r in drawn]), rows, k)
    lists = len(index.centres)

    def assign(batches):
        for b in batches:
            if len(b):
                x = np.stack(b["v"].to_numpy())
                b["list"] = index.order(x @ index.rotation, 1)[:, 0]
                yield b[["list", "rep", "ids", "v"]]

    placed = saved(classes.select("rep", "ids", "v").mapInPandas(assign, "list int, rep long, ids array<long>, v array<double>"), "lists")
    sizes = {r["list"]: r["count"] for r in placed.groupBy("list").count().collect()}
    parts = np.array([-(-sizes.get(i, 0) // CHUNK) for i in range(lists)])
    teams = max(1, -(-n_queries * index.probes // (lists * CHUNK)))

    home = index.order(index.seeds, 1)[:, 0]

    def probe(count: int, step: int):
        def run(batches):
            for b in batches:
                for at in range(0, len(b), step):
                    some = b.iloc[at : at + step]
                    x = np.stack(some["v"].to_numpy()) @ index.rotation
                    near = index.order(x, count)
                    # Only seeds in the probed lists bound a search: others are not met in it.
                    probed = np.zeros((len(x), lists), bool)
                    np.put_along_axis(probed, near, True, 1)
                    far = np.sort(np.where(probed[:, home], _squares(x, index.seeds), np.inf), 1)
                    bound = far[:, k + 1] if far.shape[1] > k + 1 else np.full(len(x), np.inf)
                    each = parts[near].sum(1)
                    yield pd.DataFrame({
                        "list": np.repeat(near.ravel(), parts[near].ravel()),
                        "part": np.concatenate([np.arange(p) for p in parts[near].ravel()]) if near.size else [],
                        "team": np.repeat(some["team"].to_numpy(), each),
                        "query": np.repeat(some["query"].to_numpy(), each),
                        "bound": np.repeat(bound, each),
                        "q": [v for v, e in zip(some["v"], each) for _ in range(e)],
                    })

        return run

    split = F.array(*[F.lit(int(p)) for p in np.maximum(parts, 1)])[F.col("list")]
    held = placed.select("list", F.pmod(F.xxhash64("rep"), split).cast("int").alias("part"), "rep", "ids", "v")
    held = held.select("*", F.explode(F.sequence(F.lit(0), F.lit(teams - 1))).alias("team"))

    def meet(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query": [], "id": [], "score": []}).astype({"query": "int64", "id": "int64", "score": float})
        if not len(q) or not len(c):
            return empty
        asked, there = np.stack(q["q"].to_numpy()), np.stack(c["v"].to_numpy())
        ids = c["ids"].to_numpy()
        found = scan(asked @ index.rotation, q["bound"].to_numpy() * (1 + 1e-9), there @ index.rotation, k + 1)
        out = []
        for query, vec, (at, d) in zip(q["query"], asked, found):
            if len(at) > k + 1:
                at = at[d <= np.partition(d, k)[k] * (1 + 1e-9) + 1e-12]
            score = np.sqrt(((there[at] - vec) ** 2).sum(1))
            pairs = sorted((s, i) for s, a in zip(score.tolist(), at.tolist()) for i in ids[a])
            out += [(query, i, s) for s, i in pairs[: k + 1]]
        return pd.DataFrame(out, columns=["query", "id", "score"]) if out else empty

    keys = ["list", "part", "team"]
    best = Window.partitionBy("query").orderBy("score", "id")

    def search(some: DataFrame, count: int, step: int) -> DataFrame:
        """(query, near): the k + 1 nearest in the `count` nearest lists, the query itself among them."""
        team = F.pmod(F.xxhash64("query"), F.lit(teams)).cast("int")
        sought = some.select("v", "query", team.alias("team"))
        sought = sought.mapInPandas(probe(count, step), "list int, part int, team int, query long, bound double, q array<double>")
        found = sought.groupBy(*keys).cogroup(held.groupBy(*keys)).applyInPandas(meet, "query long, id long, score double")
        found = found.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= k + 1)
        return found.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("near"))

    found = saved(search(queries, index.probes, 512), "found")
    enough = found.where(F.size("near") >= min(k + 1, n_ids))
    short = saved(queries.join(enough, "query", "left_anti"), "short")
    if short.limit(1).count():
        found = enough.union(search(short, lists, 16))
    names = base.where("asked").select("id", "v").join(queries, "v").select("id", "query").distinct()
    others = F.slice(F.filter("near", lambda x: x["id"] != F.col("id")), 1, k)
    out = names.join(found, "query").select(F.col("id").alias("query_id"), F.posexplode(others).alias("_p", "_x"))
    return out.select("query_id", (F.col("_p") + 1).cast("int").alias("rank"), F.col("_x.id").alias("vec_id"), F.col("_x.score").alias("score"))
