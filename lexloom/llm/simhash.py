"""SimHash near-duplicates: a byte-position index with count filtering, exact for the stated radius."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from lexloom.llm.common import saved

WORDS = 4
RADIUS = 4
SEED = 42
BYTES = 8
#: Pairs of fingerprints compared at once.
BLOCK_PAIRS = 500_000
#: Stars that a group under one key is cut into at most, and members that need none.
STARS, LEAST_STAR = 64, 256
#: Fingerprints under one key that one task compares, at most; larger groups are split.
SLOT = 32_768
#: Links of one node that meet in one task, at most, and nodes with more, at most.
LEAST_HUB, HUBS = 1_024, 100_000
#: Links that a task and a file hold in a round, about.
ROUND_LINKS = 250_000


def _shingle_hashes(text: str | None, words: int, seed: int) -> np.ndarray:
    """XXH64 of each word shingle, repeats included; none without words.

    A-Z are lowered; words are separated by ASCII white space; a text with fewer than
    `words` words is one shingle.
    """
    parts = (text or "").encode("utf-8", "replace").lower().split()
    n = len(parts)
    if not n:
        return np.zeros(0, "<u8")
    joined = b" ".join(parts)
    hash64 = xxhash.xxh64_intdigest
    if n <= words:
        return np.array([hash64(joined, seed)], "<u8")
    lengths = np.fromiter(map(len, parts), np.int64, n)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
    ends = (starts + lengths)[words - 1 :].tolist()
    return np.array([hash64(joined[a:b], seed) for a, b in zip(starts.tolist(), ends)], "<u8")


def _majority(h: np.ndarray) -> int:
    """The bits that more than half of the hashes have, as a signed number."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 65_536):
        octets = h[at : at + 65_536].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(h), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """64-bit SimHash of word shingles as a signed number; zero for a text without words, or null.

    A bit is 1 if more than half of the shingles' XXH64 have it, repeats included.
    """
    return _majority(_shingle_hashes(text, words, seed))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """(key, fp) of every row, whole texts."""

    @F.pandas_udf("long")
    def mark(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    return docs.select(F.col(key), mark(F.col(text)).alias("fp"))


def _masks(radius: int) -> list[tuple[int, tuple[int, ...]]]:
    """Byte positions of each key: one byte less than fingerprints within `radius` share at least."""
    if not 0 <= radius < BYTES:
        raise ValueError("the byte index is exact for 0 to 7 differing bits")
    return list(enumerate(combinations(range(BYTES), max(1, BYTES - radius - 1))))


def roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest member reachable by the links a[i] - b[i] among 0 .. n - 1."""
    parent = np.arange(n)
    while True:
        low = np.minimum(parent[a], parent[b])
        before = parent.copy()
        np.minimum.at(parent, parent[a], low)
        np.minimum.at(parent, parent[b], low)
        np.minimum.at(parent, a, low)
        np.minimum.at(parent, b, low)
        while True:
            up = parent[parent]
            if (up == parent).all():
                break
            parent = up
        if (parent == before).all():
            return parent


def tally(apart: np.ndarray) -> np.ndarray:
    """Positional bytes that two fingerprints share, from their differing bits."""
    t = apart | (apart >> np.uint64(4))
    t |= t >> np.uint64(2)
    t |= t >> np.uint64(1)
    return BYTES - np.bitwise_count(t & np.uint64(0x0101010101010101))


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in a and in b of pairs that share the guaranteed number of bytes and differ in at most `radius` bits.

    Bytes are tallied for all pairs that meet; bits are counted of those that reach the number.
    """
    apart = a[:, None] ^ b[None]
    i, j = np.nonzero(tally(apart) >= BYTES - radius)
    near = np.bitwise_count(apart[i, j]) <= radius
    return i[near], j[near]


def forest(fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same members as all pairs within `radius` bits.

    `fps` are distinct; places of linked members come back, fewer than n
    links. Members near one pivot are connected through it, so in a dense group only
    stars whose members are not yet connected, and members of no star, are compared with
    others, block by block. No pair is left out: two stars are compared until a link is found.
    """
    n = len(fps)
    parent = np.arange(n)

    def join(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal parent
        if len(a):
            parent = roots(np.concatenate([a, np.arange(n)]), np.concatenate([b, parent]), n)

    free, stars = np.arange(n), []
    while len(free) > LEAST_STAR and len(stars) < STARS:
        near = np.zeros(len(free), bool)
        near[0] = True
        near[near_pairs(fps[free[:1]], fps[free], radius)[1]] = True
        stars.append(free[near])
        free = free[~near]
        join(stars[-1][1:], np.full(len(stars[-1]) - 1, stars[-1][0]))
    step = max(1, BLOCK_PAIRS // n)
    for at in range(0, len(free), step):
        part = free[at : at + step]
        i, j = near_pairs(fps[part], fps, radius)
        join(part[i], j)
    for x, one in enumerate(stars):
        for other in stars[x + 1 :]:
            for at in range(0, len(one), step):
                if parent[one[0]] == parent[other[0]]:
                    break
                i, j = near_pairs(fps[one[at : at + step]], fps[other], radius)
                join(one[at : at + step][i[:1]], other[j[:1]])
    child = np.nonzero(parent != np.arange(n))[0]
    return child, parent[child]


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b): links that leave the same components as all pairs of `fp` within `radius` bits.

    Every fingerprint is posted under each choice of byte positions, one fewer than a pair
    within `radius` shares for certain (the guaranteed minimum of matches). Those that meet
    under a key are tallied byte by byte; pairs that reach the minimum are verified. Keys of
    more than SLOT fingerprints are found on the way and dealt out again: their fingerprints
    fall into blocks, and each two blocks meet in a task.
    """
    index = F.array(*[
        F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(_signed(sum(0xFF << (8 * p) for p in positions)))))
        for k, positions in _masks(radius)
    ])
    posted = distinct.select(F.explode(index).alias("slot"), F.col("fp").alias("node"))
    found = saved(_meet(posted, radius, SLOT), "pairs")
    # At most one row for SLOT postings.
    full = found.where("full").select(F.col("a").alias("slot"), F.ceil(2 * F.col("b") / SLOT).cast("int").alias("blocks"))
    out = found.where("not full").select("a", "b")
    if full.limit(1).count():
        block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
        dealt = posted.join(F.broadcast(full), "slot").withColumn("one", block)
        dealt = dealt.select("slot", "node", "one", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("two"))
        teams = dealt.select(F.xxhash64("slot", F.least("one", "two"), F.greatest("one", "two")).alias("slot"), "node")
        out = out.union(_meet(teams, radius, None).select("a", "b"))
    return out.distinct()


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _meet(posted: DataFrame, radius: int, most: int | None) -> DataFrame:
    """(a, b, full) from (slot, node) postings: links under any slot, and (slot, size, true) of slots of more than `most`."""
    posted = posted.repartition("slot").sortWithinPartitions("slot", "node")

    def run(batches):
        slots = nodes = np.zeros(0, np.int64)
        passed = 0  # size so far of a slot that is too large; its slot stays as the last one seen
        last = None
        for b in batches:
            if not len(b):
                continue
            s, n = b["slot"].to_numpy(), b["node"].to_numpy()
            if passed:
                cut = int(np.searchsorted(s, last, "right"))
                passed += cut
                s, n = s[cut:], n[cut:]
                if not len(s):
                    continue
                yield pd.DataFrame({"a": [last], "b": [passed], "full": [True]})
                passed = 0
            slots, nodes = np.concatenate([slots, s]), np.concatenate([nodes, n])
            whole = int(np.searchsorted(slots, slots[-1]))
            if whole:
                yield _met(slots[:whole], nodes[:whole], radius)
                slots, nodes = slots[whole:], nodes[whole:]
            if most is not None and len(slots) > most:
                last, passed = slots[0], len(slots)
                slots = nodes = np.zeros(0, np.int64)
        if passed:
            yield pd.DataFrame({"a": [last], "b": [passed], "full": [True]})
        if len(slots):
            yield _met(slots, nodes, radius)

    return posted.mapInPandas(run, "a long, b long, full boolean")


def _met(slots: np.ndarray, nodes: np.ndarray, radius: int) -> pd.DataFrame:
    """Links within each run of equal slots; a node that comes twice counts once."""
    once = np.ones(len(slots), bool)
    once[1:] = (slots[1:] != slots[:-1]) | (nodes[1:] != nodes[:-1])
    slots, nodes = slots[once], nodes[once]
    fps = np.ascontiguousarray(nodes).view(np.uint64)
    edge = np.nonzero(slots[1:] != slots[:-1])[0] + 1
    first = np.concatenate([[0], edge])
    size = np.diff(np.concatenate([first, [len(slots)]]))
    pair = first[size == 2]
    apart = fps[pair] ^ fps[pair + 1]
    enough = tally(apart) >= BYTES - radius
    pair = pair[enough][np.bitwise_count(apart[enough]) <= radius]
    a, b = [nodes[pair + 1]], [nodes[pair]]
    for at, k in zip(first[size > 2].tolist(), size[size > 2].tolist()):
        child, root = forest(fps[at : at + k], radius)
        a.append(nodes[at + child])
        b.append(nodes[at + root])
    return pd.DataFrame({"a": np.concatenate(a), "b": np.concatenate(b), "full": False})


def _with_lowest(rows: DataFrame, low: DataFrame, links: int) -> DataFrame:
    """`rows` with the lowest neighbour of `a`, from (a, low, n).

    Nodes of very many links are few, so their lowest neighbours go to the rows; the rows of
    other nodes go to the lowest neighbours.
    """
    hub = max(LEAST_HUB, links // HUBS)
    # At most HUBS rows: each stands for more than links / HUBS links (two ends each).
    hubs = F.broadcast(low.where(F.col("n") > 2 * hub).select("a", F.col("low").alias("_low")))
    rows = rows.join(hubs, "a", "left")
    there = rows.where(F.col("_low").isNotNull()).withColumnRenamed("_low", "low")
    return there.union(rows.where(F.col("_low").isNull()).drop("_low").join(low.drop("n"), "a"))


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Alternates contraction inside partitions with star contraction across them; each
    round is written to the shared folder, so lost executors cost one round at most.
    """
    def contract(batches):
        a = [np.zeros(0, np.int64)]
        b = [np.zeros(0, np.int64)]
        for batch in batches:
            a.append(batch["a"].to_numpy())
            b.append(batch["b"].to_numpy())
        a, b = np.concatenate(a), np.concatenate(b)
        nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        parent = roots(at[: len(a)], at[len(a) :], len(nodes))
        child = parent != np.arange(len(nodes))
        yield pd.DataFrame({"a": nodes[child], "b": nodes[parent[child]]})

    current = saved(edges.where("a <> b").mapInPandas(contract, "a long, b long"), "links")
    for _ in range(rounds):
        count = current.count()
        if not count:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        # Links get fewer from round to round; so do the files that a round writes and reads.
        files = -(-count // ROUND_LINKS)
        # Large star: neighbours above a node move to the smallest around it.
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"), F.count("*").alias("n"))
        large = _with_lowest(both.where("b > a"), low, count).select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = saved(large.distinct().coalesce(files), "links")
        # Small star: neighbours below a node, and the node, move to the smallest of them.
        low = large.groupBy("a").agg(F.min("b").alias("low"), F.count("*").alias("n"))
        small = _with_lowest(large, low, count).where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.union(low.select("a", F.col("low").alias("b"))).distinct()
        current = saved(small.coalesce(files).mapInPandas(contract, "a long, b long"), "links")
        twice = current.groupBy("a").count().where("count > 1").select("a")
        chained = current.join(current.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a")
        if not twice.union(chained).limit(1).count():
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    raise RuntimeError("links did not settle")


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """(key, fp, component): each row's fingerprint and the smallest key reachable over links.

    Rows link if their fingerprints differ in at most `radius` bits. Equal fingerprints
    are one node, so copies cost one row however many there are. Null or blank texts have
    fingerprint zero and link like any other; a null key stays in the result but is never
    a component's name unless all keys are null. Repeated rows are returned each.
    """
    marked = saved(fingerprints(docs, key, text, words), "fingerprints")
    first = marked.groupBy("fp").agg(F.min(key).alias("first"))
    return marked.join(_classes(first, radius), "fp").select(key, "fp", F.col("first").alias("component"))


def _classes(first: DataFrame, radius: int) -> DataFrame:
    """(fp, first): the smallest `first` among all fingerprints that each of (fp, first) reaches."""
    first = saved(first, "distinct")
    nodes = components(links(first.select("fp"), radius)).withColumnRenamed("node", "fp")
    named = first.join(nodes, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = named.groupBy("root").agg(F.min("first").alias("first"))
    return named.select("fp", "root").join(smallest, "root").select("fp", "first")


def drop_near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """One row of each group of `near_duplicates`, with all its columns.

    The row with the smallest key stays (no key comes last), of those the one with the
    smallest digest of its text, of equal rows any one. Groups are of rows, not of keys: a
    key may stay in several groups, or in none. An empty table stays empty.
    """

    @F.pandas_udf("long")
    def mark(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, words) for t in texts], dtype="int64")

    # Rows are stored with a name of their own, so that one of them can be told from its copies.
    rows = saved(docs.select(F.struct("*").alias("row"), mark(F.col(text)).alias("fp"), F.expr("uuid()").alias("name")), "rows")
    order = F.struct(F.col(f"row.{key}").isNull().alias("none"), F.col(f"row.{key}").alias("key"), F.xxhash64(f"row.{text}").alias("text"), "name")
    first = rows.groupBy("fp").agg(F.min(order).alias("first"))
    kept = _classes(first, radius).select(F.col("first.name").alias("name")).distinct()
    return rows.join(kept, "name", "left_semi").select("row.*")


def hex_digits(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
