"""Mixing by soft membership: domain posteriors from a labelled table, document rates by projected gradient."""

from __future__ import annotations

import zlib
from collections.abc import Collection, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from lexloom.llm.common import held_out, one_text_per_key, saved, smallest

#: Labelled documents that the classifier is fitted on, at most.
TRAIN_ROWS = 6_000
BUCKETS = 1 << 15
#: Full-batch steps of the classifier, their size, and its pull towards zero.
LEARN, RATE, PULL = 150, 0.05, 1e-4
#: Projected-gradient steps, at most; fewer once the totals are met.
STEPS = 60
#: Relative error of the domain totals at which the steps end.
CLOSE = 1e-4
#: Pull towards rate 1, relative to the curvature of the fit.
RIDGE = 1e-6


_BUCKET: dict[str, int] = {}


def buckets_of(words: list[str]) -> np.ndarray:
    """Distinct hashed features of a document: word beginnings, and the ends of words with their marks."""
    known = _BUCKET
    if len(known) > 200_000:
        known.clear()
    out = set()
    for f in {w[:4] for w in words} | {"~" + w[-2:] for w in words}:
        b = known.get(f)
        if b is None:
            b = known[f] = zlib.crc32(f.encode("utf-8", "replace")) % BUCKETS
        out.add(b)
    return np.fromiter(out, np.int64, len(out))


@dataclass
class DomainModel:
    """Class names in the order of the posteriors; weights per bucket and class, and offsets."""

    domains: list[str]
    weights: np.ndarray
    offset: np.ndarray

    def predict(self, features: list[np.ndarray]) -> np.ndarray:
        out = np.stack([self.weights[f].sum(0) for f in features]) + self.offset if features else np.zeros((0, len(self.domains)))
        out = np.exp(out - out.max(1, keepdims=True, initial=-np.inf))
        return out / out.sum(1, keepdims=True)


def learn(features: list[np.ndarray], y: np.ndarray, domains: list[str]) -> DomainModel:
    """Multinomial logistic regression on hashed features, by Adam over the whole sample."""
    k, n = len(domains), len(features)
    if not k:
        return DomainModel(domains, np.zeros((BUCKETS, 0), np.float32), np.zeros(0))
    flat = np.concatenate(features) if n else np.zeros(0, np.int64)
    row = np.repeat(np.arange(n), [len(f) for f in features])
    used, at = np.unique(flat, return_inverse=True)
    share = np.bincount(y, minlength=k) + 0.5
    w, b = np.zeros((len(used), k)), np.log(share / share.sum())
    target = np.eye(k)[y]
    first, second = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, LEARN + 1):
        z = np.stack([np.bincount(row, w[at, d], n) for d in range(k)], 1) + b
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        off = (p - target) / n
        g = np.stack([np.bincount(at, off[row, d], len(used)) for d in range(k)], 1) + PULL * w
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        w -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        b -= off.sum(0)
    weights = np.zeros((BUCKETS, k), np.float32)
    weights[used] = w
    return DomainModel(domains, weights, b)


def fit_domains(
    docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text", domain: str = "domain",
    bound: int = TRAIN_ROWS,
) -> DomainModel:
    """Fit on at most `bound` documents of the labelled table (key, domain) that are not held out.

    Null keys and domains take no part. A key with several domains takes the smallest;
    of documents repeated under one key, that of the smallest hash of the text counts.
    Only domains seen in documents count; with one, its posterior is 1, and there is none
    without labels. Executors hash the features; the driver sees those of the sample.
    """
    spark = docs.sparkSession
    known = (
        labelled.select(F.col(key).alias("k"), F.col(domain).cast("string").alias("d"))
        .where(F.col("k").isNotNull() & F.col("d").isNotNull() & ~held_out("k"))
        .groupBy("k").agg(F.min("d").alias("d"))
    )
    rows = smallest(known, bound, "k")
    sample = spark.createDataFrame([(r["k"], r["d"]) for r in rows], f"k {dict(known.dtypes)['k']}, d string")
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(sample), "k")
    texts = one_text_per_key(texts).select("text", "d")

    def hashed(batches):
        for b in batches:
            found = [np.sort(buckets_of((t or "").split())) for t in b["text"]]
            yield pd.DataFrame({"d": b["d"], "f": pd.Series(found, dtype=object)})

    seen = sorted((r["d"], r["f"]) for r in texts.mapInPandas(hashed, "d string, f array<int>").collect())
    domains = sorted({d for d, _ in seen})
    y = np.array([domains.index(d) for d, _ in seen], np.int64)
    return learn([np.array(f, np.int64) for _, f in seen], y, domains)


def posterior(text: Column, model: DomainModel) -> Column:
    """struct<tokens, posterior> of each whole text; tokens are white-space words, none of a null text."""

    @F.pandas_udf("struct<tokens:long,posterior:array<double>>")
    def run(texts: pd.Series) -> pd.DataFrame:
        sizes, features = [], []
        for t in texts:
            words = (t or "").split()
            sizes.append(len(words))
            features.append(buckets_of(words).astype(np.int32))
        p = model.predict(features).astype(float)
        return pd.DataFrame({"tokens": pd.Series(sizes, dtype="int64"), "posterior": pd.Series(list(p), dtype=object)})

    return run(text)


def posteriors(docs: DataFrame, model: DomainModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, tokens, posterior) of every row; posterior is an array in the order of the domains."""
    out = docs.select(F.col(key).alias("_mix_key"), posterior(F.col(text), model).alias("_mix"))
    return out.select(F.col("_mix_key").alias(key), "_mix.tokens", "_mix.posterior")


def _totals(weights: DataFrame, rate: Column, k: int) -> np.ndarray:
    """Expected tokens of each domain at these rates."""
    row = weights.agg(*[F.sum(rate * F.col("tokens") * F.col("posterior")[d]) for d in range(k)]).first()
    return np.array([float(v or 0) for v in row])


def _rate(duals: np.ndarray, posterior: str = "posterior") -> Column:
    pull = F.lit(1.0)
    for d, v in enumerate(duals):
        pull = pull + F.lit(float(v)) * F.col(posterior)[d]
    return F.greatest(pull, F.lit(0.0))


def fit_rates(weights: DataFrame, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Projected-gradient least squares; returns what describes the rates, and the totals they reach.

    Minimises the squared error of the domain totals over nonnegative document rates,
    starting from rate 1. Steps are taken in the metric of the documents' tokens, so a
    step changes a rate by a combination of its posteriors: the K numbers that hold the
    sum of all steps describe every rate, and an iteration is one aggregation of K sums
    over the documents. The step length is that of Barzilai and Borwein, after a first
    step bounded by the curvature sum(tokens * p * p').
    """
    k = len(targets)
    names = [(a, b) for a in range(k) for b in range(a, k)]
    p = F.col("posterior")
    row = weights.agg(*[F.sum(F.col("tokens") * p[a] * p[b]) for a, b in names]).first()
    curve = np.zeros((k, k))
    for (a, b), v in zip(names, row):
        curve[a, b] = curve[b, a] = float(v or 0)
    if not curve.any():
        return np.zeros(k), np.zeros(k)
    # Errors are taken in units of each domain's tokens at rate 1, so that rare domains count too.
    unit = 1 / np.sqrt(np.maximum(curve.diagonal(), 1e-9))
    scaled = curve * unit[:, None] * unit[None, :]
    x = np.zeros(k)
    total = _totals(weights, _rate(x), k)
    error = (total - targets) * unit
    step = 1 / np.linalg.eigvalsh(scaled)[-1]
    best, best_total, least = x, total, np.inf
    for _ in range(STEPS):
        size = float(np.abs((total - targets) / np.maximum(targets, targets.sum() * 1e-3)).max())
        if size < least:
            best, best_total, least = x, total, size
        if size < CLOSE:
            break
        gradient = error + RIDGE * x / unit
        nxt = x - step * unit * gradient
        total = _totals(weights, _rate(nxt), k)
        new_error = (total - targets) * unit
        moved, turned = (nxt - x) / unit, new_error - error + RIDGE * (nxt - x) / unit
        if turned @ turned < 1e-30:
            break
        step = max(1e-3, abs(float(moved @ turned)) / float(turned @ turned))
        x, error = nxt, new_error
    return best, best_total


def goals(share: np.ndarray, there: np.ndarray, ceiling: np.ndarray) -> np.ndarray:
    """Tokens to keep of each domain without repeating any: the most that no share is missed for.

    The shares of domains with a `ceiling` are upper bounds: the others alone say how much
    stays, and these give the smaller of their share of it all and what is there. Where
    no other domain has a share, ceilings count as shares.
    """
    firm = (share > 0) & ~ceiling
    if not firm.any():
        firm = share > 0
    out = np.where(firm, share * (there[firm] / share[firm]).min(), 0.0)
    full = ~firm & (share > 0)
    # What a short domain leaves unused lowers the total that the shares of others are of.
    for d in sorted(np.nonzero(full)[0], key=lambda d: there[d] / share[d]):
        total = out[~full].sum() / (1 - share[full].sum())
        out[d] = min(there[d], share[d] * total)
        full[d] = False
    return out


def _fitted(
    weights: DataFrame, model: DomainModel, targets: Mapping[str, float], repeats: bool, ceilings: Collection[str],
) -> np.ndarray | None:
    share = np.array([float(targets.get(d, 0.0)) for d in model.domains])
    if not model.domains or share.sum() <= 0:
        return None
    share = share / share.sum()
    there = _totals(weights, F.lit(1.0), len(share))
    if repeats:
        return fit_rates(weights, share * there.sum())[0]
    return fit_rates(weights, goals(share, there, np.array([d in ceilings for d in model.domains])))[0]


def mix(
    docs: DataFrame, model: DomainModel, targets: Mapping[str, float], key: str = "doc_id", text: str = "text",
    repeats: bool = True, ceilings: Collection[str] = (),
) -> DataFrame:
    """(key, tokens, posterior, rate) of every row: how often a document should be seen.

    Rates are nonnegative and their expected domain totals meet the targets: shares of as
    many tokens as `docs` have, or, without `repeats`, of the most that no domain must be
    repeated for; the shares of `ceilings` are then upper bounds, so that a rare domain of
    these takes nothing from the others. Shares of domains the model does not know
    are left out and the others scaled up; a known domain without a share has target
    zero; without any share all rates are 1. Documents without words get the rate of
    their posterior and add nothing. Repeated rows get the same rate.
    """
    weights = saved(posteriors(docs, model, key, text), "posteriors")
    duals = _fitted(weights, model, targets, repeats, ceilings)
    return weights.withColumn("rate", F.lit(1.0) if duals is None else _rate(duals))


def resample(
    docs: DataFrame, model: DomainModel, targets: Mapping[str, float], key: str = "doc_id", text: str = "text",
    repeats: bool = True, seed: int = 0, ceilings: Collection[str] = (),
) -> DataFrame:
    """Rows of `docs` as often as their rates say, all columns kept; texts are scored once and never shuffled."""
    scored = saved(docs.withColumn("_mix", posterior(F.col(text), model)), "scored")
    duals = _fitted(scored.select("_mix.tokens", "_mix.posterior"), model, targets, repeats, ceilings)
    if duals is None:
        return docs
    out = scored.withColumn("_mix_times", copies(_rate(duals, "_mix.posterior"), F.col(key), seed))
    again = F.explode(F.array_repeat(F.lit(1), F.col("_mix_times"))).alias("_mix_one")
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], again).drop("_mix_one")


def copies(rate: Column, key: Column, seed: int = 0) -> Column:
    """Whole copies of a document for its rate: the rest of it decides by a draw from the key."""
    draw = F.pmod(F.xxhash64(F.lit(seed), key), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("int")).cast("int")
