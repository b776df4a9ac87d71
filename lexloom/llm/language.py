"""Language identification by rank-order n-gram profiles and the out-of-place distance."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from lexloom.llm.common import held_out, pieces

#: n-grams of a profile, of languages and of documents.
PROFILE = 400
#: Documents a language's profile is counted on, about.
TRAIN_PER_LANGUAGE = 4_000
#: How sharply the score follows the distance (in units of the largest possible one).
SHARP = 25.0
UNKNOWN = "und"

_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    """Code point -> its lower-case letter, or 0 for what is no letter."""
    if not _LETTERS:
        out = np.zeros(0x110000, np.uint32)
        for i in range(0x110000):
            c = chr(i)
            if c.isalpha():
                low = c.lower()
                out[i] = ord(low) if len(low) == 1 else i
        _LETTERS.append(out)
    return _LETTERS[0]


def grams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram, count) of the letters of a text, n from 1 to 3, words padded by one blank each side.

    An n-gram is a number: 21 bits a character, blank 0. Both empty without letters.
    """
    nothing = np.zeros(0, np.int64)
    if not text:
        return nothing, nothing
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")].astype(np.int64)
    if not c.any():
        return nothing, nothing
    c = np.concatenate([[0], c, [0]])
    blank = c == 0
    c = c[np.concatenate([[True], ~(blank[1:] & blank[:-1])])]
    two = (c[:-1] << 21) | c[1:]
    three = (two[:-1] << 21) | c[2:]
    # What spans a blank in its middle joins two words and is left out.
    three = three[c[1:-1] != 0]
    keys = np.concatenate([c[c != 0], two, three])
    keys.sort()
    first = np.concatenate([[True], keys[1:] != keys[:-1]])
    at = np.nonzero(first)[0]
    return keys[at], np.diff(np.concatenate([at, [len(keys)]]))


def ranked(keys: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, ties by n-gram."""
    return keys[np.argsort(-counts, kind="stable")[:size]]


@dataclass
class Profiles:
    """Rank of every profile n-gram in each language; `size` where a language lacks it."""

    languages: list[str]
    keys: np.ndarray
    ranks: np.ndarray
    size: int

    def distance(self, text: str | None) -> np.ndarray | None:
        """Mean out-of-place distance to each language, from 0 to 1; None without letters."""
        keys, counts = grams(text)
        if not len(keys) or not self.languages:
            return None
        top = ranked(keys, counts, self.size)
        at = np.searchsorted(self.keys, top)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == top
        places = np.arange(len(top))[:, None]
        out = np.full((len(top), len(self.languages)), self.size)
        rank = self.ranks[at[known]]
        out[known] = np.where(rank < self.size, np.abs(rank - places[known]), self.size)
        return out.mean(0) / self.size

    def predict(self, text: str | None) -> tuple[str, float]:
        d = self.distance(text)
        if d is None:
            return UNKNOWN, 0.0
        p = np.exp(-SHARP * (d - d.min()))
        best = int(d.argmin())
        return self.languages[best], float(p[best] / p.sum())


def profiles(rows, size: int = PROFILE) -> Profiles:
    """Profiles from (language, n-gram, rank) rows."""
    languages = sorted({r[0] for r in rows})
    keys = np.unique(np.array([r[1] for r in rows], np.int64))
    ranks = np.full((len(keys), len(languages)), size)
    for lang, key, rank in rows:
        ranks[np.searchsorted(keys, key), languages.index(lang)] = rank
    return Profiles(languages, keys, ranks, size)


def fit_profiles(
    docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", size: int = PROFILE,
    bound: int = TRAIN_PER_LANGUAGE,
) -> Profiles:
    """Count n-grams of about `bound` training documents of each language and keep the top `size`.

    Documents that are held out (by key) or have a null text or language take no part.
    A language with more than `bound` documents is thinned by a hash of the key. Counts
    are summed inside tasks before they are shuffled.
    """
    known = docs.select(F.col(key).alias("k"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang"))
    known = known.where(F.col("lang").isNotNull() & F.col("k").isNotNull() & ~held_out("k"))
    sizes = known.groupBy("lang").count().collect()
    dense = [(r["lang"], int(bound / r["count"] * (1 << 20))) for r in sizes if r["count"] > bound]
    draw, stay = F.pmod(F.xxhash64("k"), F.lit(1 << 20)), F.lit(True)
    for name, part in dense:
        stay = stay & ((F.col("lang") != name) | (draw < part))
    known = known.where(stay & F.col("text").isNotNull())

    def count(batches):
        total: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def merge(name, keys, counts):
            if name in total:
                keys = np.concatenate([total[name][0], keys])
                counts = np.concatenate([total[name][1], counts])
            keys, at = np.unique(keys, return_inverse=True)
            total[name] = keys, np.bincount(at, counts, len(keys)).astype(np.int64)

        for b in pieces(batches, "text"):
            for name, group in b.groupby("lang"):
                found = [grams(t) for t in group["text"]]
                merge(name, np.concatenate([k for k, _ in found]), np.concatenate([c for _, c in found]))
        for name, (keys, counts) in total.items():
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                lang = pd.Series([name] * len(keys[part]), dtype=object)
                yield pd.DataFrame({"lang": lang, "gram": keys[part], "n": counts[part]})

    counts = known.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    counts = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    top = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= size)
    return profiles([(r["lang"], r["gram"], r["rank"] - 1) for r in top.collect()], size)


def identify(docs: DataFrame, model: Profiles, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score) of every row from its whole text.

    `und` with score 0 where the text is null or has no letter, or nothing was learned.
    Ties go to the language that comes first by name. Repeated rows are judged each;
    other columns are not read.
    """

    @F.pandas_udf("struct<lang:string,score:double>")
    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([model.predict(t) for t in texts], columns=["lang", "score"])

    out = docs.select(F.col(key), run(F.col(text)).alias("_p"))
    return out.select(key, F.col("_p.lang").alias("lang_pred"), F.col("_p.score").alias("score"))
