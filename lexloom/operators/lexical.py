"""Word profiles, diversity, readability, n-grams and lexical richness."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window, functions as F, types

from lexloom.functions import text as T
from lexloom.functions.columns import count_if, let, long_sum, no_strings, ratio
from lexloom.operators.labels import flag_new
from lexloom.operators.scan import is_vocabulary, join_vocabulary, null_safe_join, prefix_sum
from lexloom.session import materialise
from lexloom.vocab import STOPWORDS

if TYPE_CHECKING:
    import pyarrow as pa

GROUP_LIMIT = 1_000  # up to so many rows a group, Spark limits groups before it shuffles them
TIED = 100_000  # words of one count that one task puts in order, at most, if k is small
MIN_SLOTS = 65_536  # hash slots that n-grams of a group are added up in, at least
MAX_SLOTS = 200_000  # slots, with their group, that are sent to every task
PIECE = 8_000_000  # bytes of lines whose n-grams are added up at once, before they are sent on
PIECE_WORDS = 1 << 21  # words of a line whose n-grams are added up at once
BATCH_ROWS = 50_000  # n-grams handed back to Spark at once
CHUNK = 10_000  # neighbouring texts ranked together when n-grams may cross text ends


def tokenize(df: DataFrame, text: str = "text") -> DataFrame:
    """Add `tokens`."""
    return df.withColumn("tokens", T.tokens(F.col(text)))


def is_stopword(word: Column, stopwords: Sequence[str] = STOPWORDS) -> Column:
    return word.isin(*stopwords)


def content_tokens(tokens: Column, stopwords: Sequence[str] | None) -> Column:
    return tokens if not stopwords else F.filter(tokens, lambda w: ~is_stopword(w, stopwords))


def word_counts(df: DataFrame, by: Sequence[str] = (), stopwords: Sequence[str] | None = None) -> DataFrame:
    """Frequency of each word per group."""
    words = df.select(*by, F.explode(T.tokens(F.col("text"))).alias("word"))
    if stopwords:
        words = words.where(~is_stopword(F.col("word"), stopwords))
    return words.groupBy(*by, "word").agg(F.count("*").alias("n"))


def roll_up(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Coarser word counts from finer ones."""
    return counts.groupBy(*by, "word").agg(F.sum("n").alias("n"))


def token_stats(counts: DataFrame, by: Sequence[str] = (), stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Tokens, types and hapaxes per group, with and without stopwords."""
    content = ~is_stopword(F.col("word"), stopwords)
    return counts.groupBy(*by).agg(
        long_sum(F.col("n")).alias("tokens"),
        F.count("*").alias("types"),
        long_sum(F.when(content, F.col("n"))).alias("content_tokens"),
        count_if(content).alias("content_types"),
        count_if(F.col("n") == 1).alias("hapaxes"),
    )


def top_words(counts: DataFrame, by: Sequence[str] = (), k: int = 30) -> DataFrame:
    """The k most frequent words per group; ties in word order.

    For a large k the numbers of words by count tell from which count on a word can be among
    them; only those words, and of the words of the last count only as many as are missing,
    meet in a group's task. No task sorts a vocabulary however large k is.
    """
    if not by:
        return counts.orderBy(F.desc("n"), "word").limit(k)
    if k > GROUP_LIMIT:
        counts = _likely(materialise(counts.select(*by, "word", "n")), by, k)
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("n"), "word"))
    return counts.withColumn("rank", rank).where(F.col("rank") <= k)


def _likely(counts: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """Words above the count at which a group's k are full, and the first few of those at it."""
    spectrum = counts.groupBy(*by, "n").agg(F.count("*").alias("words"))
    higher = Window.partitionBy(*by).orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    spectrum = spectrum.withColumn("above", F.coalesce(F.sum("words").over(higher), F.lit(0)))
    last = spectrum.where(F.col("above") < k).groupBy(*by).agg(
        F.min("n").alias("_last"), (k - F.max("above")).alias("_missing"), F.min_by("words", "n").alias("_tied")
    )
    last = materialise(last)
    few = F.broadcast(last) if is_vocabulary(last) else last
    likely = null_safe_join(counts, few, by).where(F.col("n") >= F.col("_last"))
    tied = likely.where(F.col("n") == F.col("_last"))
    most = last.agg(F.max("_tied")).first()[0] or 0
    # Very many words of one count are dealt over tasks, each keeps as many as are missing, and so on.
    room, salt = max(TIED, 20 * k), 0
    while most > room:
        parts = -(-most // room)
        part = F.pmod(F.xxhash64("word", F.lit(salt)), F.lit(parts))
        place = F.row_number().over(Window.partitionBy(*by, part).orderBy("word"))
        tied = tied.withColumn("_place", place).where(F.col("_place") <= F.col("_missing")).drop("_place")
        most, salt = parts * k, salt + 1
    sure = likely.where(F.col("n") > F.col("_last"))
    return sure.unionByName(tied).drop("_last", "_missing", "_tied")


def ttr(counts: DataFrame, by: Sequence[str] = (), stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Types per token, with and without stopwords."""
    s = token_stats(counts, by, stopwords)
    return s.select(
        *by,
        ratio(F.col("types"), F.col("tokens")).alias("ttr"),
        ratio(F.col("content_types"), F.col("content_tokens")).alias("ttr_content"),
    )


def hapax_ratio(counts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return counts.groupBy(*by).agg(
        F.count("*").alias("types"), count_if(F.col("n") == 1).alias("hapaxes")
    ).withColumn("hapax_ratio", ratio(F.col("hapaxes"), F.col("types")))


def msttr(
    df: DataFrame, key: str, by: Sequence[str] = (), segment: int = 1000, stopwords: Sequence[str] | None = None
) -> DataFrame:
    """Mean type/token ratio of the full segments of the corpus-long token stream.

    Texts follow each other in the order of `key`, which is numeric and unique. Bounds and
    offsets of ranges of keys come from keys and token counts alone; the words of the
    texts are shuffled once, to their range. There they get their places and the segments
    inside a range are counted; only pieces of segments that cross the ends of a range are
    sent on. Without a full segment the plain ratio of the short one stands in.
    """

    def measured(text: str) -> Column:
        tokens = content_tokens(T.tokens(F.col(text)), stopwords)
        return let(tokens, lambda t: F.struct(F.size(t).cast("bigint").alias("n_tokens"), F.array_join(t, " ").alias("line")))

    sizes = materialise(df.select(*by, key, measured("text")["n_tokens"].alias("n_tokens")))
    lines = df.select(*by, key, F.inline(F.array(measured("text")))).where(F.col("n_tokens") > 0)
    narrow = sizes.where(F.col("n_tokens") > 0)
    placed = prefix_sum(lines, key, ["n_tokens"], by, narrow=narrow, keep_place=True)
    start, end = F.col("n_tokens_before"), F.col("n_tokens_before") + F.col("n_tokens")
    pieces = placed.withColumn(
        "segment", F.explode(F.sequence(F.floor(start / segment), F.floor((end - 1) / segment)))
    )
    low = F.greatest(F.col("segment") * segment - start, F.lit(0))
    high = F.least((F.col("segment") + 1) * segment - start, F.col("n_tokens"))
    pieces = pieces.select(
        *by,
        "_place",
        "segment",
        (high - low).alias("size"),
        F.array_distinct(F.slice(F.split("line", " "), (low + 1).cast("int"), (high - low).cast("int"))).alias("words"),
    )
    # The first grouping needs no shuffle, rows stand by range already; the second gets
    # the words of a segment only where it crosses a range.
    gathered = F.array_distinct(F.flatten(F.collect_list("words")))
    inside = pieces.groupBy(*by, "_place", "segment").agg(F.sum("size").alias("size"), gathered.alias("words"))
    whole = F.col("size") == segment
    inside = inside.select(
        *by, "segment", "size", F.when(whole, F.size("words")).alias("n"),
        F.when(~whole, F.col("words")).otherwise(no_strings()).alias("words"),
    )
    segments = inside.groupBy(*by, "segment").agg(
        F.sum("size").alias("size"), F.coalesce(F.max("n"), F.size(gathered)).alias("types")
    )
    full = F.col("size") == segment
    value = F.col("types") / F.col("size")
    found = segments.groupBy(*by).agg(
        count_if(full).alias("segments"), F.coalesce(F.avg(F.when(full, value)), F.max(value)).alias("msttr")
    )
    if not by:
        return found.select("segments", F.coalesce("msttr", F.lit(0.0)).alias("msttr"))
    groups = sizes.select(*by).distinct()
    return null_safe_join(groups, found, by, "left").select(
        *by, F.coalesce("segments", F.lit(0)).alias("segments"), F.coalesce("msttr", F.lit(0.0)).alias("msttr")
    )


def text_ttr(df: DataFrame) -> DataFrame:
    """Add each text's own type/token ratio."""
    value = let(T.tokens(F.col("text")), lambda t: ratio(F.size(F.array_distinct(t)), F.size(t)))
    return df.withColumn("text_ttr", value)


def ttr_by_group(df: DataFrame, by: str, k: int = 20, counts: DataFrame | None = None) -> DataFrame:
    """Type/token ratio per group, the k highest and the k lowest; from word counts per group if given."""
    per_group = materialise(ttr(word_counts(df, [by]) if counts is None else counts, [by]).select(by, "ttr"))
    top = per_group.orderBy(F.desc("ttr"), by).limit(k).withColumn("end", F.lit("top"))
    bottom = per_group.orderBy("ttr", by).limit(k).withColumn("end", F.lit("bottom"))
    return top.unionByName(bottom)


QUALITY = ("avg_word_len", "punct_ratio", "upper_ratio", "digit_ratio", "flesch_kincaid", "coleman_liau")


def text_quality(df: DataFrame) -> DataFrame:
    """Add word length, character-class ratios and both readability grades per text."""
    text = F.col("text")
    chars = F.char_length(text)
    measured = df.withColumns(
        {
            "_words": T.count_words(text),
            "_sentences": T.count_sentences(text),
            "_chars": F.greatest(chars, F.lit(1)),
            "_in_words": T.length_without(T.spaced(text), T.BLANK_RUN),
            "_punct": chars - T.length_without(text, T.PUNCTUATION + "+"),
            "_upper": chars - T.length_without(text, T.UPPER + "+"),
            "_digits": T.count_digits(text),
            "_letters": T.length_without(text, rf"\P{{L}}+"),
        }
    ).withColumn("_syllables", T.count_syllables(text, F.col("_words")))
    words, sentences = F.col("_words"), F.col("_sentences")
    out = measured.withColumns(
        {
            "avg_word_len": ratio(F.col("_in_words"), words),
            "punct_ratio": F.col("_punct") / F.col("_chars"),
            "upper_ratio": F.col("_upper") / F.col("_chars"),
            "digit_ratio": F.col("_digits") / F.col("_chars"),
            "flesch_kincaid": T.flesch_kincaid(words, sentences, F.col("_syllables")),
            "coleman_liau": T.coleman_liau(F.col("_letters"), words, sentences),
        }
    )
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def quality_by_genre(df: DataFrame, genres: DataFrame, by: str = "genre") -> DataFrame:
    """Mean readability and word length per genre with the new flag."""
    cols = ("flesch_kincaid", "coleman_liau", "avg_word_len")
    means = text_quality(df).groupBy(by).agg(*[F.avg(c).alias(c) for c in cols])
    return flag_new(means, genres, by).orderBy("flesch_kincaid", by)


def _counted(n: int):
    """For mapInArrow: (groups, line) to (groups, ngram, n), added up over pieces of neighbouring lines.

    Words of a piece become numbers, an n-gram one number of its group and words, and equal
    numbers are counted. A line longer than a piece is counted by runs of PIECE_WORDS words.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def numbers(column) -> tuple:
            found = column.dictionary_encode("encode")
            return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), len(found.dictionary)

        def pieces() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                batch = batch.filter(pc.not_equal(batch["line"], ""))
                ends, start = np.cumsum(pc.binary_length(batch["line"]).to_numpy(), dtype=np.int64), 0
                while start < len(batch):
                    done = ends[start - 1] if start else 0
                    stop = max(start + 1, int(ends.searchsorted(done + PIECE, "right")))
                    yield batch.slice(start, stop - start)
                    start = stop

        for batch in pieces():
            *groups, lines = batch.columns
            words = pc.split_pattern(lines, " ")
            row = pc.list_parent_indices(words).to_numpy().astype(np.int64)
            words = words.flatten()
            group, size = np.zeros(len(batch), np.int64), 1
            for column in groups:
                if pa.types.is_nested(column.type):  # rows apart are added up later
                    group, size = np.arange(len(batch)), len(batch)
                    break
                ids, kinds = numbers(column)
                group, size = np.unique(group * kinds + ids, return_inverse=True)[1], min(size * kinds, len(batch))
            for start in range(0, len(words) - n + 1, PIECE_WORDS):
                part = words.slice(start, PIECE_WORDS + n - 1)
                ids, kinds = numbers(part)
                at = np.arange(len(part) - n + 1)
                at = at[row[start + at] == row[start + at + n - 1]]
                code, bound = group[row[start + at]], size
                for shift in range(n):
                    if bound * kinds >= 1 << 62:
                        code, bound = np.unique(code, return_inverse=True)[1], len(code)
                    code, bound = code * kinds + ids[at + shift], bound * kinds
                _, first, total = np.unique(code, return_index=True, return_counts=True)
                at = at[first]
                grams = pc.binary_join_element_wise(*[part.take(pa.array(at + i)) for i in range(n)], " ")
                of = pa.array(row[start + at])
                found = pa.RecordBatch.from_arrays(
                    [*[c.take(of) for c in groups], grams, pa.array(total, pa.int64())],
                    names=[*batch.schema.names[:-1], "ngram", "n"],
                )
                for low in range(0, len(found), BATCH_ROWS):
                    yield found.slice(low, BATCH_ROWS)

    return count


def ngrams(
    df: DataFrame,
    n: int,
    by: Sequence[str] = (),
    stopwords: Sequence[str] | None = STOPWORDS,
    across_texts: bool = False,
    key: str | None = None,
) -> DataFrame:
    """n-gram counts after stopword removal.

    With `across_texts` the texts of a group form one stream in key order and
    n-grams run over text ends. Those extra ones need only the n-1 outer words of
    each text, so whole texts are never sorted. Texts are cut into words once, and the
    words stored as a line each; n-grams and outer words are read off the lines.
    """
    return _add_up(_ngram_rows(df, n, by, stopwords, across_texts, key, False), [*by, "ngram"])


def _add_up(rows: DataFrame, at: Sequence[str]) -> DataFrame:
    """Totals of `n` of rows that are mostly distinct and were added up before, where none comes very often.

    Tasks add up once rows have met and not before, as most of what they hold would be kept
    and spilled for little. A hash leads the key: where a task has to sort, it settles the order.
    """
    met = rows.repartition(*at).withColumn("_hash", F.xxhash64(*at))
    return met.groupBy("_hash", *at).agg(F.sum("n").alias("n")).drop("_hash")


def _ngram_rows(
    df: DataFrame, n: int, by: Sequence[str], stopwords: Sequence[str] | None, across_texts: bool, key: str | None,
    again: bool,
) -> DataFrame:
    """n-grams with a count each, added up within pieces of a task; with `again`, what they are read off is stored."""
    tokens = content_tokens(T.tokens(F.col("text")), stopwords)
    across = across_texts and n > 1
    kept = [*by, key] if across else by
    lines = df.select(*kept, F.array_join(tokens, " ").alias("line"))
    if across or again:
        lines = materialise(lines.where(F.col("line") != ""))
    if across:
        edges = materialise(
            lines.select(
                *by,
                key,
                F.split(F.substring_index("line", " ", n - 1), " ").alias("head"),
                F.split(F.substring_index("line", " ", 1 - n), " ").alias("tail"),
                F.lit(1).cast("bigint").alias("one"),
            )
        )
        crossing = _crossing_lines(edges, n, by, key)
        lines = lines.select(*by, "line").unionByName(materialise(crossing) if again else crossing)
    schema = types.StructType([*lines.select(*by).schema, types.StructField("ngram", types.StringType()), types.StructField("n", types.LongType())])
    return lines.mapInArrow(_counted(n), schema)


def frequent_ngrams(
    df: DataFrame,
    n: int,
    k: int = 20,
    by: Sequence[str] = (),
    stopwords: Sequence[str] | None = STOPWORDS,
    across_texts: bool = False,
    key: str | None = None,
    slots: int | None = None,
) -> DataFrame:
    """Exact counts of the n-grams that `ngrams` counts as often as the k-th of their group or more often.

    No count of every distinct n-gram is made. A first pass adds up n-grams by a hash slot;
    a slot's total bounds the count of each n-gram in it from above. The n-grams of the
    fullest slots are then counted by name, and the k-th count among them bounds the true
    k-th from below. Slots whose total does not reach it cannot hold one of the k; where
    others were left out they are counted too, and then nothing can be missing. Tasks send
    on at most `slots` totals a group (64 k, at least 65,536 unless given), and then only
    n-grams of the slots that count. All ties at the k-th count are in the result.
    """
    slots = slots or max(MIN_SLOTS, 64 * k)
    rows = _ngram_rows(df, n, by, stopwords, across_texts, key, True)
    rows = rows.withColumn("_slot", F.pmod(F.xxhash64("ngram"), F.lit(slots)).cast("int"))
    totals = materialise(rows.groupBy(*by, "_slot").agg(F.sum("n").alias("total")))
    fullest = _kth(totals, "total", by, 2 * k).withColumnRenamed("kth", "_from")
    bounded = materialise(_with_bound(totals, fullest, by).fillna(0, ["_from"]))
    counted = _count_slots(rows, bounded.where(F.col("total") >= F.col("_from")), by)
    least = materialise(_kth(counted, "n", by, k))
    left = _with_bound(bounded.where(F.col("total") < F.col("_from")), least, by)
    left = materialise(left.where(F.col("total") >= F.coalesce("kth", F.lit(0))).drop("kth"))
    if not left.isEmpty():
        counted = counted.unionByName(_count_slots(rows, left, by))
        least = materialise(_kth(counted, "n", by, k))
    return _with_bound(counted, least, by).where(F.col("n") >= F.coalesce("kth", F.lit(0))).drop("kth")


def _kth(df: DataFrame, value: str, by: Sequence[str], k: int) -> DataFrame:
    """The k-th largest value of each group as `kth`; groups of fewer rows are left out."""
    often = df.groupBy(*by, value).agg(F.count("*").alias("_rows"))
    down = Window.partitionBy(*by).orderBy(F.desc(value))
    reached = often.withColumn("_reached", F.sum("_rows").over(down)).where(F.col("_reached") >= k)
    return reached.groupBy(*by).agg(F.max(value).alias("kth"))


def _with_bound(df: DataFrame, bound: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the bound of a row's group, null where the group has none."""
    if by:
        return null_safe_join(df, F.broadcast(bound) if is_vocabulary(bound) else bound, by, "left")
    return df.withColumn(bound.columns[0], bound.agg(F.max(bound.columns[0])).scalar())


def _count_slots(rows: DataFrame, slots: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts of the n-grams that fall in the slots, stored.

    More slots than are sent to every task meet n-grams that are counted already, as all of them would be.
    """
    chosen = slots.select(*by, "_slot")
    at = [*by, "_slot"]
    if chosen.limit(MAX_SLOTS + 1).count() <= MAX_SLOTS:
        rows = null_safe_join(rows, F.broadcast(chosen), at, "left_semi")
        return materialise(rows.groupBy(*by, "ngram").agg(F.sum("n").alias("n")))
    every = _add_up(rows, [*at, "ngram"])
    return materialise(null_safe_join(every, chosen, at, "left_semi").drop("_slot"))


def _crossing_lines(edges: DataFrame, n: int, by: Sequence[str], key: str) -> DataFrame:
    """The last n-1 words of each text and the n-1 that follow, whose n-grams are those that run over its end."""
    ranked = prefix_sum(edges, key, ["one"], by).withColumn("place", F.col("one_before"))
    # Each chunk also receives the first n-1 texts of the next one, marked as copies.
    chunk = F.floor(F.col("place") / CHUNK)
    homes = F.array(F.struct(chunk.alias("chunk"), F.lit(False).alias("copy")))
    both = F.array(
        F.struct(chunk.alias("chunk"), F.lit(False).alias("copy")),
        F.struct((chunk - 1).alias("chunk"), F.lit(True).alias("copy")),
    )
    early = (F.col("place") % CHUNK < n - 1) & (chunk > 0)
    sent = ranked.select(*by, "place", "head", "tail", F.inline(F.when(early, both).otherwise(homes)))
    w = Window.partitionBy(*by, "chunk").orderBy("place")
    following = F.flatten(F.array_compact(F.array(*[F.lead("head", i).over(w) for i in range(1, n)])))
    joined = sent.withColumn("following", following).where(~F.col("copy"))
    return joined.select(*by, F.array_join(F.concat("tail", F.slice("following", 1, n - 1)), " ").alias("line"))


def top_ngrams(counts: DataFrame, by: Sequence[str] = (), k: int = 20) -> DataFrame:
    return top_words(counts.withColumnRenamed("ngram", "word"), by, k).withColumnRenamed("word", "ngram")


def ngram_overlap(left: DataFrame, right: DataFrame, top: int = 5000) -> DataFrame:
    """Shared and one-sided n-grams of the two top lists."""
    a = left.orderBy(F.desc("n"), "ngram").limit(top).select("ngram", F.lit(True).alias("in_left"))
    b = right.orderBy(F.desc("n"), "ngram").limit(top).select("ngram", F.lit(True).alias("in_right"))
    both = a.join(b, "ngram", "full_outer")
    return both.agg(
        count_if(F.col("in_left") & F.col("in_right")).alias("shared"),
        count_if(F.col("in_left") & F.col("in_right").isNull()).alias("left_only"),
        count_if(F.col("in_left").isNull() & F.col("in_right")).alias("right_only"),
    ).withColumn("shared_pct", 100.0 * F.col("shared") / top)


def lexical_richness(df: DataFrame, by: Sequence[str] = (), counts: DataFrame | None = None) -> DataFrame:
    """Yule's K, Brunet's W, Honore's H and TTR per group, with the number of texts.

    `counts` are the word counts per group where a caller has them; texts are then not read.
    """
    m = F.col("n").cast("double")
    sums = (word_counts(df, by) if counts is None else counts).groupBy(*by).agg(
        long_sum(F.col("n")).alias("tokens"),
        F.count("*").alias("types"),
        count_if(F.col("n") == 1).alias("hapaxes"),
        F.sum(m * m).alias("_m2"),
    )
    texts = df.groupBy(*by).agg(F.count("*").alias("n_texts"))
    if by:
        joined = null_safe_join(texts, sums, by, "left")
    else:
        joined = sums.withColumn("n_texts", texts.scalar())
    n = F.coalesce("tokens", F.lit(0)).cast("double")
    v = F.coalesce("types", F.lit(0)).cast("double")
    v1 = F.coalesce("hapaxes", F.lit(0)).cast("double")
    return joined.select(
        *by,
        "n_texts",
        n.cast("bigint").alias("tokens"),
        v.cast("bigint").alias("types"),
        F.when(n > 1, 10000 * (F.col("_m2") - n) / (n * n)).otherwise(0.0).alias("yules_k"),
        F.when(n > 0, F.pow(n, F.pow(v, F.lit(-0.172)))).otherwise(0.0).alias("brunets_w"),
        F.when((v > 0) & (v1 < v), 100 * F.log(n) / (1 - v1 / v)).otherwise(0.0).alias("honores_h"),
        ratio(v, n).alias("ttr"),
    )


def category_words(df: DataFrame, categories: DataFrame, k: int = 15, counts: DataFrame | None = None) -> DataFrame:
    """Top words of each category over all categories' top words, scaled by the category's maximum.

    `categories` maps genre to category, `counts` are word counts per genre if a caller
    has them. A word outside a category's own top k counts 0 there. Genres without category
    form one of their own.
    """
    of = categories.select("genre", "category")
    if counts is None:
        words = word_counts(join_vocabulary(df, of, "genre"), ["category"], STOPWORDS)
    else:
        words = roll_up(join_vocabulary(counts, of, "genre").where(~is_stopword(F.col("word"))), ["category"])
    top = top_words(words, ["category"], k)
    scaled = top.withColumn("scaled", F.col("n") / F.max("n").over(Window.partitionBy("category")))
    # One array of the categories goes to the words; the result has a row for each of both anyway.
    every = categories.agg(F.array_sort(F.collect_set(F.struct("category")))).scalar()
    grid = top.select("word").distinct().select("word", F.inline(every))
    found = null_safe_join(grid, scaled.select("word", "category", "scaled"), ["word", "category"], "left")
    return found.select("word", "category", F.coalesce("scaled", F.lit(0.0)).alias("scaled"))
