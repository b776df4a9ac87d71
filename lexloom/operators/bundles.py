"""From model replies to labelled rows, one element at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lexloom.functions.columns import count_if, let, long_sum, no_strings
from lexloom.functions.text import is_blank, trim_blanks

# The bounds a reply is asked to keep.
TEXTS_PER_BUNDLE = 5
SHARED_LABELS = 15
POSITIVE_RANGE = (1, 5)
NEGATIVE_RANGE = (8, 15)


def parse_responses(df: DataFrame, response: str = "response") -> DataFrame:
    """Add `bundle VARIANT`: the JSON object inside a reply (fences and chatter cut off), null if malformed.

    A repeated key keeps its last value, as in most JSON readers; Spark decides that by the
    setting `spark.sql.variant.allowDuplicateKeys` of the session, which is set here and
    holds for later plans too. An object that an array holds is no bundle: a bracket stands
    directly before it, or what an open bracket before it begins is an array. Other
    brackets are chatter.
    """
    df.sparkSession.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    found = F.regexp_extract(F.col(response), r"(?s)(\{.*\})", 1)
    before = F.regexp_extract(F.col(response), r"(?s)\A([^{]*)", 1)
    begun = F.regexp_extract(before, r"(\[[^\[\]]*)\z", 1)
    array = F.try_parse_json(F.concat(begun, F.regexp_extract(F.col(response), r"(?s)(\{.*\])", 1)))
    in_array = F.when(begun == "", F.lit(False)).otherwise(begun.rlike(r"\A\[\s*\z") | array.isNotNull())
    return df.withColumn("bundle", F.when(~in_array, F.try_parse_json(found)))


def validate_bundles(df: DataFrame) -> DataFrame:
    """Add `is_valid`: an object whose `examples` is a non-empty array."""
    examples = F.try_variant_get("bundle", "$.examples", "array<variant>")
    return df.withColumn("is_valid", F.coalesce(F.size(examples) > 0, F.lit(False)))


def _strings(value: Column, path: str) -> Column:
    """Trimmed, non-blank scalars of a JSON array; anything but an array gives none."""
    items = F.transform(
        F.try_variant_get(value, path, "array<variant>"), lambda x: trim_blanks(F.try_variant_get(x, "$", "string"))
    )
    return F.coalesce(F.filter(items, lambda x: x.isNotNull() & (x != "")), no_strings())


def _usable_examples() -> Column:
    """array<struct<example_no, text, labels, not_labels>>: the examples of a bundle that make rows.

    All of it is one expression on the reply, so that each element is cleaned
    once; as filters over exploded columns the optimizer would repeat the cleaning.
    """

    def text_of(element: Column) -> Column:
        # A missing text is an empty one; a text of another type is no text.
        text = F.try_variant_get(element, "$.text", "variant")
        string = F.try_variant_get(element, "$.text", "string")
        found = F.when(text.isNull(), F.lit("")).when(F.schema_of_variant(text) == "STRING", string)
        return F.when(F.schema_of_variant(element).startswith("OBJECT"), found)

    def row(element: Column, number: Column) -> Column:
        lists = F.struct(
            _strings(element, "$.labels").alias("pos"), _strings(element, "$.not_labels").alias("neg")
        )
        return let(
            lists,
            lambda x: F.struct(
                number.alias("example_no"),
                text_of(element).alias("text"),
                F.filter(x["pos"], lambda label: ~F.array_contains(x["neg"], label)).alias("labels"),
                F.filter(x["neg"], lambda label: ~F.array_contains(x["pos"], label)).alias("not_labels"),
            ),
        )

    examples = F.when(F.col("is_valid"), F.try_variant_get("bundle", "$.examples", "array<variant>"))
    return F.filter(
        F.transform(examples, row),
        lambda r: r["text"].isNotNull() & (F.size(r["labels"]) > 0) & (F.size(r["not_labels"]) > 0),
    )


def expand_bundles(df: DataFrame, source: str = "wikipedia", require_text: bool = False) -> DataFrame:
    """Labelled rows of all valid bundles.

    A label in both lists of a text is removed from both, repeats are kept, and a
    row survives only with a string text and labels left on both sides.
    """
    other = [c for c in df.columns if c not in ("bundle", "is_valid", "response")]
    # The outer form infers no filter on its input, which would parse every reply again.
    rows = df.select(*other, F.inline_outer(_usable_examples())).where(F.col("example_no").isNotNull())
    if require_text:
        rows = rows.where(~is_blank(F.col("text")))
    return rows.withColumn("source", F.lit(source))


def expand_replies(df: DataFrame, source: str = "wikipedia") -> DataFrame:
    """Parse, validate and expand replies in one narrow pass."""
    return expand_bundles(validate_bundles(parse_responses(df)), source)


def generation_counters(df: DataFrame) -> DataFrame:
    """Replies by outcome and rows written, from one pass over the replies."""
    replies = validate_bundles(parse_responses(df.select("response"))).select(
        F.col("response").isNotNull().alias("replied"),
        F.col("bundle").isNotNull().alias("parsed"),
        F.col("is_valid").alias("valid"),
        F.coalesce(F.size(_usable_examples()), F.lit(0)).alias("rows"),
    )
    replied, parsed, valid = F.col("replied"), F.col("parsed"), F.col("valid")
    return replies.agg(
        F.count("*").alias("bundles"),
        count_if(~replied).alias("no_reply"),
        count_if(replied & ~parsed).alias("malformed"),
        count_if(parsed & ~valid).alias("invalid"),
        count_if(~valid).alias("failed_bundles"),
        count_if(valid).alias("usable_bundles"),
        long_sum(F.col("rows")).alias("examples"),
    )


def bundle_compliance(df: DataFrame) -> DataFrame:
    """Whether each valid bundle keeps the rules its prompt states; no shuffle.

    Rules: number of texts, number of distinct shared labels, label counts per
    text, labels taken from the shared ones, and every shared label positive in
    one text and negative in a different one.
    """
    other = [c for c in df.columns if c not in ("bundle", "is_valid", "response")]
    examples = F.transform(
        F.try_variant_get("bundle", "$.examples", "array<variant>"),
        lambda e: F.struct(_strings(e, "$.labels").alias("pos"), _strings(e, "$.not_labels").alias("neg")),
    )
    parts = df.where("is_valid").select(
        *other, examples.alias("e"), F.array_distinct(_strings(F.col("bundle"), "$.shared_labels")).alias("shared")
    )

    def within(size: Column, bounds: tuple[int, int]) -> Column:
        return size.between(*bounds)

    def both_roles(label: Column) -> Column:
        positive = F.transform(F.col("e"), lambda x: F.array_contains(x["pos"], label))
        negative = F.transform(F.col("e"), lambda x: F.array_contains(x["neg"], label))
        different = F.zip_with(positive, negative, lambda p, n: p | n)
        hits = F.size(F.filter(different, lambda d: d))
        return F.array_contains(positive, True) & F.array_contains(negative, True) & (hits > 1)

    rules = {
        "five_texts": F.size("e") == TEXTS_PER_BUNDLE,
        "fifteen_shared": F.size("shared") == SHARED_LABELS,
        "positive_counts": F.forall("e", lambda x: within(F.size(x["pos"]), POSITIVE_RANGE)),
        "negative_counts": F.forall("e", lambda x: within(F.size(x["neg"]), NEGATIVE_RANGE)),
        "labels_shared": F.forall(
            "e", lambda x: F.size(F.array_except(F.concat(x["pos"], x["neg"]), F.col("shared"))) == 0
        ),
        "cross_role": F.forall("shared", both_roles),
    }
    checked = parts.select(*other, *[rule.alias(name) for name, rule in rules.items()])
    compliant = F.lit(True)
    for name in rules:
        compliant = compliant & F.col(name)
    return checked.withColumn("compliant", compliant)
