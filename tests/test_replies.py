"""Parsing and expanding replies: one bad element never spoils a bundle."""

import json

import pytest
from pyspark.sql import functions as F

from lexloom.operators import bundles

GOOD = {"text": "fine", "labels": ["a", "b"], "not_labels": ["c"]}


@pytest.fixture
def expand(spark):
    def run(*replies, **options):
        data = [(i, "g", "B1", r if isinstance(r, str) or r is None else json.dumps(r)) for i, r in enumerate(replies)]
        df = spark.createDataFrame(data, "bundle_id int, genre string, language_level string, response string")
        valid = bundles.validate_bundles(bundles.parse_responses(df))
        out = bundles.expand_bundles(valid, **options).orderBy("bundle_id", "example_no").collect()
        return [(r.text, list(r.labels), list(r.not_labels)) for r in out]

    return run


def bundle(*examples):
    return {"shared_labels": [], "examples": list(examples)}


FINE = ("fine", ["a", "b"], ["c"])


def test_bad_elements_are_skipped_alone(expand):
    got = expand(bundle("a string", 5, None, ["x"], {**GOOD, "labels": None}, {**GOOD, "labels": "abc"}, GOOD))
    assert got == [FINE]


def test_scalars_in_labels(expand):
    got = expand(bundle({"text": "t", "labels": ["x", None, 5, True, 1.5], "not_labels": ["n"]}))
    assert got == [("t", ["x", "5", "true", "1.5"], ["n"])]


@pytest.mark.parametrize("text", [5, None, True, ["t"], {"a": 1}])
def test_text_must_be_a_string(expand, text):
    assert expand(bundle({**GOOD, "text": text}, GOOD)) == [FINE]


def test_missing_and_empty_text_are_kept(expand):
    no_text = {k: v for k, v in GOOD.items() if k != "text"}
    assert expand(bundle(no_text, {**GOOD, "text": ""})) == [("", ["a", "b"], ["c"])] * 2
    assert expand(bundle(no_text, {**GOOD, "text": " \t"}, GOOD), require_text=True) == [FINE]


def test_labels_are_trimmed_of_all_blanks(expand):
    got = expand(bundle({"text": "t", "labels": ["\t a\n", " b ", " ", ""], "not_labels": ["\x1cc\x1f"]}))
    assert got == [("t", ["a", "b"], ["c"])]


def test_conflicts_leave_both_lists_and_repeats_stay(expand):
    got = expand(bundle({"text": "t", "labels": ["a", "x", "a", "y"], "not_labels": ["x", "b", "b", " y "]}))
    assert got == [("t", ["a", "a"], ["b", "b"])]
    assert expand(bundle({"text": "t", "labels": ["a", "b"], "not_labels": ["b", "a"]})) == []


def test_replies_around_the_object(expand):
    body = json.dumps(bundle(GOOD))
    assert expand(body, "Sure:\n```json\n" + body + "\n```\nbye", "  " + body) == [FINE] * 3


def test_unusable_replies(expand):
    assert expand(None, "", "no json", '{"examples": [', "[1, 2]", {"examples": []}, {"examples": {}}, {"x": 1}) == []


def test_last_of_repeated_keys_wins(expand):
    assert expand('{"examples": [], "examples": [{"text":"fine","labels":["a","b"],"not_labels":["c"]}]}') == [FINE]


def test_non_ascii_text(expand):
    assert expand(bundle({**GOOD, "text": "é – 漢字 😀"})) == [("é – 漢字 😀", ["a", "b"], ["c"])]


def test_counters_keep_units_apart(spark):
    data = [(0, None), (1, "nothing"), (2, '{"examples": []}'), (3, json.dumps(bundle(GOOD, "x", GOOD))), (4, json.dumps(bundle("x")))]
    df = spark.createDataFrame(data, "bundle_id int, response string").withColumns({"genre": F.lit("g"), "language_level": F.lit("B1")})
    got = bundles.generation_counters(df).collect()[0].asDict()
    assert got == {
        "bundles": 5, "no_reply": 1, "malformed": 1, "invalid": 1, "failed_bundles": 3, "usable_bundles": 2, "examples": 2,
    }


def compliance(spark, reply):
    df = spark.createDataFrame([(1, json.dumps(reply))], "bundle_id int, response string")
    valid = bundles.validate_bundles(bundles.parse_responses(df))
    return bundles.bundle_compliance(valid).collect()[0].asDict()


def test_compliance(spark):
    shared = [f"l{i}" for i in range(15)]
    texts = [{"text": "t", "labels": shared[3 * i : 3 * i + 3], "not_labels": shared[: 3 * i] + shared[3 * i + 3 :]} for i in range(5)]
    good = compliance(spark, {"shared_labels": shared, "examples": texts})
    assert all(v for k, v in good.items() if k != "bundle_id")

    one = [{**t, "not_labels": [x for x in t["not_labels"] if x != "l0"]} for t in texts]
    one[0] = {**texts[0], "not_labels": texts[0]["not_labels"] + ["l0"]}  # both roles, but in one text only
    bad = compliance(spark, {"shared_labels": shared, "examples": one})
    assert not bad["cross_role"] and not bad["compliant"] and bad["labels_shared"]

    other = compliance(spark, {"shared_labels": shared[:14], "examples": texts[:4]})
    assert not other["five_texts"] and not other["fifteen_shared"] and not other["labels_shared"]


def test_parsing_needs_no_setting_of_the_session(spark):
    from lexloom.operators import bundles

    spark.conf.unset("spark.sql.variant.allowDuplicateKeys")
    one = '{"text": "t", "labels": ["a"], "not_labels": ["b"]}'
    replies = {
        "repeated": '{"examples": [], "examples": [%s]}' % one,
        "in array": '[{"examples": [%s]}]' % one,
        "in fenced array": '```json\n[\n {"examples": [%s]}]\n```' % one,
        "second in array": '[1, {"examples": [%s]}]' % one,
        "chatter with brackets": 'As [asked]: {"examples": [%s]}' % one,
        "chatter with an open bracket": 'Note [draft 1: {"examples": [%s]}' % one,
        "open bracket and a list behind": 'Note [draft 1: {"examples": [%s]} and [so on]' % one,
        "array that is cut off": '[ {"examples": [%s]}' % one,
    }
    df = spark.createDataFrame(list(replies.items()), "name string, response string")
    got = {r.name: r.is_valid for r in bundles.validate_bundles(bundles.parse_responses(df)).collect()}
    assert got == {"repeated": True, "in array": False, "in fenced array": False, "second in array": False, "chatter with brackets": True,
        "chatter with an open bracket": True, "open bracket and a list behind": True, "array that is cut off": False}
