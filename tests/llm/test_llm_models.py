"""Trained operators: held-out accuracy, odd rows, and their parts against plain versions."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexloom.llm import common, language, mixing, quality, toxicity, trees, urls
from lexloom.llm.queries import QUERIES, RULES

SF = "/root/testdata/sf0.01"
ODD = [(1, None), (2, ""), (3, "   "), (4, "1234 !!"), (None, "no key here"), (5, "same"), (5, "same"), (6, "word " * 20_000)]


def out_of_sample(key):
    return zlib.crc32(str(key).encode()) % 5 == 0


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(k, t, "en", 1, 0.5, "x") for k, t in ODD]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, y int, score double, k string")


def read(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def test_held_out_is_the_remainder_of_the_checksum(spark):
    keys = [0, 1, 17, 5000, -3, None]
    df = spark.createDataFrame([(k,) for k in keys], "k long").select("k", common.held_out("k").alias("h"))
    assert {r["k"]: r["h"] for r in df.collect()} == {k: k is None or out_of_sample(k) for k in keys}


def test_label_sample_is_bounded_and_never_held_out(spark):
    rows = [(i, i % 2) for i in range(1000)] + [(1, 0), (1, 0), (2, None), (None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, y int")
    got = common.sample_labels(df, "doc_id", "y", 100).collect()
    assert len(got) == 100 and not any(out_of_sample(r["k"]) for r in got)
    every = {r["k"]: r["y"] for r in common.sample_labels(df, "doc_id", "y", 10_000).collect()}
    assert set(every) == {i for i in range(1000) if not out_of_sample(i)}
    assert 1 not in every or every[1] == 0
    assert common.sample_labels(df.limit(0), "doc_id", "y", 10).collect() == []


# --- trees and quality -------------------------------------------------------


def test_flat_traversal_is_that_of_a_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = trees.fit(x, y, trees=20)
    assert ((model.score(x) > 0.5) == y).mean() > 0.97
    for row, margin in zip(x[:50], model.margin(x[:50])):
        total = model.base
        for feature, cut, leaf in zip(model.feature, model.cut, model.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + (2 if row[feature[node]] > cut[node] else 1)
            total += leaf[node - len(feature)]
        assert abs(total - margin) < 1e-9


@pytest.mark.parametrize("y", [[], [1.0, 1.0], [0.0]])
def test_trees_without_two_classes(y):
    model = trees.fit(np.zeros((len(y), 3)), np.array(y))
    assert ((0 < model.score(np.zeros((4, 3)))) & (model.score(np.zeros((4, 3))) < 1)).all()


def test_statistics_of_small_texts():
    s = quality.statistics("AB ab ab\nab ab ab")
    k = len(quality._CLASSES)
    assert s[0] == 2 / 17 and s[k + 5] == 2 / 6 and s[k + 7] == 5 / 6 and s[k + 8] == 4 / 6
    assert not quality.statistics(None).any() and not quality.statistics("").any()


def held_out_accuracy(spark, name, label):
    rows = QUERIES[name](spark, SF).join(read(spark, "labels").where(f"{label} is not null"), "doc_id").collect()
    assert all(r["held_out"] == out_of_sample(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    test = [r for r in rows if r["held_out"]]
    return np.mean([r["predicted"] == r[label] for r in test]), rows


def test_quality_on_held_out_documents(spark):
    accuracy, rows = held_out_accuracy(spark, "op8_quality", "quality")
    assert accuracy > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in rows)


def test_quality_of_odd_rows(spark, odd):
    model = quality.fit_quality(odd, odd.select("doc_id", F.lit(1).alias("quality")))
    got = quality.classify_quality(odd, model).collect()
    assert len(got) == len(ODD) and len({r["score"] for r in got if r["doc_id"] in (1, 2)}) == 1
    assert quality.classify_quality(odd.limit(0), model).collect() == []
    assert quality.drop_low_quality(odd, model).columns == odd.columns


# --- language ----------------------------------------------------------------


def plain_grams(text):
    out, word = Counter(), ""
    for c in text + " ":
        low = c.lower() if len(c.lower()) == 1 else c
        if c.isalpha():
            word += low
        elif word:
            padded = f" {word} "
            out.update(word)
            out.update(padded[i : i + 2] for i in range(len(padded) - 1))
            out.update(padded[i : i + 3] for i in range(len(padded) - 2))
            word = ""
    return {tuple(g): n for g, n in out.items()}


def unpacked(key):
    c = []
    while key:
        c.append(key & (1 << 21) - 1)
        key >>= 21
    return c[::-1]


@pytest.mark.parametrize("text", ["Ab, ab ÉÉ x", "one", "ßİ 日本語 a1b", "  a  "])
def test_grams_are_those_of_padded_words(text):
    keys, counts = language.grams(text)
    want = Counter()
    for gram, n in plain_grams(text).items():
        number = 0
        for c in gram:
            number = number << 21 | (0 if c == " " else ord(c))
        want[number] += n
    assert dict(zip(keys.tolist(), counts.tolist())) == dict(want)


def test_out_of_place_distance_by_hand():
    a, b, c = (ord(x) for x in "abc")
    model = language.profiles([("x", a, 0), ("x", b, 1), ("y", b, 0), ("y", c, 1)], 3)
    model.size = 3
    # "a" has grams a, _a, a_, _a_: the three lowest of equal counts are _a, a... by number.
    keys, counts = language.grams("a")
    top = language.ranked(keys, counts, 3)
    want = []
    for lang in ({a: 0, b: 1}, {b: 0, c: 1}):
        want.append(np.mean([abs(lang[g] - i) if g in lang else 3 for i, g in enumerate(top.tolist())]) / 3)
    assert np.allclose(model.distance("a"), want)


def test_languages_on_held_out_documents(spark):
    rows = QUERIES["op2_language"](spark, SF).join(read(spark, "documents"), "doc_id").collect()
    test = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == r["lang"] for r in test]) > 0.97
    assert all(r["held_out"] == out_of_sample(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)


def test_languages_of_odd_rows(spark, odd):
    model = language.fit_profiles(odd)
    got = [(r["doc_id"], r["lang_pred"]) for r in language.identify(odd, model).collect()]
    assert sorted(got, key=str) == sorted(
        [(k, "en" if t and any(map(str.isalpha, t)) else "und") for k, t in ODD], key=str
    )
    nothing = language.fit_profiles(odd.limit(0))
    assert {r["lang_pred"] for r in language.identify(odd, nothing).collect()} == {"und"}
    assert language.identify(odd.limit(0), model).collect() == []


# --- toxicity ----------------------------------------------------------------


def test_clauses_weigh_what_surrounds_an_insult():
    grammar = toxicity.Grammar(toxicity.seed_words(), {"lowei": (toxicity.INSULT, 3.0)})

    def insult(text):
        return grammar.clauses(text)[0][0][0]

    plain = insult("what an idiot came here")
    assert insult("you idiot") == insult("idiot you") == pytest.approx(plain * toxicity.TARGETED)
    assert insult("not an idiot") == pytest.approx(plain * toxicity.NEGATED)
    assert insult("he said that idiot came") == pytest.approx(plain * toxicity.REPORTED * toxicity.TARGETED)
    assert insult("an idiot came, the paper said") == pytest.approx(plain * toxicity.REPORTED)
    # Negation ends with its reach, and with its clause.
    assert insult("not a b c d e idiot") == pytest.approx(plain)
    assert insult("no. an idiot") == pytest.approx(plain)
    assert insult("ein loweixyz") == 3.0
    assert grammar.clauses(None) == ([], 0) and grammar.clauses("nothing here")[0] == []


def test_negated_and_reported_threats_weigh_less():
    grammar = toxicity.Grammar(toxicity.seed_words(), {})

    def threat(text):
        return grammar.clauses(text)[0][0][1]

    plain = threat("i will kill you")
    assert plain == threat("you i will kill") > 0 == threat("kill time")
    assert threat("kill it as a b c d e you") == pytest.approx(plain * toxicity.FAR)
    assert threat("i will not kill you") == threat("never kill you") == pytest.approx(plain * toxicity.NEGATED)
    assert threat("the man said i will kill you") == pytest.approx(plain * toxicity.REPORTED)
    assert threat("the man said i will not kill you") == pytest.approx(plain * toxicity.REPORTED * toxicity.NEGATED)


def test_grammar_agrees_with_a_plain_reading_of_clauses():
    """Every match is weighed by looking at all words of its clause, without states."""
    grammar = toxicity.Grammar(toxicity.seed_words(), {"zor": (toxicity.INSULT, 2.5), "zork": (toxicity.THREAT, 2.7)})
    rng = np.random.default_rng(3)
    words = "idiot kill zorkly you they not never said wrote a b c d e . ! you".split()
    reach = toxicity.REACH
    for _ in range(400):
        text = " ".join(rng.choice(words, rng.integers(1, 40)))
        want = []
        for clause in text.replace("!", ".").split("."):
            kinds = [grammar.look(w) for w in clause.split()]
            at = {c: [i for i, (k, _) in enumerate(kinds) if k == c] for c in range(6)}
            total = {toxicity.INSULT: 0.0, toxicity.THREAT: 0.0}
            for i, (c, w) in enumerate(kinds):
                if c not in total:
                    continue
                if any(0 < i - j <= reach for j in at[toxicity.NEGATION]):
                    w *= toxicity.NEGATED
                if at[toxicity.REPORT]:
                    w *= toxicity.REPORTED
                near = any(abs(i - j) <= reach for j in at[toxicity.TARGET])
                if c == toxicity.INSULT:
                    w *= toxicity.TARGETED if near else 1
                else:
                    w *= 1 if near else toxicity.FAR if at[toxicity.TARGET] else 0
                total[c] += w
            if at[toxicity.INSULT] or at[toxicity.THREAT]:
                want.append((total[toxicity.INSULT], total[toxicity.THREAT]))
        got = grammar.clauses(text)[0]
        assert len(got) == len(want) and all(g == pytest.approx(w) for g, w in zip(got, want))


def test_states_change_scores_of_a_fitted_grammar(spark):
    """The same words score less where they are negated or reported, and threats count with a target only."""
    grammar = toxicity.fit_toxicity(read(spark, "documents"), read(spark, "labels"))

    def score(clause):
        return grammar.score([clause + ". " + "the a and of " * 30])[0]

    assert score("you are an idiot") > score("you are not an idiot")
    assert score("you are an idiot") > score("said that you are an idiot") > score("said nothing to you")
    assert score("i will kill you now") > score("i will not kill you now")
    assert score("i will kill you now") > score("i will kill time now")


def test_composition_is_the_product_of_its_parts():
    left, right, insult, threat = toxicity.compose()
    assert insult.shape == threat.shape == (len(left), len(right))
    assert left.max() < len(left) and right.max() < len(right)
    state = 0
    for c in (toxicity.TARGET, toxicity.NEGATION):
        state = left[state, c]
    assert insult[state, 0] == pytest.approx(toxicity.NEGATED * toxicity.TARGETED)
    assert threat[state, 0] == pytest.approx(toxicity.NEGATED)


def test_toxicity_on_held_out_documents(spark):
    accuracy, rows = held_out_accuracy(spark, "op3_toxicity", "toxic")
    assert accuracy > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.5) for r in rows)


def test_toxicity_of_odd_rows(spark, odd):
    labels = odd.select("doc_id", F.lit(0).alias("toxic"))
    grammar = toxicity.fit_toxicity(odd, labels)
    got = toxicity.score_toxicity(odd, grammar).collect()
    assert len(got) == len(ODD) and all(0 <= r["score"] <= 1 for r in got)
    assert toxicity.score_toxicity(odd.limit(0), toxicity.fit_toxicity(odd.limit(0), labels.limit(0))).collect() == []


# --- urls --------------------------------------------------------------------


def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = ""
    while rest and rest[0] not in "/?#":
        host, rest = host + rest[0], rest[1:]
    path = ""
    while rest and rest[0] not in "?#":
        path, rest = path + rest[0], rest[1:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [r for r in RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.where), default=None)
    return host, path, best


def test_rules_on_all_pages_and_odd_urls(spark):
    odd = [
        None, "", "no scheme", "://", "http://", "http://A.Example.COM/en/x?y#z", "http://com/", "http://com", "x://www.example.com/en/",
        "http://notcom/", "http://a.net/es", "http://a.net/es/", "http://a.net?b=/es/", "http://ÄÖ.com/ü", "a://b://c.com/", "http://a.com\n/x",
    ]
    pages = read(spark, "pages").select("page_id", "url").collect()
    rows = [(r["page_id"], r["url"]) for r in pages] + [(10_000 + i, u) for i, u in enumerate(odd)]
    df = spark.createDataFrame([(k, u, "h", "p", "r") for k, u in rows], "page_id long, url string, host string, path string, rule string")
    got = {r["page_id"]: r for r in urls.judge_urls(df, RULES).collect()}
    assert len(got) == len(rows)
    for k, u in rows:
        host, path, rule = plain_verdict(u)
        r = got[k]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule and rule.where), u
        assert r["verdict"] == (rule.verdict if rule else "block" if r["score"] >= 0.5 else "allow")


def test_url_trees_learn_lexical_signs(spark):
    rng = np.random.default_rng(0)
    good = [f"https://site{i % 40}.org/articles/{'abcdefg'[i % 7]}" for i in range(300)]
    bad = [f"http://x{i % 40}-y-{rng.integers(1e9)}.org/p?id={rng.integers(1e9)}&k={rng.integers(1e9)}" for i in range(300)]
    df = spark.createDataFrame([(u, y) for us, y in ((good, 0), (bad, 1)) for u in us], "url string, y int")
    model = urls.fit_urls(df)
    score = model.forest.score(np.array([urls.lexical(u, model) for u in ("https://site99.org/articles/b", "http://q9-z-771290011.org/p?id=881230011&k=123456789")]))
    assert score[0] < 0.5 < score[1]
    empty = urls.fit_urls(df.limit(0))
    assert empty.forest.score(np.array([urls.lexical(None, empty)])) == pytest.approx(0.5)
    assert urls.judge_urls(spark.createDataFrame([], "page_id long, url string"), RULES).collect() == []


# --- mixing ------------------------------------------------------------------


def plain_rates(tokens, p, targets, steps=200_000):
    """Projected gradient on all rates, in the metric of tokens, until it stands still."""
    rate = np.ones(len(tokens))
    a = tokens[:, None] * p
    step = 0.5 / np.linalg.eigvalsh((a.T @ p)).max()
    for _ in range(steps):
        new = np.maximum(0, rate - step * (p @ (a.T @ rate - targets)))
        if np.abs(new - rate).max() < 1e-12:
            break
        rate = new
    return rate


def test_rates_meet_targets_like_a_plain_solver(spark):
    rng = np.random.default_rng(3)
    tokens = rng.integers(0, 500, 300)
    p = rng.dirichlet([0.3, 0.3, 0.3], 300)
    rows = [(i, int(t), [float(v) for v in q]) for i, (t, q) in enumerate(zip(tokens, p))]
    df = spark.createDataFrame(rows, "doc_id long, tokens long, posterior array<double>").repartition(4)
    targets = np.array([0.7, 0.2, 0.1]) * tokens.sum()
    duals, totals = mixing.fit_rates(df, targets)
    assert np.allclose(totals, targets, rtol=1e-3)
    rate = np.maximum(0, 1 + p @ duals)
    assert np.allclose((rate * tokens) @ p, totals, rtol=1e-9) and rate.min() >= 0
    assert np.allclose(rate, plain_rates(tokens.astype(float), p, targets), atol=0.05)


def test_mix_of_the_given_table(spark):
    rows = QUERIES["op6_mixing"](spark, SF).collect()
    total = sum(r["tokens"] for r in rows)
    assert len(rows) == 1000 and min(r["rate"] for r in rows) >= 0
    for name, share in (("plain", 0.95), ("toxic", 0.02), ("junk", 0.03)):
        assert sum(r["rate"] * r["tokens"] * r[f"p_{name}"] for r in rows) / total == pytest.approx(share, rel=5e-3)
    assert all(abs(r["p_plain"] + r["p_toxic"] + r["p_junk"] - 1) < 1e-6 for r in rows)


def test_posteriors_separate_held_out_domains(spark):
    rows = QUERIES["op6_mixing"](spark, SF).join(read(spark, "labels"), "doc_id").collect()
    test = [r for r in rows if out_of_sample(r["doc_id"]) and r["quality"] is not None and r["toxic"] is not None]
    name = [("toxic" if r["toxic"] else "plain" if r["quality"] else "junk") for r in test]
    right = [max(("plain", "toxic", "junk"), key=lambda d: r[f"p_{d}"]) == n for r, n in zip(test, name)]
    assert np.mean(right) > 0.85


def test_mixing_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(k, "a" if k % 2 else "b") for k in range(1, 7)], "doc_id long, domain string")
    docs = odd.withColumns({"tokens": F.lit("x"), "posterior": F.lit(1), "rate": F.lit(2)})
    for table in (labels, labels.where("domain = 'a'"), labels.limit(0)):
        model = mixing.fit_domains(docs, table)
        got = mixing.mix(docs, model, {"a": 1.0, "b": 1.0}).collect()
        assert len(got) == len(ODD) and all(r["rate"] >= 0 for r in got)
        again = mixing.resample(docs, model, {"a": 1.0, "b": 1.0})
        assert again.columns == docs.columns and again.count() >= 0
        assert mixing.mix(docs.limit(0), model, {"a": 1.0}).collect() == []


def test_copies_follow_the_rate(spark):
    df = spark.range(20_000).select("id", mixing.copies(F.lit(1.3), F.col("id")).alias("n"))
    counts = {r["n"]: r["count"] for r in df.groupBy("n").count().collect()}
    assert set(counts) == {1, 2} and abs(counts[2] / 20_000 - 0.3) < 0.02


@pytest.mark.parametrize("toxic", [0, 10, 240])
def test_clean_documents_stay_at_any_toxic_share(spark, toxic):
    def text(i, domain):
        return " ".join(f"{'good' if domain == 'plain' else 'evil'}{(i * j) % 7} {'aehr' if domain == 'plain' else 'ixzq'}" for j in range(1, 11))

    known = [(i, text(i, d), d) for i in range(400) for d in ["plain" if i % 2 else "toxic"]]
    df = spark.createDataFrame(known, "doc_id long, text string, domain string")
    model = mixing.fit_domains(df.select("doc_id", "text"), df.select("doc_id", "domain"))
    rows = [(i, text(i, d), d) for i in range(2000) for d in ["toxic" if i < toxic else "plain"]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, domain string")
    got = Counter(r["domain"] for r in mixing.resample(docs, model, {"plain": 0.98, "toxic": 0.02}, repeats=False, ceilings={"toxic"}).collect())
    assert got["plain"] >= 0.98 * (2000 - toxic)
    assert got["toxic"] <= min(toxic, 65)
    assert got["toxic"] >= min(toxic, 15) - 5


def test_goals_keep_shares_and_ceilings():
    share, ceiling = np.array([0.0, 0.9, 0.05, 0.05]), np.array([False, False, True, True])
    assert np.allclose(mixing.goals(share, np.array([9, 90, 50, 50]), ceiling), [0, 90, 5, 5])
    assert np.allclose(mixing.goals(share, np.array([9, 95, 0, 50]), ceiling), [0, 95, 0, 5])
    assert np.allclose(mixing.goals(share, np.array([9, 90, 1, 2]), ceiling), [0, 90, 1, 2])
    assert np.allclose(mixing.goals(share, np.array([9, 90, 0, 50]), ~ceiling & False), [0, 0, 0, 0])


def test_a_repeated_key_leaves_the_sample_bounded_and_whole(spark):
    known = [(i, d, int(d == "toxic")) for i in range(40) for d in [("junk", "plain", "toxic")[i % 3]]]
    hot = next(i for i, d, _ in known if d == "junk" and not out_of_sample(i))
    rows = [(i, f"{d} text {i}") for i, d, _ in known] + [(hot, f"junk again {i}") for i in range(3 * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame(known, "doc_id long, domain string, y int")
    assert mixing.fit_domains(docs, labels, bound=40).domains == ["junk", "plain", "toxic"]
    sample = common.sampled_texts(docs, "doc_id", "text", labels, "y", 40).collect()
    assert len(sample) == sum(not out_of_sample(i) for i, _, _ in known)
    again = common.sampled_texts(docs.repartition(3, "text"), "doc_id", "text", labels, "y", 40).collect()
    assert sorted(sample) == sorted(again)


def test_trees_meet_rules_on_held_out_urls(spark):
    """A fifth of the urls that rules decide are not learned from."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    ruled = urls.judge_urls(pages, RULES, model=urls.fit_urls(pages.limit(0).select("url", F.lit(0).alias("y")))).where("rule is not null")
    known = ruled.join(pages, "page_id").select("url", (F.col("verdict") == "block").cast("int").alias("y")).distinct().cache()
    apart = F.pmod(F.crc32(F.col("url").cast("binary")), F.lit(5)) == 0
    model = urls.fit_urls(known.where(~apart))
    held = known.where(apart).collect()
    right = sum((model.forest.score(np.array([urls.lexical(r.url, model)], float))[0] >= urls.BLOCK) == (r.y == 1) for r in held)
    assert len(held) > 50 and 0 < sum(r.y for r in held) < len(held)
    most = max(sum(r.y for r in held), sum(1 - r.y for r in held))
    assert right >= 0.9 * len(held) > most, (right / len(held), most / len(held))


def test_a_sample_has_a_bar_before_it_leaves_the_tasks(spark):
    rows = spark.range(20_000).select((F.col("id") % 9_000).alias("k"), F.lit("x").alias("d")).union(spark.range(9_000).select(F.lit(3).alias("k"), F.lit("x").alias("d")))
    few = common.smallest(rows, 50, "k")
    assert len(few) == 50 == len({r.k for r in few})
    hashes = {r.k: r.h for r in rows.distinct().select("k", F.xxhash64("k").alias("h")).collect()}
    bar = int(1.25 * 50 / 9_000 * (1 << 30))
    assert all(hashes[r.k] % (1 << 30) < 1.3 * bar for r in few)
    assert sorted(r.k for r in common.smallest(rows.where("k < 20"), 50, "k")) == list(range(20))
    assert common.smallest(rows.limit(0), 50, "k") == []
