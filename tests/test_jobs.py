"""Sources, sinks, whole jobs and streams."""

import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from lexloom import fixtures as fx, vocab
from lexloom.operators import curate, prompts
from lexloom.plans import audit, build, generate
from lexloom.session import materialise
from lexloom.sources import corpus
from lexloom.streaming import jobs


@pytest.fixture
def jsonl(tmp_path):
    def write(folder, name, *lines):
        path = tmp_path / folder
        path.mkdir(parents=True, exist_ok=True)
        (path / name).write_text("".join((x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)) + "\n" for x in lines), "utf-8")
        return tmp_path

    return write


def test_read_examples(spark, jsonl):
    jsonl("model one+x", "wiki1.jsonl", {"text": "é", "labels": ["a"]}, {"text": "t", "labels": None, "not_labels": ["n"], "extra": 1})
    root = jsonl("m2", "wiki2.jsonl", {"text": "u", "labels": [], "not_labels": []})
    got = sorted((r.text, r.model, list(r.labels), list(r.not_labels)) for r in corpus.read_examples(spark, f"{root}/*/wiki*.jsonl").collect())
    assert got == [("t", "model one+x", [], ["n"]), ("u", "m2", [], []), ("é", "model one+x", ["a"], [])]


def test_malformed_lines_stop_the_read_unless_told_otherwise(spark, jsonl):
    root = jsonl("m", "wiki.jsonl", {"text": "t", "labels": []}, "{broken")
    with pytest.raises(Exception):
        corpus.read_examples(spark, f"{root}/*/*.jsonl").collect()
    assert corpus.read_examples(spark, f"{root}/*/*.jsonl", mode="DROPMALFORMED").count() == 1


def test_published_split_reads_one_partition(spark, tmp_path):
    df = spark.createDataFrame([("a", "train"), ("b", "test")], "text string, split string")
    corpus.write_dataset(df, str(tmp_path / "d"))
    test = corpus.read_published(spark, str(tmp_path / "d"), "test")
    assert [r.text for r in test.collect()] == ["b"]
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().executedPlan().toString()


def test_build_then_add_increment(spark, jsonl, tmp_path):
    def line(i, j):
        return {"text": f"t{i}", "labels": [f"l{i % 40}"], "not_labels": [f"l{(i + j) % 40}"]}

    jsonl("old/m1", "wiki.jsonl", *[line(i, 1) for i in range(200)])
    jsonl("old/m2", "wiki.jsonl", *[line(i, 2) for i in range(0, 200, 5)])
    root = jsonl("new/m3", "wiki.jsonl", *[line(i, 1) for i in range(150, 300)])
    reports = build.build_dataset(spark, f"{root}/old/*/*.jsonl", str(tmp_path / "v1"), ratio=0.1)
    check = reports["leak_check"].collect()[0]
    assert check.leaked_labels == 0 and check.heldout_labels == 4
    v1 = corpus.read_published(spark, str(tmp_path / "v1"))
    assert v1.where("size(model) = 2").count() > 0
    held = materialise(curate.reconstruct_heldout(v1))
    before = {r.split: r["count"] for r in v1.groupBy("split").count().collect()}
    files = sorted(os.listdir(tmp_path / "v1" / "increment=base" / "split=train"))
    for _ in range(2):  # an increment written again replaces itself
        more = build.add_increment(spark, str(tmp_path / "v1"), f"{root}/new/*/*.jsonl", "more")
        growth = {r.split: (r.before, r.after) for r in more["growth"].collect()}
        assert {s: b for s, (b, _) in growth.items()} == before and growth["train"][1] > growth["train"][0]
        skipped = {r.split: (r.added, r.skipped) for r in more["skipped"].collect()}
        assert all(growth[s][1] - growth[s][0] == added for s, (added, _) in skipped.items())
        assert sum(s for _, s in skipped.values()) > 0
    now = corpus.read_published(spark, str(tmp_path / "v1"))
    assert now.groupBy("text", "split").count().where("count > 1").count() == 0
    assert curate.leak_check(now, held).collect()[0].leaked_labels == 0
    assert sorted(os.listdir(tmp_path / "v1" / "increment=base" / "split=train")) == files


def test_increment_reads_digests_of_published_rows_only(spark, tmp_path):
    old = spark.createDataFrame([("a", ["x"], ["y"], "train")], "text string, labels array<string>, not_labels array<string>, split string")
    corpus.write_dataset(old, str(tmp_path / "d"))
    new = spark.createDataFrame([("a", "train"), ("b", "train")], "text string, split string")
    fresh = curate.dedupe_against(new, corpus.read_published(spark, str(tmp_path / "d")))
    assert [r.text for r in fresh.collect()] == ["b"]
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<text_digest:binary>" in plan


@pytest.mark.parametrize("across", [False, True])
@pytest.mark.parametrize("most", [500_000, 2])
def test_published_digests_stay_where_they_are(spark, tmp_path, monkeypatch, across, most):
    """New digests go to the published ones, up to a number; the rows are the same beyond it."""
    monkeypatch.setattr(curate, "MAX_KEYS", most)
    old = spark.range(2000).select(F.concat(F.lit("t"), F.col("id") % 900).alias("text"), F.when(F.col("id") % 3 == 0, "test").otherwise("train").alias("split"))
    corpus_rows = old.select("text", F.array(F.lit("x")).alias("labels"), F.array(F.lit("y")).alias("not_labels"), "split")
    corpus.write_dataset(corpus_rows, str(tmp_path / "d"))
    new = spark.createDataFrame([(f"t{i}", s) for i in (1, 3, 898, 901, 5000) for s in ("train", "test")] + [(None, "train")], "text string, split string")
    published = corpus.read_published(spark, str(tmp_path / "d"))
    fresh = curate.dedupe_against(new, published, across)
    have = {(r.text,) if across else (r.text, r.split) for r in old.collect()}
    want = sorted(str(tuple(r)) for r in new.collect() if ((r.text,) if across else (r.text, r.split)) not in have)
    assert sorted(str(tuple(r)) for r in fresh.collect()) == want and 0 < len(want) < 11
    counts = {r.split: (r.added, r.skipped) for r in curate.dedupe_counts(new, published, across).collect()}
    assert sum(a for a, _ in counts.values()) == len(want) and sum(a + b for a, b in counts.values()) == 11
    if most > 2:
        # Only what the semi join leaves of the published digests is exchanged, as a broadcast.
        found = curate._known(new.withColumn("_text", F.sha2("text", 256).cast("binary")), published, ["_text", "split"])
        plan = found._jdf.queryExecution().executedPlan().toString()
        semi = plan.split("LeftSemi")[1].split("BroadcastExchange")[0]
        assert "FileScan" in semi and "Exchange" not in semi



def flaky_client():
    """A factory, built in a function so that it travels to the workers by value."""

    def factory():
        import json
        import threading

        class Client:
            def __init__(self):
                self.tries, self.lock = {}, threading.Lock()

            def complete(self, messages, **params):
                text = messages[1]["content"]
                with self.lock:
                    self.tries[text] = self.tries.get(text, 0) + 1
                    n = self.tries[text]
                if n < 3:
                    raise TimeoutError("busy")
                one = {"text": "made up", "labels": ["a"], "not_labels": ["b"]}
                return "```json\n" + json.dumps({"shared_labels": [], "examples": [one] * 5}) + "\n```"

        return Client()

    return factory


def test_generate_until_the_target(spark, sf_dir, tmp_path):
    conditions = (vocab.genre_table(spark), vocab.length_table(spark), vocab.level_table(spark))
    articles = fx.articles(spark, sf_dir)

    def run(name, target):
        return generate.generate(
            spark, articles, conditions, flaky_client(), str(tmp_path / "replies"), str(tmp_path / "rows"), target, name,
            sep="\n", model="m", wait=lambda attempt: 0.0,
        ).collect()[0]

    first = run("run1", 52)
    assert (first.bundles, first.examples, first.failed_bundles) == (11, 55, 0)
    assert run("run2", 52).bundles == 0
    assert run("run3", 80).bundles == 5
    rows = corpus.read_examples(spark, f"{tmp_path}/rows/*", with_model=False)
    assert rows.count() == 80 and rows.where("source <> 'wikipedia'").count() == 0
    replies = generate.read_replies(spark, f"{tmp_path}/replies")
    assert replies.select("article_id").distinct().count() == 16
    # The same run again: nothing is asked for twice, nothing stored is lost.
    asked = sorted(r.article_id for r in replies.collect())
    assert run("run1", 80).bundles == 11
    assert run("run1", 100).bundles == 15
    again = sorted(r.article_id for r in generate.read_replies(spark, f"{tmp_path}/replies").collect())
    assert len(again) == len(set(again)) == 20 and set(asked) <= set(again)
    assert corpus.read_examples(spark, f"{tmp_path}/rows/*", with_model=False).count() == 100


def test_generate_goes_on_after_a_failure_before_its_rows(spark, sf_dir, tmp_path, monkeypatch):
    conditions = (vocab.genre_table(spark), vocab.length_table(spark), vocab.level_table(spark))
    where = (str(tmp_path / "replies"), str(tmp_path / "rows"))

    def run(target):
        return generate.generate(
            spark, fx.articles(spark, sf_dir), conditions, flaky_client(), *where, target, "run", sep="\n", model="m",
            wait=lambda attempt: 0.0,
        ).collect()[0]

    def fail(*args):
        raise OSError("disk")

    write = generate._write_rows
    monkeypatch.setattr(generate, "_write_rows", fail)
    with pytest.raises(OSError):
        run(50)
    kept = {r.article_id for r in generate.read_replies(spark, where[0]).collect()}
    assert len(kept) == 10
    # A write that stopped half way leaves a folder that counts for nothing and is written anew.
    os.makedirs(f"{where[0]}/run--1/_temporary")
    monkeypatch.setattr(generate, "_write_rows", write)
    assert run(60).examples == 60
    assert kept < {r.article_id for r in generate.read_replies(spark, where[0]).collect()}
    assert corpus.read_examples(spark, f"{where[1]}/*", with_model=False).count() == 60


def counting_client(asked):
    """A client that leaves a file for each call, named by the article's title."""
    folder = str(asked)

    def factory():
        import json
        import re
        import uuid

        class Client:
            def complete(self, messages, **params):
                title = re.search(r"Title \d+", messages[1]["content"])[0]
                open(f"{folder}/{title}-{uuid.uuid4().hex}", "w").close()
                one = {"text": "made up", "labels": ["a"], "not_labels": ["b"]}
                return json.dumps({"shared_labels": [], "examples": [one] * 5})

        return Client()

    return factory


def test_a_run_killed_between_slices_keeps_them_and_asks_nothing_twice(spark, sf_dir, tmp_path, monkeypatch):
    conditions = (vocab.genre_table(spark), vocab.length_table(spark), vocab.level_table(spark))
    articles = fx.articles(spark, sf_dir).withColumn("text", F.concat("title", F.lit(" ")))
    where = (str(tmp_path / "replies"), str(tmp_path / "rows"))
    asked = tmp_path / "asked"
    asked.mkdir()

    def run():
        return generate.generate(
            spark, articles, conditions, counting_client(asked), *where, 500, "run", sep="\n", slice_size=10, model="m",
            wait=lambda attempt: 0.0,
        ).collect()[0]

    calls, real = [], generate.complete

    def dies(*args, **kw):
        calls.append(1)
        if len(calls) > 3:
            raise KeyboardInterrupt
        return real(*args, **kw)

    monkeypatch.setattr(generate, "complete", dies)
    with pytest.raises(KeyboardInterrupt):
        run()
    assert generate.complete_folders(spark, where[0]) == generate.complete_folders(spark, where[1]) == [f"run--0.00000{i}" for i in range(3)]
    kept = {r.article_id: r.response for r in generate.read_replies(spark, where[0]).collect()}
    assert len(kept) == len(os.listdir(asked)) and 10 < len(kept) < 60
    monkeypatch.setattr(generate, "complete", real)
    assert run().bundles == 100
    replies = {r.article_id: r.response for r in generate.read_replies(spark, where[0]).collect()}
    assert kept.items() <= replies.items() and len(replies) == 100
    titles = [f.split("-")[0] for f in os.listdir(asked)]
    assert len(titles) == len(set(titles)) == 100
    assert corpus.read_examples(spark, f"{where[1]}/*", with_model=False).count() == 500


def test_complete_gives_up_and_keeps_the_row(spark):
    def factory():
        class Client:
            def complete(self, messages, **params):
                kind = messages[1]["content"]
                if kind == "down":
                    raise ConnectionError("down")
                if kind == "odd":
                    raise KeyError("odd")
                return f"{kind} {params['temperature']} {params['top_p']}"

        return Client()

    message = F.struct(F.lit("user").alias("role"), F.col("kind").alias("content"))
    df = spark.createDataFrame([("ok",), ("down",), ("odd",)], "kind string").withColumn("messages", F.array(message, message))
    got = {r.kind: r.response for r in prompts.complete(df, factory, "m", wait=lambda a: 0.0).collect()}
    assert got == {"ok": "ok 0.9 0.95", "down": None, "odd": None}


def test_prompt_is_cut_by_characters(spark):
    row = [("g", "d", "short", "li", "B1", "ii", "t", "é" * 10_000)]
    cols = "genre_name string, genre_description string, length_label string, length_instruction string, level_label string, level_instruction string, title string, text string"
    got = prompts.build_prompts(spark.createDataFrame(row, cols)).collect()[0]
    assert len(got.messages[1].content) == 6144 and got.messages[0].role == "system"
    assert got.messages[1].content.startswith("<genre>\ng: d\n\n</genre>\n\n<length>short: li</length>\n\n<language_level>B1: ii</language_level>")


def test_stream_of_replies_goes_on_where_it_stopped(spark, sf_dir, tmp_path):
    replies = fx.replies(spark, sf_dir)
    args = (str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "cp"))
    for part in (0, 1):
        replies.where(F.col("bundle_id") % 2 == part).write.mode("append").json(args[0])
        jobs.stream_expand(spark, *args).awaitTermination()
    jobs.stream_expand(spark, *args).awaitTermination()
    from lexloom.operators.bundles import expand_replies

    got = corpus.read_examples(spark, args[1], with_model=False).select("text", "labels", "not_labels")
    want = expand_replies(replies).select("text", "labels", "not_labels")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_replayed_increment_adds_nothing(spark, tmp_path):
    def rows(*data):
        return spark.createDataFrame(list(data), jobs.INCREMENT_SCHEMA)

    published = spark.createDataFrame([("known", "train")], "text string, split string")
    heldout = spark.createDataFrame([("h",)], "label string")
    args = (str(tmp_path / "in"), published, heldout, str(tmp_path / "out"))
    rows(("known", ["a"], ["b"], "m"), ("fresh", ["a"], ["b"], "m"), ("test", ["h"], ["b"], "m"), ("bad", ["a"], ["h"], "m")).write.json(args[0])
    jobs.stream_increment(spark, *args, str(tmp_path / "cp")).awaitTermination()
    want = {("fresh", "train"), ("test", "test")}
    assert {(r.text, r.split) for r in jobs.read_increment(spark, args[3]).collect()} == want
    # A lost checkpoint makes another query, which finds all of it there.
    jobs.stream_increment(spark, *args, str(tmp_path / "cp2")).awaitTermination()
    assert sorted((r.text, r.split) for r in jobs.read_increment(spark, args[3]).collect()) == sorted(want)
    rows(("fresh", ["a"], ["b"], "m"), ("later", ["a"], ["b"], "m")).write.mode("append").json(args[0])
    jobs.stream_increment(spark, *args, str(tmp_path / "cp2")).awaitTermination()
    got = sorted((r.text, r.split) for r in jobs.read_increment(spark, args[3]).collect())
    assert got == sorted(want | {("later", "train")})


@pytest.mark.parametrize("batches", [2, 3])
def test_lost_checkpoint_after_some_batches(spark, tmp_path, batches):
    published = spark.createDataFrame([("known", "train")], "text string, split string")
    heldout = spark.createDataFrame([("h",)], "label string")
    args = (str(tmp_path / "in"), published, heldout, str(tmp_path / "out"))
    for i in range(batches):
        rows = [(f"t{i}", ["a"], ["b"], "m"), ("both", ["a"], ["b"], "m")]
        spark.createDataFrame(rows, jobs.INCREMENT_SCHEMA).write.mode("append").json(args[0])
        jobs.stream_increment(spark, *args, str(tmp_path / "cp"), 1).awaitTermination()
    want = sorted([f"t{i}" for i in range(batches)] + ["both"])
    assert sorted(r.text for r in jobs.read_increment(spark, args[3]).collect()) == want
    jobs.stream_increment(spark, *args, str(tmp_path / "cp2"), 100).awaitTermination()
    assert sorted(r.text for r in jobs.read_increment(spark, args[3]).collect()) == want


def test_folded_batches(spark, tmp_path):
    published = spark.createDataFrame([("known", "train")], "text string, split string")
    heldout = spark.createDataFrame([("h",)], "label string")
    args = (str(tmp_path / "in"), published, heldout, str(tmp_path / "out"))
    folders = lambda: sorted(int(p.name[6:]) for p in (tmp_path / "out").glob("query=*/batch=*"))
    added = lambda: sorted((r.text, r.split) for r in jobs.read_increment(spark, args[3]).collect())

    def arrive(i, cp="cp"):
        rows = [(f"t{i}", ["a"], ["b"], "m"), ("both", ["a"], ["b"], "m"), ("held", ["h"], ["b"], "m")]
        spark.createDataFrame(rows, jobs.INCREMENT_SCHEMA).write.mode("append").json(args[0])
        jobs.stream_increment(spark, *args, str(tmp_path / cp), 1).awaitTermination()

    for i in range(2):
        arrive(i)
    want = added()
    assert want == [("both", "train"), ("held", "test"), ("t0", "train"), ("t1", "train")]
    n = len(folders())
    (query,) = (tmp_path / "out").glob("query=*")
    # What a fold that died left behind does not count, and does not stop the next.
    shutil.copytree(query / "batch=0", query / f"batch={-n}")
    (query / f"batch={-n}" / "_SUCCESS").unlink()
    assert added() == want
    shutil.copytree(query / "batch=0", tmp_path / "first")
    assert jobs.fold_increment(spark, args[3]) == n and folders() == [-n] and added() == want
    assert jobs.fold_increment(spark, args[3]) == 0 and added() == want
    # Folded batches that are there again are not counted twice.
    shutil.copytree(tmp_path / "first", query / "batch=0")
    assert added() == want
    arrive(2)
    want = sorted([*want, ("t2", "train")])
    assert added() == want
    jobs.fold_increment(spark, args[3])
    assert added() == want and len(folders()) == 1 and folders()[0] < -n
    # Another query finds the folded rows.
    jobs.stream_increment(spark, *args, str(tmp_path / "cp2"), 100).awaitTermination()
    assert added() == want


def test_audits_run(spark, sf_dir):
    e = fx.examples(spark, sf_dir)
    from checks.queries import QUERIES

    genres = fx.genre_table(spark, sf_dir)
    corpus_tables = audit.audit_corpus(e, "doc_id")
    pair = audit.audit_pair(e, "doc_id", "origin", fx.LEFT, fx.RIGHT)
    genre = audit.audit_genres(e, genres, "doc_id", 5)
    # The tables equal the queries, which equal their SQL.
    same = {
        "corpus_health": corpus_tables["health"], "describe": corpus_tables["describe"],
        "quality_scorecard": corpus_tables["scorecard"], "summary_table": corpus_tables["summary"],
        "label_roles": corpus_tables["roles"], "overlap_summary": corpus_tables["overlap"],
        "depth_vs_baseline": corpus_tables["depth"], "token_fit": corpus_tables["token_fit"], "short_texts": corpus_tables["short_texts"],
        "ngram_overlap": pair["bigram_overlap"], "lexical_richness": pair["richness"],
        "genre_distribution": genre["distribution"], "genre_entropy": genre["entropy"], "ttr_by_group": genre["ttr"],
        "quality_by_genre": genre["quality"], "lexical_richness_by_genre": genre["richness"],
        "five_numbers": genre["five_numbers"], "category_words": genre["category_words"],
    }
    from checks.queries import flat

    for name, table in same.items():
        want = QUERIES[name](spark, sf_dir)
        got = flat(table).select(want.columns)
        key = lambda r: [str(x) for x in r]
        assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, want.collect()), key=key), name
    assert all(t.count() > 0 for t in (*corpus_tables.values(), *pair.values()))
    vocabulary = corpus_tables["vocabulary"].collect()
    assert vocabulary == curate.label_vocabulary(e).collect()


def test_shared_folder_is_the_configured_one(spark):
    from lexloom.session import shared_dir

    configured = spark.conf.get("spark.checkpoint.dir")
    assert os.path.basename(configured) in shared_dir(spark)


def test_clean_up_removes_intermediate_tables(spark):
    from lexloom import session

    mine, others = {}, dict(session._made)
    session._made.clear()
    table = materialise(spark.range(10))
    assert table.count() == 10
    mine.update(session._made)
    session.clean_up()
    assert len(mine) == 1 and not any(os.path.exists(p) for p in mine)
    session._made.update(others)
