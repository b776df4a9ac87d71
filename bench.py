"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR selects the data, BENCH_CPUS the local cores, BENCH_QUERIES (comma
separated, or `all`) the queries, BENCH_WARM=1 a second run of each. Every query runs
to completion into a no-op sink. `derive_corpus` is the time to read the documents and
write the labelled corpus that the other queries read; `shuffle_mb` is what a query's
first run wrote to shuffles.
"""

from __future__ import annotations

import json
import os
import sys
import time

from checks.queries import QUERIES
from lexloom import build_session, fixtures

HEADLINE = (
    "merge_by_text strict_split seen_in_train_buckets expand_bundles label_counts label_roles label_diversity "
    "corpus_health describe overlap_summary depth_vs_baseline token_fit quality_scorecard word_counts lexical_richness "
    "msttr flesch_kincaid describe_quality bigrams top_bigrams_across_texts ngram_overlap ks_two_sample mann_whitney"
).split()


def shuffled(spark) -> float:
    """MB written to shuffles so far."""
    store = spark.sparkContext._jsc.sc().statusStore().executorList(False)
    return sum(store.apply(i).totalShuffleWrite() for i in range(store.size())) / 1e6


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g",
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(100).groupBy("id").count().count()  # start-up is not a query
    derive = timed(lambda: fixtures.examples(spark, sf_dir).count())
    print(f"{derive:8.3f} derive_corpus", file=sys.stderr, flush=True)
    QUERIES["label_counts"](spark, sf_dir).count()
    seconds, warm, megabytes = {}, {}, {}
    for name in names:

        def run(name=name):
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

        before = shuffled(spark)
        seconds[name] = timed(run)
        megabytes[name] = round(shuffled(spark) - before, 2)
        if os.environ.get("BENCH_WARM"):
            warm[name] = timed(run)
        print(f"{seconds[name]:8.3f} {megabytes[name]:9.2f} MB {name}", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
                "derive_corpus": derive,
                "shuffle_mb": megabytes,
                **({"warm": warm} if warm else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
