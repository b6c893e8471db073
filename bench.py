"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  data folder (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default: all)

Each query is run to the end with the ``noop`` sink, which computes every row and column.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wordloom import operators as op  # noqa: E402
from wordloom.plans import queries as q  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))


#: Parts of a stripe over all words.
PARTS = 16


def all_word_stripes(distance: int):
    return lambda spark, sf: op.all_word_stripes(
        q.documents(spark, sf), distance, q.SHORT_STOPWORDS, parts=PARTS
    )


def all_word_stripes_sweep(spark, sf):
    return op.all_word_stripes_sweep(
        q.documents(spark, sf), (1, 2, 3, 4), q.SHORT_STOPWORDS, parts=PARTS
    )


def vocabulary_stripes(distance: int):
    def run(spark, sf):
        docs = q.documents(spark, sf)
        vocabulary = q.plans.frequent_words(docs, 50, q.SHORT_STOPWORDS)
        return op.vocabulary_stripes(docs, distance, vocabulary, small_lists=True)

    return run


BENCH = {
    "top_words": q.top_words,
    **{f"pairs_d{d}": q.pairs_query(d) for d in (1, 2, 3, 4)},
    "pairs_sweep_d1_to_d4": q.cooc_pairs_sweep,
    **{f"stripes_vocabulary_d{d}": vocabulary_stripes(d) for d in (1, 2, 3, 4)},
    "stripes_vocabulary_sweep_d1_to_d4": q.cooc_stripes_sweep,
    **{f"stripes_all_words_d{d}": all_word_stripes(d) for d in (1, 2, 3, 4)},
    "stripes_all_words_sweep_d1_to_d4": all_word_stripes_sweep,
    f"pairs_d{q.WIDE_DISTANCE}": q.pairs_query(q.WIDE_DISTANCE),
    "pairs_rare_words_d4": q.cooc_pairs_rare,
    "doc_freq": q.doc_freq,
    "doc_freq_dictionary": q.doc_freq_dictionary,
    "doc_freq_stopword_table": q.doc_freq_stopword_table,
    "tfidf": q.tfidf,
}


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("wordloom-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    q.documents(spark, SF_DIR).write.format("noop").mode("overwrite").save()  # start the JVM
    seconds = {}
    for name, query in BENCH.items():
        start = time.perf_counter()
        query(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(SF_DIR)).removeprefix("sf"),
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
