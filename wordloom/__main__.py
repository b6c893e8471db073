"""``spark-submit``-able entry point: ``python -m wordloom <job> --help``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wordloom.operators.frequency import DEFAULT_DOCUMENTS
from wordloom.plans import jobs


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wordloom", description=jobs.__doc__)
    commands = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, *paths: str) -> argparse.ArgumentParser:
        command = commands.add_parser(name, help=run.__doc__, description=run.__doc__)
        for path in paths:
            command.add_argument(path)
        command.set_defaults(run=run)
        return command

    job("top-words", jobs.top_words, "corpus", "out", "stopwords").add_argument(
        "--k", type=int, default=50
    )
    pairs = job("pairs", jobs.pairs, "corpus", "out", "vocabulary")
    frequent = job("frequent-pairs", jobs.frequent_pairs, "corpus", "out", "stopwords")
    stripes = job("stripes", jobs.stripes, "corpus", "out", "vocabulary", "stopwords")
    every = job("all-word-stripes", jobs.all_word_stripes, "corpus", "out", "stopwords")
    for command in (pairs, frequent, stripes, every):
        command.add_argument("distance", type=int)
    frequent.add_argument("--k", type=int, default=50)
    every.add_argument("--parts", type=int, required=True, help="distinct words / 100,000")
    df = job("document-frequency", jobs.document_frequency, "corpus", "out", "stopwords")
    job("top-terms", jobs.top_terms, "df_table", "out").add_argument("--k", type=int, default=100)
    tfidf = job("tf-idf", jobs.tf_idf, "corpus", "out", "df_table")
    scores = job("frequent-term-scores", jobs.frequent_term_scores, "corpus", "out", "stopwords")
    scores.add_argument("--k", type=int, default=100)
    for command in (tfidf, scores):
        command.add_argument("--n-documents", type=int, default=DEFAULT_DOCUMENTS)
    for command in (df, tfidf, scores):
        command.add_argument("--max-line-bytes", type=int)
    for command in (pairs, frequent, stripes, every, df, tfidf, scores):
        command.add_argument("--ordered", action="store_true", help="sort the result")
    return top


def main(arguments: list[str] | None = None) -> None:
    options = vars(parser().parse_args(arguments))
    run, name = options.pop("run"), options.pop("job")
    spark = SparkSession.builder.appName(f"wordloom {name}").getOrCreate()
    for counter, value in (run(spark, **options) or {}).items():
        print(f"{counter}\t{value}")


if __name__ == "__main__":
    main()
