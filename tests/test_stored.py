"""Stems by dictionary, whole files, observed counters, stored matrices and clustered tables."""

import glob
import io
import random
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from wordloom import operators as op
from wordloom import sinks, sources
from wordloom.__main__ import main
from wordloom.operators.matrix import merged_entries
from wordloom.plans import jobs
from wordloom.plans.counters import Counters

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")


@pytest.mark.parametrize("slices, broadcast", [(1, True), (16, False)])
def test_dictionary(spark, docs, rows, slices, broadcast):
    stop = spark.createDataFrame([("the",), ("of",)], "word string")
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        by_dictionary = op.document_frequency_by_dictionary(docs, stop, slices=slices)
        assert rows(by_dictionary) == rows(op.document_frequency(docs, stop))
        assert rows(op.term_frequency_by_dictionary(docs, slices=slices)) == rows(op.term_frequency(docs))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_each_distinct_token_is_stemmed_once(docs):
    """The stem's patterns stand once in the plan, above the aggregate that makes tokens distinct."""
    text = plan(op.document_frequency_by_dictionary(docs))
    once = plan(op.stems(docs, "apostrophe"))
    assert text.count("rlike") + text.count("RLIKE") == once.count("rlike") + once.count("RLIKE")
    assert text.count("regexp_replace") == once.count("regexp_replace")
    with pytest.raises(ValueError):
        op.stem_dictionary(docs, "text", slices=0)


def test_documents_without_tokens(spark, rows):
    docs = spark.createDataFrame([("a", None), ("b", ""), ("c", "..."), (None, "cats cat")], "doc_id string, text string")
    assert rows(op.document_terms_by_dictionary(docs)) == [(None, "cat")]
    assert rows(op.document_frequency_by_dictionary(docs.limit(0))) == []


@pytest.fixture
def corpus(tmp_path):
    for folder in ("a", "b"):
        (tmp_path / "corpus" / folder).mkdir(parents=True)
    (tmp_path / "corpus" / "a" / "1.txt").write_text("Cats and cat.\r\nThe houses\rhouse\n")
    (tmp_path / "corpus" / "a" / "same.txt").write_text("one cat")
    (tmp_path / "corpus" / "b" / "same.txt").write_text("two cats\n")
    (tmp_path / "corpus" / "b" / "big + name.txt").write_text("long line of cats\n" * 50)
    (tmp_path / "corpus" / "b" / "empty.txt").write_text("")
    (tmp_path / "stop.txt").write_text("the\nAND\n")
    return tmp_path


def paths(corpus):
    return [str(corpus / "corpus" / "a"), str(corpus / "corpus" / "b")]


@pytest.mark.parametrize("limit", [None, 17])
def test_whole_files_hold_what_their_lines_hold(spark, corpus, rows, limit):
    whole, lines = sources.read_documents(spark, paths(corpus), limit, clean_ids=True, whole_bytes=100)
    assert {r.doc_id for r in whole.collect()} == {"1"}
    assert {r.doc_id for r in lines.collect()} <= {"same", "big + name"}
    both = whole.select("doc_id", F.explode(F.split("text", "\r\n|\r|\n")).alias("line")).unionByName(lines)
    expected = sources.read_document_lines(spark, paths(corpus), limit, clean_ids=True)
    assert rows(both.where("line <> ''")) == rows(expected.where("line <> ''"))
    others = sources.split_documents(sources.list_documents(spark, paths(corpus)), 100)
    assert rows(others) == [("big + name.txt",), ("same.txt",)]


def test_distinct_terms_of_whole_files_need_no_shuffle(spark, corpus, rows):
    stop = sources.read_stopwords(spark, str(corpus / "stop.txt"))
    whole, _ = sources.read_documents(spark, paths(corpus), whole_bytes=100)
    terms = op.document_terms(whole, stop, one_row_per_document=True, small_stopwords=True)
    assert rows(terms) == [("1.txt", "cat"), ("1.txt", "hous")]
    text = plan(terms)
    assert "term" not in "".join(line for line in text.splitlines() if "Exchange" in line)


def test_counters_come_with_the_run(spark, corpus, capsys):
    out = str(corpus / "df")
    found = jobs.document_frequency(spark, paths(corpus), out, str(corpus / "stop.txt"), ordered=True)
    table = {line.split("\t")[0]: int(line.split("\t")[1]) for f in sorted(glob.glob(out + "/part-*")) for line in open(f).read().splitlines()}
    assert table == {"cat": 3, "hous": 1, "line": 1, "long": 1, "of": 1, "on": 1, "two": 1}
    assert found == {"documents": 3, "term_document_pairs": sum(table.values()), "terms": len(table)}
    scores = jobs.tf_idf(spark, paths(corpus), str(corpus / "scores"), out)
    lines = [line for f in glob.glob(str(corpus / "scores/part-*")) for line in open(f).read().splitlines()]
    assert scores == {"documents": 3, "score_rows": len(lines)}
    single = str(corpus / "corpus" / "a")
    main(["document-frequency", single, str(corpus / "again"), str(corpus / "stop.txt")])
    assert capsys.readouterr().out.splitlines() == ["documents\t2", "term_document_pairs\t4", "terms\t3"]


def test_counters_equal_the_query_on_them(spark, docs):
    counters = Counters()
    terms = counters.watch(op.document_terms(counters.watch(docs, "documents"), one_row_per_document=True), "pairs")
    table = counters.watch(terms.groupBy("term").agg(F.count("*").alias("df")), "terms")
    table.write.format("noop").mode("overwrite").save()
    df = op.document_frequency(docs, one_row_per_document=True)
    expected = {r.counter: r.value for r in op.corpus_counters(docs, df, df.limit(0)).collect()}
    assert counters.values() == {
        "documents": expected["documents"],
        "pairs": expected["term_document_pairs"],
        "terms": expected["terms"],
    }


def test_merged_entries(spark):
    rng = random.Random(6)
    entry = "array<struct<neighbor:string,cnt:bigint>>"
    table = []
    for i in range(200):
        sides = [{f"n{rng.randrange(12)}": rng.randrange(1, 9) for _ in range(rng.randrange(9))} for _ in "ab"]
        table.append((i, *(None if rng.random() < 0.1 else sorted(s.items()) for s in sides)))
    df = spark.createDataFrame(table, f"i int, a {entry}, b {entry}")
    for r in df.select("*", merged_entries(F.col("a"), F.col("b")).alias("m")).collect():
        total = {}
        for n, c in [*(r.a or []), *(r.b or [])]:
            total[n] = total.get(n, 0) + c
        assert [tuple(e) for e in r.m] == sorted(total.items())


def test_merge_leaves_the_stored_side_where_it_is(spark, docs, rows, tmp_path):
    turns = spark.read.parquet(f"{FOLDER}/conversations.parquet").select("text")
    first, second = (op.all_word_stripes(t, 1, ["the"], parts=3) for t in (docs, turns))
    op.save_stripes(first, "stored_matrix", 8, str(tmp_path / "matrix"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = op.merge_into_stored(spark.table("stored_matrix"), second)
        assert rows(merged) == rows(op.merge_stripes(first, second, parts=3))
        text = plan(merged).split("== Initial Plan ==")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql("drop table stored_matrix")
    join = text[text.index("SortMergeJoin") :]
    left = join[: join.index("stored_matrix")]
    assert "Exchange" not in left, "the stored side is read in its buckets"


def test_a_bucket_is_written_by_several_tasks(spark, rows, tmp_path):
    entry = "word string, part int, entries array<struct<neighbor:string,cnt:bigint>>"
    first = spark.createDataFrame([(f"w{i}", i % 2, [("n", i)]) for i in range(600)], entry)
    op.save_stripes(first, "many_writers", 3, str(tmp_path / "matrix"))
    try:
        files = glob.glob(str(tmp_path / "matrix" / "*.parquet"))
        assert 3 < len(files) <= 12, "more tasks than buckets, and no task with two buckets"
        stored = spark.table("many_writers")
        assert rows(stored) == rows(first)
        assert "Exchange" not in stored.groupBy("word", "part").count()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.sql("drop table many_writers")


def test_a_lookup_reads_one_file(spark, tmp_path, rows):
    table = spark.range(10_000).select(F.concat(F.lit("k"), F.lpad("id", 5, "0")).alias("word"), F.col("id").alias("cnt"))
    path = str(tmp_path / "clustered")
    sinks.write_clustered(table, path, "word", 16)
    index = spark.read.parquet(f"{path}/index").orderBy("first").collect()
    assert 12 <= len(index) <= 16 and sum(r.rows for r in index) == 10_000
    assert all(a.last < b.first for a, b in zip(index, index[1:]))
    assert len(sinks.files_of(spark, path, ["k05000"])) == 1
    found = sinks.lookup(spark, path, "word", ["k05000"])
    assert len(found.inputFiles()) == 1 and rows(found) == [("k05000", 5000)]
    assert rows(sinks.lookup(spark, path, "word", ["k00001", "k09999", "z"])) == [("k00001", 1), ("k09999", 9999)]
    assert rows(sinks.lookup(spark, path, "word", ["a"])) == rows(sinks.lookup(spark, path, "word", [])) == []
    with pytest.raises(ValueError):
        sinks.write_clustered(table, path + "2", "word", 0)


def test_a_key_of_a_third_of_the_rows_stays_in_one_file(spark, tmp_path):
    table = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, F.concat(F.lit("x"), "id")).alias("word"))
    path = str(tmp_path / "clustered")
    sinks.write_clustered(table, path, "word", 8)
    assert len(sinks.files_of(spark, path, ["hot"])) == 1
    assert sinks.lookup(spark, path, "word", ["hot"]).count() == 1000
    assert spark.read.parquet(f"{path}/index").agg(F.sum("nulls")).first()[0] == 1000
