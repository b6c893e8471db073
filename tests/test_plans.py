"""What the physical plans must look like at any scale."""

import io
from contextlib import redirect_stdout

import pytest

from wordloom import operators as op
from wordloom import plans, sources
from wordloom.plans.queries import QUERIES, WRITING

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("simple")
    return out.getvalue()


def jobs_so_far(spark):
    """Jobs that have run, but for the short ones in which Spark reads a table's schema."""
    tracker = spark.sparkContext.statusTracker()
    return {
        job
        for job in tracker.getJobIdsForGroup(None)
        if any(
            "parquet at" not in (tracker.getStageInfo(s) or _NO_STAGE).name
            for s in tracker.getJobInfo(job).stageIds
        )
    }


class _NO_STAGE:
    name = "parquet at"


def executed(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@pytest.fixture
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(WRITING)))
def test_jvm_only_and_no_nested_loops(spark, name):
    before = jobs_so_far(spark)
    df = QUERIES[name](spark, FOLDER)
    # the tracker forgets old jobs, so that only new ones count
    assert not jobs_so_far(spark) - before, "a job ran while the plan was built"
    text = plan(df)
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "MapInArrow" not in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_word_count_shuffles_counts_only(docs):
    text = plan(op.word_count(docs, ["the"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert "partial_count" in text and "LeftAnti" in text
    assert "ReadSchema: struct<text:string>" in text


def test_a_list_is_broadcast_by_its_size(spark, docs, tmp_path):
    path = tmp_path / "stopwords.txt"
    path.write_text("\n".join(f"word{i}" for i in range(1000)))
    stop = sources.read_stopwords(spark, str(path))
    assert "BroadcastHashJoin" in plan(op.word_count(docs, stop))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    try:
        text = plan(op.word_count(docs, stop))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text
    # The join is above the count: one row per distinct word, no hot key.
    assert text.index("Join") < text.index("HashAggregate")


def test_pairs_need_one_shuffle_besides_the_vocabulary(docs):
    text = plan(op.cooccurrence_pairs(docs, 4, ["a", "b"]))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("BroadcastHashJoin") == 2
    assert "Sort" not in text and "Window" not in text


def test_explode_adds_no_second_tokenization(docs):
    for df in (op.token_counts(docs, "alnum"), op.document_frequency(docs), op.stems(docs, "alpha")):
        assert plan(df).count("split(") == 1


def test_document_frequency_of_whole_rows_has_one_shuffle(docs):
    text = plan(op.document_frequency(docs, ["the"], one_row_per_document=True))
    assert text.count("Exchange") == 1
    text = plan(op.document_frequency(docs, ["the"]))
    assert text.count("Exchange") == 2


def test_scores_join_the_table_once_and_before_the_count(docs):
    text = plan(plans.frequent_term_scores(docs, one_row_per_document=True))
    lines = text.splitlines()
    joins = [i for i, line in enumerate(lines) if "BroadcastHashJoin" in line]
    tf = next(i for i, line in enumerate(lines) if "hashpartitioning(doc_id" in line)
    assert len(joins) == 1 and tf < joins[0]
    assert text.count("TakeOrderedAndProject") == 1


def test_top_lists_are_broadcast_as_executed(docs):
    text = executed(plans.frequent_term_scores(docs, one_row_per_document=True))
    assert text.count("BroadcastHashJoin") == 1 and "SortMergeJoin" not in text
    text = executed(plans.frequent_word_pairs(docs, 2))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_stripes_need_two_shuffles_and_no_join(spark, docs):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(op.all_word_stripes(docs, 1, parts=8))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange") == 2 and "Join" not in text


def test_a_few_stopwords_are_masked_inside_the_row(spark, docs, texts):
    text = plan(op.all_word_stripes(docs, 2, ["the", "of"], parts=4))
    assert "Join" not in text and text.count("Exchange") == 2
    table = texts("the cat of the house", "of the", "", "dog", None)
    pairs = op.stripes_to_pairs(op.all_word_stripes(table, 3, ["the", "of"], parts=2))
    assert sorted(tuple(r) for r in pairs.collect()) == [("cat", "house", 1), ("house", "cat", 1)]
    assert {r.word for r in op.all_word_stripes(table, 3, ["the", "of"], parts=2).collect()} == {"cat", "house", "dog"}


def test_a_merge_of_stripes_needs_one_shuffle(spark):
    entry = "word string, part int, entries array<struct<neighbor:string,cnt:bigint>>"
    first = spark.createDataFrame([("a", 0, [("b", 1), ("c", 2)]), ("b", 0, [("a", 1)]), ("x", 0, [])], entry)
    second = spark.createDataFrame([("a", 0, []), ("a", 1, [("b", 3)]), ("y", 0, []), (None, 0, [(None, 1)])], entry)
    merged = op.merge_stripes(first, second, parts=3)
    assert plan(merged).count("Exchange") == 1
    found = {}
    for r in merged.collect():
        assert r.entries or r.part == 0
        found.setdefault(r.word, {}).update((e.neighbor, e.cnt) for e in r.entries)
    assert found == {"a": {"b": 4, "c": 2}, "b": {"a": 1}, "x": {}, "y": {}, None: {}}


def test_a_table_of_many_splits_is_not_shuffled(spark, tmp_path, texts):
    path = str(tmp_path / "many")
    n = 2 * spark.sparkContext.defaultParallelism
    spark.range(n * 10).selectExpr("id AS doc_id", "'a b' AS text").repartition(n).write.parquet(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1")
    try:
        assert "Exchange" not in plan(sources.read_table(spark, path, "text"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
