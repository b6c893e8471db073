"""The pipeline against its parts, each judged by brute force elsewhere, and the registry."""

import re

import __spark_entry__ as contract
import corpus_pipeline
from wordloom.llm import decontaminate, near_dedup, quality_rules, queries, secrets, sentencepiece_codec

FOLDER = "/root/testdata/sf0.001"


def test_registry():
    names = contract.queries()
    for n in range(1, 14):
        assert len([q for q in names if re.fullmatch(rf"op{n}_\w+", q)]) == 1
    assert "pipeline" in names and queries.ORACLE.keys() <= queries.QUERIES.keys()


def test_stages_against_plain_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    rows = {r.doc_id: r for r in docs.collect()}
    kept = {r.doc_id for r in quality_rules.judge(docs).collect() if r.kept}
    left = docs.where(docs.doc_id.isin(list(kept)))
    kept = {r.doc_id for r in near_dedup.near_duplicates(left).collect() if r.kept}
    left = docs.where(docs.doc_id.isin(list(kept)))
    kept -= {r.doc_id for r in decontaminate.leaks(left, spark.read.parquet(f"{FOLDER}/benchmark.parquet")).collect()}
    result = corpus_pipeline.run(spark, FOLDER).cache()
    assert {r.doc_id for r in result.collect()} == kept and len(kept) > 100
    for r in sentencepiece_codec.decode(result).collect():
        text = rows[r.doc_id].text
        for rule in secrets.BASE:
            assert not [m for m in re.finditer(rule.pattern, r.text) if len(m[rule.group]) >= max(rule.least, 6)]
        if secrets.MASK not in r.text:
            assert r.text == text
    docs.unpersist()
    result.unpersist()


def test_stages_keep_the_columns_and_take_odd_rows(spark):
    text = " ".join(f"w{i}" for i in range(80))
    data = [(None, text, None, None, None), (None, None, None, None, None), (1, text, "en", "s", 3), (2, text, "en", "s", 3), (2, text + " x", "en", "s", 3), (3, "", "en", "s", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS, name
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "None"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, FOLDER)
    assert empty.collect() == []
