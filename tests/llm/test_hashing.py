"""Hashes against self-similar words, and executors that do not have the library."""

import os
import random
import subprocess
import sys

import numpy as np
import pyarrow as pa
import pytest

from wordloom.llm import decontaminate, near_dedup, sentencepiece_codec
from wordloom.llm.hashing import Words, span_hashes, text_bytes

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def self_similar(doublings=11):
    """A Thue-Morse word and its complement: equal under any polynomial hash modulo a power of two."""
    x, y = "a", "b"
    for _ in range(doublings):
        x, y = x + y, y + x
    return x, y


def test_spans_of_any_length_and_place():
    rng = random.Random(1)
    words = ["".join(rng.choice("ab") for _ in range(n)) for n in [*range(1, 40), 255, 256, 257, 2000] for _ in range(6)]
    data, offsets = text_bytes(pa.array([" ".join(words), "".join(words[::-1])]))
    start, end, texts = [], [], []
    raw = data.tobytes()
    for w in set(words):
        at = raw.find(w.encode())
        while at >= 0:
            start.append(at)
            end.append(at + len(w))
            texts.append(w)
            at = raw.find(w.encode(), at + 1)
    hashed = span_hashes(data, np.array(start), np.array(end), 5)
    by = {}
    for w, h in zip(texts, hashed.tolist(), strict=True):
        by.setdefault(w, set()).add(h)
    assert all(len(h) == 1 for h in by.values())
    assert len(set.union(*by.values())) == len(by)
    assert len(span_hashes(data, np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0
    assert (span_hashes(data, np.array(start), np.array(end), 6) != hashed).all()


@pytest.mark.parametrize("doublings", [6, 8, 10, 11, 14])
def test_self_similar_words(doublings):
    x, y = self_similar(doublings)
    data, offsets = text_bytes(pa.array([x, y, x.upper()]))
    hashed, *_ = Words().hash_words(data, offsets)
    assert hashed[0] != hashed[1] and hashed[0] == hashed[2]


def test_self_similar_words_in_the_operators(documents, spark):
    x, y = self_similar()
    texts = [x, y, f"{x} {y}", f"{y} {x} {x}"]
    rows = {r.doc_id: r for r in sentencepiece_codec.encode(documents(texts)).collect()}
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL_PATH)
    for i, text in enumerate(texts):
        assert rows[i].ids == library.encode(text) and rows[i].n_differences == 0 and rows[i].round_trip
    near = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(documents([x, y, x])).collect()}
    assert near == {0: 0, 1: 1, 2: 0}
    filler = " ".join(f"w{i}" for i in range(4))
    benchmark = spark.createDataFrame([(1, f"{filler} {x} " * 3)], "item_id long, text string")
    found = decontaminate.leaks(documents([f"{filler} {x} " * 3, f"{x} " * 15, f"{y} " * 15]), benchmark)
    assert [(r.doc_id, r.item_id) for r in found.collect()] == [(0, 1)]


SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", {folder!r}).getOrCreate())

def importable(_):
    try:
        import wordloom
        return ["yes"]
    except ImportError:
        return ["no"]

assert spark.sparkContext.parallelize([0], 1).mapPartitions(importable).collect() == ["no"]
import __spark_entry__ as contract
for name in {names!r}:
    print(name, contract.queries()[name](spark, "/root/testdata/sf0.001").count())
"""


def test_executors_need_no_copy_of_the_library(tmp_path):
    names = [
        "op2_sentencepiece",
        "op6_decontamination",
        "op10_ordinal_quality",
        "op11_periodic_runs",
        "op12_tokenizer_alignment",
        "op13_source_mixing",
    ]
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    script = SCRIPT.format(root=ROOT, folder=str(tmp_path / "shared"), names=names)
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert [line.split()[0] for line in out.stdout.splitlines() if line.startswith("op")] == names
