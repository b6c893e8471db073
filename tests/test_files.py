import gzip
import io
import random
from contextlib import redirect_stdout

import pytest
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from wordloom import operators as op
from wordloom import sinks, sources
from wordloom.sources import files


@pytest.fixture
def folder(tmp_path):
    def write(**files):
        for name, content in files.items():
            path = tmp_path / name.replace("__", ".")
            path.write_bytes(content.encode())
        return str(tmp_path)

    return write


def read_back(spark, path):
    return sorted(r.value for r in spark.read.text(path).collect())


# --- corpora ------------------------------------------------------------------------------


def test_lines_of_files(spark, folder, rows):
    path = folder(a__txt="one\r\ntwo\rthree\nfour", b__txt="five\n\nsix")
    lines = rows(sources.read_lines(spark, path))
    assert lines == [("",), ("five",), ("four",), ("one",), ("six",), ("three",), ("two",)]


def test_document_id_is_the_file_name(spark, tmp_path, rows):
    for sub in ("x", "y"):
        (tmp_path / sub).mkdir()
    (tmp_path / "x" / "1+0 5%.txt").write_text("house\n")
    (tmp_path / "y" / "1+0 5%.txt").write_text("houses\n")
    (tmp_path / "y" / "a.txt.txt").write_text("tree\n")
    paths = [str(tmp_path / "x"), str(tmp_path / "y")]
    lines = sources.read_document_lines(spark, paths)
    assert rows(lines) == [
        ("1+0 5%.txt", "house"),
        ("1+0 5%.txt", "houses"),
        ("a.txt.txt", "tree"),
    ]
    clean = sources.read_document_lines(spark, paths, clean_ids=True)
    assert rows(clean.select("doc_id").distinct()) == [("1+0 5%",), ("a",)]
    assert rows(op.document_frequency(clean, text="line")) == [("hous", 1), ("tree", 1)]


def test_over_long_lines(spark, folder, rows):
    path = folder(a__txt="abc\nabcd\nab\nabcde")
    assert rows(sources.read_lines(spark, path, max_bytes=5)) == [("ab",), ("abc",)]
    assert len(rows(sources.read_document_lines(spark, path))) == 4
    # Bytes count, not characters: three letters in five bytes.
    wide = folder(a__txt="éàx\nabc")
    assert rows(sources.read_lines(spark, wide, max_bytes=6)) == [("abc",)]


def test_lines_of_a_table(texts, rows):
    docs = texts("a\nb\r\n\rc", None)
    assert rows(sources.document_lines(docs)) == [
        ("d1", 0, "a"),
        ("d1", 1, "b"),
        ("d1", 2, ""),
        ("d1", 3, "c"),
    ]


def test_table_with_few_splits_is_spread(spark, tmp_path, texts):
    path = str(tmp_path / "t")
    texts("a", "b").coalesce(1).write.parquet(path)
    table = sources.read_table(spark, path, "text")
    assert table.columns == ["text"]
    assert table.rdd.getNumPartitions() == 2 * spark.sparkContext.defaultParallelism


# --- word lists ---------------------------------------------------------------------------


def test_stopwords(spark, folder, rows):
    path = folder(stopwords__txt="The\r\n\r\n  don't \t\r\nthe\n\n")
    assert rows(sources.read_stopwords(spark, path)) == [("don't",), ("the",)]


def test_vocabulary(spark, folder, rows):
    path = folder(words__txt="York\t2172\ncity 9\n\nyork\n lead\n")
    assert rows(sources.read_vocabulary(spark, path)) == [("city",), ("york",)]


def test_an_empty_vocabulary_is_an_error(spark, folder):
    with pytest.raises(ValueError, match="empty"):
        sources.read_checked_vocabulary(spark, folder(words__txt="\n\n"))


def test_a_missing_file_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        sources.read_vocabulary(spark, str(tmp_path / "none"))


def test_a_long_list_in_code(spark, rows):
    words = [f"w{i}" for i in range(sources.wordlists.LITERAL_WORDS + 1)]
    assert rows(sources.word_set(spark, words)) == sorted((w,) for w in words)


def test_size_check(spark, monkeypatch):
    assert sources.are_few(["a", "b"])
    assert not sources.are_few(sources.word_set(spark, ["a"]))
    monkeypatch.setattr(sources.wordlists, "FEW_BYTES", 2)
    assert sources.are_few(["a", "b"]) and not sources.are_few(["a", "bc"])
    monkeypatch.setattr(sources.wordlists, "FEW_WORDS", 1)
    assert not sources.are_few(["a", "b"])


def test_word_set(spark, rows):
    assert rows(sources.word_set(spark, ["b", "a", "b", ""])) == [("a",), ("b",)]
    assert rows(sources.word_set(spark, [])) == []


# --- document-frequency tables ------------------------------------------------------------


def test_df_table(spark, folder, rows):
    lines = ["a\t5", " b \t7", "c", "d\tx", "e\t1\t2", "", "f\t9\t", "g\t99999999999", "h\t+3", "i\t1.5"]
    path = folder(df__tsv="\n".join(lines))
    assert rows(sources.read_df_table(spark, path)) == [("a", 5), ("b", 7), ("f", 9), ("h", 3)]


def test_a_duplicate_term_is_an_error(spark, folder):
    table = sources.read_df_table(spark, folder(df__tsv="a\t5\nb\t1\na\t6\n"))
    with pytest.raises(Exception, match="duplicate term"):
        table.collect()


# --- sinks --------------------------------------------------------------------------------


def test_pairs_and_counts(spark, texts, tmp_path):
    docs = texts("york city york")
    pairs = op.cooccurrence_pairs(docs, 1)
    sinks.write_pairs(pairs, str(tmp_path / "p"), ordered=True)
    assert read_back(spark, str(tmp_path / "p")) == ["(city,york)\t2", "(york,city)\t2"]
    sinks.write_tsv(op.word_count(docs), str(tmp_path / "w"), order_by="word")
    assert read_back(spark, str(tmp_path / "w")) == ["city\t1", "york\t2"]


def test_stripes(spark, texts, tmp_path):
    stripes = op.all_word_stripes(texts("b a", "b c", "d"), 1, parts=1)
    sinks.write_stripes(stripes, str(tmp_path / "s"), ordered=True)
    assert read_back(spark, str(tmp_path / "s")) == ["a\t{b=1}", "b\t{a=1, c=1}", "c\t{b=1}", "d\t{}"]


def test_stripes_in_parts_name_the_part(spark, texts, tmp_path):
    stripes = op.all_word_stripes(texts("b a", "b c", "d"), 1, parts=2)
    sinks.write_stripes(stripes, str(tmp_path / "s"), parts=2)
    fields = [line.split("\t") for line in read_back(spark, str(tmp_path / "s"))]
    assert {f[0] for f in fields if f[1] == "0"} == {"a", "b", "c", "d"}
    assert "".join(f[2].strip("{}") for f in fields if f[0] == "d") == ""


def test_scores_and_modes(spark, texts, tmp_path):
    table = spark.createDataFrame([("hous", 2)], "term string, df bigint")
    path = str(tmp_path / "t")
    scores = op.tf_idf(texts("house house"), table)
    sinks.write_scores(scores, path)
    assert read_back(spark, path) == ["d1\thous\t17.034786"]
    with pytest.raises(AnalysisException):
        sinks.write_scores(scores, path)
    sinks.write_scores(scores, path, mode="overwrite", ordered=True)
    assert read_back(spark, path) == ["d1\thous\t17.034786"]


def test_a_written_top_list_is_a_vocabulary(spark, texts, tmp_path, rows):
    docs = texts("york city york x")
    path = str(tmp_path / "top")
    sinks.write_tsv(op.top_words(op.word_count(docs), 2), path)
    assert rows(sources.read_vocabulary(spark, path)) == [("city",), ("york",)]


def test_ordered_files_follow_each_other(spark, tmp_path, texts):
    docs = texts(*[f"w{i:04d}" for i in range(2000)])
    path = str(tmp_path / "o")
    sinks.write_tsv(op.word_count(docs), path, order_by="word")
    files = sorted(p for p in (tmp_path / "o").iterdir() if p.name.startswith("part-"))
    lines = [line for f in files for line in f.read_text().splitlines()]
    assert lines == [f"w{i:04d}\t1" for i in range(2000)]


def test_documents_as_files(spark, tmp_path, texts, rows):
    docs = texts("a\nb", None, "same", "same", "", "ü\r\nx\n").repartition(4)
    path = tmp_path / "documents"
    sinks.write_documents(docs, str(path))
    files = list(path.glob("folder=*/*.txt"))
    expected = ["a\nb\n", "\n", "same\n", "same\n", "\n", "ü\r\nx\n\n"]
    assert sorted(f.read_bytes().decode() for f in files) == sorted(expected)
    assert len({f.name for f in files}) == len(files)
    assert not list(path.glob("_*")), "a task moves its folder into place and leaves nothing to commit"
    lines = sources.read_document_lines(spark, str(path))
    assert sorted(r[1] for r in rows(lines)) == sorted(["a", "b", "", "same", "same", "", "ü", "x", ""])
    whole, rest = sources.read_documents(spark, str(path))
    assert whole.count() == 6 and rest.count() == 0


def test_no_documents_as_files(spark, tmp_path, texts):
    path = str(tmp_path / "none")
    sinks.write_documents(texts("a").where("false"), path)
    assert sources.read_document_lines(spark, path).count() == 0


def test_documents_where_arrow_has_no_file_system(spark, tmp_path, texts, monkeypatch):
    def unknown(uri):
        raise OSError(uri)

    monkeypatch.setattr("wordloom.sinks.documents.fs.FileSystem", type("None", (), {"from_uri": staticmethod(unknown)}))
    path = str(tmp_path / "plain")
    sinks.write_documents(texts("a\nb", None), path)
    assert sorted(r.line for r in sources.read_document_lines(spark, path).collect()) == ["", "a", "b"]


@pytest.fixture
def odd_corpus(tmp_path):
    """Files in folders of a partition column and the same in one folder, with all that ends a line."""
    rng = random.Random(3)
    texts = [b"", b"\n", b"\r\r\n\n", b"one", b"\xef\xbb\xbfmark\r\nx", b"\xef\xbb\xbf", b"\xff\xfe broken \xc3\n", "ü ß\r".encode()]
    texts += [b"".join(rng.choice([b"a", b"bc d", b"\r", b"\n", b"\r\n"]) for _ in range(60)) for _ in range(12)]
    for i, text in enumerate(texts):
        for place in (tmp_path / "flat", tmp_path / f"parts/folder={i % 3}"):
            place.mkdir(parents=True, exist_ok=True)
            (place / f"n {i}+%41.txt").write_bytes(text)
            (place / "_hidden").write_bytes(b"hidden")
    return tmp_path


def _line_rows(df):
    return sorted((r[0], bytes(r[1])) for r in df.select("doc_id", F.col("line").cast("binary")).collect())


@pytest.mark.parametrize("step", [1, 2, 7, 1 << 20])
@pytest.mark.parametrize("folder", ["flat", "parts"])
def test_files_are_listed_and_read_in_tasks(spark, odd_corpus, monkeypatch, folder, step):
    path = str(odd_corpus / folder)
    expected = _line_rows(sources.read_document_lines(spark, path))
    assert len(expected) > 100
    _, lines = sources.read_documents(spark, path, whole_bytes=0)
    assert _line_rows(lines) == expected
    for size in (1, 2, 3, 10):
        monkeypatch.setattr("wordloom.sources.files.STEP_BYTES", step)
        found = []
        for file in sorted((odd_corpus / folder).glob("**/n *.txt")):
            with fs.LocalFileSystem().open_input_file(str(file)) as opened:
                n = file.stat().st_size
                found += [(file.name, line) for first in range(0, n, size) for line in files._range_lines(opened, first, first + size)]
        assert sorted(found) == expected
    whole, rest = sources.read_documents(spark, path)
    got = {r[0]: bytes(r[1]) for r in whole.select("doc_id", F.col("text").cast("binary")).collect()}
    assert got == {f.name: f.read_bytes() for f in (odd_corpus / folder).glob("**/n *.txt") if f.stat().st_size}
    assert rest.count() == 0


def test_the_driver_holds_no_list_of_files(spark, odd_corpus):
    for folder in ("flat", "parts"):
        for table in (*sources.read_documents(spark, str(odd_corpus / folder)), sources.list_documents(spark, str(odd_corpus / folder))):
            assert table.inputFiles() == []
            out = io.StringIO()
            with redirect_stdout(out):
                table.explain("simple")
            assert "FileScan" not in out.getvalue() and "BatchScan" not in out.getvalue()


def test_files_that_only_spark_reads(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a/x.txt.gz").write_bytes(gzip.compress(b"one\ntwo\n"))
    (tmp_path / "b/inner").mkdir(parents=True)
    (tmp_path / "b/y.txt").write_bytes(b"three")
    (tmp_path / "b/inner/z.txt").write_bytes(b"four")
    found = {}
    for place in (tmp_path / "a", tmp_path / "b", tmp_path / "b/y.txt", tmp_path / "?"):
        whole, rest = sources.read_documents(spark, str(place))
        assert rest.count() == 0
        found[place.name] = {r.doc_id: r.text for r in whole.collect()}
    assert found["a"] == {"x.txt.gz": "one\ntwo\n"} and found["y.txt"] == {"y.txt": "three"}
    assert found["b"] == {"y.txt": "three"} and found["?"] == found["a"] | found["b"]
    with pytest.raises(AnalysisException):
        sources.read_documents(spark, str(tmp_path / "none"))
