"""The jobs from files to files, chained as a user chains them."""

import pytest

from wordloom.__main__ import main


@pytest.fixture
def corpus(tmp_path):
    folder = tmp_path / "corpus"
    folder.mkdir()
    (folder / "1.txt").write_text("New York city, York city.\nThe house\r\n")
    (folder / "2.txt").write_text("the houses of York\rdays, days")
    (tmp_path / "stop.txt").write_text("The\n\nof\n")
    return tmp_path


@pytest.fixture
def run(spark, corpus):
    """Run a job; the paths are names inside the test's folder."""

    def call(job, paths, *arguments):
        main([job, *(str(corpus / p) for p in paths.split()), *arguments])

    return call


def lines(folder, name):
    files = sorted(p for p in (folder / name).iterdir() if p.name.startswith("part-"))
    return [line for f in files for line in f.read_text().splitlines()]


def test_words_then_cooccurrence(run, corpus):
    run("top-words", "corpus top stop.txt", "--k", "2")
    assert lines(corpus, "top") == ["york\t3", "city\t2"]
    pairs = ["(city,city)\t2", "(city,york)\t3", "(york,city)\t3", "(york,york)\t2"]
    run("pairs", "corpus pairs top", "2", "--ordered")
    assert lines(corpus, "pairs") == pairs
    run("pairs", "corpus loose top", "2")
    assert sorted(lines(corpus, "loose")) == pairs
    run("frequent-pairs", "corpus frequent stop.txt", "2", "--k", "2", "--ordered")
    assert lines(corpus, "frequent") == pairs
    run("stripes", "corpus stripes top stop.txt", "2", "--ordered")
    assert lines(corpus, "stripes") == ["city\t{city=2, york=3}", "york\t{city=3, york=2}"]
    run("all-word-stripes", "corpus all stop.txt", "1", "--parts", "1", "--ordered")
    assert lines(corpus, "all") == [
        "city\t{york=3}",
        "days\t{days=2}",
        "house\t{}",
        "houses\t{}",
        "new\t{york=1}",
        "york\t{city=3, new=1}",
    ]
    run("all-word-stripes", "corpus parts stop.txt", "1", "--parts", "3")
    fields = [line.split("\t") for line in lines(corpus, "parts")]
    assert {len(f) for f in fields} == {3}
    assert {f[0] for f in fields if f[1] == "0"} == {"city", "days", "house", "houses", "new", "york"}
    york = {entry for f in fields if f[0] == "york" for entry in f[2][1:-1].split(", ") if entry}
    assert york == {"city=3", "new=1"}


def test_lists_of_any_length(run, corpus, monkeypatch):
    """A list that is not short is joined behind a filter; the files are the same."""
    run("top-words", "corpus words stop.txt", "--k", "3")
    expected = {}
    for few in (100_000, 0):
        monkeypatch.setattr("wordloom.plans.FEW_WORDS", few)
        for d in ("2", "30"):
            run("pairs", f"corpus pairs{few}-{d} words", d, "--ordered")
            run("stripes", f"corpus stripes{few}-{d} words stop.txt", d, "--ordered")
            found = lines(corpus, f"pairs{few}-{d}"), lines(corpus, f"stripes{few}-{d}")
            assert found == expected.setdefault(d, found) and all(found)
        run("document-frequency", f"corpus df{few} stop.txt", "--ordered")
        assert lines(corpus, f"df{few}") == expected.setdefault("df", lines(corpus, f"df{few}"))


def test_document_frequency_then_scores(run, corpus):
    run("document-frequency", "corpus df stop.txt", "--ordered")
    assert lines(corpus, "df") == ["citi\t1", "dai\t1", "hous\t2", "new\t1", "york\t2"]
    run("top-terms", "df top", "--k", "3")
    assert lines(corpus, "top") == ["york\t2", "hous\t2", "new\t1"]
    run("tf-idf", "corpus scores top", "--ordered")
    assert lines(corpus, "scores") == [
        "1\thous\t8.517393",
        "1\tnew\t9.210440",
        "1\tyork\t17.034786",
        "2\thous\t8.517393",
        "2\tyork\t8.517393",
    ]
    run("frequent-term-scores", "corpus direct stop.txt", "--k", "3", "--ordered")
    assert lines(corpus, "direct") == lines(corpus, "scores")
    (corpus / "none.tsv").write_text("no table\n")
    with pytest.raises(ValueError, match="empty"):
        run("tf-idf", "corpus nothing none.tsv")
    run("tf-idf", "corpus short top", "--n-documents", "2", "--max-line-bytes", "20", "--ordered")
    assert lines(corpus, "short") == ["1\thous\t0.693147", "2\thous\t0.693147", "2\tyork\t0.693147"]


def test_usage(capsys):
    with pytest.raises(SystemExit):
        main(["pairs", "corpus", "out", "words", "far"])
    assert "invalid int value" in capsys.readouterr().err
