"""WARC archives, URL filters and text extraction against brute force."""

import gzip
import hashlib
import html
import math
import re
from collections import Counter

import duckdb
import pytest

from wordloom.llm import html_text, url_filter, warc

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def pages(spark):
    def make(*rows):
        return spark.createDataFrame(
            [(*r, "x") for r in rows], "page_id long, url string, html string, digest string"
        )

    return make


# --- WARC ----------------------------------------------------------------------------------

BIG, OTHER = "b" * 1200, "é" * 700


def rows_of(df):
    return sorted(
        ((r.page_id, r.record_type, r.payload_bytes, r.payload_digest, r.refers_to) for r in df.collect()), key=str
    )


def test_round_trip(pages):
    table = pages(
        (1, "http://a/", BIG), (2, "u\r\nx", BIG), (3, None, "small"), (4, "c", "small"), (5, "d", None),
        (6, "e", OTHER), (7, "f", OTHER), (7, "f", OTHER), (None, "g", BIG), (8, "h", "\r\n\r\nWARC/1.1\r\n"),
    )
    read = warc.read_warc(warc.write_warc(table)).collect()
    got = {(r.page_id, r.record_type): r for r in read}
    assert len(read) == 10
    assert got[1, "revisit"].refers_to == 2 and got[1, "revisit"].payload is None
    assert got[6, "revisit"].refers_to == 7
    assert got[2, "response"].url == "u%0D%0Ax" and got[3, "response"].url is None
    for r in read:
        if r.record_type == "response":
            assert hashlib.sha1(r.payload).hexdigest() == r.payload_digest and len(r.payload) == r.payload_bytes
    assert got[1, "revisit"].payload_bytes == 1200
    assert got[1, "revisit"].payload_digest == hashlib.sha1(BIG.encode()).hexdigest()
    assert sum(r.record_type == "response" for r in read if r.page_id == 7) == 2
    assert warc.read_warc(warc.write_warc(table.limit(0))).collect() == []


def test_files_are_plain_gzip_members(pages, tmp_path):
    manifest = warc.write_warc(pages((1, "u", "text"), (2, "v", "more")), f"file://{tmp_path}/w").collect()
    data = b"".join(gzip.open(r.path.removeprefix("file://")).read() for r in manifest)
    assert data.count(b"WARC/1.1\r\n") == 2 and sum(r.records for r in manifest) == 2


@pytest.mark.parametrize("split", [7, 100, 333, 5000])
def test_every_record_has_one_owner(tmp_path, split):
    """Also where a record's stored data holds gzip magic and whole members of another archive."""
    inner = b"".join(warc._member(900 + i, "x", b"inner", "00" * 20, None) for i in range(2))
    members = []
    for i in range(12):
        member = warc._member(i, f"http://h/{i}", b"p%d " % i * (i * 40), "00" * 20, None)
        text = gzip.decompress(member)
        if i == 5:  # stored, not compressed: the inner members stand in the file byte by byte
            text = re.sub(rb"Content-Length: \d+", b"Content-Length: %d" % (len(inner) + 40), text, count=1)
            head = text.split(b"\r\n\r\n")[0]
            member = gzip.compress(head + b"\r\n\r\nHTTP/1.1 200 OK\r\n\r\n" + inner + b"\x1f\x8b\x08junk", 0)
        members.append(member)
    path = tmp_path / "a.warc.gz"
    path.write_bytes(b"".join(members))
    owners = []
    size = path.stat().st_size
    for start in range(0, size, split):
        reader = warc._Members(f"file://{path}", size)
        at = reader.first(start, min(start + split, size))
        while at is not None and at < min(start + split, size):
            owners.append(at)
            at = reader.inflate(at)[1]
    begin = [0]
    for m in members[:-1]:
        begin.append(begin[-1] + len(m))
    assert owners == begin


def test_damage_is_an_error(spark, pages, tmp_path):
    manifest = warc.write_warc(pages((1, "u", "text" * 100)), f"file://{tmp_path}/w").collect()
    path = manifest[0].path.removeprefix("file://")
    data = open(path, "rb").read()
    open(path, "wb").write(data[:-20])
    files = spark.createDataFrame([(manifest[0].path, len(data) - 20)], "path string, size long")
    with pytest.raises(Exception, match="cut off"):
        warc.read_warc(files).collect()


def test_warc_query_against_sql(spark):
    database = duckdb.connect()
    database.execute(f"CREATE VIEW pages AS SELECT * FROM '{FOLDER}/pages.parquet'")
    df = warc.query(spark, FOLDER)
    relation = database.sql(warc.ORACLE)
    order = [relation.columns.index(c) for c in df.columns]
    assert sorted(map(tuple, df.collect()), key=str) == sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=str)


# --- URL filters ---------------------------------------------------------------------------


def parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def judged(rows):
    """Rules and naive Bayes, straight from the definition."""
    words = Counter()
    for _, _, page in rows:
        title = re.search(r"(?i)<title[^>]*>([^<]*)", page or "")
        if title:
            words.update(w for w in re.split(r"[\W\d_]+", title[1].lower()) if len(w) > 1)
    total = sum(words.values()) + 1

    def tokens(host, path):
        found = []
        for label in re.split(r"[\W_]+", host):
            places = [(i, j) for i in range(len(label)) for j in range(i + 1, min(len(label), i + 24) + 1)]
            known = {(i, j): math.log(words[label[i:j]] / total) for i, j in places if words[label[i:j]]}
            found += ["h:" + w for w in url_filter.viterbi(label, known, total)]
        skeleton = re.sub("[0-9]+", "#", path)
        return found + ["p:" + w.lower() for w in re.split(r"[^\w#]+|_", skeleton) if w]

    out, counts, seen = {}, {"allow": Counter(), "block": Counter()}, Counter()
    for page_id, url, _ in rows:
        host, path = parts(url)
        fits = [
            (len(h + p), h + p, v)
            for h, p, v in url_filter.RULES
            if (host == h or host.endswith("." + h)) and path.startswith(p)
        ]
        _, rule, verdict = max(fits, default=(0, None, None))
        out[page_id] = [host, path, rule, verdict]
        if rule:
            counts[verdict].update(tokens(host, path))
            seen[verdict] += 1
    known = set(counts["allow"]) | set(counts["block"])
    for row in out.values():
        if row[3] is None:
            odds = math.log((seen["block"] + 1) / (seen["allow"] + 1)) if seen else 0.0
            for t in tokens(row[0], row[1]):
                if t in known:
                    for sign, v in ((1, "block"), (-1, "allow")):
                        odds += sign * math.log((counts[v][t] + 1) / (counts[v].total() + len(known) + 1))
            row[3] = "block" if odds > 0 else "allow"
    return {k: tuple(v) for k, v in out.items()}


def filtered(df):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.filter_urls(df).collect()}


URLS = [
    "http://Example.COM/en/x?y", "https://www.example.com/en/", "http://example.com/EN/", "http://com", "http://com/",
    "http://notcom/", "http://a.net/es/1", "http://a.net/esx", "http://a.net/fr/2#f", "http://a.org/fr/3", None, "", "no scheme",
    "http://", "x://y://z/", "http://b.org?q=/en/", "http://bignews.org/fr/sport", "http://user@a.com:80/en/", "http://a.com\n/en/",
]


def test_rules_and_bayes_against_brute_force(pages):
    titles = [None, "<title>big news</title>", "<TITLE lang='x'>sport News example</TITLE>", "<p>none"]
    rows = [(i, u, titles[i % 4]) for i, u in enumerate(URLS)]
    assert filtered(pages(*rows)) == judged(rows)


def test_given_pages_against_brute_force(spark):
    rows = [(r.page_id, r.url, r.html) for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.query(spark, FOLDER).collect()}
    assert got == judged(rows)


def test_url_edge_cases(pages):
    assert filtered(pages((1, "x", None)).limit(0)) == {}
    assert filtered(pages((1, "http://nobody/", None), (2, None, None))) == {
        1: ("nobody", "/", None, "allow"),
        2: ("", "", None, "allow"),
    }


def test_segmentation():
    known = {(0, 3): -2.0, (3, 7): -2.0, (0, 7): -9.0}
    assert url_filter.viterbi("bignews", known, 100.0) == ["big", "news"]
    assert url_filter.viterbi("", {}, 10.0) == []
    assert "".join(url_filter.viterbi("x" * 60, {}, 10.0)) == "x" * 60


# --- text extraction -------------------------------------------------------------------------


def template(i, body, menu="<nav><ul><li>Home</li></ul></nav>", wrap="article"):
    return (
        f"<!DOCTYPE html><html><head><title>T{i}</title><style>p{{}}</style><script>var t='</p>{i}';</script></head>"
        f"<body>{menu}<!-- c {i} --><div class='ad-box'>Buy {i}</div><{wrap}>{body}</{wrap.split()[0]}>"
        f"<div class='comments'><p>first! {i}</p></div><footer>&copy; x</footer></body></html>"
    )


def texts_of(df):
    return {r.page_id: r.text for r in html_text.extract(df).collect()}


def test_article_text(pages):
    body = "<h1>Head &amp; shoulders</h1><p>a <b>b</b>c<br>d<p>e&nbsp; f\n g</p><aside>side</aside><form>f</form>"
    rows = [(i, "http://h/", template(i, body + f"<p>{i}")) for i in range(6)]
    rows += [(10, "http://h/", None), (11, None, "<p>only</p> text"), (12, "http://h/", "<article><p>cut &am")]
    got = texts_of(pages(*rows))
    assert all(got[i] == f"Head & shoulders a bc d e f g {i}" for i in range(6))
    assert (got[10], got[11], got[12]) == ("", "only text", "cut &am")
    assert texts_of(pages(*rows).limit(0)) == {}


def test_a_main_slot_without_an_article_element(pages):
    rows = []
    for i in range(8):
        body = f"<h2>Story {i}</h2><p>{' '.join(f'w{i}x{k}' for k in range(40))}</p><div class='tools'>Print this page</div>"
        page = template(i, body, "<div class='top'>Site name and motto</div>", "div id='content'")
        rows.append((i, "http://h/", page))
    got = texts_of(pages(*rows))
    for i in range(8):
        assert got[i] == f"Story {i} " + " ".join(f"w{i}x{k}" for k in range(40))


def test_a_main_slot_holds_all_varying_text(pages):
    words = lambda i: " ".join(f"w{i}x{k}" for k in range(200))
    rows, expected = [], {}
    for i in range(8):
        # a heading, a note on one page only, and a date beside the body, each a small share of the letters
        note = "<div class='note'>Corrected</div>" if i == 3 else ""
        body = f"<h1>Story {i}</h1>{note}<div class='entry'><p>{words(i)}</p></div><div class='date'>Day {i}</div>"
        rows.append((i, "http://h/", template(i, body, "<div class='top'>Site name</div>", "div class='content'")))
        expected[i] = f"Story {i} {'Corrected ' if note else ''}{words(i)} Day {i}"
    for i in range(8, 16):  # loose text behind the last element
        rows.append((i, "http://loose/", f"<html><body><div class='top'>Site name</div><div>{words(i)}</div></body></html>end {i}"))
        expected[i] = f"{words(i)} end {i}"
    assert texts_of(pages(*rows)) == expected


def test_copies_of_one_page_keep_their_text(pages):
    page = template(0, "<h1>One</h1><p>text</p>")
    assert set(texts_of(pages(*[(i, "http://h/", page) for i in range(9)])).values()) == {"One text"}


def test_copies_of_one_article_are_no_template(pages):
    body = "<div class='text'>The only article</div>"
    rows = [(i, "http://same/", template(0, body)) for i in range(5)]
    # what differs stands outside of the article
    rows += [(i, "http://top/", template(i, body, f"<div class='top'>Day {i}</div>")) for i in range(5, 12)]
    # two articles, mirrored
    rows += [(i, "http://two/", template(i, f"<p>{i % 2}</p>{body}")) for i in range(12, 20)]
    # five articles show what is the template
    rows += [(i, "http://many/", template(i, f"<p>{i}</p>{body}")) for i in range(20, 25)]
    expected = {i: "The only article" for i in range(12)}
    expected |= {i: f"{i % 2} The only article" for i in range(12, 20)} | {i: f"{i}" for i in range(20, 25)}
    assert texts_of(pages(*rows)) == expected


def test_names_that_change_from_page_to_page(pages):
    """On the body, on a wrapper, on both, and as ids of their own; the article is the same slot."""
    rows, expected = [], {}
    kinds = ["<body class='{c}'>{a}", "<body><div class='wrap-{c}'>{a}</div>", "<body class='{c} b'><div id='{c}'>{a}</div>"]
    for i in range(24):
        c = "abcdefgh"[i % 8] + "x" * (i % 8)
        a = f"<article><h1>T{i}</h1><p>body {i} text</p></article>"
        page = kinds[i // 8].replace("<body", "<body", 1).format(c=c, a=f"<div>Site name and motto</div>{a}<div>Imprint</div>")
        rows.append((i, f"http://h{i // 8}/", f"<html>{page}</body></html>"))
        expected[i] = f"T{i} body {i} text"
    assert texts_of(pages(*rows)) == expected


def test_a_wrapper_without_an_article_element(pages):
    rows, expected = [], {}
    for i in range(10):
        words = " ".join(f"w{i}x{k}" for k in range(30))
        page = f"<body class='cat-{'abcdefghij'[i]}'><div class='top'>Site name</div><div class='entry post-{chr(97 + i)}'><h2>T{i}</h2><p>{words}</p></div><div class='end'>Imprint</div></body>"
        rows.append((i, "http://h/", page))
        expected[i] = f"T{i} {words}"
    assert texts_of(pages(*rows)) == expected


def test_the_header_of_an_article_holds_its_headline(pages):
    page = "<body><header><h1>Site</h1></header>{}<article><header class='entry-header'><h1>T{}</h1></header><p>text {}</p><footer>tags</footer></article></body>"
    rows = [(i, "http://h/", page.format("", i, i)) for i in range(7)]
    assert texts_of(pages(*rows)) == {i: f"T{i} text {i}" for i in range(7)}


def test_the_only_article_of_a_page_that_fits_no_template(pages):
    rows = [(i, f"http://h{i}/", f"<body><div>menu of words</div><main><article><p>one {i}</p></article></main><div>end</div></body>") for i in range(3)]
    rows += [(9, "http://two/", "<body><article>a</article><article>b</article>c</body>")]
    got = texts_of(pages(*rows))
    assert [got[i] for i in range(3)] == ["one 0", "one 1", "one 2"] and got[9] == "a b c"


def test_deep_markup_costs_its_length(pages):
    """20,000 nested elements: places stay short, the text is whole."""
    import time

    depth = 20_000
    inner = "".join(f"<div>w{k} " for k in range(depth))
    expected = " ".join(f"w{k}" for k in range(depth))
    rows = [(i, "http://h/", f"<body><article>{inner}{i}</article></body>") for i in range(3)]
    start = time.perf_counter()
    got = texts_of(pages(*rows))
    assert got == {i: f"{expected} {i}" for i in range(3)}
    assert time.perf_counter() - start < 60
    assert max(len(e.path) for e in html_text.events("<div class='a" + "b" * 5000 + "'>" * 200)) < 48 * 90


def test_a_host_of_many_pages_with_names_of_their_own(pages):
    rows = [
        (i, "http://h/", f"<body id='page-{i}' class='t{'abcdefgh'[i % 8]}'><div class='n{'xyz'[i % 3]}'>Name</div><article><h1>T{i}</h1><p>text {i}</article><p>Imprint</body>")
        for i in range(10_000)
    ]
    assert texts_of(pages(*rows)) == {i: f"T{i} text {i}" for i in range(10_000)}


def test_odd_markup():
    cases = {"a < b": "a < b", "<": "<", "<p": "", "<!-- x": "", "<p>a</b>c": "ac", "<script>x": "", "</p>z": "z", "<a href='>'>q</a>": "q", "<p title=\"x>": ""}
    for page, expected in cases.items():
        assert html_text.main_text(page, None) == expected, page
    assert html_text.main_text("<div>" * 3000 + "deep", None) == "deep"


def test_given_pages(spark):
    got = {r.page_id: r for r in html_text.query(spark, FOLDER).collect()}
    for p in spark.read.parquet(f"{FOLDER}/pages.parquet").collect():
        inside = re.search(r"(?s)<article>(.*?)(</article>|$)", p.html)[1]
        blocks = re.split(r"</?(?:p|h1|div|ul|li)[^>]*>", inside)
        tidy = (" ".join(html.unescape(re.sub("</?b>", "", re.sub("<br>", " ", b))).split()) for b in blocks)
        expected = " ".join(b for b in tidy if b)
        assert (got[p.page_id].text, got[p.page_id].n_chars, got[p.page_id].url) == (expected, len(expected), p.url)


def test_a_class_falls_with_a_token_outside_of_the_template(spark):
    # one page marks the outer element an advert: it is no token, and what stands in it no part of the template
    page = '<body><div class="u{0}"><section><div>{1}</div></section></div></body>'
    rows = [(9, "http://h.org/", '<body><div class="ad">buy</div></body>')]
    rows += [(i, "http://h.org/", page.format(chr(97 + i) * 3, f"own text {i}")) for i in range(9)]
    rows += [(i, "http://i.org/", f"<body><span><div><p>text {i}</p></div></span></body>") for i in range(10, 16)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    named = pages.selectExpr("split(url, '/')[2] AS host", "page_id", "html", "cast(array() AS array<string>) AS names")
    main = {r.host: r.main for r in html_text.templates(named).collect()}
    assert main == {"h.org": "/body", "i.org": "/body/span/div"}
    texts = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert texts == {i: f"own text {i}" for i in range(9)} | {9: ""} | {i: f"text {i}" for i in range(10, 16)}


def test_classes_fall_with_those_they_stand_in(spark):
    table = [
        ("h", "/body", 1),
        ("h", "/body/div", 2),
        ("h", "/gone/section", 2),  # of the class of /body/div, inside of nothing
        ("h", "/body/div/td", 3),
        ("h", "/body/div/td/div", 4),
        ("h", "/body/main", 5),
        ("i", "/body/div", 2),  # another host's class, without its body
        ("j", "", 1),
        ("j", "/body", 2),
    ]
    frequent = spark.createDataFrame(table, "host string, token string, vector long")
    left = sorted(r.host + r.token for r in html_text._in_valid_classes(frequent).collect())
    assert left == ["h/body", "h/body/main", "j", "j/body"]
