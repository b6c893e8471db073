"""Main text of web pages by template deduction over equivalence classes of tokens (operator 9).

A token is a tag in its place: the path of open elements, each with those of its class and id names that
half of the host's pages have. Names that change from page to page tell no places apart, and are left
out; so are levels below the first ``DEPTH``, whose elements belong to the place above them. Over the
pages of a host every token has an occurrence vector, its number of occurrences on each page.

1. A first pass counts the names. Then each task counts its pages' tokens; vectors are kept as an order-free hash of (page, count), so
   that partial results merge and a host with a third of all pages is no group of its own size.
2. Tokens of one host that share a vector form an equivalence class. A class is valid if it is
   frequent and each of its tokens stands inside a token of a valid class; classes thus nest into a
   template. Tokens that occur once on each page are its skeleton, between which the slots lie.
3. The skeleton token around the article holds the main slot: an ``article`` or ``main`` element, else
   the deepest container with all text that varies between pages, else the whole page. A page without
   its host's main slot gives its only article, or its only ``main``, or its whole text. Slots whose
   text is the same on all pages are part of the template, if other text in the main slot varies.
4. The main slot's text is extracted block by block, without the elements that by name or class are
   menus, headers, footers, sidebars, notices, adverts, forms, comments, scripts or styles. A ``header``
   inside an ``article`` is the article's own, with its headline, and stays.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wordloom.llm.shared import settled
from wordloom.llm.url_filter import host_of

#: Share of a host's pages on which a class must occur.
SUPPORT = 0.5
#: Distinct texts of one slot that show another one to be constant; copies of a page show nothing.
CONSTANT_TEXTS = 5
#: Levels of elements that a place tells apart.
DEPTH = 48
#: Letters of a label; longer ones are hashed.
LABEL = 80
#: Templates are broadcast up to so many bytes and joined by shuffle beyond.
BROADCAST_BYTES = 32 << 20

#: HTML elements by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template textarea title iframe svg math".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
SKIPPED_TAGS = frozenset(
    "head nav header footer aside form menu button select input option dialog object canvas audio video".split()
)
SKIPPED_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu"
    " breadcrumb breadcrumbs header masthead footer sidebar aside notice notices cookie cookies consent alert comment"
    " comments respond disqus form newsletter subscribe share social related".split()
)
WHOLE = frozenset(["html", "body", "article", "main"])
CONTAINERS = frozenset(["body", "article", "main", "section", "div", "td"])
PROSE = frozenset("h1 h2 h3 h4 h5 h6 p blockquote pre li dd dt td th figcaption".split())

_NAME = re.compile(r"</?([A-Za-z][^\s/>]*)")
_REST = re.compile(r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>""")
_ATTRIBUTE = re.compile(r"""(?i)(?:^|\s)(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_SPACE = re.compile(r"\s+")
_DIGITS = re.compile(r"\d+")


class Event:
    """What a page is made of: ``open`` and ``close`` of an element, ``text``, and block borders.

    ``deep`` elements have no token of their own.
    """

    __slots__ = ("kind", "path", "skip", "text", "inline", "deep")

    def __init__(self, kind: str, path: str, skip: bool, text: str = "", inline: bool = False, deep: bool = False):
        self.kind, self.path, self.skip, self.text, self.inline, self.deep = kind, path, skip, text, inline, deep


def names_in(attributes: str) -> set[str]:
    """Class, id and role names of a tag, digits made alike."""
    names: set[str] = set()
    for _, a, b, c in _ATTRIBUTE.findall(attributes):
        names.update(_DIGITS.sub("#", (a or b or c).lower()).split())
    return names


def events(page: str, kept: frozenset[str] | None = None) -> Iterator[Event]:
    """The elements and texts of a page in order. Markup that never ends is read to the page's end.

    Of the names of elements only ``kept`` ones are part of a place; None keeps all.
    """
    stack: list[tuple[str, str, bool]] = []  # name, path, skipped
    opened: dict[str, int] = {}
    at, size = 0, len(page)

    def here() -> tuple[str, bool]:
        return (stack[-1][1], stack[-1][2]) if stack else ("", False)

    while at < size:
        start = page.find("<", at)
        if start < 0:
            start = size
        if start > at:
            path, skip = here()
            yield Event("text", path, skip, page[at:start])
            at = start
            continue
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            at = size if end < 0 else end + 3
            continue
        name = _NAME.match(page, at)
        if not name:
            if page.startswith(("<!", "<?"), at):
                end = page.find(">", at)
                at = size if end < 0 else end + 1
            else:  # a lone sign
                path, skip = here()
                yield Event("text", path, skip, "<")
                at += 1
            continue
        rest = _REST.match(page, name.end())
        end = rest.end() if rest else page.find(">", name.end()) + 1 or size
        inside, tag = page[name.end() : end - 1], name[1].lower()
        at = end
        if page[name.start() + 1] == "/":
            if not opened.get(tag):
                continue
            depth = next(i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag)
            while len(stack) > depth:
                gone = stack.pop()
                opened[gone[0]] -= 1
                yield Event("close", gone[1], gone[2], gone[0], gone[0] in INLINE)
            continue
        if tag not in INLINE:  # a block ends an open paragraph, with what is open inside it
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE), None)
            if depth is not None and stack[depth][0] == "p" or depth is not None and stack[depth][0] == tag == "li":
                while len(stack) > depth:
                    gone = stack.pop()
                    opened[gone[0]] -= 1
                    yield Event("close", gone[1], gone[2], gone[0], gone[0] in INLINE)
        path, skip = here()
        names = set()
        if tag not in INLINE and ("class" in inside or "id" in inside or "role" in inside):
            names = names_in(inside)
        own_header = tag == "header" and opened.get("article", 0) > 0
        skip = skip or tag in RAW or tag in SKIPPED_TAGS and not own_header
        if not skip and names and tag not in WHOLE:
            parts = {part for n in names for part in re.split("[-_]+", n)}
            skip = not SKIPPED_NAMES.isdisjoint(parts - {"header"} if own_header else parts)
        deep = len(stack) >= DEPTH
        if not deep:
            label = ".".join([tag, *sorted(names if kept is None else names & kept)])
            if len(label) > LABEL:
                label = f"{tag}.{xxhash.xxh3_64_hexdigest(label)}"
            path = f"{path}/{label.replace('/', '|')}"
        yield Event("open", path, skip, tag, tag in INLINE, deep)
        if tag in VOID or inside.endswith("/") and tag not in CONTAINERS:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            at = close.end() if close else size
            continue
        stack.append((tag, path, skip))
        opened[tag] = opened.get(tag, 0) + 1
    while stack:
        gone = stack.pop()
        yield Event("close", gone[1], gone[2], gone[0], gone[0] in INLINE)


def _number(*parts: object) -> int:
    return xxhash.xxh3_64_intdigest("\x1f".join(map(str, parts))) - (1 << 63)


_NAMED = re.compile(r"<[A-Za-z][^<>]*?\s(?:class|id|role)\s*=[^<>]*", re.I)


def _count_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, name, pages), one row per host and name of a batch; the name '' counts the pages."""
    for batch in batches:
        found: dict[tuple[str, str], int] = {}
        for host, page in zip(*(batch.column(c).to_pylist() for c in ("host", "html")), strict=True):
            names = {""}
            for tag in set(_NAMED.findall(page)):
                names |= names_in(tag)
            for name in names:
                found[host, name] = found.get((host, name), 0) + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in found], pa.string()) for i in (0, 1)] + [pa.array(list(found.values()), pa.int64())],
            names=["host", "name", "pages"],
        )


def frequent_names(pages: DataFrame) -> DataFrame:
    """(host, names): the class, id and role names on at least ``SUPPORT`` of a host's pages.

    They are fewer than the names of ``1 / SUPPORT`` average pages of the host.
    """
    counts = pages.select("host", "html").mapInArrow(_count_names, "host string, name string, pages long")
    counts = counts.groupBy("host", "name").agg(F.sum("pages").alias("pages"))
    every = counts.where("name = ''").select("host", F.col("pages").alias("every"))
    often = counts.where("name != ''").join(every, "host").where(F.col("pages") >= SUPPORT * F.col("every"))
    return settled(often.groupBy("host").agg(F.collect_list("name").alias("names")), "names")


def _with(rows: DataFrame, by_host: DataFrame) -> DataFrame:
    """``rows`` with the columns of a table by host, broadcast if its bytes allow it."""
    size = by_host.agg(F.sum(F.length(F.to_json(F.struct("*")))).alias("n")).first().n or 0
    return rows.join(F.broadcast(by_host) if size <= BROADCAST_BYTES else by_host, "host", "left")


class _Kept:
    """The kept names of the rows of a batch, made once for each host."""

    def __init__(self) -> None:
        self.host, self.names = None, frozenset()

    def of(self, host: str, names: list[str] | None) -> frozenset[str]:
        if host != self.host:
            self.host, self.names = host, frozenset(names or ())
        return self.names


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(host, token, vector, pages, times, skip, contents, letters), one row per host and token of a batch.

    ``contents`` are hashes of the text right inside the token on a page: all distinct ones if fewer
    than ``CONSTANT_TEXTS``, else so many of them.
    """
    for batch in batches:
        found: dict[tuple[str, str], list] = {}
        kept = _Kept()
        for host, page_id, page, names in zip(
            *(batch.column(c).to_pylist() for c in ("host", "page_id", "html", "names")), strict=True
        ):
            times: dict[str, int] = {}
            skipped: dict[str, bool] = {}
            texts: dict[str, list[str]] = {}
            for e in events(page, kept.of(host, names)):
                if e.kind == "open" and not e.inline and not e.deep:
                    times[e.path] = times.get(e.path, 0) + 1
                    skipped[e.path] = e.skip
                elif e.kind == "text" and not e.skip and not e.text.isspace():
                    texts.setdefault(_block_path(e.path), []).append(e.text)
            if "" in texts:  # text outside of all elements has a place too
                times[""], skipped[""] = 1, False
            for path, n in times.items():
                text = "\x1f".join(texts.get(path, ()))
                content = _number(text)
                vector = _number(page_id, n)
                own = found.get((host, path))
                if own is None:
                    found[host, path] = [vector, 1, n, skipped[path], {content}, len(text)]
                else:
                    own[0] ^= vector
                    own[1] += 1
                    own[2] += n
                    if len(own[4]) < CONSTANT_TEXTS:
                        own[4].add(content)
                    own[5] += len(text)
        keys, values = list(found), list(found.values())
        columns = list(zip(*values, strict=True)) or [()] * 6
        columns[4] = list(map(list, columns[4]))
        kinds = [pa.int64()] * 3 + [pa.bool_(), pa.list_(pa.int64()), pa.int64()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string())]
            + [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
            names=["host", "token", "vector", "pages", "times", "skip", "contents", "letters"],
        )


def _block_path(path: str) -> str:
    """The path without inline elements at its end."""
    while path:
        head, _, last = path.rpartition("/")
        if last.split(".", 1)[0] not in INLINE:
            break
        path = head
    return path


def _in_valid_classes(frequent: DataFrame) -> DataFrame:
    """``frequent`` tokens of valid classes: each token of the class stands at the top or inside a token of a valid class.

    A class falls with any of its tokens, and takes those along that stand inside its tokens. Rounds end when none
    falls; what is left nests into the template. Inline elements have no token: what they hold stands inside the
    element around them.
    """
    parent = F.regexp_replace("token", f"(?:/(?:{'|'.join(sorted(INLINE))})(?=/))*+/[^/]*$", "")
    # the class of each token, and of the token it stands in; the page itself is always there
    classes = frequent.select("host", "vector", "token", parent.alias("parent")).where("token != ''")
    places = frequent.select("host", F.col("token").alias("parent"), F.col("vector").alias("outer"))
    links = classes.join(places, ["host", "parent"], "left").where("parent != ''")
    links = settled(links.select("host", "vector", "outer").distinct().where("outer is null or outer != vector"), "classes")
    fallen = settled(links.where("outer is null").select("host", "vector").distinct(), "classes")
    new = fallen
    while not new.isEmpty():
        inside = links.join(new.select("host", F.col("vector").alias("outer")), ["host", "outer"], "left_semi")
        new = inside.select("host", "vector").distinct().join(fallen, ["host", "vector"], "left_anti")
        new = settled(new, "classes")
        fallen = fallen.unionByName(new)
    return frequent.join(fallen, ["host", "vector"], "left_anti")


def templates(pages: DataFrame) -> DataFrame:
    """(host, main, fixed): the path of the main slot and the constant slots in it.

    An empty path stands for the whole page. Hosts without a template are absent. ``pages`` has (host, page_id,
    html, names) without nulls in host and html.
    """
    counted = pages.mapInArrow(
        _count_tokens,
        "host string, token string, vector long, pages long, times long, skip boolean, contents array<long>, letters long",
    )
    counted = settled(counted, "page-tokens")
    contents = counted.select("host", "token", F.explode("contents").alias("content")).distinct()
    contents = contents.groupBy("host", "token").agg(F.count("*").alias("n_texts"))
    tokens = (
        counted.groupBy("host", "token")
        .agg(
            F.expr("bit_xor(vector)").alias("vector"),
            F.sum("pages").alias("pages"),
            F.sum("times").alias("times"),
            F.max("skip").alias("skip"),
            F.sum("letters").alias("letters"),
        )
        .join(contents, ["host", "token"])
    )
    tokens = settled(tokens, "page-tokens")
    hosts = tokens.groupBy("host").agg(
        F.max("pages").alias("all_pages"), F.max(F.when(~F.col("skip"), F.col("n_texts"))).alias("most_texts")
    )
    # classes: tokens of a host with the same occurrence vector, frequent enough
    frequent = tokens.join(hosts, "host").where((F.col("pages") >= SUPPORT * F.col("all_pages")) & ~F.col("skip"))
    valid = _in_valid_classes(frequent)
    # how much text below a token varies, that of rare tokens too; every token adds to each of its ancestors
    tag = F.regexp_extract("token", r"/([^/.]*)[^/]*$", 1)
    enough_texts = F.coalesce(F.col("most_texts") >= CONSTANT_TEXTS, F.lit(False))
    varies = (F.col("n_texts") > 1) | ~enough_texts
    steps = F.split("token", "/")
    rare = F.col("pages") < SUPPORT * F.col("all_pages")
    varying = tokens.join(hosts, "host").where((varies | rare) & (F.col("letters") > 0) & ~F.col("skip"))
    whole = varying.groupBy("host").agg(F.sum("letters").alias("most"))
    up = varying.where("token != ''").select(
        "host",
        F.explode(F.sequence(F.lit(2), F.size(steps))).alias("depth"),
        steps.alias("steps"),
        "letters",
    )
    weight = up.select(
        "host", F.array_join(F.slice("steps", 1, F.col("depth")), "/").alias("token"), "letters"
    ).groupBy("host", "token").agg(F.sum("letters").alias("varying"))
    once = (F.col("times") == F.col("pages")) & tag.isin(*CONTAINERS)
    slots = valid.where(once).join(weight, ["host", "token"], "left").join(whole, "host", "left")
    named = tag.isin("article", "main")
    depth = F.size(steps)
    enough = F.coalesce(F.col("varying") == F.col("most"), F.lit(False))
    order = [named.desc(), F.when(named, depth).otherwise(-depth), F.col("token")]
    main = (
        slots.where(named | enough)
        .withColumn("rank", F.row_number().over(Window.partitionBy("host").orderBy(*order)))
        .where("rank = 1")  # a host has as many tokens as its pages have places
        .select("host", F.col("token").alias("main"))
    )
    main = hosts.select("host").join(main, "host", "left").withColumn("main", F.coalesce("main", F.lit("")))
    inside = frequent.join(main, "host").where(F.startswith(F.col("token"), F.concat("main", F.lit("/"))))
    own = tokens.where(~F.col("skip")).join(main, "host")
    own = own.where((F.col("token") == F.col("main")) | F.startswith(F.col("token"), F.concat("main", F.lit("/"))))
    proven = own.groupBy("host").agg(F.max("n_texts").alias("n")).where(F.col("n") >= CONSTANT_TEXTS)
    fixed = (
        inside.where((F.col("n_texts") == 1) & (F.col("letters") > 0) & ~tag.isin(*PROSE))
        .join(proven, "host", "left_semi")
        .groupBy("host")
        .agg(F.collect_list("token").alias("fixed"))
    )
    found = main.join(fixed, "host", "left").where("main != '' or fixed is not null")
    return settled(found, "templates")


def _own_place(page: str, kept: frozenset[str] | None) -> str | None:
    """The place of a page's only article, or else of its only ``main``, if it has one."""
    for tag in ("article", "main"):
        found, inside = [], 0
        if f"<{tag}" not in page.lower():
            continue
        for e in events(page, kept):
            if e.text == tag and not e.skip and not e.deep:
                if e.kind == "open":
                    found += [e.path] if not inside else []
                    inside += 1
                elif e.kind == "close":
                    inside -= 1
        if len(found) == 1:
            return found[0]
    return None


def main_text(
    page: str, main: str | None, fixed: frozenset[str] = frozenset(), kept: frozenset[str] | None = None
) -> str:
    """The text of a page's main slot; without the slot, that of its only article, or of the whole page."""
    places = [main] if main else []
    for place in [*places, "", None]:
        if place == "":
            place = _own_place(page, kept)
            if place is None:
                continue
        blocks, block, seen = [], [], place is None
        for e in events(page, kept):
            if e.kind != "text":
                if e.text == "br":
                    block.append(" ")
                elif not e.inline:
                    blocks.append("".join(block))
                    block = []
                seen = seen or e.path == place
                continue
            inside = place is None or e.path == place or e.path.startswith(place + "/")
            if inside and not e.skip and (not fixed or _block_path(e.path) not in fixed):
                block.append(e.text)
        blocks.append("".join(block))
        if seen:
            break
    tidy = (_SPACE.sub(" ", html.unescape(b)).strip() for b in blocks)
    return " ".join(b for b in tidy if b)


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kept = _Kept()
        columns = (batch.column(c).to_pylist() for c in ("host", "html", "main", "fixed", "names"))
        texts = [
            main_text(page, main, frozenset(fixed or ()), kept.of(host, names))
            for host, page, main, fixed, names in zip(*columns, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())],
            names=["page_id", "url", "text"],
        )


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text) for each row of (page_id, url, html).

    Null and empty html gives an empty text. Pages with a null url, or one without host, share the
    template of the empty host. A page without its host's main slot gives the text of its only article, or
    of its whole body, outside of the skipped elements. Repeated rows and null ids are extracted each; further
    columns are ignored; an empty table gives no rows. Of several containers that could be the main slot the
    deepest counts (of articles the outermost), ties go to the smaller path. A very long page is read in one
    task, in time and memory that grow with its length.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        host_of(F.col("url")).alias("host"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    )
    rows = _with(rows, frequent_names(rows))
    found = templates(rows.select("host", "page_id", "html", "names"))
    return _with(rows, found).mapInArrow(_extract, "page_id long, url string, text string")


def query(spark, sf_dir: str) -> DataFrame:
    texts = extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
