"""Boolean trigram queries that every match of a regular expression satisfies.

A query is a list of alternatives, each a set of trigrams that all occur in the lower-cased text;
``None`` stands for a pattern without mandatory trigrams. The derivation walks the parsed pattern:
runs of literals, small classes and alternations multiply out to sets of strings, whose trigrams are
required; whatever has no small set of strings ends the run and asks for nothing.
"""

from __future__ import annotations

import re
from re import _constants as kind
from re import _parser

#: Strings and alternatives up to which sets are multiplied out.
MOST = 64

Query = list[frozenset[str]]


def _trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def _simplify(query: Query) -> Query:
    """Without alternatives that another one implies."""
    distinct = sorted(set(query), key=lambda x: (len(x), sorted(x)))
    return [q for q in distinct if not any(p < q for p in distinct)]


def _both(a: Query, b: Query) -> Query:
    """Every alternative of a with every one of b, unless that grows too large: then the stronger."""
    if len(a) * len(b) > MOST:
        return a if min(map(len, a)) >= min(map(len, b)) else b
    return _simplify([x | y for x in a for y in b])


def _of_strings(strings: set[str]) -> Query:
    return _simplify([_trigrams(s) for s in strings])


def _strings(node) -> set[str] | None:
    """All strings that a node matches, lower-cased, or None if they are not few."""
    op, value = node
    if op is kind.LITERAL:
        return {chr(value).lower()}
    if op is kind.IN:
        found = set()
        for what, x in value:
            if what is kind.LITERAL:
                found.add(chr(x).lower())
            elif what is kind.RANGE and x[1] - x[0] < 8:
                found |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
            else:
                return None
        return found if len(found) <= 8 else None
    if op is kind.SUBPATTERN:
        return _sequence_strings(value[-1])
    if op is kind.BRANCH:
        found = set()
        for part in value[1]:
            own = _sequence_strings(part)
            if own is None:
                return None
            found |= own
        return found if len(found) <= MOST else None
    if op in (kind.MAX_REPEAT, kind.MIN_REPEAT):
        low, high, part = value
        if (low, high) in ((0, 1), (1, 1)):
            own = _sequence_strings(part)
            return None if own is None else own | ({""} if low == 0 else set())
        return None
    if op is kind.AT:
        return {""}
    return None


def _sequence_strings(nodes) -> set[str] | None:
    found = {""}
    for node in nodes:
        own = _strings(node)
        if own is None or len(found) * len(own) > MOST:
            return None
        found = {a + b for a in found for b in own}
    return found


def _query(nodes) -> Query:
    query: Query = [frozenset()]
    run = {""}
    for node in nodes:
        own = _strings(node)
        if own is not None and len(run) * len(own) <= MOST:
            run = {a + b for a in run for b in own}
            continue
        query = _both(query, _of_strings(run))
        run = {""} if own is None else own
        if own is None:
            op, value = node
            if op is kind.SUBPATTERN:
                query = _both(query, _query(value[-1]))
            elif op is kind.BRANCH:
                query = _both(query, _simplify([q for part in value[1] for q in _query(part)]))
            elif op in (kind.MAX_REPEAT, kind.MIN_REPEAT) and value[0] > 0:
                query = _both(query, _query(value[2]))
    return _both(query, _of_strings(run))


def trigram_query(pattern: str) -> Query | None:
    """The alternatives for ``pattern``, or None where some match needs no trigram."""
    re.compile(pattern)
    query = _query(_parser.parse(pattern))
    return None if frozenset() in query else query
