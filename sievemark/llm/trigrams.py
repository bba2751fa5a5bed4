"""Which trigrams must a regular expression's match contain?

``clauses(pattern)`` gives an AND of ORs of lower-case trigrams that every match
contains, or an empty list if none is mandatory. The analysis keeps, for each part
of the expression, its finite set of exact strings while that stays small; where a
part is unbounded, the strings gathered so far become a clause.
"""

from __future__ import annotations

import re
from itertools import product
from re import _constants as C
from re import _parser

#: Exact sets larger than this are given up.
MOST_STRINGS = 64


def _one(op, arg) -> set[str] | None:
    """Strings of one parsed node, or None if they are too many."""
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN:
        found: set[str] = set()
        for kind, x in arg:
            if kind is C.LITERAL:
                found.add(chr(x).lower())
            elif kind is C.RANGE and x[1] - x[0] < 4:
                found |= {chr(i).lower() for i in range(x[0], x[1] + 1)}
            else:
                return None
        return found
    return None


def _walk(nodes, out: list[set[str]], current: set[str]) -> set[str] | None:
    """Extends ``current`` by ``nodes``; where the strings end, adds a clause to ``out``."""
    for op, arg in nodes:
        if op is C.SUBPATTERN:
            current = _walk(arg[3], out, current) or {""}
            continue
        if op is C.AT or op is C.ASSERT or op is C.ASSERT_NOT:
            continue
        options: set[str] | None = None
        if op is C.BRANCH:
            options = set()
            for branch in arg[1]:
                inner: list[set[str]] = []
                got = _walk(branch, inner, {""})
                if inner or got is None or options is None:
                    options = None
                else:
                    options |= got
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT):
            low, high, body = arg
            inner = []
            got = _walk(body, inner, {""}) if high == 1 or low == high and low <= 8 else None
            if got is not None and not inner:
                options = {"".join(x) for x in product(got, repeat=low)} if low == high else got | {""}
            elif low >= 1:
                out.extend(inner)
        else:
            options = _one(op, arg)
        if options is None or len(current) * len(options) > MOST_STRINGS:
            _clause(current, out)
            current = {""} if options is None or len(options) > MOST_STRINGS else options
        else:
            current = {a + b for a in current for b in options}
    return current


def _clause(strings: set[str], out: list[set[str]]) -> None:
    if all(len(s) >= 3 for s in strings):
        out.append(set(strings))


def clauses(pattern: str) -> list[list[str]]:
    """AND of ORs of trigrams. A clause of strings becomes, for each position that all reach, one OR."""
    found: list[set[str]] = []
    last = _walk(_parser.parse(pattern, re.ASCII), found, {""})
    _clause(last or {""}, found)
    query: list[list[str]] = []
    for strings in found:
        for at in range(min(len(s) for s in strings) - 2):
            query.append(sorted({s[at : at + 3] for s in strings}))
    return [list(x) for x in dict.fromkeys(map(tuple, query))]
