"""Predicates that select documents and packets."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

def match_all() -> Column:
    return F.lit(True)


def match_phrase(text: Column, phrase: str) -> Column:
    """The phrase's words in order, whatever stands between words, in any case."""
    padded = lambda x: F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(x), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    return F.contains(padded(text), padded(F.lit(phrase)))


def in_range(value: Column, gte=None, gt=None, lte=None, lt=None) -> Column:
    out = F.lit(True)
    for bound, test in ((gte, value.__ge__), (gt, value.__gt__), (lte, value.__le__), (lt, value.__lt__)):
        if bound is not None:
            out &= test(F.lit(bound))
    return out


def filtered(query: Column, *filters: Column) -> Column:
    for f in filters:
        query &= f
    return query


def uri_query(q: str) -> Column:
    """``*``, ``field:value`` and these joined by ``AND``; values may stand in double quotes."""
    out = F.lit(True)
    for part in re.split(r"\s+AND\s+", q.strip()):
        if part == "*":
            continue
        m = re.fullmatch(r'(\w[\w.]*):("(?:[^"]*)"|\S+)', part)
        if not m:
            raise ValueError(f"use a Column for this query: {part}")
        value = m[2].strip('"')
        out &= F.col(m[1]).isNotNull() if value == "*" else F.col(m[1]).cast("string") == value
    return out


def of_types(index: Column, type_: Column, wanted: dict[str, set[str]] | list[str] | None) -> Column:
    """Types in the wanted set, which may differ by index; an empty or missing set wants all."""
    if not wanted:
        return F.lit(True)
    if not isinstance(wanted, dict):
        return type_.isin(list(wanted))
    out = F.lit(True)
    for name, types in wanted.items():
        if types:
            out &= (index != name) | type_.isin(list(types))
    return out & index.isin(list(wanted))


def not_system(index: Column, system: list[str] | None = None) -> Column:
    """Not an index that jobs keep for themselves: one of ``system``, or by default any whose name begins with a dot."""
    return ~index.isin(list(system)) if system is not None else ~F.startswith(index, F.lit("."))


def sane_packet(index: Column, type_: Column, id_: Column, payload: Column) -> Column:
    """All parts there, and neither type nor id begins with a dot, as leftovers of other tools do."""
    return index.isNotNull() & type_.isNotNull() & id_.isNotNull() & payload.isNotNull() & ~F.startswith(type_, F.lit(".")) & ~F.startswith(id_, F.lit("."))
