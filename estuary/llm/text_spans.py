"""Spans of regular expressions in texts, in SQL functions and in linear time."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPANS = "array<struct<s:int,e:int,v:string>>"
_CUT, _DEPTH = 24, 2


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, merge: Callable[[Column, Column], Column], zero: int, depth: int = _DEPTH) -> Column:
    """``merge`` of an array's elements up to each one, itself included; ``zero`` changes nothing.

    Blocks of ``_CUT`` are merged on their own, and the running values of
    the blocks, made in the same way, are carried in: no list is copied for each
    element, so an array of any length takes ``_CUT`` steps an element.
    """
    def naive(xs: Column) -> Column:
        return F.transform(xs, lambda _, i: F.aggregate(F.slice(xs, F.lit(1), i + 1), F.lit(zero), lambda a, x: merge(a, x)))

    def blocks(xs: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(xs), F.lit(_CUT)), lambda s: let(F.slice(xs, s, F.lit(_CUT)), naive))

    def moved(parts: Column) -> Column:
        wholes = running(F.transform(parts, lambda b: F.element_at(b, -1)), merge, zero, depth - 1)
        before = let(wholes, lambda w: F.concat(F.array(F.lit(zero)), F.slice(w, F.lit(1), F.size(w) - 1)))
        return F.flatten(F.zip_with(parts, before, lambda b, o: F.transform(b, lambda x: merge(o, x))))

    def long(xs: Column) -> Column:
        return F.when(F.size(xs) <= _CUT, naive(xs)).otherwise(let(blocks(xs), moved))

    return let(values, long if depth else naive)


def matches(text: Column, pattern: str) -> Column:
    """Start, end and text of every match, leftmost and non-overlapping; code points, ends exclusive."""
    def placed(found: Column) -> Column:
        sizes = F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found, lambda g, m: F.length(g) + F.length(m))
        ends = F.zip_with(running(sizes, lambda a, x: a + x, 0), found, lambda e, m: F.struct((e - F.length(m)).alias("s"), e.alias("e"), m.alias("v")))
        return F.when(F.size(found) > 0, ends).otherwise(F.array().cast(SPANS))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), placed)


def outside(found: Column, spans: Column) -> Column:
    """The elements of ``found``, in order of their starts, that overlap none of ``spans``.

    Both are put in one order; what ends last before an element and what
    begins first from it on tell whether a span overlaps it.
    """
    low = -(1 << 31) + 1

    def free(all_of: Column, xs: Column) -> Column:
        ends = running(F.transform(all_of, lambda t: F.when(t["i"] < 0, t["e"]).otherwise(low)), F.greatest, low)
        starts = running(F.transform(F.reverse(all_of), lambda t: F.when(t["i"] < 0, -t["s"]).otherwise(low)), F.greatest, low)
        edges = F.zip_with(ends, F.reverse(starts), lambda a, b: F.struct(a.alias("last"), (-b).alias("next")))
        kept = F.filter(F.zip_with(all_of, edges, lambda t, w: F.struct(t["i"].alias("i"), (
            (t["i"] >= 0) & (w["last"] <= t["s"]) & (w["next"] >= t["e"])).alias("free"))), lambda t: t["free"])
        return F.transform(kept, lambda t: F.get(xs, t["i"]))

    def placed(xs: Column) -> Column:
        marked = F.transform(xs, lambda x, i: F.struct(x["s"].alias("s"), x["e"].alias("e"), i.alias("i")))
        others = F.transform(spans, lambda b: F.struct(b["s"].alias("s"), b["e"].alias("e"), F.lit(-1).alias("i")))
        both = F.array_sort(F.concat(marked, others))
        return F.when((F.size(spans) == 0) | (F.size(xs) == 0), xs).otherwise(let(both, lambda t: free(t, xs)))

    return let(found, placed)
