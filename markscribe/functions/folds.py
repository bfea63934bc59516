"""Ordered folds, runs and spans over arrays in a document's row, in time that grows with the array.

Appending to an array copies it, and a substring is found from the text's beginning, so a fold that
appends at every step and a cut for every marker grow with the square of a sheet. Here a fold's outputs
are gathered in short chunks that are joined once, and texts are cut from pieces of fixed size.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 64  # outputs gathered before they are joined
PIECE = 1024  # code points of a text's piece


def let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def indices(n: Column) -> Column:
    """0 to n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def scan(values: Column, zero: Column, step: Callable[[Column, Column], Column], out: str) -> Column:
    """array<out>: ``step(state, x)`` gives struct<state, out> of each element in order, from the state ``zero``."""

    def inner(acc: Column, x: Column) -> Column:
        return let(step(acc["state"], x), lambda r: F.struct(r["state"].alias("state"), F.concat(acc["out"], F.array(r["out"])).alias("out")))

    def outer(all_values: Column):
        def joined(acc: Column, at: Column) -> Column:
            some = F.slice(all_values, at + 1, F.lit(CHUNK))
            own = F.aggregate(some, F.struct(acc["state"].alias("state"), F.array().cast(f"array<{out}>").alias("out")), inner)
            return let(own, lambda p: F.struct(p["state"].alias("state"), F.concat(acc["out"], F.array(p["out"])).alias("out")))

        return joined

    begin = F.struct(zero.alias("state"), F.array().cast(f"array<array<{out}>>").alias("out"))
    starts = lambda v: F.when(F.size(v) > 0, F.sequence(F.lit(0), F.size(v) - 1, F.lit(CHUNK))).otherwise(F.array().cast("array<int>"))
    return let(values, lambda v: F.flatten(F.aggregate(starts(v), begin, outer(v), lambda acc: acc["out"])))


def runs(n: Column, begins: Callable[[Column], Column]) -> Column:
    """array<struct<first, last>>: the runs of 0 to n - 1 that start where ``begins(i)`` holds (it holds for 0)."""
    return let(F.filter(indices(n), begins), lambda s: F.transform(s, lambda a, k: F.struct(a.alias("first"), F.coalesce(F.get(s, k + 1) - 1, n - 1).alias("last"))))


def distinct_in_order(values: Column) -> Column:
    """The first of equal elements each, in order, for elements that ``array_distinct`` compares pair by pair (structs)."""

    def firsts(s: Column) -> Column:
        kept = F.filter(s, lambda x, k: (k == 0) | ~F.get(s, k - 1)["x"].eqNullSafe(x["x"]))
        return F.transform(F.array_sort(F.transform(kept, lambda x: F.struct(x["i"].alias("i"), x["x"].alias("x")))), lambda x: x["x"])

    return let(F.array_sort(F.transform(values, lambda x, i: F.struct(x.alias("x"), i.alias("i")))), firsts)


def pieces(text: Column) -> Column:
    """A text cut after every PIECE code points, for ``span``; make it a column of its own."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0))


def span(cut: Column, start: Column, length: Column) -> Column:
    """``substr`` of the text whose ``pieces`` these are, from code point ``start`` (0 is the first), in time of the span's own length."""
    first = F.floor(start / PIECE).cast("int")
    last = F.floor((start + length - 1) / PIECE).cast("int")
    joined = F.array_join(F.slice(cut, first + 1, last - first + 1), "")
    return F.when(length <= 0, "").otherwise(F.substr(joined, start - first * PIECE + 1, length))
