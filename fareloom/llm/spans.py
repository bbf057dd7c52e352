"""Places of pattern matches in texts, as column expressions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY = "array<struct<start:int,end:int,found:string>>"


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is computed once, though the result names it inside other functions."""
    return F.transform(F.array(value), use)[0]


def before_each(values: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each of an array of ints, what `merge` (a sum or a maximum, from 0 on) makes of those before it.

    A fold copies the list that it grows at every step. Here folds run over parts of about the root of the length, each
    from the result of all parts before it, so that n values cost n times the root of n.
    """
    def fold(part: Column, start: Column) -> Column:
        zero = F.struct(start.alias("at"), F.array().cast("array<int>").alias("seen"))
        return F.aggregate(part, zero, lambda s, v: F.struct(
            merge(s["at"], v).cast("int").alias("at"), F.concat(s["seen"], F.array(s["at"])).alias("seen")), lambda s: s["seen"])

    def by_parts(all_values: Column) -> Column:
        width = F.greatest(F.lit(16), F.ceil(F.sqrt(F.size(all_values)))).cast("int")
        part = lambda i: F.slice(all_values, i * width + 1, width)
        numbers = F.sequence(F.lit(0), F.floor((F.size(all_values) - 1) / width).cast("int"))
        totals = F.transform(numbers, lambda i: F.aggregate(part(i), F.lit(0), lambda s, v: merge(s, v).cast("int")))
        return F.flatten(F.zip_with(numbers, fold(totals, F.lit(0)), lambda i, start: fold(part(i), start)))

    return once(values, lambda v: F.when(F.size(v) > 0, by_parts(v)).otherwise(F.array().cast("array<int>")))


def located(text: Column, pattern: str, hint: Column) -> Column:
    """start, end (code points, end exclusive) and text of all leftmost non-overlapping matches, in order.

    The parts between the matches and the matches alternate, so that running lengths are the places. `hint` is a cheap
    condition without which there is no match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    parts = F.zip_with(found, F.split(text, pattern, -1), lambda m, gap: F.struct(
        m.alias("m"), F.length(gap).alias("gap"), F.length(m).alias("length")))
    # zip_with pads the shorter array: the part after the last match comes with a null match
    real = F.filter(parts, lambda p: p["m"].isNotNull())

    def placed(matches: Column) -> Column:
        before = before_each(F.transform(matches, lambda p: p["gap"] + p["length"]), lambda s, v: s + v)
        return F.zip_with(matches, before, lambda p, at: F.struct(
            (at + p["gap"]).alias("start"), (at + p["gap"] + p["length"]).alias("end"), p["m"].alias("found")))

    return F.when(hint, once(real, placed)).otherwise(F.array().cast(EMPTY))


def kept(spans: Column, accept: Callable[[Column], Column]) -> Column:
    return F.filter(spans, lambda s: accept(s["found"]))


def named(spans: Column, kind: str, rank: int) -> Column:
    """rank, kind, start and end of spans."""
    return F.transform(spans, lambda s: F.struct(F.lit(rank).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), F.lit(kind).alias("kind")))


def written(spans: Column) -> Column:
    """kind:start:end of each, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_kind(spans: Column) -> Column:
    return F.array_sort(spans.cast("array<struct<rank:int,start:int,end:int,kind:string>>"))


def by_start(spans: Column) -> Column:
    turned = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["rank"].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind")))
    return F.array_sort(turned)
