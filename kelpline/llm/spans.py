"""Places of regular-expression matches in a text, with Spark's own functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once; named in a lambda, an expression is computed at each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def found(text: Column, pattern: str) -> Column:
    """Array of struct(start, end, value) of the leftmost non-overlapping matches: code points, end exclusive.

    What lies between matches comes from a split by the same pattern, so starts are running lengths.
    A text without a match is searched once only.
    """
    between = F.split(text, F.lit(pattern), -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    empty = F.lit(None).cast("array<struct<start:bigint,end:bigint,value:string>>")
    none = F.coalesce(empty, F.array().cast("array<struct<start:bigint,end:bigint,value:string>>"))

    def add(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["value"])
        one = F.array(F.struct(start.cast("bigint").alias("start"), end.cast("bigint").alias("end"), x["value"].alias("value")))
        return F.struct(end.cast("bigint").alias("at"), F.concat(acc["out"], one).alias("out"))

    pairs = let(matches, lambda m: F.zip_with(F.slice(between, F.lit(1), F.size(m)), m, lambda g, v: F.struct(g.alias("gap"), v.alias("value"))))
    run = F.aggregate(pairs, F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("out")), add, lambda acc: acc["out"])
    return F.when(text.rlike(pattern), run).otherwise(none)


def kinds(spans: Column, kind: str) -> Column:
    """Spans without their values, and with their kind."""
    return F.transform(spans, lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))


def listed(spans: Column) -> Column:
    """kind:start:end of each, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
