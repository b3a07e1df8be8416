"""Array expressions for Spark SQL columns that stay linear, or nearly so, in the array's length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once. A column that a lambda refers to would
    otherwise be computed anew for each element."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def upto(n: Column) -> Column:
    """0, 1, ... n - 1, empty for n = 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def sums_before(values: Column) -> Column:
    """For each element, the sum of the elements before it. Works in blocks of the root of the
    length, so n elements cost n**1.5 additions and no copies of growing arrays."""

    def blocked(v: Column) -> Column:
        n = F.size(v)
        width = F.greatest(F.ceil(F.sqrt(n.cast("double"))).cast("int"), F.lit(1))
        block = lambda b: F.slice(v, b * width + 1, width)
        blocks = upto(F.ceil(n / width).cast("int"))
        block_sums = F.transform(blocks, lambda b: total(block(b)))

        def placed(sums: Column) -> Column:
            return F.flatten(
                F.transform(
                    blocks,
                    lambda b: let(
                        total(F.slice(sums, F.lit(1), b)),
                        lambda base: let(
                            block(b),
                            lambda own: F.transform(
                                upto(F.size(own)), lambda i: base + total(F.slice(own, F.lit(1), i))
                            ),
                        ),
                    ),
                )
            )

        return let(block_sums, placed)

    return let(values, blocked)


def matches(text: Column, pattern: str) -> Column:
    """The non-overlapping matches of a pattern that never matches an empty string:
    array of (start, match), starts in code points from 0."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def placed(parts: Column, hits: Column) -> Column:
        # what lies before match i: the pieces up to i and the matches before i
        steps = F.zip_with(
            F.slice(parts, F.lit(1), F.size(hits)),
            F.concat(F.array(F.lit(0)), F.transform(hits, F.length)),
            lambda piece, hit: F.coalesce(F.length(piece), F.lit(0)).cast("long") + hit,
        )
        # one entry more than hits: its sum before is the start of the last match
        starts = F.slice(sums_before(F.concat(steps, F.array(F.lit(0).cast("long")))), F.lit(2), F.size(hits))
        return F.zip_with(starts, hits, lambda start, hit: F.struct(start.alias("start"), hit.alias("match")))

    return let(F.split(text, pattern, -1), lambda parts: let(found, lambda hits: placed(parts, hits)))
