"""SQL-side building blocks for operators that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = "\\x20\\x09-\\x0D"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, also inside other lambdas."""
    return F.transform(F.array(value), use)[0]


def words(text: Column) -> Column:
    """White-space words of a text, in order; null gives none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def grams(hashes: Column, k: int) -> Column:
    """Hashes of every k consecutive items; none where there are fewer."""
    return F.when(
        F.size(hashes) >= k,
        F.transform(
            F.sequence(F.lit(0), F.size(hashes) - k),
            lambda i: F.xxhash64(*[F.get(hashes, i + j) for j in range(k)]),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def covered_by_repeats(grams_: Column, k: int) -> Column:
    """Number of items in windows of k whose hash occurs twice or more, the first included.

    Most texts repeat nothing, which one hash set shows; only the others are sorted.
    """

    def neighbours(s: Column) -> Column:
        return F.filter(
            s,
            lambda e, i: F.get(s, i - 1)["g"].eqNullSafe(e["g"])
            | F.get(s, i + 1)["g"].eqNullSafe(e["g"]),
        )

    def count(at: Column) -> Column:
        steps = F.transform(
            at, lambda p, i: F.least(F.lit(k), F.coalesce(F.get(at, i + 1) - p, F.lit(k)))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def slow(g: Column) -> Column:
        pairs = F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("g"), i.alias("i"))))
        places = let(
            pairs, lambda s: F.sort_array(F.transform(neighbours(s), lambda e: e["i"]))
        )
        return let(places, count)

    return let(
        grams_,
        lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("bigint"))
        .otherwise(slow(g)),
    )
