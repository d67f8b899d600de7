"""Exact medians by radix selection.

A value is read as digits from the top: its exponent with eight bits of its mantissa, the
next 22 bits, the rest. Counts by group and first digit are combined before any exchange,
however large a group is; their running sum tells which digit holds the middle, and only
values with that digit are looked at for the next one. Nothing is sorted as a whole and
nothing is sampled; what is ranked in the end are values that agree in all but the last
23 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach

_FIRST, _SECOND = 8, 22


def _digits(v: str) -> tuple[Column, Column]:
    """The first two digits of a double, in its order: 0 for zero, mirrored below it."""
    value = F.col(v)
    special = F.isnan(value) | (F.abs(value) == float("inf"))
    plain = ~special & (value != 0)
    size = F.when(plain, F.abs(value)).otherwise(F.lit(1.0))
    # Whatever the logarithm rounds to, it never falls as values rise, and all further steps
    # are exact: powers of two only shift a mantissa.
    exponent = F.floor(F.log2(size))
    scaled = size / F.pow(F.lit(2.0), exponent) * F.lit(float(1 << _FIRST))
    first = (exponent + 1100) * 1024 + F.floor(scaled)
    second = F.floor((scaled - F.floor(scaled)) * F.lit(float(1 << _SECOND)))
    sign = F.when(value < 0, F.lit(-1)).otherwise(F.lit(1))
    ends = F.when(F.isnan(value), F.lit(1 << 40)).when(special, sign * F.lit(1 << 39)).otherwise(0)
    return (
        F.when(plain, sign * first).otherwise(ends).cast("long"),
        F.when(plain, sign * second).otherwise(0).cast("long"),
    )


def _holding(sizes: DataFrame, group: list[str], digit: str) -> DataFrame:
    """The digits of each group that hold the ranks __r1 and __r2 (from 0), and the ranks
    within them; a rank that another digit holds is null."""
    order = Window.partitionBy(*group).orderBy(digit).rowsBetween(Window.unboundedPreceding, 0)
    summed = sizes.withColumn("__before", F.sum("__size").over(order) - F.col("__size"))
    inside = {
        r: F.when(
            (F.col(r) >= F.col("__before")) & (F.col(r) < F.col("__before") + F.col("__size")),
            F.col(r) - F.col("__before"),
        )
        for r in ("__r1", "__r2")
    }
    found = summed.select(*group, digit, *[rank.alias(r) for r, rank in inside.items()])
    return found.where("__r1 IS NOT NULL OR __r2 IS NOT NULL")


def group_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """Exact interpolated median of `value` per group, one row per group with a non-NULL value."""
    values = df.select(*keys, F.col(value).cast("double").alias("__v")).where("__v IS NOT NULL")
    counts = values.groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n"))
    first, second = _digits("__v")
    counts = counts.withColumns({"__d1": first, "__d2": second})

    sizes = counts.groupBy(*keys, "__d1").agg(F.sum("__n").alias("__size"))
    total = F.sum("__size").over(Window.partitionBy(*keys))
    ranked = sizes.withColumn("__total", total).withColumns(
        {"__r1": F.expr("(__total - 1) div 2"), "__r2": F.expr("__total div 2")}
    )
    at = _holding(ranked, keys, "__d1")

    within = attach(counts, at, [*keys, "__d1"], "inner")
    sizes = within.groupBy(*keys, "__d1", "__r1", "__r2", "__d2").agg(F.sum("__n").alias("__size"))
    at = _holding(sizes, [*keys, "__d1"], "__d2")

    within = attach(counts, at, [*keys, "__d1", "__d2"], "inner")
    sizes = within.withColumnRenamed("__n", "__size")
    at = _holding(sizes, [*keys, "__d1", "__d2"], "__v")
    lower = F.max(F.when(F.col("__r1").isNotNull(), F.col("__v")))
    upper = F.max(F.when(F.col("__r2").isNotNull(), F.col("__v")))
    return at.groupBy(*keys).agg((lower + (upper - lower) * 0.5).alias(out))


def group_medians(df: DataFrame, keys: list[str], outs: dict[str, str]) -> DataFrame:
    """Exact medians of several columns in one pass: {column: output name}."""
    pairs = [
        F.struct(F.lit(out).alias("__name"), F.col(value).cast("double").alias("__value"))
        for value, out in outs.items()
    ]
    long = df.select(*keys, F.inline(F.array(*pairs)))
    medians = group_median(long, [*keys, "__name"], "__value", "__median")
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("__name") == out, F.col("__median"))).alias(out) for out in outs.values()]
    )
