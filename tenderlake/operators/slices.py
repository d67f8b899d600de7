"""Ordered work inside groups of any size.

A window over a group puts the whole group in one task. Here the rows are
range-partitioned on (group, order) first, so a large group is cut into as many slices
as the caller asks for the size of the input; the windows run per slice, and only one summary row per slice meets
in the group's own window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE = "__slice"


def slice_count(df: DataFrame) -> int:
    """Slices where the caller knows no better: as many as the session shuffles into."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices_for(n_bytes: int, target: int = 256 * 2**20) -> int:
    """Slices of about `target` bytes for an input of `n_bytes`."""
    return max(1, -(-n_bytes // target))


def with_slices(
    df: DataFrame, keys: list[str], order: list[Column], slices: int | None = None
) -> DataFrame:
    """Number contiguous (keys, order) ranges; the explicit count keeps AQE from merging them.

    `slices` follows from the size of the input (`slices_for`). Read the result once
    per plan: the cut points come from a sample, so two readers may see different
    slices. No result depends on where the cuts are.
    """
    n = slices or slice_count(df)
    ranged = df.repartitionByRange(n, *[F.col(k).asc_nulls_last() for k in keys], *order)
    return ranged.withColumn(SLICE, F.spark_partition_id())


def summarise_in_order(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    value: str,
    row: Column | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Per group, over its rows in the given order: (keys, n, falls, top, top_row).

    `falls`: is any value smaller than the one just before it? A step from or to
    NULL is no step. `top` is the largest value and `top_row` the given columns of
    the first row that has it.

    Neighbours inside a slice are compared by `lag`; across a cut, the last value of
    the slice before with the first after.
    """
    sliced = with_slices(df, keys, order, slices)
    inner = Window.partitionBy(*keys, SLICE).orderBy(*order)
    steps = sliced.select(
        *keys,
        SLICE,
        F.col(value).alias("__v"),
        (F.lit(0) if row is None else row).alias("__row"),
        F.row_number().over(inner).alias("__place"),
        (F.col(value) < F.lag(value).over(inner)).alias("__falls"),
    )
    # Largest value first, then the earliest place.
    best = F.when(F.col("__v").isNotNull(), F.struct("__v", -F.col("__place")))
    edges = steps.groupBy(*keys, SLICE).agg(
        F.count(F.lit(1)).alias("__n"),
        F.bool_or("__falls").alias("__falls"),
        F.min_by("__v", "__place").alias("__first"),
        F.max_by("__v", "__place").alias("__last"),
        F.max("__v").alias("__top"),
        F.max_by("__row", best).alias("__top_row"),
    )
    # One row per group and slice from here on.
    outer = Window.partitionBy(*keys).orderBy(SLICE)
    at_cut = (F.col("__first") < F.lag("__last").over(outer)).alias("__cut")
    best = F.when(F.col("__top").isNotNull(), F.struct("__top", -F.col(SLICE)))
    return (
        edges.select("*", at_cut)
        .groupBy(*keys)
        .agg(
            F.sum("__n").alias("n"),
            F.bool_or(
                F.coalesce("__falls", F.lit(False)) | F.coalesce("__cut", F.lit(False))
            ).alias("falls"),
            F.max("__top").alias("top"),
            F.max_by("__top_row", best).alias("top_row"),
        )
    )


def falling_steps(df: DataFrame, keys: list[str], order: list[Column], value: str) -> DataFrame:
    """Per group: does `value` ever fall from one row to the next in the given order?"""
    return summarise_in_order(df, keys, order, value).select(*keys, "falls")
