"""Exact distinct counts that roll up.

Counted values get dense numbers from a stored dictionary. Per group and counted column the
numbers are kept as bitmaps of 32,768 each, so a coarser group's count follows from the
finer groups' bitmaps by a bitwise or: the rows are never counted again. Map tasks combine
bitmaps before the exchange, so a hot group sends a few of them per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import attach

NAME, VALUE = "__name", "__value"
DICTIONARY = "__name string, __value string, __id long"


def _long(rows: DataFrame, columns: dict[str, str], *keys: str) -> DataFrame:
    values = [
        F.struct(F.lit(out).alias(NAME), F.col(column).cast("string").alias(VALUE))
        for column, out in columns.items()
    ]
    return rows.select(*keys, F.inline(F.array(*values))).where(F.col(VALUE).isNotNull())


def numbered(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The dictionary of the counted columns {column: output name}: every value with a number.
    Store it before it is used; numbers run without gaps within each of its tasks."""
    values = _long(rows, columns).distinct()
    return values.sortWithinPartitions(NAME, VALUE).withColumn("__id", F.monotonically_increasing_id())


def distinct_bitmaps(
    rows: DataFrame, keys: list[str], columns: dict[str, str], dictionary: DataFrame
) -> DataFrame:
    """keys, __name, __bucket, __bitmap: the values of each group as bitmaps of their numbers."""
    known = attach(_long(rows, columns, *keys).distinct(), dictionary, [NAME, VALUE], "inner")
    return known.groupBy(*keys, NAME, F.bitmap_bucket_number("__id").alias("__bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("__id")).alias("__bitmap")
    )


def rolled_up(bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """Bitmaps of coarser groups."""
    return bitmaps.groupBy(*keys, NAME, "__bucket").agg(F.bitmap_or_agg("__bitmap").alias("__bitmap"))


def distinct_counts(bitmaps: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """One row per group: its distinct counts, from bitmaps of these or of finer groups."""
    counts = F.sum(F.bitmap_count("__bitmap"))
    return (
        rolled_up(bitmaps, keys)
        .groupBy(*keys, NAME)
        .agg(counts.alias("__n"))
        .groupBy(*keys)
        .agg(*[F.coalesce(F.max(F.when(F.col(NAME) == n, F.col("__n"))), F.lit(0)).alias(n) for n in names])
    )
