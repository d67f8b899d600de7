"""Delta replacement and one-row-per-key rules.

None of these sends all rows of one key to one task. One-row-per-key uses
`row_number() = 1`, for which Spark inserts a WindowGroupLimit before the
exchange: each map task forwards at most one row per key. Whole-group
replacement aggregates to one row per key first and joins that back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import attach

SOURCE = "__source_file"
# The place of the row's file in the order of all file names, given when the file is landed.
ORDER = "__load_order"
# The lot key as the file has it: files compete for published keys, spelling included.
PUBLISHED = "__published_cig"


def load_order(df: DataFrame, source: str = SOURCE) -> Column:
    """The place of a row's file in the order of the whole file names of `df`, from 1.

    The names are a constant that Spark finds from the one column before the rows are read;
    files are few, rows many. A landed table carries its order as a column instead."""
    if ORDER in df.columns:
        return F.col(ORDER)
    names = df.agg(F.array_sort(F.collect_set(source))).scalar()
    return F.array_position(names, F.col(source))


def _remaining(df: DataFrame, used: list[str]) -> list[Column]:
    lowered = {u.lower() for u in used}
    return [F.col(f"`{c}`").asc_nulls_last() for c in df.columns if c.lower() not in lowered]


def keep_newest_source(df: DataFrame, key: str = "cig", source: str = SOURCE) -> DataFrame:
    """Keep the rows of each key that come from the newest file naming that key.

    A later file replaces everything an earlier one said about the key, so only
    keys seen in more than one file need a lookup; the others pass unmatched. Files
    are compared by the place of their whole names: a minimum of whole numbers is
    combined by hashing, one of names would sort all rows by key first.
    """
    numbered = df.withColumn("__file", load_order(df, source))
    span = (
        numbered.groupBy(key)
        .agg(F.min("__file").alias("__oldest"), F.max("__file").alias("__newest"))
        .where(F.col("__oldest") < F.col("__newest"))
        .drop("__oldest")
    )
    stale = F.col("__newest").isNotNull() & (F.col("__file") < F.col("__newest"))
    return attach(numbered, span, [key]).where(~stale).drop("__newest", "__file")


def one_per_key(
    df: DataFrame, keys: list[str], order: list[Column], ordered_by: list[str] | None = None
) -> DataFrame:
    """First row per key. Ties are broken by the columns that are neither key nor in the order
    (`ordered_by` names those), so a retried task picks the same row."""
    rest = _remaining(df, [*keys, *(ordered_by or [])])
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return (
        df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") == 1).drop("__rn")
    )


def latest_per_key(df: DataFrame, keys: list[str], dates: list[str]) -> DataFrame:
    """Most recent row per key, undated rows last."""
    return one_per_key(df, keys, [F.col(d).desc_nulls_last() for d in dates], dates)


def newest_source_per_key(df: DataFrame, keys: list[str], source: str = SOURCE) -> DataFrame:
    """Newest file wins per full key; other rows of the same lot survive."""
    return one_per_key(df, keys, [F.col(source).desc_nulls_last()], [source])


def split_dedup(
    df: DataFrame, keys: list[str], nullable: str, record: list[str], source: str = SOURCE
) -> DataFrame:
    """Dedup by key where `nullable` is set, by the whole record where it is NULL.

    Copies of a record without id differ in nothing but the file name, so the
    second branch is a hash-aggregated distinct and needs no window.
    """
    with_id = newest_source_per_key(df.where(F.col(nullable).isNotNull()), keys, source)
    others = [k for k in keys if k != nullable]
    without_id = (
        df.where(F.col(nullable).isNull())
        .groupBy(*others, *record)
        .agg(F.max(source).alias(source))
        .withColumn(nullable, F.lit(None).cast(df.schema[nullable].dataType))
    )
    columns = [*keys, *record, source]
    return with_id.select(*columns).unionByName(without_id.select(*columns))


def distinct_records(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def mark_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Flag one row per group of copies as `is_first` and keep them all.

    `keys + order` must identify a row. The first row is an aggregate per group,
    joined back: a group of copies of any size stays spread over its tasks.
    """
    rank = F.struct(
        *[x for o in order for x in (F.col(o).isNull().alias(f"{o}_null"), F.col(o).alias(o))]
    )
    heads = df.groupBy(*keys).agg(F.min(rank).alias("__head"))
    same_rank = [F.col(o).eqNullSafe(F.col(f"__head.{o}")) for o in order]
    is_first = same_rank[0]
    for condition in same_rank[1:]:
        is_first = is_first & condition
    return attach(df, heads, keys).withColumn("is_first", is_first).drop("__head")
