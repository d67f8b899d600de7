"""Top-N, shares, pivots and other reshaping on already aggregated tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import pct, rounded


def report_order(df: DataFrame, ordered: bool, *order) -> DataFrame:
    """Rows in the order of the report, for reading. A stored table has no row order: skip the sort,
    which would compute a large result twice, once for the sample of its cut points."""
    return df.orderBy(*order) if ordered else df


def top_n(df: DataFrame, measure: str, n: int, ties: list[str] | None = None) -> DataFrame:
    """The n rows with the largest measure: per-task heaps, no full sort."""
    return df.orderBy(F.col(measure).desc_nulls_last(), *(ties or [])).limit(n)


def top_n_per_group(
    df: DataFrame, groups: list[str], measure: str, n: int, ties: list[str], rank: str = "rank"
) -> DataFrame:
    """The n best rows per group with their rank; cut down map-side before the exchange."""
    window = Window.partitionBy(*groups).orderBy(F.col(measure).desc_nulls_last(), *ties)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)


def keep_top_groups(df: DataFrame, group: str, measure: str, n: int) -> DataFrame:
    """All rows of the n groups with the largest total."""
    totals = df.groupBy(group).agg(F.sum(measure).alias("__total"))
    best = top_n(totals, "__total", n, [group]).select(F.col(group).alias("__group"))
    # n rows, so the semi join may broadcast them.
    return df.join(F.broadcast(best), df[group].eqNullSafe(best["__group"]), "left_semi")


def share_of_partition(
    df: DataFrame, groups: list[str], measure: str, out: str, digits: int = 2
) -> DataFrame:
    """Percentage of the group total. For aggregated rows, a handful per group."""
    total = F.sum(measure).over(Window.partitionBy(*groups))
    return df.withColumn(out, pct(F.col(measure), total, digits))


def share_of_total(df: DataFrame, measure: str, out: str, digits: int = 2) -> DataFrame:
    """Percentage of the grand total: a scalar subquery, no global window and no join."""
    total = df.agg(F.sum(measure)).scalar()
    return df.withColumn(out, pct(F.col(measure), total, digits))


def change_to_previous(
    df: DataFrame, groups: list[str], order: str, measure: str, out: str, digits: int = 2
) -> DataFrame:
    """Percentage change to the previous row in `order` (one row per group and year)."""
    before = F.lag(measure).over(Window.partitionBy(*groups).orderBy(order))
    return df.withColumn(out, pct(F.col(measure) - before, before, digits))


def cumulative_share(df: DataFrame, measure: str, n: int, ties: list[str]) -> DataFrame:
    """Share of the grand total and running share, for the n largest rows."""
    total = df.agg(F.sum(measure)).scalar()
    shares = top_n(df, measure, n, ties).withColumn(
        "pct_mercato", pct(F.col(measure), total, 2)
    )
    # At most n rows, so one task is enough for the running sum.
    upto = Window.orderBy(F.col(measure).desc_nulls_last(), *ties).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return shares.withColumn("cum_pct", rounded(F.sum("pct_mercato").over(upto), 2))


def positive_long(
    df: DataFrame, ids: list[str], columns: list[str], name: str, value: str
) -> DataFrame:
    """Wide to long, positive values only."""
    return df.unpivot(ids, columns, name, value).where(F.col(value) > 0)


def conditional_sums(name: str, value: str, groups: dict[str, list[str]]) -> list[Column]:
    """One sum per named group of labels: long to wide in a single aggregation."""
    return [
        F.sum(F.when(F.col(name).isin(labels), F.col(value))).alias(out)
        for out, labels in groups.items()
    ]


def pivot_filled(
    df: DataFrame, row: str, column: str, values: list, measure: str
) -> DataFrame:
    """Cross table with 0 in empty cells. The column values are given, so no extra job finds them."""
    return df.groupBy(row).pivot(column, values).agg(F.sum(measure)).na.fill(0.0)
