"""Joins of a table of any skew with a table of one row per key.

AQE splits a hot partition of the large side only when each side of the join is
read straight from its own exchange. A small side that was just aggregated by the
join key has no exchange of its own: the aggregate's is reused, and the hot
partition stays whole. Matching with the null-safe `<=>` gives the join its own
hash expressions, so the small side is exchanged once more (one row per key) and
the large side can be split. It also matches NULL keys, as GROUP BY does.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _same(df: DataFrame, other: DataFrame, keys: list[str]):
    return reduce(and_, [df[k].eqNullSafe(other[f"__j{i}"]) for i, k in enumerate(keys)])


def _renamed(other: DataFrame, keys: list[str], *rest: str) -> DataFrame:
    return other.select(*[F.col(k).alias(f"__j{i}") for i, k in enumerate(keys)], *rest)


def attach(df: DataFrame, facts: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Add the columns of `facts`, which has one row per key; `how` is left or inner."""
    other = _renamed(facts, keys, *[c for c in facts.columns if c not in keys])
    joined = df.join(other, _same(df, other, keys), how)
    return joined.drop(*[f"__j{i}" for i in range(len(keys))])


def keep_matching(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key occurs in `wanted`."""
    other = _renamed(wanted, keys)
    return df.join(other, _same(df, other, keys), "left_semi")


def drop_matching(df: DataFrame, unwanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key does not occur in `unwanted`."""
    other = _renamed(unwanted, keys)
    return df.join(other, _same(df, other, keys), "left_anti")


def attach_distinct_counts(
    cells: DataFrame, rows: DataFrame, keys: list[str], outs: dict[str, str]
) -> DataFrame:
    """Add several distinct counts per group to an aggregate of `rows`: {column: output name}.

    Counting them together with many other aggregates would carry every buffer of
    those through the shuffle once per counted column. Here only (group, name,
    value) travels, at the price of reading the few columns again.
    """
    values = [
        F.struct(F.lit(out).alias("__name"), F.col(column).cast("string").alias("__value"))
        for column, out in outs.items()
    ]
    known = rows.select(*keys, F.inline(F.array(*values))).where(F.col("__value").isNotNull())
    counts = known.distinct().groupBy(*keys).agg(
        *[F.count_if(F.col("__name") == out).alias(out) for out in outs.values()]
    )
    filled = {out: F.coalesce(out, F.lit(0)) for out in outs.values()}
    return attach(cells, counts, keys).withColumns(filled)


def not_in(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """SQL `column NOT IN (values)` without a forced broadcast of the values.

    A NULL on either side makes the test unknown: a NULL in the list drops every
    row, a NULL in the column drops its row unless the list is empty.
    """
    (name,) = values.columns
    size = values.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count(name).alias("known"))).scalar()
    n, known = size.getField("n"), size.getField("known")
    decided = (n == 0) | (F.col(column).isNotNull() & (n == known))
    listed = values.select(F.col(name).alias(column)).distinct()
    return drop_matching(df.where(decided), listed, [column])
