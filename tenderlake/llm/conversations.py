"""Collapse of logged conversation snapshots, and their rendering.

Chat logs hold a conversation many times, each snapshot a prefix of the next one. A rolling
hash of the turns names every prefix; a conversation whose last hash names a prefix of a
longer one is dropped by an anti join, and of equal ones the smallest id stays. What is left
are the maximal conversations. DataFrame functions only.

The rolling hash of k turns is the sum of the hashes of (position, role, text) of each: 40
bits twice. Sums can be taken in slices of a conversation's turns, first the slices' sums,
then within each slice, so that a conversation that holds a third of all rows does not meet
in one task. Rendered turns stay rows of their own for the same reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

SLICE = 64
BITS = (1 << 40) - 1


def _running(rows: DataFrame, columns: dict, order: list[str]) -> DataFrame:
    """Running sums of `columns` (name: expression) over each conversation's turns, in the
    order of slice, then `order`; and their totals as total_<name>."""
    values = rows.withColumns({f"_{c}": e for c, e in columns.items()})
    sums = values.groupBy("conv", "slice").agg(*[F.sum(f"_{c}").alias(f"_s_{c}") for c in columns])
    earlier = Window.partitionBy("conv").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("conv")
    starts = {f"_start_{c}": F.coalesce(F.sum(f"_s_{c}").over(earlier), F.lit(0)) for c in columns}
    totals = {f"total_{c}": F.sum(f"_s_{c}").over(every) for c in columns}
    sums = sums.withColumns(starts | totals).drop(*[f"_s_{c}" for c in columns])
    inside = Window.partitionBy("conv", "slice").orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = values.join(sums, ["conv", "slice"])
    running = {c: F.col(f"_start_{c}") + F.sum(f"_{c}").over(inside) for c in columns}
    return joined.withColumns(running).drop(*[f"_{c}" for c in columns], *starts)


def prefixes(turns: DataFrame) -> DataFrame:
    """conv, conv_id, position, role, text, s1, s2 (rolling hash up to the turn), total_* (of
    the whole conversation) of every turn of `turns` (conv_id, turn, role, text).

    Turns go by turn (nulls first), role and text; equal rows of a conversation are one
    logged twice and count once. Rows with a null conv_id make one conversation.
    """
    rows = turns.select("conv_id", "turn", "role", "text").distinct()
    rows = rows.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("conv"),
        "conv_id",
        "turn",
        "role",
        "text",
        F.coalesce(F.floor(F.col("turn") / SLICE), F.lit(-(1 << 62))).cast("long").alias("slice"),
    )
    rows = stored(rows, "turns")
    placed = _running(rows, {"position": F.lit(1)}, ["turn", "role", "text"])
    placed = placed.withColumnRenamed("total_position", "n_turns")

    def part(seed):
        whole = F.xxhash64(
            F.lit(seed), "position", F.col("role").isNull(), "role", F.col("text").isNull(), "text"
        )
        return whole.bitwiseAND(F.lit(BITS))

    return _running(stored(placed, "placed"), {"s1": part(1), "s2": part(2)}, ["position"])


def maximal(turns: DataFrame) -> DataFrame:
    """The turns of the maximal conversations of `turns`: conv_id, position, n_turns, role,
    text."""
    rows = stored(prefixes(turns), "prefixes")
    key = ["n", "h1", "h2"]
    whole = rows.where("position = n_turns").select(
        "conv", "conv_id", F.col("n_turns").alias("n"), F.col("s1").alias("h1"), F.col("s2").alias("h2")
    )
    order = F.struct(F.col("conv_id").isNull().alias("none"), "conv_id", "conv")
    one = whole.groupBy(*key).agg(F.min(order).alias("first")).select(*key, "first.conv")
    inner = rows.where("position < n_turns").select(
        F.col("position").alias("n"), F.col("s1").alias("h1"), F.col("s2").alias("h2")
    )
    kept = one.join(inner.distinct(), key, "left_anti").select("conv")
    kept = stored(kept, "maximal")
    return rows.join(kept, "conv", "left_semi").select(
        "conv_id", F.col("position").cast("long").alias("position"),
        F.col("n_turns").cast("long").alias("n_turns"), "role", "text"
    )


def rendered(turns: DataFrame) -> DataFrame:
    """conv_id, position, n_turns, rendered: the turns of the maximal conversations in chat
    markup, one row per turn; a conversation's text is its rows in order. A null role is
    "unknown", a null text empty."""
    return maximal(turns).select(
        "conv_id",
        "position",
        "n_turns",
        F.concat(
            F.lit("<|im_start|>"), F.coalesce("role", F.lit("unknown")), F.lit("\n"),
            F.coalesce("text", F.lit("")), F.lit("<|im_end|>\n"),
        ).alias("rendered"),
    )


ORACLE = r"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
n AS (SELECT *, row_number() OVER w AS position, count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST)),
h AS (SELECT *, string_agg(md5(concat_ws('|', coalesce(length(role), -1), coalesce(role, ''), coalesce(text, ''))), ',')
    OVER (PARTITION BY conv_id ORDER BY position) AS prefix FROM n),
whole AS (SELECT conv_id, prefix FROM h WHERE position = n_turns),
one AS (SELECT prefix, min(conv_id) AS conv_id FROM whole GROUP BY prefix),
kept AS (SELECT conv_id FROM one WHERE prefix NOT IN (SELECT prefix FROM h WHERE position < n_turns))
SELECT conv_id, position, n_turns,
  '<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS rendered
FROM n WHERE conv_id IN (SELECT conv_id FROM kept)
"""
