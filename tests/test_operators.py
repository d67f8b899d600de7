"""Slicing operators against brute force, on skewed random data."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import keys as K
from tenderlake.operators import reshape as R
from tenderlake.operators.joins import not_in
from tenderlake.operators.radix import group_median, group_medians
from tenderlake.operators.slices import falling_steps, slices_for
from tenderlake.plans import questions as Q


def test_group_median_with_one_hot_group(spark):
    rnd = random.Random(1)
    rows = [(rnd.choice(["hot"] * 6 + ["a", "b", None]), rnd.choice([None, rnd.random() * 100, 7.0])) for _ in range(4000)]
    rows += [("single", 3.0), ("pair", 1.0), ("pair", 2.0), ("empty", None)]
    expected: dict = {}
    for k, v in rows:
        if v is not None:
            expected.setdefault(k, []).append(v)
    got = {r.k: r.m for r in group_median(spark.createDataFrame(rows, "k string, v double"), ["k"], "v", "m").collect()}
    assert got.keys() == expected.keys()
    for k, values in expected.items():
        assert abs(got[k] - statistics.median(values)) < 1e-12


def test_group_median_of_all_kinds_of_values(spark):
    """Neighbours in the last bit, powers of two, signs, tiny and huge values, infinities."""
    rnd = random.Random(7)
    up, down = float("inf"), float("-inf")

    def value():
        base = rnd.choice([1.0, 2.0 ** rnd.randrange(-1074, 1023), rnd.gauss(0, 1e6), 3.3, 0.0, rnd.random() * 1e-300])
        return rnd.choice([1, -1]) * rnd.choice([base, math.nextafter(base, up), math.nextafter(base, down)])

    rows = [(g, value()) for g in range(40) for _ in range(rnd.randrange(1, 60))]
    rows += [("i", up), ("i", down), ("i", 1.0), ("j", up), ("j", up), ("close", 1.0), ("close", math.nextafter(1.0, 2))]
    rows = [(str(g), v) for g, v in rows]
    df = spark.createDataFrame(rows * 2 + rows[:50], "k string, v double")
    expected: dict = {}
    for k, v in rows * 2 + rows[:50]:
        expected.setdefault(k, []).append(v)
    got = {r.k: r.m for r in group_median(df, ["k"], "v", "m").collect()}
    for k, values in expected.items():
        low, high = statistics.median_low(values), statistics.median_high(values)
        want = low + (high - low) * 0.5
        assert got[k] == want or (math.isnan(got[k]) and math.isnan(want)), k


def test_group_median_sorts_nothing_as_a_whole(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").cast("double").alias("v"))
    plan = group_median(df, ["k"], "v", "m")._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan.lower()


def test_group_median_of_copies(spark):
    df = spark.range(1000).select(F.lit("x").alias("k"), F.when(F.col("id") < 501, 1.0).otherwise(2.0).alias("v"))
    assert group_median(df, ["k"], "v", "m").first().m == 1.0


def test_several_medians_in_one_pass(spark):
    rows = [("a", 1.0, None), ("a", 3.0, 5.0), ("b", None, None), (None, 2.0, 4.0)]
    df = spark.createDataFrame(rows, "k string, v double, w double")
    got = {r.k: (r.mv, r.mw) for r in group_medians(df, ["k"], {"v": "mv", "w": "mw"}).collect()}
    assert got == {"a": (2.0, 5.0), None: (2.0, 4.0)}


def test_falling_steps_across_slices(spark):
    n = 3000
    rows = [("up", i, float(i)) for i in range(n)]
    rows += [("down once", i, float(i if i != 1700 else -1)) for i in range(n)]
    rows += [("gap", i, None if i % 2 else float(-i)) for i in range(50)]
    df = spark.createDataFrame(rows, "k string, o int, v double")
    got = {r.k: r.falls for r in falling_steps(df, ["k"], [F.col("o").asc()], "v").collect()}
    assert got == {"up": False, "down once": True, "gap": False}


def test_newest_source(spark):
    rows = [("a", "00", 1), ("a", "01", 2), ("a", "01", 3), ("b", "00", 4), (None, "00", 5), (None, "01", 6)]
    df = spark.createDataFrame(rows, "cig string, __source_file string, v int")
    assert sorted(r.v for r in K.keep_newest_source(df).collect()) == [2, 3, 4, 6]


def test_one_per_key_forwards_one_row_per_task(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    top = K.one_per_key(df, ["k"], [F.col("v").desc()])
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the exchange
    assert sorted(r.v for r in top.collect()) == [997, 998, 999]


def test_mark_first_keeps_every_row(spark):
    rows = [("s", 1.0, 3, "a"), ("s", 1.0, None, "b"), ("s", 1.0, 2, "c"), ("s", None, 1, "d"), ("s", None, 5, "e")]
    df = spark.createDataFrame(rows, "s string, amount double, n int, id string")
    got = {r.id: r.is_first for r in K.mark_first(df, ["s", "amount"], ["n", "id"]).collect()}
    assert got == {"a": False, "b": False, "c": True, "d": True, "e": False}


def test_shares_and_changes(spark):
    df = spark.createDataFrame([("x", 1, 10.0), ("x", 2, 30.0), ("y", 1, 0.0)], "g string, t int, v double")
    total = {(r.g, r.t): r.q for r in R.share_of_total(df, "v", "q").collect()}
    assert total == {("x", 1): 25.0, ("x", 2): 75.0, ("y", 1): 0.0}
    part = {(r.g, r.t): r.q for r in R.share_of_partition(df, ["g"], "v", "q").collect()}
    assert part == {("x", 1): 25.0, ("x", 2): 75.0, ("y", 1): None}
    step = {(r.g, r.t): r.q for r in R.change_to_previous(df, ["g"], "t", "v", "q").collect()}
    assert step == {("x", 1): None, ("x", 2): 200.0, ("y", 1): None}


def test_pivot_and_top_groups(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, 1.0), ("b", 1, 3.0), ("c", 1, 9.0)], "r string, y int, v double")
    matrix = {r.r: (r["1"], r["2"]) for r in R.pivot_filled(df, "r", "y", [1, 2], "v").collect()}
    assert matrix == {"a": (5.0, 1.0), "b": (3.0, 0.0), "c": (9.0, 0.0)}
    assert sorted({r.r for r in R.keep_top_groups(df, "r", "v", 2).collect()}) == ["a", "c"]


BIDDERS = "cig string, ruolo string, codice_fiscale string, denominazione string"


def test_consortia(spark):
    rows = [("A", "MANDATARIA", "L", "Lead"), ("A", "MANDANTE", "1", "Uno"), ("A", "MANDANTE", "2", "Due"),
            ("A", "MANDANTE", "2", "Due"), ("B", "MANDATARIA", "L", "Lead"), ("B", "MANDANTE", "1", "Uno")]
    bidders = spark.createDataFrame(rows, BIDDERS)
    got = [tuple(r[c] for c in ("cig", "cf_mandataria", "mandataria", "n_mandanti"))
           for r in Q.consortia(bidders).collect()]
    assert got == [("A", "L", "Lead", 2)]
    assert sorted(tuple(r) for r in Q.consortia_members(bidders).collect()) == [("A", "Due"), ("A", "Uno")]
    text = Q.names_of(bidders.where("ruolo = 'MANDANTE'"), "cig", "denominazione", ["A"], "nomi")
    assert [tuple(r) for r in text.collect()] == [("A", "Due | Uno")]


@pytest.mark.parametrize("partitions", ["4", "16"])
def test_long_member_lists_keep_one_shape(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        lead = spark.createDataFrame([("A", "MANDATARIA", f"L{i}", "Lead") for i in range(3)], BIDDERS)
        number = F.format_string("N%05d", "id")
        member = spark.range(10_001).select(
            F.lit("A").alias("cig"), F.lit("MANDANTE").alias("ruolo"),
            number.alias("codice_fiscale"), number.alias("denominazione"),
        )
        bidders = lead.unionByName(member)
        assert [r.n_mandanti for r in Q.consortia(bidders).collect()] == [10_001] * 3
        names = sorted(r.denominazione for r in Q.consortia_members(bidders).collect())
        assert names == [f"N{i:05d}" for i in range(10_001)]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_not_in_is_null_aware(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "name string")

    def kept(*values):
        listed = spark.createDataFrame([(v,) for v in values], "v string")
        return sorted(str(r.name) for r in not_in(df, "name", listed).collect())

    assert kept("a", "a") == ["b"]
    assert kept("a", None) == []
    assert kept() == ["None", "a", "b"]


def test_newest_file_is_found_by_hashing(spark):
    """File numbers are whole: no sort of all rows before the lots are combined."""
    df = spark.range(100).select(
        F.col("id").cast("string").alias("cig"), F.lit("00-full.csv").alias(K.SOURCE)
    )
    plan = K.keep_newest_source(df)._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def test_files_compete_by_the_heads_of_their_names(spark):
    rows = [("A", "00-full.csv", 1), ("A", "10-delta.csv", 2), ("A", "02-delta.csv", 3), ("B", "f", 4), (None, "x", 5)]
    df = spark.createDataFrame(rows, f"cig string, {K.SOURCE} string, v int")
    assert sorted(r.v for r in K.keep_newest_source(df).collect()) == [2, 4, 5]


def test_slices_follow_the_input():
    assert [slices_for(n, 100) for n in (0, 1, 100, 101, 1000)] == [1, 1, 1, 2, 10]
