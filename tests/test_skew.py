"""One key holds a third of the rows: the joins split it, the dedup combines it early."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import keys as K
from tenderlake.operators.joins import attach, drop_matching, keep_matching
from tenderlake.plans.clean import classify_series

SMALL = {
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def small_limits(spark):
    """AQE limits scaled down to the size of the test data."""
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def rows(spark):
    h = F.xxhash64("id")
    return spark.range(0, 60_000, 1, 8).select(
        F.when(F.pmod(h, F.lit(3)) == 0, "HOT").otherwise(F.concat(F.lit("C"), F.pmod(h, F.lit(5000)))).alias("cig"),
        F.col("id").alias("n"),
        F.when(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) == 0, "01").otherwise("00").alias(K.SOURCE),
    )


def final_plan(df) -> str:
    counted = df.agg(F.sum(F.xxhash64(*df.columns) % 7))
    counted.collect()
    return counted._jdf.queryExecution().executedPlan().toString().split("== Initial Plan")[0]


def test_joins_split_the_hot_key(small_limits, rows):
    facts = rows.groupBy("cig").agg(F.max("n").alias("top"))
    assert "skewed" in final_plan(attach(rows, facts, ["cig"]))
    assert "skewed" in final_plan(keep_matching(rows, facts.where("top > 9"), ["cig"]))
    assert "skewed" in final_plan(drop_matching(rows, facts.where("top < 55000"), ["cig"]))


def test_delta_rule_splits_the_hot_key(small_limits, rows):
    kept = K.keep_newest_source(rows)
    assert "skewed" in final_plan(kept)
    newest = {r.cig: r.m for r in rows.groupBy("cig").agg(F.max(K.SOURCE).alias("m")).collect()}
    expected = sorted(r.n for r in rows.collect() if r[K.SOURCE] == newest[r.cig])
    assert sorted(r.n for r in kept.collect()) == expected


def test_series_split_the_hot_key(small_limits, rows):
    progress = rows.select(
        "cig",
        F.when(F.col("cig") == "HOT", 1).otherwise(F.col("n")).alias("id_aggiudicazione"),
        F.col("n").cast("int").alias("progressivo_sal"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(F.xxhash64("n"), F.lit(300)).cast("int")).alias(
            "data_emissione_sal"),
        F.pmod(F.xxhash64("n", F.lit(2)), F.lit(10_000)).cast("double").alias("importo_sal"),
    )
    classified = classify_series(progress)
    assert "skewed" in final_plan(classified)
    hot = classified.where("cig = 'HOT'").agg(
        F.sum("importo_quota").alias("q"), F.max("importo_sal").alias("m"), F.min("tipo_serie").alias("t")
    ).first()
    assert hot.q == hot.m and hot.t == "anomala"


def test_a_task_reads_little_of_wide_tables(spark):
    """What a task reads grows many times over when its columns are typed and sorted."""
    from tenderlake.session import tune

    names = ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.files.maxPartitionBytes")
    for name in names:
        spark.conf.set(name, "128m")
    tune(spark)
    assert [spark.conf.get(name) for name in names] == ["16m", "32m"]
