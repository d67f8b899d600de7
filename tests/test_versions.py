"""Published tables: versions, checks before the switch, parts, layouts."""

from __future__ import annotations

import glob
from datetime import date

import pytest
from pyspark.sql import functions as F

from tenderlake.plans import build, quality
from tenderlake.sources import versions as V


def ids(df):
    return sorted(r[0] for r in df.select("id").collect())


def test_newest_commit_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        V.read_version(spark, path)
    V.replace(spark.range(3), path)
    V.replace(spark.range(5), path)
    assert ids(V.read_version(spark, path)) == [0, 1, 2, 3, 4]
    assert ids(V.read_version(spark, path, 1)) == [0, 1, 2]
    assert V.versions(spark, path) == [1, 2]


def test_a_failing_check_and_a_killed_write_change_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    V.replace(spark.range(3), path)
    before = {f: open(f, "rb").read() for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}

    def refuse(staged):
        raise quality.QualityError("no")

    with pytest.raises(quality.QualityError):
        V.replace(spark.range(9), path, refuse)
    broken = spark.range(9).select(F.when(F.col("id") < 8, F.col("id")).otherwise(F.raise_error(F.lit("lost"))).alias("id"))
    with pytest.raises(Exception, match="lost"):
        V.replace(broken, path)
    # A commit that was broken off has no file.
    (tmp_path / "t/commits/000000000002-dead/_temporary").mkdir(parents=True)
    assert ids(V.read_version(spark, path)) == [0, 1, 2] and V.version_of(spark, path) == 1
    assert {f: open(f, "rb").read() for f in before} == before
    V.replace(spark.range(2), path)
    assert ids(V.read_version(spark, path)) == [0, 1]


def test_parts_are_replaced_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(9).withColumn("y", F.when(F.col("id") < 8, (F.col("id") % 3).cast("string")))
    V.publish(spark, path, V.stage(rows, path, "y"))
    held = {r["part"]: r["folder"] for r in V.current(spark, path)}
    assert held.keys() == {"0", "1", "2", "none"}
    again = V.stage(spark.range(100, 102).withColumn("y", F.lit("1")), path, "y")
    V.publish(spark, path, again, ["2"])
    now = {r["part"]: r["folder"] for r in V.current(spark, path)}
    assert ids(V.read_version(spark, path)) == [0, 3, 6, 8, 100, 101]
    assert now["0"] == held["0"] and now["1"] != held["1"] and "2" not in now
    assert ids(V.read_version(spark, path, parts=["1"])) == [100, 101]
    assert V.read_version(spark, path, parts=["7"]).count() == 0
    files = V.read_version(spark, path, parts=["0"]).inputFiles()
    assert files and all("__part=0" in f for f in files)


def test_measures_are_taken_while_writing(spark, tmp_path):
    rows = spark.range(1000).withColumn("y", (F.col("id") % 4).cast("string"))
    wanted = {"n": F.count(F.lit(1)), "big": F.count_if(F.col("id") > 990), "top": F.max("id")}
    for part in (None, "y"):
        staged = V.stage(rows.repartition(7), str(tmp_path / f"t{part}"), part, wanted)
        assert staged.measured == {"n": 1000, "big": 9, "top": 999}
    empty = V.stage(rows.where("id < 0"), str(tmp_path / "e"), "y", wanted)
    assert empty.measured == {"n": 0, "big": 0, "top": None} and empty.rows.count() == 0


def test_layouts_come_from_the_commit(spark, tmp_path):
    path = str(tmp_path / "t")
    V.publish(spark, path, V.stage(spark.range(3).withColumn("y", F.lit("a")), path, "y"))
    other = spark.range(3).select(F.col("id").cast("string").alias("id"), F.lit("b").alias("y"))
    V.publish(spark, path, V.stage(other, path, "y"), [])
    assert V.layout_changes(spark, path) == {"b": ["id: bigint -> string"]} or V.layout_changes(spark, path) == {
        "a": ["id: string -> bigint"]
    }


def test_old_versions_expire(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(4).withColumn("y", F.col("id").cast("string"))
    V.publish(spark, path, V.stage(rows, path, "y"))
    for k in range(3):
        V.publish(spark, path, V.stage(spark.range(10 + k, 11 + k).withColumn("y", F.lit("0")), path, "y"), [])
    assert V.expire(spark, path, keep=2) == [1, 2]
    assert V.versions(spark, path) == [3, 4]
    assert ids(V.read_version(spark, path)) == [1, 2, 3, 12] and ids(V.read_version(spark, path, 3)) == [1, 2, 3, 11]
    assert V.expire(spark, path, keep=2) == []


def test_a_rejected_build_keeps_every_table(spark, tmp_path):
    out = str(tmp_path / "out")
    (tmp_path / "00.csv").write_text("cig;cup\nA;P1\nB;P1\nC;P2\n;P3\n")
    build.build_dataset(spark, "cup", [str(tmp_path / "00.csv")], out)
    (tmp_path / "01.csv").write_text("cig;cup\nA;P1\nA;P1\nZ;P9\n")
    with pytest.raises(quality.QualityError, match="chiavi_duplicate"):
        build.build_dataset(spark, "cup", [str(tmp_path / "01.csv")], out)
    assert sorted(r.cig for r in build.read_table(spark, out, "clean", "cup").collect()) == ["A", "B", "C"]
    assert {r.cup for r in build.read_table(spark, out, "mart", "cup", "mart_cup").collect()} == {"P1", "P2"}
    (tmp_path / "02.csv").write_text("cig;cup\nZ;P9\n")
    build.build_dataset(spark, "cup", [str(tmp_path / "02.csv")], out)
    assert [r.cig for r in build.read_table(spark, out, "clean", "cup").collect()] == ["Z"]


def test_measured_audit_equals_the_counted_one(spark, tmp_path):
    rows = spark.createDataFrame(
        [("A", 1, date(1980, 1, 1)), ("A", 1, date(2030, 1, 1)), (" ", None, None), ("B", 2, date(2020, 5, 5))],
        "cig string, id_aggiudicazione int, d date",
    )
    rules = quality.Rules(required=["cig", "lost"], key=["cig", "id_aggiudicazione"], not_null=["id_aggiudicazione"],
                          max_null={"d": 0.1}, dates=["d"], min_rows=9)
    for frame in (rows, rows.where("false")):
        staged = V.stage(frame, str(tmp_path / f"t{frame.count()}"), measures=quality.measures(frame, rules, date(2024, 1, 1), True))
        told = quality.audit(staged.rows, "t", rules, today=date(2024, 1, 1), newest=True, measured=staged.measured)
        counted = quality.audit(staged.rows, "t", rules, today=date(2024, 1, 1), newest=True)
        assert sorted(map(tuple, told.collect())) == sorted(map(tuple, counted.collect()))
        # What was measured needs no scan but the one of the keys.
        plan = told._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parquet") <= 1
