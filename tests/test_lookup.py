"""Lookup by key, search of names, and distinct counts that roll up."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tenderlake.operators import bitmaps, search
from tenderlake.plans import build
from tenderlake.plans import questions as Q
from tenderlake.sources import versions as V


def scanned(df) -> int:
    """Rows the scans of a plan gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_reads_few_row_groups(spark, tmp_path):
    """Keys in no order at all, so only Bloom filters tell the files apart."""
    key = F.concat(F.lit("LOT"), F.hex(F.xxhash64("id")))
    rows = spark.range(400_000).select(key.alias("cig"), F.col("id").alias("v")).repartition(20)
    table = V.replace(rows, str(tmp_path / "t"), bloom=["cig"])
    (lot,) = rows.where("v = 77").collect()
    found = Q.lookup_published({"t": table}, [f" {lot.cig.lower()} "])["t"]
    assert "EqualTo(cig," in found._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert [r.v for r in found.collect()] == [77]
        assert scanned(Q.lookup_published({"t": table}, [lot.cig])["t"]) <= 400_000 // 20 * 3
        assert scanned(Q.lookup_cigs({"t": table}, [lot.cig])["t"]) == 400_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_every_spelling_is_found(spark):
    rows = spark.createDataFrame([("ab1", 1), ("AB1", 2), (" Ab1", 3), ("zz", 4), (None, 5)], "cig string, v int")
    spelled = Q.spellings(rows)
    assert sorted((r.lot, r.cig) for r in spelled.collect()) == [("AB1", " Ab1"), ("AB1", "ab1"), ("ZZ", "zz")]
    tables = {"t": rows, "other": rows.drop("cig")}
    for wanted in (["aB1 "], ["ZZ", "none"], []):
        plain = {n: sorted(r.v for r in df.collect()) for n, df in Q.lookup_cigs(tables, wanted).items()}
        found = Q.lookup_published(tables, wanted, {"t": spelled})
        assert {n: sorted(r.v for r in df.collect()) for n, df in found.items()} == plain


@pytest.mark.parametrize("fragment", ["mun", "Comune di", "a", "ZZZ", "", "ùò", "e d", "ROMA", "m_n", "%"])
def test_names_with_a_fragment(spark, tmp_path, fragment):
    names = ["Comune di Roma", "COMUNE DI ROMA", "Comune d'Este", "ab", "A", "Università di Bari", "ùòà", "m_n%", None, ""]
    rows = spark.createDataFrame([(n, i) for i, n in enumerate(names * 3)], "sa string, v int")
    path = str(tmp_path / "index")
    search.write_index(rows, "sa", path, files=3)
    got = {r["name"] for r in search.names_with(spark, path, fragment).collect()}
    assert got == {n.upper() for n in names if n is not None and fragment.upper() in n.upper()}
    kept = search.rows_named(rows, "sa", search.names_with(spark, path, fragment))
    want = [i for i, n in enumerate(names * 3) if n is not None and fragment.upper() in n.upper()]
    assert sorted(r.v for r in kept.collect()) == want and kept.columns == rows.columns


def test_a_search_asks_for_its_own_postings(spark, tmp_path):
    rows = spark.range(3000).select(F.concat(F.lit("ente "), F.hex(F.xxhash64("id"))).alias("sa"))
    path = str(tmp_path / "index")
    search.write_index(rows, "sa", path, files=30)
    names = search.names_with(spark, path, "4F9")
    assert "EqualTo(gram,4F9)" in names._jdf.queryExecution().executedPlan().toString().split("PushedFilters")[1]
    total = V.read_version(spark, f"{path}/postings").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert scanned(search.names_with(spark, path, "4F9")) < total / 8
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_distinct_counts_roll_up(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(4), rng.choice([None, *range(200)]), rng.choice(["x", "y", None]))
            for _ in range(3000)]
    rows += [("hot", 1, k, "x") for k in range(70_000)]
    df = spark.createDataFrame(rows, "g string, y int, v int, w string")
    columns = {"v": "n_v", "w": "n_w"}
    dictionary = V.replace(bitmaps.numbered(df, columns), str(tmp_path / "d"))
    assert dictionary.select("__id").distinct().count() == dictionary.count()
    cells = V.replace(bitmaps.distinct_bitmaps(df, ["g", "y"], columns, dictionary), str(tmp_path / "b"))
    for keys in (["g", "y"], ["g"], ["y"]):
        got = sorted(map(repr, map(tuple, bitmaps.distinct_counts(cells, keys, ["n_v", "n_w"]).collect())))
        want = df.groupBy(*keys).agg(F.count_distinct("v"), F.count_distinct("w")).collect()
        assert got == sorted(map(repr, map(tuple, want)))


def test_published_tables_are_looked_up(spark, tmp_path):
    out = str(tmp_path / "out")
    (tmp_path / "00.csv").write_text("cig;cup\nabc1;P1\nABC1;P2\nZ9;P2\n")
    build.build_dataset(spark, "cup", [str(tmp_path / "00.csv")], out)
    found = build.lookup(spark, out, ["cup"], ["Abc1"])["cup"]
    assert sorted(r.cup for r in found.collect()) == ["P1", "P2"]
    head = ("cig;anno_pubblicazione;importo_lotto;stato;denominazione_amministrazione_appaltante\n")
    (tmp_path / "b.csv").write_text(head + "A;2020;5;ATTIVO;Comune di Roma\nB;2020;7;ATTIVO;Ente\nC;2021;9;ATTIVO;comune di bari\n")
    build.build_dataset(spark, "bandi_gara", [str(tmp_path / "b.csv")], out, check=False)
    assert [r.cig for r in build.find_authority(spark, out, " comune ").collect()] == ["C", "A"]
