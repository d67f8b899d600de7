from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tenderlake.operators.keys import SOURCE
from tenderlake.plans import build, quality
from tenderlake.sources import catalog, delimited, layers


def test_audit_reports_each_rule(frame):
    df = frame(
        [("A", 2024, date(2024, 1, 1), None), ("A", 2024, date(1980, 1, 1), "x"), ("B", 2023, date(2030, 1, 1), "x"),
         ("B", 2024, None, "x"), (" ", 2024, None, None)],
        "cig string, anno int, d date, note string",
    )
    rules = quality.Rules(required=["cig", "z"], key=["cig"], not_null=["cig"], max_null={"note": 0.3}, dates=["d"], min_rows=9)
    found = {(r.livello, r.regola, r.oggetto): r.valore for r in quality.audit(df, "t", rules, "anno", date(2026, 1, 1)).collect()}
    assert found == {
        ("errore", "colonna_assente", "z"): 1,
        ("errore", "righe_minime", "9"): 4,
        ("errore", "cig_vuoto", "cig"): 1,
        ("errore", "valori_null", "note"): 2,
        ("errore", "date_ante_1990", "d"): 1,
        ("avviso", "date_future", "d"): 1,
        ("errore", "chiavi_duplicate", "cig"): 1,
        ("avviso", "chiavi_in_piu_anni", "cig"): 1,
    }
    with pytest.raises(quality.QualityError, match="chiavi_duplicate"):
        quality.validate(quality.audit(df, "t", rules))
    assert quality.missing_tables({"a": df}, ["a", "b"]) == ["b"]


def test_clean_report_is_empty(frame):
    df = frame([("A", 1)], "cig string, id_aggiudicazione long")
    report = quality.audit(df, "t", quality.Rules(required=["cig"], key=["cig"], not_null=["cig"]))
    assert quality.validate(report).collect() == []


def test_schema_drift(spark, tmp_path):
    spark.range(1).select(F.lit(1).alias("a"), F.lit("x").alias("b")).write.parquet(str(tmp_path / "1"))
    spark.range(1).select(F.lit("1").alias("a"), F.lit(1).alias("c")).write.parquet(str(tmp_path / "2"))
    drift = quality.schema_drift(spark, {2023: str(tmp_path / "1"), 2024: str(tmp_path / "2")})
    assert drift == {2024: ["a: int -> string", "b: string -> assente", "c: assente -> int"]}
    assert quality.freshness(spark, str(tmp_path / "1")).first().giorni == 0


CSV0 = 'cig;nome;importo\n A ;"Ditta ""X""";10\nB;corta\nC;lunga;1;2\n'
CSV1 = 'cig;nome;importo\nA;"due\nrighe";20\n'


@pytest.fixture
def files(tmp_path):
    (tmp_path / "00-full.csv").write_text(CSV0, encoding="utf-8")
    (tmp_path / "01-delta.csv").write_text(CSV1, encoding="utf-8")
    return [str(tmp_path / "00-full.csv"), str(tmp_path / "01-delta.csv")]


def test_delimited_files(spark, files):
    rows = [tuple(r) for r in delimited.read_delimited(spark, files, multiline=True).collect()]
    assert sorted(rows, key=str) == sorted(
        [("A", 'Ditta "X"', "10", "00-full.csv"), ("B", "corta", None, "00-full.csv"),
         ("C", "lunga", "1", "00-full.csv"), ("A", "due\nrighe", "20", "01-delta.csv")], key=str)
    ragged = delimited.read_delimited(spark, files[0], ragged=True, source_file=False)
    assert {r.cig: r[delimited.RAGGED] for r in ragged.collect()} == {"A": False, "B": True, "C": True}


def test_files_with_other_headers(spark, tmp_path):
    (tmp_path / "a.csv").write_text("cig;x\nA;1\n")
    (tmp_path / "b.csv").write_text("x;cig;y\n2;B;3\n")
    df = delimited.read_delimited_by_header(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert sorted((r.cig, r.x, r.y or "") for r in df.collect()) == [("A", "1", ""), ("B", "2", "3")]


def test_another_header_is_an_error(spark, tmp_path):
    (tmp_path / "a.csv").write_text("cig;x\nA;1\n")
    (tmp_path / "b.csv").write_text("x;cig\n2;B\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        delimited.read_delimited(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")]).collect()


def test_year_layers(spark, tmp_path):
    path = str(tmp_path / "t")
    both = spark.createDataFrame([("A", 2023), ("B", 2024)], "cig string, anno int")
    layers.write_table(both, path, "anno")
    layers.write_table(spark.createDataFrame([("C", 2024)], "cig string, anno int"), path, "anno")
    assert sorted(r.cig for r in layers.load_mart_all_years(spark, path).collect()) == ["A", "C"]
    assert [r.cig for r in layers.load_mart(spark, path).collect()] == ["C"]
    assert [r.cig for r in layers.load_mart(spark, path, 2023).collect()] == ["A"]
    pruned = layers.read_years(spark, path, [2023], "anno")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anno" in plan or "PartitionFilters: [anno" in plan
    assert [r.cig for r in pruned.collect()] == ["A"]


def test_sql_templates(spark, frame):
    awards = frame([("A", 2e6, 1), ("B", 3e6, 2), ("C", 5e5, 1)],
                   "cig string, importo_aggiudicazione double, num_imprese_offerenti int")
    catalog.register({"aggiudicazioni": awards})
    assert spark.sql("select count(*) from aggiudicazioni").first()[0] == 3
    assert [r.cig for r in catalog.run_template(spark, "un_solo_offerente", awards).collect()] == ["A"]
    assert catalog.run_template(spark, "conta_righe", awards).first().n == 3
    assert {(r.colonna, r.n) for r in catalog.columns(awards).collect()} == {(c, 3) for c in awards.columns}
    assert [r.cig for r in catalog.preview(awards, ["cig"], 2).collect()] == sorted(r.cig for r in awards.collect())[:2]


def test_build_dataset_end_to_end(spark, tmp_path):
    (tmp_path / "00.csv").write_text("cig;cup\nA;P1\nB;P1\nC;P2\n;P3\n")
    tables = build.build_dataset(spark, "cup", [str(tmp_path / "00.csv")], str(tmp_path / "out"))
    assert [(r.cup, r.n_cig) for r in tables["mart_cup"].orderBy("cup").collect()] == [("P1", 2), ("P2", 1)]
    (tmp_path / "01.csv").write_text("cig;cup\nA;P1\nA;P1\n")
    with pytest.raises(quality.QualityError):
        build.build_dataset(spark, "cup", [str(tmp_path / "01.csv")], str(tmp_path / "out2"))


def test_build_awards_from_files(spark, tmp_path):
    head = "cig;id_aggiudicazione;data_aggiudicazione_definitiva;importo_aggiudicazione\n"
    (tmp_path / "00-full.csv").write_text(head + "A;1;2024-01-01;10\nA;2;2024-01-01;20\nB;3;2024-05-01;5\n")
    (tmp_path / "01-delta.csv").write_text(head + "A;1;2024-02-01;30\n")
    out = str(tmp_path / "out")
    files = [str(tmp_path / "00-full.csv"), str(tmp_path / "01-delta.csv")]
    tables = build.build_dataset(spark, "aggiudicazioni", files, out, check=False)
    assert sorted((r.cig, r.id_aggiudicazione, r.importo_aggiudicazione) for r in tables["mart_dettaglio"].collect()) == [
        ("A", 1, 30.0), ("B", 3, 5.0)]
    assert SOURCE not in tables["clean"].columns


def test_only_named_files_are_read_whole(spark, files, monkeypatch):
    scans = []
    plain = delimited.read_delimited

    def spy(spark, paths, columns, whole, *rest):
        scans.append((sorted(p.rpartition("/")[2] for p in paths), whole))
        return plain(spark, paths, columns, whole, *rest)

    monkeypatch.setattr(delimited, "read_delimited", spy)
    rows = delimited.read_delimited_by_header(spark, files, multiline=["01-delta.csv"]).collect()
    assert sorted(scans) == [(["00-full.csv"], False), (["01-delta.csv"], True)]
    assert "due\nrighe" in {r.nome for r in rows}


def test_drift_inside_one_table_is_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).select(F.lit("A").alias("cig"), F.lit(1).alias("v")).write.parquet(path)
    spark.range(3).select(F.lit("A").alias("cig"), F.lit("1").alias("v")).write.mode("append").parquet(path)
    clean = spark.read.schema("cig string").parquet(path)
    report = quality.audit(clean, "t", quality.Rules(dates=[]), path=path)
    assert [(r.livello, r.regola) for r in report.collect() if r.regola == "deriva_schema"] == [("errore", "deriva_schema")]


def test_newest_days_are_noted(frame):
    df = frame([("A", date(2024, 1, 2)), ("B", None)], "cig string, d date")
    report = quality.audit(df, "t", quality.Rules(dates=["d"]), newest=True)
    (note,) = report.where("livello = 'nota'").collect()
    assert (note.regola, note.oggetto, note.valore) == ("data_massima", "d", (date(2024, 1, 2) - date(1970, 1, 1)).days)
