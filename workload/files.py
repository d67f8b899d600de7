"""Files and layers: the given tables written in the published formats and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlake.functions import scalars as S
from tenderlake.operators import keys as K
from tenderlake.plans import tenders
from tenderlake.session import scratch_path
from tenderlake.sources import delimited, layers

from .registry import query


def _publish(df, path: str) -> None:
    """Write a frame as a published resource: `;`-separated with quoted text."""
    (
        df.write.option("header", True)
        .option("sep", ";")
        .option("quote", '"')
        .option("escape", '"')
        .option("quoteAll", True)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


@query(
    "csv_scan_with_provenance",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS cig, o_totalprice AS importo,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS giorno,
           CASE WHEN o_orderstatus = 'F' THEN '01-20260401.csv' ELSE '00-full.csv' END AS __source_file
    FROM {orders}""",
)
def csv_scan_with_provenance(t):
    root = scratch_path(t.spark, "raw")
    rows = t.orders.select(
        F.col("o_orderkey").alias("cig"),
        F.col("o_totalprice").alias("importo"),
        F.to_date("o_orderdate").alias("giorno"),
        "o_orderstatus",
    )
    resources = {
        "00-full.csv": rows.where("o_orderstatus <> 'F'"),
        "01-20260401.csv": rows.where("o_orderstatus = 'F'"),
    }
    for name, part in resources.items():
        _publish(part.drop("o_orderstatus"), f"{root}/{name}")
    raw = delimited.read_delimited(
        t.spark, [f"{root}/{name}" for name in resources], split_resources=True
    )
    return raw.select(
        "cig", S.cast_double("importo").alias("importo"), S.safe_date("giorno").alias("giorno"), K.SOURCE
    )


@query(
    "csv_scan_with_line_breaks",
    """
    SELECT doc_id, lang, length(replace(replace(text, chr(13), ''), chr(10), '')) AS caratteri,
           length(text) - length(replace(text, chr(10), '')) AS righe,
           md5(replace(replace(text, chr(13), ''), chr(10), ' ')) AS impronta
    FROM {documents}""",
)
def csv_scan_with_line_breaks(t):
    """Whole texts, line breaks and quotes included, through the tolerant reader."""
    path = scratch_path(t.spark, "testi")
    _publish(t.documents.select("doc_id", "lang", "text"), path)
    raw = delimited.read_delimited(t.spark, path, multiline=True, source_file=False)
    flat = F.regexp_replace("text", "\r", "")
    return raw.select(
        S.cast_bigint("doc_id").alias("doc_id"),
        "lang",
        F.length(F.regexp_replace(flat, "\n", "")).cast("bigint").alias("caratteri"),
        (F.length("text") - F.length(F.regexp_replace("text", "\n", ""))).cast("bigint").alias("righe"),
        F.md5(F.regexp_replace(flat, "\n", " ")).alias("impronta"),
    )


@query(
    "csv_scan_badly_quoted",
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS cig, 'Ditta ' || s_name || ' srl' AS nome,
           s_suppkey * 3 AS importo
    FROM {supplier}""",
)
def csv_scan_badly_quoted(t):
    """A file whose inner quotes are not escaped, read whole by its name, beside one that is
    split; no row is lost or cut."""
    root = scratch_path(t.spark, "ditte")
    key, cost = F.col("s_suppkey").cast("string"), (F.col("s_suppkey") * 3).cast("string")
    is_delta = F.col("s_suppkey") % 3 == 0
    resources = {
        "00-full.csv": (~is_delta, '"Ditta "', '" srl"'),
        "01-delta.csv": (is_delta, '"Ditta ""', '"" srl"'),
    }
    for name, (rows, head, tail) in resources.items():
        line = F.concat_ws(";", key, F.concat(F.lit(head), "s_name", F.lit(tail)), cost)
        # The lines as they are: one column that is never quoted, named like the header.
        t.supplier.where(rows).select(line.alias("cig;nome;importo")).write.option(
            "header", True
        ).option("sep", "\u0001").option("quote", "\u0000").csv(f"{root}/{name}")
    raw = delimited.read_delimited_by_header(
        t.spark, [f"{root}/{name}" for name in resources], ["00-full.csv"], source_file=False
    )
    return raw.select(
        "cig",
        F.regexp_replace("nome", '"', "").alias("nome"),
        S.cast_bigint("importo").alias("importo"),
    )


@query(
    "csv_scan_other_headers",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS cig, o_orderstatus AS stato,
           CASE WHEN o_orderstatus = 'F' THEN o_orderpriority END AS procedura
    FROM {orders}""",
)
def csv_scan_other_headers(t):
    root = scratch_path(t.spark, "raw")
    lots = t.orders.select(
        F.col("o_orderkey").alias("cig"),
        F.col("o_orderstatus").alias("stato"),
        F.col("o_orderpriority").alias("procedura"),
    )
    _publish(lots.where("stato <> 'F'").select("stato", "cig"), f"{root}/a")
    _publish(lots.where("stato = 'F'").select("procedura", "cig", "stato"), f"{root}/b")
    return delimited.read_delimited_by_header(
        t.spark, [f"{root}/a", f"{root}/b"], source_file=False
    ).select("cig", "stato", "procedura")


@query(
    "year_partition_scan",
    """
    SELECT anno_pubblicazione, count(*) AS n, sum(importo_lotto) AS importo
    FROM {bandi} WHERE anno_pubblicazione IN (1996, 1998) GROUP BY 1""",
)
def year_partition_scan(t):
    path = scratch_path(t.spark, "bandi")
    layers.write_table(t.bandi, path, "anno_pubblicazione")
    years = layers.read_years(t.spark, path, [1996, 1998])
    return years.groupBy("anno_pubblicazione").agg(
        F.count(F.lit(1)).alias("n"), F.sum("importo_lotto").alias("importo")
    )


@query(
    "year_partition_overwrite",
    """
    SELECT anno_pubblicazione, count(*) AS n,
           count(*) FILTER (anno_pubblicazione = 1997) AS rettificate
    FROM {bandi} GROUP BY 1""",
)
def year_partition_overwrite(t):
    """One year written again replaces that year only."""
    path = scratch_path(t.spark, "bandi")
    lots = t.bandi.select("cig", "anno_pubblicazione")
    layers.write_table(lots.withColumn("versione", F.lit(0)), path, "anno_pubblicazione")
    again = lots.where("anno_pubblicazione = 1997").withColumn("versione", F.lit(1))
    layers.write_table(again, path, "anno_pubblicazione")
    return (
        t.spark.read.parquet(path)
        .groupBy("anno_pubblicazione")
        .agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("versione") == 1).alias("rettificate"))
    )


def _stored_mart(t) -> str:
    path = scratch_path(t.spark, "mart_trend_settore")
    layers.write_table(tenders.mart_trend_settore(t.bandi), path)
    return path


_TREND = """
    SELECT anno_pubblicazione AS anno, sezione_regionale AS regione,
           oggetto_principale_contratto AS settore, count(*) AS n_lotti,
           round(sum(importo_lotto), 0) AS importo_totale
    FROM {bandi} WHERE stato = 'ATTIVO' AND NOT flag_importo_sospetto
      AND sezione_regionale IS NOT NULL GROUP BY ALL"""
_COLUMNS = ["anno", "regione", "settore", "n_lotti", "importo_totale"]


@query(
    "mart_load_latest_year",
    f"WITH m AS ({_TREND}) SELECT * FROM m WHERE anno = (SELECT max(anno) FROM m)",
)
def mart_load_latest_year(t):
    return layers.load_mart(t.spark, _stored_mart(t)).select(*_COLUMNS)


@query("mart_load_all_years", _TREND)
def mart_load_all_years(t):
    return layers.load_mart_all_years(t.spark, _stored_mart(t)).select(*_COLUMNS)
