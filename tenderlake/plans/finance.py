"""Marts over the cost breakdown and the funding sources."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import billions, pct, rounded, sum_or_zero
from ..operators.joins import attach
from ..operators.reshape import positive_long
from ..operators.radix import group_median
from .fields import FONTI
from .tenders import n_rows, n_where

CONTRACT_PARTS = ["importo_lavori", "importo_servizi", "importo_forniture"]


def _first(event: str, value: str):
    """Value on the first row of the event, rows ordered by detail; NULL without such a row."""
    detail = F.col("dettaglio_evento")
    order = F.struct(detail.isNull(), detail, F.col("__contratto"), F.col("somme_a_disposizione"))
    return F.min_by(F.col(value), F.when(F.col("descrizione_evento") == event, order))


def mart_cig(events: DataFrame, suspect: float = 1e10, large: float = 1e9) -> DataFrame:
    """Base and final amount per award.

    Amounts are snapshots, not parts of a sum: the final one is the closing
    statement, or the largest seen when there is none. One aggregation covers
    base, closing and change events, so the events are shuffled once.
    """
    change = F.col("descrizione_evento") == "VARIANTE"
    closing = F.col("descrizione_evento") == "CONSUNTIVO"
    awards = (
        events.where(F.col("cig").isNotNull() & F.col("id_aggiudicazione").isNotNull())
        .withColumn("__contratto", sum_or_zero(*CONTRACT_PARTS))
        .groupBy("cig", "id_aggiudicazione")
        .agg(
            _first("BASE_ASTA", "__contratto").alias("importo_base"),
            _first("BASE_ASTA", "somme_a_disposizione").alias("somme_base"),
            _first("CONSUNTIVO", "__contratto").alias("__chiusura"),
            _first("CONSUNTIVO", "somme_a_disposizione").alias("__somme_chiusura"),
            F.max("__contratto").alias("__max"),
            F.max("somme_a_disposizione").alias("__somme_max"),
            n_where(change).alias("n_varianti"),
            n_rows().alias("n_eventi"),
            F.bool_or(closing).alias("ha_consuntivo"),
            F.min(F.when(change, F.col("data"))).alias("data_prima_variante"),
            F.max(F.when(change, F.col("data"))).alias("data_ultima_variante"),
        )
        .where(F.col("importo_base") > 0)
    )
    base = F.col("importo_base")
    return awards.select(
        "cig",
        "id_aggiudicazione",
        "importo_base",
        F.coalesce("__chiusura", "__max").alias("importo_finale"),
        (F.coalesce("__chiusura", "__max") - base).alias("scostamento"),
        pct(F.coalesce("__chiusura", "__max") - base, base, 2).alias("scostamento_pct"),
        "somme_base",
        F.coalesce("__somme_chiusura", "__somme_max").alias("somme_finali"),
        "n_varianti",
        "n_eventi",
        "ha_consuntivo",
        "data_prima_variante",
        "data_ultima_variante",
        (base >= suspect).alias("flag_base_sospetta"),
        (base >= large).alias("flag_base_grande"),
    )


def mart_eventi(events: DataFrame) -> DataFrame:
    """Events per type with the contract amounts they carry (missing parts read as 0)."""
    rows = events.withColumn("__contratto", sum_or_zero(*CONTRACT_PARTS))
    kinds = rows.groupBy("descrizione_evento").agg(
        n_rows().alias("n_righe"),
        F.count_distinct("cig").alias("n_cig"),
        F.count("data").alias("n_con_data"),
        rounded(F.avg("__contratto")).alias("importo_contratto_medio"),
        billions(F.sum("__contratto"), 1).alias("importo_contratto_mld"),
    )
    median = group_median(rows, ["descrizione_evento"], "__contratto", "__median")
    return (
        attach(kinds, median, ["descrizione_evento"])
        .withColumn("importo_contratto_mediano", rounded("__median"))
        .drop("__median")
        .orderBy(F.col("n_righe").desc(), F.col("descrizione_evento").asc_nulls_last())
    )


def mart_fonti(sources: DataFrame) -> DataFrame:
    """One row per award and positive funding source; suspect totals left out."""
    ids = ["cig", "id_aggiudicazione", "fonte_prevalente", "n_fonti"]
    trusted = sources.where(~F.col("flag_fonti_sospette")).select(*ids, *FONTI)
    return positive_long(trusted, ids, FONTI, "fonte", "importo")
