"""Marts over contract execution: progress, acceptance, starts, ends, suspensions, changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import days_between, guarded_days, in_years, pct, rounded, series_key
from .tenders import n_rows, n_where


def _newest_first(df: DataFrame, measure: str, *ties: str) -> DataFrame:
    return df.orderBy(
        F.col("anno").desc_nulls_last(),
        F.col(measure).desc(),
        *[F.col(t).asc_nulls_last() for t in ties],
    )


def mart_sal(progress: DataFrame, years: tuple[int, int | None] = (2008, None)) -> DataFrame:
    """Progress statements per year; amounts from the series share, never the running total."""
    anomalous = F.col("tipo_serie") == "anomala"
    cells = (
        progress.where(in_years("data_emissione_sal", years))
        .withColumn("anno", F.year("data_emissione_sal"))
        .groupBy("anno", "flag_ritardo")
        .agg(
            n_rows().alias("n_sal"),
            F.count_distinct("cig").alias("n_cig"),
            rounded(F.sum("importo_quota")).alias("importo_totale"),
            F.count_distinct(F.when(anomalous, series_key("id_aggiudicazione", "cig"))).alias(
                "n_serie_anomale"
            ),
            rounded(F.avg("n_giorni_scostamento")).alias("scostamento_medio_giorni"),
        )
    )
    return _newest_first(cells, "n_sal", "flag_ritardo")


def mart_collaudo(tests: DataFrame, years: tuple[int, int | None] = (2000, None)) -> DataFrame:
    cells = (
        tests.where(in_years("data_delibera", years))
        .withColumn("anno", F.year("data_delibera"))
        .groupBy("anno", "esito_collaudo")
        .agg(
            n_rows().alias("n_collaudi"),
            F.count_distinct("cig").alias("n_cig"),
            rounded(F.avg("riserve_avanzate")).alias("riserve_medie"),
            rounded(F.avg("importo_contenz_risolto")).alias("contenzioso_medio"),
        )
    )
    return _newest_first(cells, "n_collaudi", "esito_collaudo")


def mart_avvio_contratto(starts: DataFrame) -> DataFrame:
    signed = "data_stipula_contratto"
    to_start = guarded_days(signed, "data_inizio_effettiva", -365, 3650)
    to_term = guarded_days(signed, "data_termine_contrattuale", 0, 18250)
    return (
        starts.where(F.col(signed).isNotNull())
        .groupBy(F.year(signed).alias("anno"))
        .agg(
            n_rows().alias("n_contratti"),
            F.count_distinct("cig").alias("n_cig"),
            F.count("data_inizio_effettiva").alias("n_con_inizio"),
            F.count("data_termine_contrattuale").alias("n_con_termine"),
            rounded(F.avg(to_start), 1).alias("giorni_medi_stipula_inizio"),
            rounded(F.avg(to_term), 1).alias("giorni_medi_durata_contrattuale"),
            _share_pct("consegna_sotto_riserva").alias("quota_consegna_sotto_riserva_pct"),
            _share_pct("consegna_frazionata").alias("quota_consegna_frazionata_pct"),
        )
        .orderBy("anno")
    )


def _share_pct(flag: str):
    return rounded(F.avg(F.coalesce(F.col(flag), F.lit(False)).cast("int")) * 100.0, 1)


def mart_fine_contratto(ends: DataFrame) -> DataFrame:
    done = "data_effettiva_ultimazione"
    return (
        ends.where(F.col(done).isNotNull())
        .groupBy(F.year(done).alias("anno"))
        .agg(
            n_rows().alias("n_conclusi"),
            F.count_distinct("cig").alias("n_cig"),
            F.count("motivo_risoluzione").alias("n_con_risoluzione"),
            F.count("motivo_interruzione_anticipata").alias("n_con_interruzione"),
            F.count("data_conclusione_anticipata").alias("n_conclusione_anticipata"),
        )
        .withColumn("quota_risoluzione_pct", pct("n_con_risoluzione", "n_conclusi", 2))
        .withColumn("quota_interruzione_pct", pct("n_con_interruzione", "n_conclusi", 2))
        .orderBy("anno")
    )


def mart_motivi_fine(ends: DataFrame) -> DataFrame:
    """Reasons of termination and of early interruption, in one list."""
    reasons = {
        "RISOLUZIONE": "motivo_risoluzione",
        "INTERRUZIONE ANTICIPATA": "motivo_interruzione_anticipata",
    }
    kinds = F.explode(
        F.array(
            *[
                F.struct(F.lit(kind).alias("tipo"), F.col(column).alias("motivo"))
                for kind, column in reasons.items()
            ]
        )
    )
    # One scan; each row yields both kinds and the empty ones fall out.
    return (
        ends.select(kinds.alias("k"))
        .select("k.tipo", "k.motivo")
        .where(F.col("motivo").isNotNull())
        .groupBy("tipo", "motivo")
        .agg(n_rows().alias("n_contratti"))
        .orderBy(F.col("n_contratti").desc(), "tipo", "motivo")
    )


MAX_SUSPENSION = 3650


def mart_sospensioni(suspensions: DataFrame) -> DataFrame:
    days = days_between("data_sospensione", "data_ripresa")
    plausible = F.when(days.between(0, MAX_SUSPENSION), days)
    cells = (
        suspensions.where(F.col("data_sospensione").isNotNull())
        .groupBy(F.year("data_sospensione").alias("anno"), "descrizione_motivo")
        .agg(
            n_rows().alias("n_sospensioni"),
            F.count_distinct("cig").alias("n_cig"),
            F.count("data_ripresa").alias("n_con_ripresa"),
            n_where(days > MAX_SUSPENSION).alias("n_durata_anomala"),
            rounded(F.avg(plausible), 1).alias("giorni_medi"),
            F.max(plausible).alias("giorni_max"),
            F.sum(F.coalesce(plausible, F.lit(0))).alias("giorni_totali"),
        )
    )
    return _newest_first(cells, "n_sospensioni", "descrizione_motivo")


def mart_varianti(changes: DataFrame) -> DataFrame:
    extended = F.col("cig_proroga").isNotNull()
    cells = (
        changes.where(F.col("data_approvazione_variante").isNotNull())
        .groupBy(F.year("data_approvazione_variante").alias("anno"), "motivo_variante")
        .agg(
            n_rows().alias("n_varianti"),
            F.count_distinct("id_variante").alias("n_varianti_distinte"),
            F.count_distinct("cig").alias("n_cig"),
            F.count_distinct(F.when(extended, F.col("cig"))).alias("n_cig_con_proroga"),
            n_where(extended).alias("__extended"),
        )
        .withColumn("quota_con_proroga_pct", pct("__extended", "n_varianti", 2))
        .drop("__extended")
    )
    return _newest_first(cells, "n_varianti", "motivo_variante")
