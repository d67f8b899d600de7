"""Marts over the tenders table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import bucket_values, ratio, rounded
from ..operators.joins import attach
from ..operators.reshape import (
    change_to_previous,
    report_order,
    share_of_partition,
    top_n_per_group,
)
from ..operators.radix import group_median

AMOUNT = "importo_lotto"
AWARDED = "AGGIUDICATA"

# Outcome texts per macro class; fixed values.
MACRO_ESITO = {
    "aggiudicata": [
        "AGGIUDICATA",
        "AGGIUDICATA EFFICACE",
        "AGGIUDICATA EFFICACE - CONTRATTO STIPULATO",
        "AGGIUDICATA - CONTRATTO STIPULATO",
        "AGGIUDICAZIONE EFFICACE",
        "AGGIUDICAZIONE EFFICACE - CONTRATTO STIPULATO",
    ],
    "non_aggiudicata": [
        "NON AGGIUDICATA",
        "DESERTA",
        "PROCEDURA DESERTA",
        "NON AGGIUDICATA - NESSUNA OFFERTA",
        "NON AGGIUDICATA - OFFERTE INAMMISSIBILI",
    ],
    "annullata": ["ANNULLATA", "CANCELLATA", "REVOCATA"],
}


def active_trusted(tenders: DataFrame) -> DataFrame:
    """Active lots whose amount is not under suspicion."""
    return tenders.where((F.col("stato") == "ATTIVO") & ~F.col("flag_importo_sospetto"))


def n_rows() -> Column:
    return F.count(F.lit(1))


def n_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def sum_where(condition: Column, value: str = AMOUNT, digits: int = 0) -> Column:
    """Sum over the rows that meet the condition, 0 when none does."""
    return rounded(F.sum(F.when(condition, F.col(value)).otherwise(0.0)), digits)


def mart_annuale(tenders: DataFrame) -> DataFrame:
    """One row per year; suspect amounts are counted and summed apart."""
    trusted, awarded = ~F.col("flag_importo_sospetto"), F.col("esito") == AWARDED
    pnrr = F.col("flag_pnrr")
    amount = F.when(trusted, F.col(AMOUNT))
    lots = tenders.withColumnRenamed("anno_pubblicazione", "anno")
    yearly = lots.groupBy("anno").agg(
        n_rows().alias("n_lotti"),
        F.count_distinct("cig").alias("n_cig"),
        F.count_distinct("cf_amministrazione_appaltante").alias("n_stazioni_appaltanti"),
        F.count_distinct("oggetto_principale_contratto").alias("n_settori"),
        rounded(F.sum(amount)).alias("importo_totale"),
        rounded(F.avg(amount)).alias("importo_medio"),
        n_where(~trusted).alias("n_importi_sospetti"),
        sum_where(~trusted).alias("importo_sospetti"),
        n_where(pnrr).alias("n_pnrr"),
        sum_where(pnrr & trusted).alias("importo_pnrr"),
        n_where(awarded).alias("n_aggiudicati"),
        n_where(~F.coalesce(awarded, F.lit(False))).alias("n_non_aggiudicati"),
        sum_where(awarded & trusted).alias("importo_aggiudicati"),
    )
    median = group_median(lots.where(trusted), ["anno"], AMOUNT, "__median")
    return (
        attach(yearly, median, ["anno"])
        .withColumn("importo_mediano", rounded("__median"))
        .drop("__median")
        .orderBy(F.col("anno").asc_nulls_last())
    )


def mart_trend_pnrr(tenders: DataFrame) -> DataFrame:
    cell = ["anno_pubblicazione", "sezione_regionale", "oggetto_principale_contratto"]
    groups = (
        active_trusted(tenders)
        .where(F.col("sezione_regionale").isNotNull())
        .groupBy(*cell, "flag_pnrr")
        .agg(
            n_rows().alias("n_lotti"),
            F.count_distinct("cig").alias("n_bandi"),
            F.count_distinct("cf_amministrazione_appaltante").alias("n_stazioni"),
            F.sum(AMOUNT).alias("__sum"),
            rounded(F.avg(AMOUNT)).alias("importo_medio"),
        )
        .withColumn("importo_totale", rounded("__sum"))
    )
    return (
        share_of_partition(groups, cell, "__sum", "quota_pct_settore")
        .drop("__sum")
        .orderBy(
            F.col(cell[0]).desc_nulls_last(),
            *[F.col(c).asc_nulls_last() for c in [*cell[1:], "flag_pnrr"]],
        )
    )


def mart_top_stazioni(tenders: DataFrame, limit: int = 500) -> DataFrame:
    """Authorities ranked per year by amount; the first `limit` rows of the report."""
    authority = "cf_amministrazione_appaltante"
    named = active_trusted(tenders).where(F.col(authority) != "").select(
        F.col("anno_pubblicazione").alias("anno"),
        authority,
        "denominazione_amministrazione_appaltante",
        F.col("sezione_regionale").alias("regione"),
        "cig",
        AMOUNT,
    )
    group = ["anno", authority, "denominazione_amministrazione_appaltante", "regione"]
    totals = named.groupBy(*group).agg(
        F.count_distinct("cig").alias("n_gare"),
        n_rows().alias("n_lotti"),
        F.sum(AMOUNT).alias("__sum"),
        rounded(F.avg(AMOUNT)).alias("importo_medio"),
    )
    # The report's order is that of the ranks, so its rows are taken first, by a heap per
    # task, and only these are ranked: a year's rows among them are its best ones.
    first = totals.orderBy(
        F.col("anno").desc_nulls_last(), F.col("__sum").desc_nulls_last(), *group[1:]
    ).limit(limit)
    ranked = top_n_per_group(first, ["anno"], "__sum", limit, group[1:], "rank_per_anno")
    return (
        ranked.withColumn("importo_totale", rounded("__sum"))
        .withColumn("lotti_medi_per_gara", rounded(ratio("n_lotti", "n_gare"), 1))
        .drop("__sum")
        .orderBy(F.col("anno").desc_nulls_last(), "rank_per_anno")
    )


def mart_esiti_per_procedura(tenders: DataFrame) -> DataFrame:
    groups = (
        active_trusted(tenders)
        .where(F.col("tipo_scelta_contraente").isNotNull() & F.col("sezione_regionale").isNotNull())
        .groupBy(
            F.col("anno_pubblicazione").alias("anno"),
            F.col("sezione_regionale").alias("regione"),
            F.col("oggetto_principale_contratto").alias("settore"),
            "tipo_scelta_contraente",
            bucket_values("esito", MACRO_ESITO, "altro").alias("macro_esito"),
        )
        .agg(n_rows().alias("n_lotti"), rounded(F.sum(AMOUNT)).alias("importo_totale"))
    )
    return share_of_partition(
        groups, ["anno", "regione", "tipo_scelta_contraente"], "n_lotti", "quota_pct"
    ).orderBy(
        F.col("anno").desc_nulls_last(),
        "regione",
        "tipo_scelta_contraente",
        F.col("n_lotti").desc(),
        F.col("settore").asc_nulls_last(),
        "macro_esito",
    )


def mart_trend_settore(tenders: DataFrame) -> DataFrame:
    """Yearly amounts per region and sector, over all years so that the change is defined."""
    groups = (
        active_trusted(tenders)
        .where(F.col("sezione_regionale").isNotNull())
        .groupBy(
            F.col("anno_pubblicazione").alias("anno"),
            F.col("sezione_regionale").alias("regione"),
            F.col("oggetto_principale_contratto").alias("settore"),
        )
        .agg(n_rows().alias("n_lotti"), rounded(F.sum(AMOUNT)).alias("importo_totale"))
    )
    moved = change_to_previous(
        groups, ["regione", "settore"], "anno", "importo_totale", "var_pct_anno_prec"
    )
    return share_of_partition(
        moved, ["anno", "regione"], "importo_totale", "quota_pct_su_regione"
    ).orderBy(
        F.col("anno").desc_nulls_last(),
        "regione",
        F.col("importo_totale").desc_nulls_last(),
        F.col("settore").asc_nulls_last(),
    )


def mart_sa_profilo(
    tenders: DataFrame, min_lots: int = 10, ordered: bool = True
) -> DataFrame:
    """Authority profile with both the mean and the true median lot amount."""
    lots = active_trusted(tenders).where(F.col("cf_amministrazione_appaltante") != "").withColumnRenamed(
        "cf_amministrazione_appaltante", "cf_sa"
    )
    pnrr = F.col("flag_pnrr")
    profile = (
        lots.groupBy("cf_sa")
        .agg(
            F.max("denominazione_amministrazione_appaltante").alias("denominazione_sa"),
            F.max("sezione_regionale").alias("regione"),
            n_rows().alias("n_bandi"),
            F.count_distinct("cig").alias("n_cig"),
            rounded(F.sum(AMOUNT)).alias("importo_totale"),
            rounded(F.avg(AMOUNT)).alias("importo_medio"),
            F.count_distinct("oggetto_principale_contratto").alias("n_settori"),
            F.min("anno_pubblicazione").alias("anno_primo"),
            F.max("anno_pubblicazione").alias("ultimo_anno"),
            n_where(pnrr).alias("n_pnrr"),
            sum_where(pnrr).alias("importo_pnrr"),
        )
        .where(F.col("n_bandi") >= min_lots)
    )
    median = group_median(lots, ["cf_sa"], AMOUNT, "__median")
    profiles = (
        attach(profile, median, ["cf_sa"])
        .withColumn("importo_mediano", rounded("__median"))
        .drop("__median")
    )
    return report_order(profiles, ordered, F.col("importo_totale").desc_nulls_last(), "cf_sa")


def tenders_per_cig(tenders: DataFrame) -> DataFrame:
    """One row per lot with the attributes the cross marts join on.

    Six marts start from this table: `build_cross` stores it once.
    """
    known = tenders.where(
        F.col("cf_amministrazione_appaltante").isNotNull() & ~F.col("flag_importo_sospetto")
    )
    return known.groupBy("cig").agg(
        F.max("anno_pubblicazione").alias("anno"),
        F.max("sezione_regionale").alias("regione"),
        F.max("oggetto_principale_contratto").alias("settore"),
        F.max("cf_amministrazione_appaltante").alias("cf_sa"),
        F.max("denominazione_amministrazione_appaltante").alias("sa"),
        F.sum(AMOUNT).alias("importo_lotto"),
    )


MARTS = {
    "mart_annuale": mart_annuale,
    "mart_trend_pnrr": mart_trend_pnrr,
    "mart_top_stazioni": mart_top_stazioni,
    "mart_esiti_per_procedura": mart_esiti_per_procedura,
    "mart_trend_settore": mart_trend_settore,
    "mart_sa_profilo": mart_sa_profilo,
}
