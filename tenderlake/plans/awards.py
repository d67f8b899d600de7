"""Marts over awards, firms, subcontracts and project codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import in_years
from ..operators.joins import attach, attach_distinct_counts
from ..operators.reshape import report_order
from ..operators.radix import group_medians
from .tenders import n_rows


def mart_annuale(awards: DataFrame, years: tuple[int, int | None] = (2005, None)) -> DataFrame:
    """Awards per month, outcome, criterion and flags."""
    day = F.col("data_aggiudicazione_definitiva")
    groups = [
        "anno_aggiudicazione",
        "mese_aggiudicazione",
        "esito",
        "criterio_aggiudicazione",
        "flag_subappalto",
        "asta_elettronica",
        "flag_importo_positivo",
    ]
    rows = awards.where(in_years(day, years)).withColumns(
        {
            "anno_aggiudicazione": F.year(day),
            "mese_aggiudicazione": F.month(day),
            "flag_importo_positivo": F.coalesce(F.col("importo_aggiudicazione") > 0, F.lit(False)),
        }
    )
    amount, discount = "importo_aggiudicazione", "ribasso_aggiudicazione"
    cells = rows.groupBy(*groups).agg(
        n_rows().alias("n_aggiudicazioni"),
        F.sum(amount).alias("importo_totale"),
        F.avg(amount).alias("importo_medio"),
        F.max(amount).alias("importo_massimo"),
        F.min(amount).alias("importo_minimo"),
        F.avg(discount).alias("ribasso_medio"),
        F.sum("numero_offerte_ammesse").alias("offerte_ammesse_totale"),
        F.sum("numero_offerte_escluse").alias("offerte_escluse_totale"),
        F.avg("num_imprese_offerenti").alias("imprese_offerenti_medie"),
        F.avg("num_imprese_invitate").alias("imprese_invitate_medie"),
    )
    distinct = {"cig": "n_cig_distinti", "id_aggiudicazione": "n_id_aggiudicazione_distinti"}
    cells = attach_distinct_counts(cells, rows, groups, distinct)
    medians = {amount: "importo_mediano", discount: "ribasso_mediano"}
    return attach(cells, group_medians(rows, groups, medians), groups)


def mart_dettaglio(awards: DataFrame) -> DataFrame:
    """Row-level awards with their keys."""
    return awards.where(F.col("cig").isNotNull()).select(
        "cig",
        "id_aggiudicazione",
        "data_aggiudicazione_definitiva",
        "data_comunicazione_esito",
        "esito",
        "criterio_aggiudicazione",
        "importo_aggiudicazione",
        "ribasso_aggiudicazione",
        "numero_offerte_ammesse",
        "numero_offerte_escluse",
        "num_imprese_offerenti",
        "num_imprese_invitate",
        "flag_subappalto",
        "asta_elettronica",
        "cod_esito",
    )


FIRM = ["codice_fiscale", "denominazione", "tipo_soggetto", "ruolo"]


def _ranked(df: DataFrame, ordered: bool, measure: str, ties: list[str]) -> DataFrame:
    return report_order(
        df, ordered, F.col(measure).desc(), *[F.col(t).asc_nulls_last() for t in ties]
    )


def mart_top_aggiudicatari(winners: DataFrame, ordered: bool = True) -> DataFrame:
    firms = (
        winners.where(F.col("codice_fiscale") != "")
        .groupBy(*FIRM)
        .agg(
            F.count_distinct("cig").alias("n_cig"),
            F.count_distinct("id_aggiudicazione").alias("n_aggiudicazioni"),
            n_rows().alias("n_record"),
        )
    )
    return _ranked(firms, ordered, "n_cig", FIRM)


def mart_top_partecipanti(bidders: DataFrame, ordered: bool = True) -> DataFrame:
    firms = (
        bidders.where(F.col("codice_fiscale") != "")
        .groupBy(*FIRM)
        .agg(F.count_distinct("cig").alias("n_cig"), n_rows().alias("n_record"))
    )
    return _ranked(firms, ordered, "n_cig", FIRM)


def mart_top_subappalti(subcontracts: DataFrame, ordered: bool = True) -> DataFrame:
    group = ["descrizione_categoria", "descrizione_cpv", "codice_fiscale", "denominazione", "ruolo"]
    cells = subcontracts.groupBy(*group).agg(
        F.count_distinct("cig").alias("n_cig"),
        F.count_distinct("id_subappalto").alias("n_subappalti"),
        n_rows().alias("n_record"),
    )
    return _ranked(cells, ordered, "n_subappalti", group)


def mart_cup(cup: DataFrame, ordered: bool = True) -> DataFrame:
    projects = cup.groupBy("cup").agg(
        n_rows().alias("n_cig"), F.count_distinct("cig").alias("n_cig_distinti")
    )
    return _ranked(projects, ordered, "n_cig", ["cup"])
