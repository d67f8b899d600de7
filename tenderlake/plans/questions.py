"""Questions asked of the clean tables and marts at reading time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.scalars import billions, pct, rounded
from ..operators.joins import attach, keep_matching
from ..operators.bitmaps import distinct_bitmaps, distinct_counts, numbered
from ..operators.search import names_with, rows_named
from ..operators.reshape import cumulative_share, keep_top_groups, pivot_filled, top_n
from .cross import LATE
from .tenders import AMOUNT, AWARDED, active_trusted, n_rows, n_where, sum_where

# --- overview ---------------------------------------------------------------


_COUNTED = {
    "cig": "n_cig",
    "cf_amministrazione_appaltante": "n_stazioni_appaltanti",
    "oggetto_principale_contratto": "n_settori",
}
_CELL = ["anno", "settore", "regione"]


def _in_cells(tenders: DataFrame) -> DataFrame:
    rows = active_trusted(tenders).where(
        F.col("oggetto_principale_contratto").isNotNull() & F.col("sezione_regionale").isNotNull()
    )
    return rows.withColumns(
        {
            "anno": F.col("anno_pubblicazione"),
            "settore": F.col("oggetto_principale_contratto"),
            "regione": F.col("sezione_regionale"),
        }
    )


def yearly_overview(tenders: DataFrame) -> DataFrame:
    """Yearly key figures. Distinct counts come from the tenders, they do not add up over cells."""
    pnrr, awarded = F.col("flag_pnrr"), F.col("esito") == AWARDED
    return (
        _in_cells(tenders)
        .groupBy("anno")
        .agg(
            F.count_distinct("cig").alias("n_cig"),
            n_rows().alias("n_lotti"),
            rounded(F.sum(AMOUNT)).alias("importo_totale"),
            F.count_distinct("cf_amministrazione_appaltante").alias("n_stazioni_appaltanti"),
            n_where(pnrr).alias("n_pnrr"),
            sum_where(pnrr).alias("importo_pnrr"),
            n_where(awarded).alias("n_aggiudicati"),
            sum_where(awarded).alias("importo_aggiudicati"),
            F.count_distinct("oggetto_principale_contratto").alias("n_settori"),
        )
        .orderBy(F.col("anno").asc_nulls_last())
    )


def overview_cells(tenders: DataFrame) -> DataFrame:
    """What adds up of the key figures, per year, sector and region: a stored mart."""
    pnrr, awarded, amount = F.col("flag_pnrr"), F.col("esito") == AWARDED, F.col(AMOUNT)

    def total(condition):
        return F.coalesce(F.sum(F.when(condition, amount)), F.lit(0.0))

    return _in_cells(tenders).groupBy(*_CELL).agg(
        n_rows().alias("n_lotti"),
        F.sum(amount).alias("importo_totale"),
        n_where(pnrr).alias("n_pnrr"),
        total(pnrr).alias("importo_pnrr"),
        n_where(awarded).alias("n_aggiudicati"),
        total(awarded).alias("importo_aggiudicati"),
    )


def overview_values(tenders: DataFrame) -> DataFrame:
    """The dictionary of the counted values; to be stored before `overview_bitmaps`."""
    return numbered(_in_cells(tenders), _COUNTED)


def overview_bitmaps(tenders: DataFrame, dictionary: DataFrame) -> DataFrame:
    """What does not add up, per year, sector and region, as bitmaps that do."""
    return distinct_bitmaps(_in_cells(tenders), _CELL, _COUNTED, dictionary)


def overview_by(cells: DataFrame, bitmaps: DataFrame, keys: list[str]) -> DataFrame:
    """The key figures of any grouping of the cells; the tenders are not read again."""
    money = ["importo_totale", "importo_pnrr", "importo_aggiudicati"]
    rows = ["n_lotti", "n_pnrr", "n_aggiudicati"]
    sums = cells.groupBy(*keys).agg(
        *[rounded(F.sum(c)).alias(c) for c in money], *[F.sum(c).alias(c) for c in rows]
    )
    counts = distinct_counts(bitmaps, keys, list(_COUNTED.values()))
    return attach(sums, counts, keys).orderBy(*[F.col(k).asc_nulls_last() for k in keys])


# --- execution --------------------------------------------------------------


def execution_funnel(tenders: DataFrame, progress: DataFrame, year: int) -> DataFrame:
    """Published, awarded, in progress and late in one year: one row, amounts in billions.

    Counts are over all lots, amounts leave suspect ones out.
    """
    trusted, awarded = ~F.col("flag_importo_sospetto"), F.col("esito") == AWARDED
    lots = (
        tenders.where((F.col("stato") == "ATTIVO") & (F.col("anno_pubblicazione") == year))
        .agg(
            n_rows().alias("n_bandi"),
            billions(F.sum(F.when(trusted, F.col(AMOUNT))), 1).alias("importo_mld"),
            n_where(awarded).alias("n_aggiudicati"),
            billions(F.sum(F.when(awarded & trusted, F.col(AMOUNT))), 1).alias("importo_agg_mld"),
            n_where(F.coalesce("esito", F.lit("")) == "").alias("n_senza_esito"),
        )
    )
    series = (
        progress.where(F.year("data_emissione_sal") == year)
        .groupBy(S.series_key("id_aggiudicazione", "cig", "").alias("__serie"))
        .agg(
            n_rows().alias("__n"),
            F.sum("importo_quota").alias("__amount"),
            n_where(F.col("flag_ritardo") == LATE).alias("__late"),
        )
    )
    late_amount = F.when(F.col("__late") > 0, F.col("__amount")).otherwise(0.0)
    statements = series.agg(
        F.coalesce(F.sum("__n"), F.lit(0)).alias("n_sal"),
        billions(F.sum("__amount"), 1).alias("importo_sal_mld"),
        F.coalesce(F.sum("__late"), F.lit(0)).alias("n_ritardi"),
        billions(F.sum(late_amount), 1).alias("importo_ritardi_mld"),
    )
    # One row each: the second comes in as a scalar of its columns.
    return lots.withColumn("__s", statements.select(F.struct("*")).scalar()).select(
        *lots.columns, "__s.*"
    )


def late_trend(mart_sal: DataFrame, since: int = 2008) -> DataFrame:
    late = F.when(F.col("flag_ritardo") == LATE, F.col("n_sal")).otherwise(0)
    return (
        mart_sal.where(F.col("anno") >= since)
        .groupBy("anno")
        .agg(F.sum("n_sal").alias("totale"), F.sum(late).alias("in_ritardo"))
        .withColumn("pct_ritardo", pct("in_ritardo", "totale", 1))
        .orderBy("anno")
    )


def late_by_sector(mart_ritardi: DataFrame) -> DataFrame:
    return (
        mart_ritardi.groupBy("settore")
        .agg(
            F.sum("n_ritardi").alias("n_ritardi"),
            F.sum("importo_ritardo_totale").alias("importo"),
        )
        .orderBy(F.col("n_ritardi").desc(), F.col("settore").asc_nulls_last())
    )


def top_late_authorities(mart: DataFrame, measure: str, n: int = 20) -> DataFrame:
    """The n authorities with most late statements (`n_ritardi`) or contracts (`n_in_ritardo`)."""
    return top_n(mart, measure, n, ["sa", "settore", "regione"])


def weighted_mean(value: str, weight: str):
    """Mean over the rows that have both; NULL when the weights sum to 0."""
    both = F.col(value).isNotNull() & F.col(weight).isNotNull()
    num = F.sum(F.when(both, F.col(value) * F.col(weight)))
    return S.ratio(num, F.sum(F.when(both, F.col(weight))))


def execution_kpis(mart_esecuzione: DataFrame) -> DataFrame:
    return mart_esecuzione.agg(
        F.sum("n_contratti").alias("n_contratti"),
        F.sum("n_con_ultimazione").alias("n_con_ultimazione"),
        F.sum("n_in_ritardo").alias("n_in_ritardo"),
        weighted_mean("giorni_medi_scostamento_termine", "n_con_ultimazione").alias(
            "giorni_scostamento"
        ),
        weighted_mean("giorni_medi_aggiudicazione_stipula", "n_con_stipula").alias(
            "giorni_aggiudicazione_stipula"
        ),
    ).withColumn("pct_ritardo", pct("n_in_ritardo", "n_con_ultimazione", 1))


def overdue_trend(mart_esecuzione: DataFrame) -> DataFrame:
    return (
        mart_esecuzione.groupBy("anno")
        .agg(
            F.sum("n_con_ultimazione").alias("n_con_ultimazione"),
            F.sum("n_in_ritardo").alias("n_in_ritardo"),
        )
        .withColumn("pct_ritardo", pct("n_in_ritardo", "n_con_ultimazione", 1))
        .orderBy("anno")
    )


# --- firms ------------------------------------------------------------------

def consortia(bidders: DataFrame, min_members: int = 2, ordered: bool = True) -> DataFrame:
    """Leads of lots with several members: one row per lot and lead, with the number of members.

    The members' names are rows of their own (`consortia_members`): they are listed
    once per lot, whatever their number, and leads and members are never paired up.
    """
    lead = (
        bidders.where(F.col("ruolo") == "MANDATARIA")
        .groupBy("cig", F.col("codice_fiscale").alias("cf_mandataria"))
        .agg(F.max("denominazione").alias("mandataria"))
    )
    rows = attach(lead, _member_counts(bidders, min_members), ["cig"], "inner")
    if not ordered:
        return rows
    return rows.orderBy(F.col("n_mandanti").desc(), "cig", F.col("cf_mandataria").asc_nulls_last())


def _member_counts(bidders: DataFrame, min_members: int) -> DataFrame:
    return (
        bidders.where(F.col("ruolo") == "MANDANTE")
        .groupBy("cig")
        .agg(F.count_distinct("codice_fiscale").alias("n_mandanti"))
        .where(F.col("n_mandanti") >= min_members)
    )


def consortia_members(bidders: DataFrame, min_members: int = 2) -> DataFrame:
    """Names of the members of the lots that `consortia` lists: one row per lot and name."""
    member = bidders.where(F.col("ruolo") == "MANDANTE")
    led = keep_matching(
        _member_counts(bidders, min_members),
        bidders.where(F.col("ruolo") == "MANDATARIA").select("cig"),
        ["cig"],
    )
    return keep_matching(distinct_names(member, "cig", "denominazione"), led, ["cig"])


def distinct_names(df: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name) once each; rows without a key or a name are left out."""
    return df.where(F.col(name).isNotNull() & F.col(key).isNotNull()).select(key, name).distinct()


def names_of(df: DataFrame, key: str, name: str, wanted: list[str], out: str, sep: str = " | ") -> DataFrame:
    """At reading time: the sorted distinct names of the few keys asked for, as one text each."""
    rows = distinct_names(df.where(F.col(key).isin(wanted)), key, name)
    return rows.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(name)), sep).alias(out))


def subcontract_receivers(subcontracts: DataFrame) -> DataFrame:
    """Firms by subcontracts received, with the number of distinct clients."""
    return (
        subcontracts.where(F.col("denominazione") != "")
        .groupBy("denominazione")
        .agg(
            n_rows().alias("n_subappalti"),
            F.count_distinct("cig").alias("n_cig"),
            F.count_distinct("cf_subappaltante").alias("n_imprese_committenti"),
        )
        .orderBy(F.col("n_subappalti").desc(), "denominazione")
    )


def role_distribution(firms: DataFrame) -> DataFrame:
    return (
        firms.groupBy(F.col("ruolo_prevalente").alias("ruolo"))
        .agg(n_rows().alias("n_imprese"))
        .orderBy(F.col("n_imprese").desc(), "ruolo")
    )


def firm_counts(firms: DataFrame) -> DataFrame:
    return firms.agg(
        n_rows().alias("imprese"),
        n_where(F.col("n_aggiudicazioni") > 0).alias("aggiudicatari"),
        n_where(F.col("n_gare_partecipate") > 0).alias("partecipanti"),
        n_where(F.col("n_subappalti") > 0).alias("subappaltanti"),
    )


def top_firms(firms: DataFrame, n: int = 20, role: str | None = None) -> DataFrame:
    """Most active firms, optionally of one prevailing role."""
    chosen = firms if role is None else firms.where(F.col("ruolo_prevalente") == role)
    return top_n(chosen, "totale_attivita", n, ["cf"])


def market_concentration(firms: DataFrame, n: int = 20) -> DataFrame:
    """Share and running share of all awards held by the n largest winners."""
    winners = firms.where(F.col("n_aggiudicazioni") > 0).select(
        "cf", "denominazione", "n_aggiudicazioni"
    )
    return cumulative_share(winners, "n_aggiudicazioni", n, ["cf"])


def procedure_mix(tenders: DataFrame, n: int = 10) -> DataFrame:
    kinds = (
        active_trusted(tenders)
        .groupBy(F.col("tipo_scelta_contraente").alias("tipo"))
        .agg(n_rows().alias("n"), billions(F.sum(AMOUNT), 1).alias("mld"))
    )
    return top_n(kinds, "n", n, ["tipo"])


# --- territory --------------------------------------------------------------

SPECIAL_REGIONS = ["CENTRALE", "NON CLASSIFICATO"]


def with_short_region(
    competition: DataFrame, prefix: str = "SEZIONE REGIONALE", special: bool = False
) -> DataFrame:
    """Region without its prefix; national and unclassified bodies left out unless `special`."""
    short = competition.withColumn("regione_short", S.strip_prefix("regione", prefix))
    return short if special else short.where(~F.col("regione_short").isin(SPECIAL_REGIONS))


def top_regions(competition: DataFrame, year: int, n: int = 10) -> DataFrame:
    return top_n(
        with_short_region(competition).where(F.col("anno") == year),
        "importo_totale",
        n,
        ["regione_short"],
    )


def top_region_trend(competition: DataFrame, n: int = 5) -> DataFrame:
    """All years of the n regions with the largest total."""
    return (
        keep_top_groups(with_short_region(competition), "regione_short", "importo_totale", n)
        .select("anno", "regione_short", "importo_totale")
        .orderBy("regione_short", "anno")
    )


def region_year_matrix(competition: DataFrame, years: list[int]) -> DataFrame:
    return pivot_filled(
        with_short_region(competition), "regione_short", "anno", years, "importo_totale"
    ).orderBy("regione_short")


# --- lookup -----------------------------------------------------------------


def lookup_cigs(tables: dict[str, DataFrame], cigs: list[str] | DataFrame) -> dict[str, DataFrame]:
    """Rows of the given lots, in any letter case, in every table that has a `cig` column."""
    having = {name: df for name, df in tables.items() if "cig" in df.columns}
    stored = F.upper(F.trim("cig"))
    if isinstance(cigs, DataFrame):
        keys = cigs.select(F.upper(F.trim("cig")).alias("__cig")).distinct()
        return {
            name: df.join(keys, stored == F.col("__cig"), "left_semi") for name, df in having.items()
        }
    wanted = [c.strip().upper() for c in cigs]
    return {name: df.where(stored.isin(wanted)) for name, df in having.items()}


def spellings(table: DataFrame) -> DataFrame:
    """lot, cig: the stored spellings of lots that are not the capital one. Few tables have
    any; stored beside the table, they let a lookup ask the files for exact values."""
    lot = F.upper(F.trim("cig"))
    return table.where(F.col("cig") != lot).select(lot.alias("lot"), "cig").distinct()


def lookup_published(
    tables: dict[str, DataFrame], cigs: list[str], spelled: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """`lookup_cigs` by the values as they are stored, so that the filter reaches the scan:
    files and row groups without the lots are passed over, by their bounds and by the Bloom
    filters that tables published with `bloom=["cig"]` carry."""
    wanted = sorted({c.strip().upper() for c in cigs})
    found = {}
    for name, df in tables.items():
        if "cig" not in df.columns:
            continue
        values = list(wanted)
        if spelled and name in spelled:
            others = spelled[name].where(F.col("lot").isin(wanted)).select("cig")
            values += [r["cig"] for r in others.collect()]
        found[name] = df.where(F.col("cig").isin(values))
    return found


def lookup_counts(tables: dict[str, DataFrame], cigs: list[str] | DataFrame) -> DataFrame:
    """In which tables the lots appear, and with how many rows."""
    return counted_rows(lookup_cigs(tables, cigs))


def counted_rows(found: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.groupBy("cig").agg(n_rows().alias("n_righe")).select(F.lit(name).alias("tabella"), "cig", "n_righe")
        for name, df in found.items()
    ]
    return reduce(DataFrame.unionByName, counts)


_LOT_CARD = [
    ("cig", "cig"),
    ("denominazione_amministrazione_appaltante", "sa"),
    ("oggetto_gara", "oggetto_gara"),
    ("importo_lotto", "importo_lotto"),
    ("anno_pubblicazione", "anno"),
]


def _lot_cards(tenders: DataFrame, limit: int) -> DataFrame:
    cards = tenders.select(*[F.col(c).alias(out) for c, out in _LOT_CARD]).distinct()
    return top_n(cards, "importo_lotto", limit, ["cig", "anno", "sa", "oggetto_gara"])


def search_authority(tenders: DataFrame, fragment: str, limit: int = 50) -> DataFrame:
    """Largest lots of the authorities whose name contains the text."""
    name = "denominazione_amministrazione_appaltante"
    return _lot_cards(tenders.where(S.contains_ci(name, fragment.strip())), limit)


def search_authority_indexed(
    spark: SparkSession, tenders: DataFrame, index: str, fragment: str, limit: int = 50
) -> DataFrame:
    """`search_authority` through an index of the authorities' names (`search.write_index`):
    the fragment is looked for in names that have its letters, not in every tender."""
    name = "denominazione_amministrazione_appaltante"
    names = names_with(spark, index, fragment.strip())
    return _lot_cards(rows_named(tenders, name, names), limit)


def search_profiles(profiles: DataFrame, fragment: str) -> DataFrame:
    return profiles.where(S.contains_ci("denominazione_sa", fragment.strip()))


def top_lots(tenders: DataFrame, limit: int = 20) -> DataFrame:
    return _lot_cards(tenders.where(F.col(AMOUNT).isNotNull()), limit)
