"""Marts that join several clean tables.

Each side is reduced to one row per lot (or award) before it is joined, so no
join multiplies rows and a lot with very many rows is combined map-side.
`per_cig` is the output of `tenders_per_cig`; pass the stored table to several
marts, or the tenders table is reduced again for each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.scalars import billions, pct, rounded
from ..operators.joins import attach
from ..operators.keys import one_per_key
from ..operators.reshape import conditional_sums, report_order
from .tenders import AMOUNT, AWARDED, active_trusted, n_rows, n_where, sum_where

LATE = "IN RITARDO"


def mart_panoramica(tenders: DataFrame) -> DataFrame:
    pnrr, awarded = F.col("flag_pnrr"), F.col("esito") == AWARDED
    lots = active_trusted(tenders).where(
        F.col("oggetto_principale_contratto").isNotNull() & F.col("sezione_regionale").isNotNull()
    )
    cells = lots.groupBy(
        F.col("anno_pubblicazione").alias("anno"),
        F.col("oggetto_principale_contratto").alias("settore"),
        F.col("sezione_regionale").alias("regione"),
    ).agg(
        n_rows().alias("n_lotti"),
        F.count_distinct("cig").alias("n_cig"),
        F.count_distinct("cf_amministrazione_appaltante").alias("n_stazioni_appaltanti"),
        F.sum(AMOUNT).alias("__sum"),
        rounded(F.avg(AMOUNT)).alias("importo_lotto_medio"),
        n_where(pnrr).alias("n_pnrr"),
        F.sum(F.when(pnrr, F.col(AMOUNT)).otherwise(0.0)).alias("__pnrr"),
        n_where(awarded).alias("n_aggiudicati"),
        sum_where(awarded).alias("importo_aggiudicati"),
    )
    return (
        cells.withColumn("importo_lotto_totale", rounded("__sum"))
        .withColumn("importo_pnrr", rounded("__pnrr"))
        .withColumn("tasso_aggiudicazione_pct", pct("n_aggiudicati", "n_lotti", 1))
        .withColumn("quota_pnrr_pct", pct("__pnrr", "__sum", 1))
        .drop("__sum", "__pnrr")
        .orderBy(
            F.col("anno").desc_nulls_last(),
            F.col("importo_lotto_totale").desc_nulls_last(),
            "settore",
            "regione",
        )
    )


# Role texts that were published in the firm-name column; fixed values.
ROLE_NAMES = [
    "OPERATORE ECONOMICO MONOSOGGETTIVO",
    "MONOSOGGETTIVO",
    "Operatore Economico monosoggettivo",
    "MANDATARIA",
    "MANDANTE",
    "01-MANDANTE",
    "02-MANDATARIA",
    "04-CAPOGRUPPO",
    "IMPRESA AUSILIARIA",
    "AUSILIARIA",
    "Impresa Ausiliaria",
    "CONSORZIO STABILE",
    "CONSORZIO ORDINARIO",
    "Consorzio stabile",
    "Consorzio ordinario",
    "05-CONSORZIATA",
    "03-ASSOCIATA",
    "OPERATORE ECONOMICO",
    "IMPRESA COOPTATA",
    "SUBAPPALTATORE QUALIFICANTE IN OFFERTA",
    "MANDANTE IN RTI",
    "MANDATARIO IN RTI",
]


def _named_firms(df: DataFrame) -> DataFrame:
    """Rows with a tax code and a real name; a missing name is no name."""
    return df.where(
        S.not_blank("codice_fiscale") & ~F.col("denominazione").isin(ROLE_NAMES)
    ).withColumn("cf", F.trim("codice_fiscale"))


def mart_imprese(
    winners: DataFrame, bidders: DataFrame, subcontracts: DataFrame, ordered: bool = True
) -> DataFrame:
    """Firm profile over its wins, bids and subcontracts.

    Every count of distinct lots or awards is a count of distinct (firm, count,
    value) rows, so one distinct serves them all, spread by value: a firm with very
    many lots is no hot key. Names are reduced the same way before the maximum.
    """
    won, sub = _named_firms(winners), _named_firms(subcontracts)
    bid = _named_firms(bidders).where(~F.col("tipo_soggetto").ilike("%STAZIONE APPALTANTE%"))
    counted = [
        (won, "n_aggiudicazioni", "cig"),
        (won, "n_lotti_vinti", "id_aggiudicazione"),
        (bid, "n_gare_partecipate", "cig"),
        (sub, "n_subappalti", "cig"),
    ]
    values = reduce(
        DataFrame.union,
        [
            rows.select("cf", F.lit(out).alias("__count"), F.col(value).cast("string").alias("__value"))
            for rows, out, value in counted
        ],
    ).distinct()
    counts = [out for _, out, _ in counted]
    tallies = values.groupBy("cf").agg(
        *[
            F.count_if((F.col("__count") == out) & F.col("__value").isNotNull()).alias(out)
            for out in counts
        ]
    )
    labels = (
        won.select("cf", "denominazione", "tipo_soggetto")
        .union(bid.select("cf", "denominazione", "tipo_soggetto"))
        .union(sub.select("cf", "denominazione", F.lit(None).cast("string")))
        .distinct()
        .groupBy("cf")
        .agg(
            F.max("denominazione").alias("denominazione"),
            F.max("tipo_soggetto").alias("tipo_soggetto"),
        )
    )
    firms = labels.join(tallies, "cf")
    role = (
        F.when(F.col("n_aggiudicazioni") > 0, "aggiudicatario")
        .when(F.col("n_subappalti") > 0, "subappaltante")
        .when(F.col("n_gare_partecipate") > 0, "partecipante")
        .otherwise("sconosciuto")
    )
    activity = S.row_max("n_aggiudicazioni", "n_gare_partecipate", "n_subappalti")
    profiles = firms.withColumn("ruolo_prevalente", role).withColumn("totale_attivita", activity)
    return report_order(profiles, ordered, F.col("totale_attivita").desc(), "cf")


def mart_ritardi_per_sa(progress: DataFrame, per_cig: DataFrame, min_late: int = 3) -> DataFrame:
    """Late progress statements per authority, sector and region.

    Series, then lots, then authorities: each step is a combinable aggregate over
    the one before, and the tenders join sees one row per lot.
    """
    late = F.col("flag_ritardo") == LATE
    days = F.when(late, F.col("n_giorni_scostamento"))
    series = progress.groupBy(
        "cig", S.series_key("id_aggiudicazione", "cig", "").alias("__serie")
    ).agg(
        F.sum("importo_quota").alias("__amount"),
        n_where(late).alias("__late"),
        F.max(days).alias("__max"),
        F.sum(days).alias("__days"),
        F.count(days).alias("__n"),
    )
    lots = (
        series.where(F.col("__late") > 0)
        .groupBy("cig")
        .agg(
            F.sum("__amount").alias("__amount"),
            F.sum("__late").alias("__late"),
            F.max("__max").alias("__max"),
            F.sum("__days").alias("__days"),
            F.sum("__n").alias("__n"),
        )
    )
    named = per_cig.where(F.col("cf_sa").isNotNull() & (F.col("cf_sa") != "") & (F.col("sa") != ""))
    return (
        lots.join(named, "cig")
        .groupBy("sa", "settore", "regione")
        .agg(
            F.sum("__late").alias("n_ritardi"),
            n_rows().alias("n_cig_ritardo"),
            F.max("__max").alias("max_gg_ritardo"),
            rounded(S.ratio(F.sum("__days"), F.sum("__n"))).alias("media_gg_ritardo"),
            rounded(F.coalesce(F.sum("__amount"), F.lit(0.0))).alias("importo_ritardo_totale"),
        )
        .where(F.col("n_ritardi") >= min_late)
        .orderBy(
            F.col("n_ritardi").desc(),
            "sa",
            F.col("settore").asc_nulls_last(),
            F.col("regione").asc_nulls_last(),
        )
    )


def mart_competitivita(
    tenders: DataFrame, awards: DataFrame, fan_out: bool = False, ceiling: float = 1e11
) -> DataFrame:
    """Competition per year and region.

    Awards are reduced to one row per lot. By default a lot counts once. With
    `fan_out` it counts once per award, as a plain join of the two tables would
    give; the weights come from the award count, no row is multiplied.
    """
    amount = F.col("importo_aggiudicazione")
    per_lot = (
        awards.where((amount > 0) & (amount < ceiling))
        .groupBy("cig")
        .agg(
            n_rows().alias("__awards"),
            F.sum("num_imprese_offerenti").alias("__bidders"),
            F.count("num_imprese_offerenti").alias("__n_bidders"),
            F.sum("ribasso_aggiudicazione").alias("__discount"),
            F.count("ribasso_aggiudicazione").alias("__n_discount"),
        )
    )
    lots = active_trusted(tenders).where(F.col("sezione_regionale") != "")
    joined = attach(lots, per_lot, ["cig"])
    times = F.coalesce("__awards", F.lit(1)) if fan_out else F.lit(1)
    won = F.col("esito") == AWARDED
    weighted = F.col(AMOUNT) * times
    cells = joined.groupBy(
        F.col("anno_pubblicazione").alias("anno"), F.col("sezione_regionale").alias("regione")
    ).agg(
        F.sum(times).cast("bigint").alias("n_bandi"),
        F.count_distinct("cig").alias("n_cig"),
        rounded(F.sum(weighted)).alias("importo_totale"),
        F.sum(F.when(won, times).otherwise(0)).cast("bigint").alias("n_aggiudicati"),
        rounded(F.sum(F.when(won, weighted).otherwise(0.0))).alias("importo_aggiudicati"),
        rounded(S.ratio(F.sum("__bidders"), F.sum("__n_bidders")), 1).alias("offerenti_medi"),
        rounded(S.ratio(F.sum("__discount"), F.sum("__n_discount")), 2).alias("ribasso_medio"),
    )
    return cells.withColumn(
        "tasso_aggiudicazione_pct", pct("n_aggiudicati", "n_bandi", 1)
    ).orderBy(
        F.col("anno").desc_nulls_last(), F.col("importo_totale").desc_nulls_last(), "regione"
    )


def latest_start_per_cig(starts: DataFrame) -> DataFrame:
    """The most recently signed contract of each lot."""
    columns = starts.select(
        "cig",
        "data_stipula_contratto",
        "id_aggiudicazione",
        "data_inizio_effettiva",
        "data_termine_contrattuale",
    )
    order = [
        F.col("data_stipula_contratto").desc_nulls_last(),
        F.col("id_aggiudicazione").desc_nulls_last(),
    ]
    return one_per_key(columns, ["cig"], order).drop("id_aggiudicazione")


def last_end_per_cig(ends: DataFrame) -> DataFrame:
    return ends.groupBy("cig").agg(F.max("data_effettiva_ultimazione").alias("ultimazione"))


def _term_deviation() -> Column:
    return S.guarded_days("data_termine_contrattuale", "ultimazione", -3650, 3650)


def mart_esecuzione(
    per_cig: DataFrame,
    awards: DataFrame,
    starts: DataFrame,
    ends: DataFrame,
    suspensions: DataFrame,
    changes: DataFrame,
    min_contracts: int = 3,
) -> DataFrame:
    """Real execution times per year, region and sector.

    A contract is a lot with a signature or a completion day. Every input is
    one row per lot on the same partitioning, so the joins add no exchange.
    """
    lots = {
        "per_cig": per_cig,
        "awarded": last_award_per_cig(awards),
        "signed": latest_start_per_cig(starts),
        "ended": last_end_per_cig(ends),
        "paused": pauses_per_cig(suspensions),
        "changed": changes_per_cig(changes),
    }
    return execution_of_lots(lots, min_contracts)


def last_award_per_cig(awards: DataFrame) -> DataFrame:
    paid = awards.where(F.col("importo_aggiudicazione") > 0)
    return paid.groupBy("cig").agg(F.max("data_aggiudicazione_definitiva").alias("ultima_agg"))


def pauses_per_cig(suspensions: DataFrame) -> DataFrame:
    pause = S.days_between("data_sospensione", "data_ripresa")
    days = F.sum(F.when(pause.between(0, 3650), pause).otherwise(0))
    dated = suspensions.where(F.col("data_sospensione").isNotNull())
    return dated.groupBy("cig").agg(days.alias("giorni_sospensione"))


def changes_per_cig(changes: DataFrame) -> DataFrame:
    return changes.groupBy("cig").agg(n_rows().alias("n_varianti"))


def acceptance_per_cig(tests: DataFrame) -> DataFrame:
    return tests.groupBy("cig").agg(
        F.max("data_cert_collaudo").alias("certificato"), F.lit(True).alias("ha_record")
    )


def lots_of(
    per_cig: DataFrame,
    awards: DataFrame,
    starts: DataFrame,
    ends: DataFrame,
    suspensions: DataFrame,
    changes: DataFrame,
    tests: DataFrame,
) -> dict[str, DataFrame]:
    """What the marts on times join, one row per lot each. Stored in buckets of the lot
    (`layers.write_bucketed`), they are joined in every mart without an exchange."""
    return {
        "per_cig": per_cig,
        "awarded": last_award_per_cig(awards),
        "signed": latest_start_per_cig(starts),
        "ended": last_end_per_cig(ends),
        "paused": pauses_per_cig(suspensions),
        "changed": changes_per_cig(changes),
        "accepted": acceptance_per_cig(tests),
    }


def execution_of_lots(lots: dict[str, DataFrame], min_contracts: int = 3) -> DataFrame:
    """`mart_esecuzione` from tables of one row per lot."""
    signed, done = F.col("data_stipula_contratto"), F.col("ultimazione")
    # From the lots outwards: the key of a full join would be a new column, on which rows
    # would have to be exchanged again.
    contracts = (
        lots["per_cig"]
        .where(F.col("anno").isNotNull())
        .join(lots["signed"], "cig", "left")
        .join(lots["ended"], "cig", "left")
        .where(signed.isNotNull() | done.isNotNull())
        .join(lots["awarded"], "cig", "left")
        .join(lots["paused"], "cig", "left")
        .join(lots["changed"], "cig", "left")
    )
    late = F.col("giorni_scostamento_termine") > 0
    phases = contracts.select(
        "anno",
        "regione",
        "settore",
        signed,
        "data_inizio_effettiva",
        done,
        S.guarded_days("ultima_agg", signed, 0, 3650).alias("giorni_aggiudicazione_stipula"),
        S.guarded_days(signed, "data_inizio_effettiva", -365, 3650).alias("giorni_stipula_inizio"),
        _term_deviation().alias("giorni_scostamento_termine"),
        F.coalesce("giorni_sospensione", F.lit(0)).alias("giorni_sospensione"),
        F.coalesce("n_varianti", F.lit(0)).alias("n_varianti"),
    )
    cells = (
        phases.groupBy("anno", "regione", "settore")
        .agg(
            n_rows().alias("n_contratti"),
            F.count(signed).alias("n_con_stipula"),
            F.count("data_inizio_effettiva").alias("n_con_inizio"),
            F.count(done).alias("n_con_ultimazione"),
            rounded(F.avg("giorni_aggiudicazione_stipula")).alias(
                "giorni_medi_aggiudicazione_stipula"
            ),
            rounded(F.avg("giorni_stipula_inizio")).alias("giorni_medi_stipula_inizio"),
            rounded(F.avg("giorni_scostamento_termine")).alias("giorni_medi_scostamento_termine"),
            n_where(late).alias("n_in_ritardo"),
            F.count("giorni_scostamento_termine").alias("__measured"),
            rounded(F.avg("giorni_sospensione")).alias("giorni_medi_sospensione"),
            rounded(F.avg("n_varianti"), 2).alias("varianti_medie"),
        )
        .where(F.col("n_contratti") >= min_contracts)
    )
    return (
        cells.withColumn("quota_in_ritardo_pct", pct("n_in_ritardo", "__measured", 1))
        .drop("__measured")
        .orderBy(
            F.col("anno").desc(),
            F.col("n_contratti").desc(),
            F.col("regione").asc_nulls_last(),
            F.col("settore").asc_nulls_last(),
        )
    )


def mart_ritardi_contratto(
    per_cig: DataFrame, starts: DataFrame, ends: DataFrame, min_contracts: int = 3
) -> DataFrame:
    """Deviation from the contractual term per authority, region and sector.

    The day difference lies in [-3650, 3650], so the exact median keeps at most
    7,301 counters per group however many contracts there are.
    """
    lots = {
        "per_cig": per_cig,
        "signed": latest_start_per_cig(starts),
        "ended": last_end_per_cig(ends),
    }
    return deviations_of_lots(lots, min_contracts)


def deviations_of_lots(lots: dict[str, DataFrame], min_contracts: int = 3) -> DataFrame:
    """`mart_ritardi_contratto` from tables of one row per lot."""
    gap = F.col("giorni")
    late = gap > 0
    measured = (
        lots["signed"]
        .join(lots["ended"], "cig")
        .select("cig", _term_deviation().alias("giorni"))
        .where(gap.isNotNull())
    )
    authorities = lots["per_cig"].where(F.col("cf_sa").isNotNull() & F.col("sa").isNotNull())
    return (
        measured.join(authorities, "cig")
        .groupBy("cf_sa", "sa", "regione", "settore")
        .agg(
            n_rows().alias("n_contratti"),
            n_where(late).alias("n_in_ritardo"),
            rounded(F.avg(gap)).alias("giorni_medi_scostamento"),
            rounded(F.median(gap)).alias("giorni_mediani_scostamento"),
            F.max(gap).alias("giorni_max_scostamento"),
            rounded(F.sum(AMOUNT)).alias("importo_lotto_totale"),
            sum_where(late).alias("importo_in_ritardo"),
        )
        .where(F.col("n_contratti") >= min_contracts)
        .withColumn("quota_in_ritardo_pct", pct("n_in_ritardo", "n_contratti", 1))
        .orderBy(
            F.col("n_in_ritardo").desc(),
            "cf_sa",
            F.col("regione").asc_nulls_last(),
            F.col("settore").asc_nulls_last(),
        )
    )


def mart_collaudo_ritardo(
    per_cig: DataFrame, ends: DataFrame, tests: DataFrame, min_works: int = 3
) -> DataFrame:
    """From completion to acceptance, keeping three states apart.

    No record, a record without a certificate day, a dated certificate. The
    measured days lie in [0, 3650], which bounds the exact median.
    """
    lots = {
        "per_cig": per_cig,
        "ended": last_end_per_cig(ends),
        "accepted": acceptance_per_cig(tests),
    }
    return acceptance_of_lots(lots, min_works)


def acceptance_of_lots(lots: dict[str, DataFrame], min_works: int = 3) -> DataFrame:
    """`mart_collaudo_ritardo` from tables of one row per lot."""
    recorded, certified = S.present("ha_record"), S.present("certificato")
    days = S.guarded_days("ultimazione", "certificato", 0, 3650)
    return (
        lots["ended"]
        .where(F.col("ultimazione").isNotNull())
        .join(lots["per_cig"], "cig")
        .join(lots["accepted"], "cig", "left")
        .groupBy("anno", "regione", "settore")
        .agg(
            n_rows().alias("n_opere_ultimate"),
            n_where(recorded).alias("n_con_record"),
            n_where(~recorded).alias("n_senza_record"),
            n_where(recorded & ~certified).alias("n_record_senza_data"),
            n_where(certified).alias("n_con_data"),
            rounded(F.median(days)).alias("giorni_mediani_ultimazione_collaudo"),
            rounded(F.avg(days)).alias("giorni_medi_ultimazione_collaudo"),
        )
        .where(F.col("n_opere_ultimate") >= min_works)
        .withColumn("quota_senza_record_pct", pct("n_senza_record", "n_opere_ultimate", 1))
        .withColumn(
            "quota_senza_data_certificato_pct",
            pct(F.col("n_opere_ultimate") - F.col("n_con_data"), "n_opere_ultimate", 1),
        )
        .orderBy(
            F.col("n_senza_record").desc(),
            F.col("anno").desc_nulls_last(),
            F.col("regione").asc_nulls_last(),
            F.col("settore").asc_nulls_last(),
        )
    )


def mart_sforamento(
    per_cig: DataFrame,
    breakdown: DataFrame,
    awards: DataFrame,
    changes: DataFrame,
    ordered: bool = True,
) -> DataFrame:
    """Cost growth per award, gross and net of the discount.

    An unknown discount stays unknown. Implausible rows stay too, with the reason.
    """
    closed = breakdown.where(F.col("ha_consuntivo") & (F.col("importo_base") > 0)).select(
        "cig", "id_aggiudicazione", "importo_base", "importo_finale", "flag_base_sospetta"
    )
    valid = F.col("ribasso_aggiudicazione").between(0, 99)
    awarded = awards.groupBy("cig", "id_aggiudicazione").agg(
        F.sum("importo_aggiudicazione").alias("importo_aggiudicato"),
        F.max(F.when(valid, F.col("ribasso_aggiudicazione"))).alias("__ribasso"),
    )
    # From the aggregate above, not from the awards: they are read and exchanged once.
    discount = awarded.groupBy("cig").agg(F.max("__ribasso").alias("ribasso_pct"))
    # Reasons are coded values, so the distinct list of a lot stays short.
    reasons = (
        changes.groupBy("cig", "motivo_variante")
        .agg(n_rows().alias("__n"))
        .groupBy("cig")
        .agg(
            F.sum("__n").alias("n_varianti"),
            F.array_sort(F.collect_list("motivo_variante")).alias("__reasons"),
        )
        .select(
            "cig",
            "n_varianti",
            F.when(F.size("__reasons") > 0, F.array_join("__reasons", " | ")).alias("motivi"),
        )
    )
    # The lot facts meet first, one row per lot on each side; awards join them once.
    lot_facts = (
        per_cig.drop(AMOUNT, "cf_sa").join(discount, "cig", "full").join(reasons, "cig", "full")
    )
    rows = attach(
        closed.join(awarded, ["cig", "id_aggiudicazione"], "left").drop("__ribasso"),
        lot_facts,
        ["cig"],
    )
    base, final, won = F.col("importo_base"), F.col("importo_finale"), F.col("importo_aggiudicato")
    net = base * (1 - F.col("ribasso_pct") / 100.0)
    reason = S.first_reason(
        [
            (F.col("flag_base_sospetta"), "base oltre 10 mld"),
            (F.col("regione").isNull() | F.col("settore").isNull(), "senza metadati bandi"),
            (final < base * 0.5, "consuntivo sotto 0,5x la base"),
            (final > base * 2, "consuntivo oltre 2x la base"),
            (won > base * 2, "aggiudicazione oltre 2x la base"),
        ]
    )
    growth = rows.select(
        "cig",
        "id_aggiudicazione",
        "anno",
        "regione",
        "settore",
        "sa",
        rounded(base, 2).alias("importo_base"),
        rounded(final, 2).alias("importo_consuntivo"),
        rounded(final - base, 2).alias("sforamento"),
        pct(final - base, base, 2).alias("sforamento_pct"),
        rounded(net, 2).alias("base_scontata"),
        rounded(final - net, 2).alias("sforamento_scontato"),
        pct(final - net, net, 2).alias("sforamento_scontato_pct"),
        rounded(won, 2).alias("importo_aggiudicato"),
        "ribasso_pct",
        F.coalesce("n_varianti", F.lit(0)).alias("n_varianti"),
        "motivi",
        reason.isNull().alias("plausibile"),
        reason.alias("motivo_esclusione"),
        S.near_multiple(final, base, 2.0, 0.005).alias("doppio_esatto"),
    )
    return report_order(
        growth, ordered, F.col("sforamento").desc_nulls_last(), "cig", "id_aggiudicazione"
    )


# The 13 published sources in seven readable groups; fixed values.
MACRO_FONTI = {
    "fin_bilancio_sa": ["fondi_bilancio_sa"],
    "fin_bilancio_amministrazione": ["fondi_bilancio_amministrazione"],
    "fin_ue": ["entrate_vincolate_ue"],
    "fin_altro_pubblico": [
        "entrate_vincolate_statali",
        "entrate_vincolate_regionali",
        "entrate_vincolate_locali",
        "entrate_vincolate_altri",
    ],
    "fin_mutuo": ["mutuo"],
    "fin_privati": ["capitali_privati", "entrate_vincolate_privati", "sfruttamento_economico"],
    "fin_altro": ["altro", "trasferimento_immobili"],
}


def mart_chi_paga(
    per_cig: DataFrame,
    breakdown: DataFrame,
    funding: DataFrame,
    authorities: DataFrame,
    min_contracts: int = 10,
) -> DataFrame:
    """Who buys and who pays, per year, region, sector and legal nature.

    Contracts and their funding are summed per lot before the tenders join, and per
    authority before the registry join: the legal nature depends on the authority only.
    """
    total = "importo_finanziato"
    funded = funding.groupBy("cig", "id_aggiudicazione").agg(
        F.sum("importo").alias(total), *conditional_sums("fonte", "importo", MACRO_FONTI)
    )
    trusted = ~F.col("flag_base_sospetta")
    measures = ["importo_base", total, *MACRO_FONTI]
    lots = (
        breakdown.where(F.col("importo_base") > 0)
        .join(funded, ["cig", "id_aggiudicazione"], "left")
        .groupBy("cig")
        .agg(
            n_rows().alias("__contracts"),
            n_where(~trusted).alias("__excluded"),
            F.count(total).alias("__funded"),
            *[F.sum(F.when(trusted, F.col(m))).alias(m) for m in measures],
        )
    )
    registry = authorities.select(F.col("codice_fiscale").alias("cf_sa"), "natura_giuridica")
    counts = ["__contracts", "__excluded", "__funded"]
    cell = ["anno", "regione", "settore"]
    buyers = (
        lots.join(per_cig.drop(AMOUNT, "sa"), "cig")
        .groupBy(*cell, "cf_sa")
        .agg(*[F.sum(m).alias(m) for m in [*counts, *measures]])
    )
    cells = (
        buyers.join(registry, "cf_sa", "left")
        .groupBy(
            *cell, F.coalesce("natura_giuridica", F.lit("NON IN ANAGRAFICA")).alias("natura_sa")
        )
        .agg(
            F.sum("__contracts").alias("n_contratti"),
            F.sum("__excluded").alias("n_esclusi_importo_sospetto"),
            F.sum("__funded").alias("n_con_fonte"),
            *[F.sum(m).alias(f"__{m}") for m in measures],
        )
        .where(F.col("n_contratti") >= min_contracts)
    )
    return cells.select(
        "anno",
        "regione",
        "settore",
        "natura_sa",
        "n_contratti",
        "n_esclusi_importo_sospetto",
        "n_con_fonte",
        pct("n_con_fonte", "n_contratti", 1).alias("quota_con_fonte_pct"),
        billions("__importo_base", 3).alias("importo_contrattuale_mld"),
        billions(f"__{total}", 3).alias("importo_finanziato_mld"),
        rounded(S.ratio(f"__{total}", "__importo_base"), 2).alias("rapporto_finanziato_contratto"),
        *[billions(f"__{m}", 3).alias(f"{m}_mld") for m in MACRO_FONTI],
    ).orderBy(
        F.col("importo_contrattuale_mld").desc_nulls_last(),
        F.col("anno").desc_nulls_last(),
        F.col("regione").asc_nulls_last(),
        F.col("settore").asc_nulls_last(),
        "natura_sa",
    )
