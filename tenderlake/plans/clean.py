"""Raw text tables to typed clean tables, one function per dataset.

All rows of a lot that an earlier file published are replaced by the newest file
naming the lot; inside a file the most recent row per declared key survives. The
rules differ by dataset on purpose and are not merged.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import keys as K
from ..operators.joins import attach
from ..operators.slices import summarise_in_order
from . import fields as L

DOMAIN_START = date(2000, 1, 1)
TERM_END = date(2060, 12, 31)
AWARD_DAY = "data_aggiudicazione_definitiva"


def _today(as_of: date | None) -> Column:
    return F.lit(as_of) if as_of else F.current_date()


def _with_source(raw: DataFrame, fields: list[L.Field], *extra: Column) -> DataFrame:
    order = [F.col(K.ORDER)] if K.ORDER in raw.columns else []
    return raw.select(*L.typed(raw, fields), *extra, F.col(K.SOURCE), *order)


def _newest_files(rows: DataFrame) -> DataFrame:
    """Rows of the newest file of each published lot key, without the bookkeeping columns."""
    return K.keep_newest_source(rows, K.PUBLISHED).drop(K.SOURCE, K.PUBLISHED, K.ORDER)


def _with_lot(raw: DataFrame, fields: list[L.Field], *extra: Column) -> DataFrame:
    return _with_source(raw, fields, *extra, L.published(raw, "cig").alias(K.PUBLISHED))


def clean_bandi_gara(raw: DataFrame, years: list[int] | None = None) -> DataFrame:
    """Tenders: one row per lot and publication year, newest communication first.

    The year filter sits on the published text, before anything else is computed.
    """
    year = S.cast_int(L.published(raw, "anno_pubblicazione"))
    wanted = year.isin(years) if years is not None else year.isNotNull()
    rows = raw.where(wanted).select(*L.typed(raw, L.BANDI_GARA))
    suspect = S.suspect_amount("importo_lotto", "importo_complessivo_gara")
    return K.latest_per_key(
        rows,
        ["anno_pubblicazione", "cig"],
        ["data_ultimo_perfezionamento", "data_pubblicazione"],
    ).withColumn("flag_importo_sospetto", suspect)


def clean_aggiudicazioni(
    raw: DataFrame, years: tuple[int, int | None] = (2005, None)
) -> DataFrame:
    """Awards: rows without a plausible award date are dropped before files compete."""
    rows = _with_lot(raw, L.AGGIUDICAZIONI)
    dated = rows.where(S.in_years(AWARD_DAY, years))
    return K.latest_per_key(
        _newest_files(dated),
        ["cig", "id_aggiudicazione"],
        ["data_comunicazione_esito", "data_aggiudicazione_definitiva"],
    )


def dated_awards(raw: DataFrame, years: tuple[int, int | None] = (2005, None)) -> DataFrame:
    """The published rows of awards that compete for their lot."""
    day = next(c for c, f in zip(L.typed(raw, L.AGGIUDICAZIONI), L.AGGIUDICAZIONI) if f.name == AWARD_DAY)
    return raw.withColumn("__day", day).where(S.in_years("__day", years)).drop("__day")


def clean_aggiudicatari(raw: DataFrame) -> DataFrame:
    rows = _newest_files(_with_lot(raw, L.AGGIUDICATARI))
    return K.one_per_key(
        rows.where(F.col("id_aggiudicazione").isNotNull()),
        ["cig", "id_aggiudicazione", "codice_fiscale"],
        [F.col("ruolo").asc_nulls_last(), F.col("denominazione").asc_nulls_last()],
    )


def clean_partecipanti(raw: DataFrame) -> DataFrame:
    rows = _newest_files(_with_lot(raw, L.PARTECIPANTI))
    return K.distinct_records(rows)


def clean_subappalti(raw: DataFrame) -> DataFrame:
    rows = _newest_files(_with_lot(raw, L.SUBAPPALTI))
    return K.latest_per_key(
        rows, ["cig", "id_subappalto", "cod_categoria", "codice_fiscale"], ["data_autorizzazione"]
    )


def clean_avvio_contratto(
    raw: DataFrame, as_of: date | None = None, since: date = DOMAIN_START
) -> DataFrame:
    """Contract starts; implausible days become NULL one by one, the row stays."""
    rows = _newest_files(_with_lot(raw, L.AVVIO_CONTRATTO))
    newest = K.latest_per_key(rows, ["cig", "id_aggiudicazione"], ["data_stipula_contratto"])
    first, today, horizon = F.lit(since), _today(as_of), F.lit(TERM_END)
    signed = F.col("data_stipula_contratto")
    unsigned = signed.isNull()
    term, start = F.col("data_termine_contrattuale"), F.col("data_inizio_effettiva")
    near_signature = S.days_between(signed, start).between(-365, 3650)
    checked = {
        name: S.clamp_date(name, first, today)
        for name in (
            "data_stipula_contratto",
            "data_esecutivita_contratto",
            "data_verbale_consegna_definitiva",
            "data_verbale_prima_consegna",
            "data_appr_prog_ese",
        )
    }
    checked["data_termine_contrattuale"] = F.when(
        unsigned | (term >= signed), S.clamp_date(term, first, horizon)
    )
    checked["data_inizio_effettiva"] = F.when(
        unsigned | near_signature, S.clamp_date(start, first, today)
    )
    return newest.where(F.col("cig").isNotNull()).withColumns(checked)


def clean_fine_contratto(
    raw: DataFrame, as_of: date | None = None, since: date = DOMAIN_START
) -> DataFrame:
    rows = _newest_files(_with_lot(raw, L.FINE_CONTRATTO))
    newest = K.latest_per_key(rows, ["cig", "id_aggiudicazione"], ["data_effettiva_ultimazione"])
    return _clamped(
        newest, ["data_conclusione_anticipata", "data_effettiva_ultimazione"], since, as_of
    )


def clean_sospensioni(
    raw: DataFrame, as_of: date | None = None, since: date = DOMAIN_START
) -> DataFrame:
    """Suspensions. The published day is part of the key, so unreadable days stay apart."""
    day_text = L.published(raw, "data_sospensione").cast("string").alias("__giorno")
    rows = _newest_files(_with_lot(raw, L.SOSPENSIONI, day_text))
    newest = K.latest_per_key(
        rows,
        ["cig", "id_aggiudicazione", "__giorno", "descrizione_motivo"],
        ["data_sospensione", "data_ripresa"],
    ).drop("__giorno")
    return _clamped(newest, ["data_sospensione", "data_ripresa"], since, as_of)


def clean_varianti(
    raw: DataFrame, as_of: date | None = None, since: date = DOMAIN_START
) -> DataFrame:
    """Contract changes; no dedup inside a file."""
    rows = _newest_files(_with_lot(raw, L.VARIANTI))
    return _clamped(rows, ["data_approvazione_variante", "data_atto_aggiuntivo"], since, as_of)


def _clamped(rows: DataFrame, dates: list[str], since: date, as_of: date | None) -> DataFrame:
    first, today = F.lit(since), _today(as_of)
    return rows.where(F.col("cig").isNotNull()).withColumns(
        {d: S.clamp_date(d, first, today) for d in dates}
    )


def clean_collaudo(raw: DataFrame) -> DataFrame:
    rows = _with_lot(raw, L.COLLAUDO).where(F.col("cig").isNotNull())
    return K.latest_per_key(
        _newest_files(rows),
        ["cig", "id_aggiudicazione"],
        ["data_cert_collaudo", "data_delibera"],
    )


def latest_statements(raw: DataFrame) -> DataFrame:
    """Typed work-progress statements, one per number, from the newest file of each lot."""
    rows = _with_lot(raw, L.STATI_AVANZAMENTO).where(F.col("cig").isNotNull())
    return K.latest_per_key(
        _newest_files(rows),
        ["cig", "id_aggiudicazione", "progressivo_sal"],
        ["data_emissione_sal"],
    )


def clean_stati_avanzamento(raw: DataFrame) -> DataFrame:
    """Work-progress statements, classified by series, with the series total on one row."""
    return classify_series(latest_statements(raw))


def classify_series(rows: DataFrame) -> DataFrame:
    """Class and amount share of cumulative payment series.

    Amounts are running totals, so a series is worth its maximum: that goes to the
    first row reaching it, every other row gets 0. Copies (same day, same amount)
    count once. A series is `singola` with one statement, `monotona` when the
    amount never falls, else `anomala`.

    A series may be huge. Its statements are reduced to distinct points, the points
    are summarised in slices, and only one row per series is joined back. `rows` is
    read twice, so pass a stored table where computing it is dear.
    """
    keyed = rows.withColumn("__serie", S.series_key("id_aggiudicazione", "cig"))
    day, amount = F.col("data_emissione_sal"), F.col("importo_sal")
    number, lot = F.col("progressivo_sal"), F.col("cig")
    # Of the copies of a point the lowest number counts, NULL last; unique in its series.
    rank = F.struct(number.isNull().alias("u"), number.alias("n"), lot.alias("cig"))
    points = keyed.groupBy("__serie", "data_emissione_sal", "importo_sal").agg(
        F.min(rank).alias("__head")
    )
    in_order = [
        day.asc_nulls_last(), F.col("__head.n").asc_nulls_last(), amount.asc_nulls_last()
    ]
    summary = summarise_in_order(
        points,
        ["__serie"],
        in_order,
        "importo_sal",
        F.struct(day.alias("day"), F.col("__head.n").alias("n"), F.col("__head.cig").alias("cig")),
    )
    series = summary.select(
        "__serie",
        F.col("top").alias("__max"),
        F.col("top_row").alias("__peak"),
        F.when(F.col("n") == 1, "singola")
        .when(~F.col("falls"), "monotona")
        .otherwise("anomala")
        .alias("tipo_serie"),
    )
    at_peak = (
        (amount == F.col("__max"))
        & day.eqNullSafe(F.col("__peak.day"))
        & number.eqNullSafe(F.col("__peak.n"))
        & (lot == F.col("__peak.cig"))
    )
    return (
        attach(keyed, series, ["__serie"])
        .withColumn("importo_quota", F.when(at_peak, F.col("__max")).otherwise(F.lit(0.0)))
        .drop("__serie", "__max", "__peak")
    )


def clean_cup(raw: DataFrame) -> DataFrame:
    rows = raw.select(*L.typed(raw, L.CUP))
    return rows.where(F.col("cig").isNotNull() & F.col("cup").isNotNull())


def clean_stazioni_appaltanti(raw: DataFrame) -> DataFrame:
    rows = raw.select(*L.typed(raw, L.STAZIONI_APPALTANTI))
    return rows.where(F.col("codice_fiscale").isNotNull()).withColumn(
        "partita_iva", S.null_if("partita_iva", S.VAT_SENTINEL)
    )


def clean_quadro_economico(raw: DataFrame) -> DataFrame:
    """Cost-breakdown events: the newest file wins per event, not per lot.

    Events are told apart by what was published, before anything is cast: two ids
    that cannot be read stay two events.
    """
    known = raw.where(S.not_blank("cig") & F.col("id_aggiudicazione").isNotNull())
    key = ["cig", "id_aggiudicazione", "descrizione_evento", "dettaglio_evento"]
    text = [L.published(known, c).alias(f"__{c}") for c in key]
    rows = _with_source(known, L.QUADRO_ECONOMICO, *text)
    return K.newest_source_per_key(rows, [f"__{c}" for c in key]).drop(
        K.SOURCE, K.ORDER, *[f"__{c}" for c in key]
    )


# Label of the prevailing source, by priority among equal amounts.
PREVALENTE = {
    "fondi_bilancio_sa": "bilancio stazione appaltante",
    "fondi_bilancio_amministrazione": "bilancio amministrazione competente",
    "entrate_vincolate_ue": "fondi UE",
    "entrate_vincolate_statali": "entrate vincolate statali",
    "mutuo": "mutuo",
    "capitali_privati": "capitali privati",
}


def clean_fonti_finanziamento(raw: DataFrame, ceiling: float = 1e9) -> DataFrame:
    """Funding sources with total, number of sources and the prevailing one."""
    record = [f.source for f in L.FONTI_FINANZIAMENTO[2:]]
    text = raw.select(
        "cig", "id_aggiudicazione", *[L.published(raw, c).alias(c) for c in record], K.SOURCE
    )
    unique = K.split_dedup(text, ["cig", "id_aggiudicazione"], "id_aggiudicazione", record)
    amounts = unique.select(*L.typed(unique, L.FONTI_FINANZIAMENTO))
    return (
        amounts.withColumn("totale_fonti", S.sum_or_zero(*L.FONTI))
        .withColumn("n_fonti", S.count_positive(*L.FONTI))
        .withColumn(
            "fonte_prevalente", S.label_of_max(PREVALENTE, S.row_max(*L.FONTI), "altre fonti")
        )
        .withColumn("flag_fonti_sospette", F.col("totale_fonti") >= ceiling)
    )


CLEAN = {
    "bandi_gara": clean_bandi_gara,
    "aggiudicazioni": clean_aggiudicazioni,
    "aggiudicatari": clean_aggiudicatari,
    "partecipanti": clean_partecipanti,
    "subappalti": clean_subappalti,
    "avvio_contratto": clean_avvio_contratto,
    "fine_contratto": clean_fine_contratto,
    "sospensioni": clean_sospensioni,
    "varianti": clean_varianti,
    "collaudo": clean_collaudo,
    "stati_avanzamento": clean_stati_avanzamento,
    "cup": clean_cup,
    "stazioni_appaltanti": clean_stazioni_appaltanti,
    "quadro_economico": clean_quadro_economico,
    "fonti_finanziamento": clean_fonti_finanziamento,
}


def _all_rows(raw: DataFrame) -> DataFrame:
    return raw


# Feeds whose rules all work within one lot, so that a bucket of lots can be cleaned by itself,
# and the published rows that compete for a lot.
COMPETING = {
    "aggiudicazioni": dated_awards,
    "aggiudicatari": _all_rows,
    "partecipanti": _all_rows,
    "subappalti": _all_rows,
    "avvio_contratto": _all_rows,
    "fine_contratto": _all_rows,
    "sospensioni": _all_rows,
    "varianti": _all_rows,
    "collaudo": _all_rows,
}
