"""Column functions, key rules, joins, windows and reshaping one by one."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlake.functions import scalars as S
from tenderlake.operators import keys as K
from tenderlake.operators import reshape as R
from tenderlake.operators.joins import attach, not_in
from tenderlake.operators.radix import group_median
from tenderlake.operators.slices import falling_steps
from tenderlake.plans import cross, deltas, tenders
from tenderlake.plans import questions as Q
from tenderlake.plans.clean import PREVALENTE
from tenderlake.session import scratch_path

from .registry import query

# --- column functions -------------------------------------------------------


@query(
    "text_to_numbers",
    """
    SELECT trim(cig) AS cig, try_cast(id_aggiudicazione AS BIGINT) AS lungo,
           try_cast(num_imprese_offerenti AS INT) AS intero,
           try_cast(importo_aggiudicazione AS DOUBLE) AS decimale, count(*) AS n
    FROM {raw_aggiudicazioni} GROUP BY ALL""",
)
def text_to_numbers(t):
    return t.raw_aggiudicazioni.groupBy(
        S.normalize_string("cig").alias("cig"),
        S.cast_bigint("id_aggiudicazione").alias("lungo"),
        S.cast_int("num_imprese_offerenti").alias("intero"),
        S.cast_double("importo_aggiudicazione").alias("decimale"),
    ).agg(F.count(F.lit(1)).alias("n"))


_D = "try_cast(data_aggiudicazione_definitiva AS DATE)"
_OK = f"CASE WHEN year({_D}) BETWEEN 1800 AND 2100 THEN {_D} END"
_COM = "try_cast(data_comunicazione_esito AS DATE)"


@query(
    "text_to_dates",
    f"""
    WITH x AS (SELECT {_OK} AS d, {_COM} AS c, data_aggiudicazione_definitiva AS testo
               FROM {{raw_aggiudicazioni}})
    SELECT testo, CAST(d AS VARCHAR) AS giorno, CAST(c AS VARCHAR) AS comunicazione,
           CAST(year(d) AS INT) AS anno, CAST(month(d) AS INT) AS mese,
           CAST(CASE WHEN year(d) >= 1999 THEN d END AS VARCHAR) AS dominio,
           CAST(CASE WHEN d BETWEEN DATE '1997-01-01' AND DATE '1999-06-30' THEN d END AS VARCHAR)
               AS finestra,
           CAST(nullif(d, DATE '1998-01-01') AS VARCHAR) AS senza_sentinella, count(*) AS n
    FROM x GROUP BY ALL""",
)
def text_to_dates(t):
    day = S.safe_date("data_aggiudicazione_definitiva")
    first, last = F.lit("1997-01-01").cast("date"), F.lit("1999-06-30").cast("date")
    sentinel = F.lit("1998-01-01").cast("date")
    return t.raw_aggiudicazioni.groupBy(
        F.col("data_aggiudicazione_definitiva").alias("testo"),
        day.alias("giorno"),
        S.safe_date("data_comunicazione_esito").alias("comunicazione"),
        F.year(day).alias("anno"),
        F.month(day).alias("mese"),
        S.domain_date(day, 1999).alias("dominio"),
        S.clamp_date(day, first, last).alias("finestra"),
        S.null_if(day, sentinel).alias("senza_sentinella"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "text_flags_and_blanks",
    """
    SELECT flag_subappalto AS testo, trim(flag_subappalto) = 'S' AS flag,
           CASE WHEN length(trim(flag_subappalto)) > 0 THEN upper(trim(flag_subappalto)) END AS pulito,
           CASE WHEN trim(flag_subappalto) <> 'N' THEN trim(flag_subappalto) END AS senza_n,
           count(*) AS n
    FROM {raw_aggiudicazioni} GROUP BY ALL""",
)
def text_flags_and_blanks(t):
    flag = "flag_subappalto"
    return t.raw_aggiudicazioni.groupBy(
        F.col(flag).alias("testo"),
        S.decode_flag(flag, "S").alias("flag"),
        S.normalize_string(flag, upper=True).alias("pulito"),
        S.null_if(S.normalize_string(flag), "N").alias("senza_n"),
    ).agg(F.count(F.lit(1)).alias("n"))


@query(
    "suspect_amounts",
    """
    SELECT cig, coalesce(importo_lotto >= 9e8 OR (c_acctbal > 0
           AND importo_lotto > c_acctbal * 100000), false) AS sospetto, importo_lotto
    FROM {bandi} JOIN {customer} ON cf_amministrazione_appaltante = CAST(c_custkey AS VARCHAR)""",
)
def suspect_amounts(t):
    owners = t.customer.select(F.col("c_custkey").cast("string").alias("cf"), "c_acctbal")
    return t.bandi.join(owners, F.col("cf_amministrazione_appaltante") == F.col("cf")).select(
        "cig", S.suspect_amount("importo_lotto", "c_acctbal", 9e8, 1e5).alias("sospetto"), "importo_lotto"
    )


@query(
    "guarded_durations",
    """
    WITH x AS (SELECT cig, data_inizio_effettiva - data_stipula_contratto AS g,
                      data_termine_contrattuale - data_inizio_effettiva AS h FROM {avvio})
    SELECT cig, CAST(g AS INT) AS giorni, CAST(CASE WHEN h BETWEEN 380 AND 420 THEN h END AS INT) AS durata
    FROM x""",
)
def guarded_durations(t):
    return t.avvio.select(
        "cig",
        S.days_between("data_stipula_contratto", "data_inizio_effettiva").alias("giorni"),
        S.guarded_days("data_inizio_effettiva", "data_termine_contrattuale", 380, 420).alias("durata"),
    )


@query(
    "ratios_and_billions",
    """
    WITH g AS (SELECT cig, sum(importo_aggiudicazione) AS s, sum(ribasso_aggiudicazione) AS r,
                      count(*) AS n FROM {aggiudicazioni} GROUP BY cig)
    SELECT cig, round(r * 100.0 / nullif(s, 0), 1) AS pct, round(s / nullif(r, 0), 2) AS rapporto,
           round(s / 1e9, 4) AS mld FROM g""",
)
def ratios_and_billions(t):
    g = t.aggiudicazioni.groupBy("cig").agg(
        F.sum("importo_aggiudicazione").alias("s"), F.sum("ribasso_aggiudicazione").alias("r")
    )
    return g.select(
        "cig",
        S.pct("r", "s", 1).alias("pct"),
        S.rounded(S.ratio("s", "r"), 2).alias("rapporto"),
        S.billions("s", 4).alias("mld"),
    )


_WIDE = ["fondi_bilancio_sa", "entrate_vincolate_ue", "mutuo", "entrate_vincolate_statali", "capitali_privati", "altro"]
_WIDE_SQL = f"""
    largo AS (SELECT cig, id_aggiudicazione, {", ".join(
        f"sum(importo) FILTER (fonte = '{f}') AS {f}" for f in _WIDE)}
              FROM {{fonti}} GROUP BY 1, 2)"""


@query(
    "row_wise_maximum_and_label",
    f"""
    WITH {_WIDE_SQL},
    x AS (SELECT *, greatest({", ".join(_WIDE)}) AS massimo FROM largo)
    SELECT cig, id_aggiudicazione, {" + ".join(f"coalesce({f}, 0)" for f in _WIDE)} AS totale, massimo,
           {" + ".join(f"CAST(coalesce({f} > 0, false) AS INT)" for f in _WIDE)} AS n_fonti,
           CASE WHEN fondi_bilancio_sa = massimo THEN 'bilancio stazione appaltante'
                WHEN entrate_vincolate_ue = massimo THEN 'fondi UE'
                WHEN entrate_vincolate_statali = massimo THEN 'entrate vincolate statali'
                WHEN mutuo = massimo THEN 'mutuo' WHEN capitali_privati = massimo THEN 'capitali privati'
                ELSE 'altre fonti' END AS prevalente
    FROM x""",
)
def row_wise_maximum_and_label(t):
    sums = R.conditional_sums("fonte", "importo", {f: [f] for f in _WIDE})
    wide = t.fonti.groupBy("cig", "id_aggiudicazione").agg(*sums)
    labels = {f: text for f, text in PREVALENTE.items() if f in _WIDE}
    return wide.select(
        "cig",
        "id_aggiudicazione",
        S.sum_or_zero(*_WIDE).alias("totale"),
        S.row_max(*_WIDE).alias("massimo"),
        S.count_positive(*_WIDE).alias("n_fonti"),
        S.label_of_max(labels, S.row_max(*_WIDE), "altre fonti").alias("prevalente"),
    )


@query(
    "series_keys",
    """
    SELECT CASE WHEN id_aggiudicazione IS NULL THEN 'cig:' || cig
                ELSE 'agg:' || CAST(id_aggiudicazione AS VARCHAR) END AS serie, count(*) AS n
    FROM {sal} GROUP BY 1""",
)
def series_keys(t):
    key = S.series_key("id_aggiudicazione", "cig").alias("serie")
    return t.sal.groupBy(key).agg(F.count(F.lit(1)).alias("n"))


@query(
    "text_matches",
    """
    SELECT denominazione, upper(denominazione) LIKE '%LIER#00000000%' AS trovata, sezione_regionale,
           trim(replace(sezione_regionale, 'SEZIONE REGIONALE ', '')) AS regione_corta, count(*) AS n
    FROM {operatori} JOIN {bandi} USING (cig)
    WHERE tipo_soggetto NOT ILIKE '%stazione appaltante%' GROUP BY ALL""",
)
def text_matches(t):
    return (
        t.operatori.where(~F.col("tipo_soggetto").ilike("%stazione appaltante%"))
        .join(t.bandi.select("cig", "sezione_regionale"), "cig")
        .groupBy(
            "denominazione",
            S.contains_ci("denominazione", "lier#00000000").alias("trovata"),
            "sezione_regionale",
            S.strip_prefix("sezione_regionale", "SEZIONE REGIONALE").alias("regione_corta"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


# --- filters ----------------------------------------------------------------


@query(
    "active_and_trusted",
    "SELECT cig, anno_pubblicazione FROM {bandi} WHERE stato = 'ATTIVO' AND NOT flag_importo_sospetto",
)
def active_and_trusted(t):
    return tenders.active_trusted(t.bandi).select("cig", "anno_pubblicazione")


@query(
    "blank_and_castable_keys",
    """
    SELECT codice_fiscale, count(*) AS n FROM {raw_operatori}
    WHERE trim(codice_fiscale) <> '' AND try_cast(id_aggiudicazione AS BIGINT) IS NOT NULL GROUP BY 1""",
)
def blank_and_castable_keys(t):
    rows = t.raw_operatori.where(
        S.not_blank("codice_fiscale") & S.cast_bigint("id_aggiudicazione").isNotNull()
    )
    return rows.groupBy("codice_fiscale").agg(F.count(F.lit(1)).alias("n"))


@query(
    "names_that_are_no_roles",
    """
    SELECT denominazione, count(*) AS n FROM {aggiudicatari}
    WHERE denominazione NOT IN (SELECT ruolo FROM {aggiudicatari}) GROUP BY 1""",
)
def names_that_are_no_roles(t):
    """Null-aware NOT IN against the published roles; a missing name is dropped."""
    named = not_in(t.aggiudicatari, "denominazione", t.aggiudicatari.select("ruolo"))
    return named.groupBy("denominazione").agg(F.count(F.lit(1)).alias("n"))


# --- keys -------------------------------------------------------------------


@query(
    "delta_replaces_lot",
    """
    SELECT cig, id_aggiudicazione, codice_fiscale, __source_file FROM {raw_operatori}
    QUALIFY __source_file = max(__source_file) OVER (PARTITION BY cig)""",
)
def delta_replaces_lot(t):
    return K.keep_newest_source(t.raw_operatori).select(
        "cig", "id_aggiudicazione", "codice_fiscale", K.SOURCE
    )


@query(
    "delta_added_later",
    """
    SELECT cig, id_aggiudicazione, codice_fiscale, __source_file FROM {raw_operatori}
    QUALIFY __source_file = max(__source_file) OVER (PARTITION BY cig)""",
)
def delta_added_later(t):
    """The same rows from a feed held by lot bucket, to which the files come one by one, the
    oldest month last."""
    path = scratch_path(t.spark, "feed")
    for name in ("00-full.csv", "delta_202605.csv", "delta_202604.csv"):
        own = t.raw_operatori.where(F.col(K.SOURCE) == name)
        deltas.keep(t.spark, path, deltas.add(own, path, [name], buckets=8))
    return deltas.live(t.spark, path).select("cig", "id_aggiudicazione", "codice_fiscale", K.SOURCE)


@query(
    "delta_replaces_key",
    """
    SELECT cig, id_aggiudicazione, codice_fiscale, __source_file FROM {raw_operatori}
    QUALIFY row_number() OVER (PARTITION BY cig, id_aggiudicazione
                               ORDER BY __source_file DESC, codice_fiscale NULLS LAST) = 1""",
)
def delta_replaces_key(t):
    rows = t.raw_operatori.select("cig", "id_aggiudicazione", "codice_fiscale", K.SOURCE)
    return K.newest_source_per_key(rows, ["cig", "id_aggiudicazione"])


@query(
    "latest_record_per_key",
    """
    SELECT cig, id_aggiudicazione, importo_aggiudicazione, CAST(data_comunicazione_esito AS VARCHAR)
               AS data_comunicazione_esito FROM {aggiudicazioni} a
    QUALIFY row_number() OVER (PARTITION BY cig, id_aggiudicazione
        ORDER BY a.data_comunicazione_esito DESC NULLS LAST, importo_aggiudicazione NULLS LAST) = 1""",
)
def latest_record_per_key(t):
    rows = t.aggiudicazioni.select(
        "cig", "id_aggiudicazione", "importo_aggiudicazione", "data_comunicazione_esito"
    )
    return K.latest_per_key(rows, ["cig", "id_aggiudicazione"], ["data_comunicazione_esito"])


@query(
    "first_row_by_text_order",
    """
    SELECT cig, codice_fiscale, ruolo, denominazione FROM {operatori}
    QUALIFY row_number() OVER (PARTITION BY cig, codice_fiscale
                               ORDER BY ruolo NULLS LAST, denominazione NULLS LAST) = 1""",
)
def first_row_by_text_order(t):
    rows = t.operatori.select("cig", "codice_fiscale", "ruolo", "denominazione")
    order = [F.col("ruolo").asc_nulls_last(), F.col("denominazione").asc_nulls_last()]
    return K.one_per_key(rows, ["cig", "codice_fiscale"], order)


@query(
    "dedup_with_nullable_key",
    """
    (SELECT cig, id_aggiudicazione, mutuo, apporto_di_capitali_privati, __source_file FROM {raw_fonti}
     WHERE id_aggiudicazione IS NOT NULL
     QUALIFY row_number() OVER (PARTITION BY cig, id_aggiudicazione ORDER BY __source_file DESC,
             mutuo NULLS LAST, apporto_di_capitali_privati NULLS LAST) = 1)
    UNION ALL
    (SELECT cig, id_aggiudicazione, mutuo, apporto_di_capitali_privati, max(__source_file)
     FROM {raw_fonti} WHERE id_aggiudicazione IS NULL GROUP BY ALL)""",
)
def dedup_with_nullable_key(t):
    record = ["mutuo", "apporto_di_capitali_privati"]
    rows = t.raw_fonti.select("cig", "id_aggiudicazione", *record, K.SOURCE)
    return K.split_dedup(rows, ["cig", "id_aggiudicazione"], "id_aggiudicazione", record)


@query("distinct_records", "SELECT DISTINCT * FROM {cup}")
def distinct_records(t):
    return K.distinct_records(t.cup)


@query(
    "latest_contract_per_lot",
    """
    SELECT cig, CAST(data_stipula_contratto AS VARCHAR) AS data_stipula_contratto,
           CAST(data_inizio_effettiva AS VARCHAR) AS data_inizio_effettiva,
           CAST(data_termine_contrattuale AS VARCHAR) AS data_termine_contrattuale
    FROM {avvio} a QUALIFY row_number() OVER (
        PARTITION BY cig ORDER BY a.data_stipula_contratto DESC NULLS LAST,
        id_aggiudicazione DESC NULLS LAST, a.data_inizio_effettiva NULLS LAST,
        a.data_termine_contrattuale NULLS LAST) = 1""",
)
def latest_contract_per_lot(t):
    return cross.latest_start_per_cig(t.avvio)


@query(
    "marked_copies",
    """
    SELECT user_id, event_type, event_id,
           event_id = min(event_id) OVER (PARTITION BY user_id, event_type, round(value)) AS is_first
    FROM {events}""",
)
def marked_copies(t):
    rows = t.events.select("user_id", "event_type", "event_id", F.round("value").alias("v"))
    return K.mark_first(rows, ["user_id", "event_type", "v"], ["event_id"]).drop("v")


# --- joins ------------------------------------------------------------------


@query(
    "inner_join_lots_contracts",
    """
    SELECT anno, settore, count(*) AS n, sum(importo_base) AS base
    FROM {contratti} q JOIN (SELECT cig, max(anno_pubblicazione) AS anno,
                                    max(oggetto_principale_contratto) AS settore
                             FROM {bandi} WHERE NOT flag_importo_sospetto GROUP BY cig) b USING (cig)
    GROUP BY ALL""",
)
def inner_join_lots_contracts(t):
    per_lot = t.contratti.groupBy("cig").agg(
        F.count(F.lit(1)).alias("n"), F.sum("importo_base").alias("base")
    )
    return (
        per_lot.join(t.per_cig, "cig")
        .groupBy("anno", "settore")
        .agg(F.sum("n").alias("n"), F.sum("base").alias("base"))
    )


@query(
    "left_join_composite_key",
    """
    WITH f AS (SELECT cig, id_aggiudicazione, sum(importo) AS fin FROM {fonti} GROUP BY 1, 2)
    SELECT q.cig, q.id_aggiudicazione, importo_base, fin
    FROM {contratti} q LEFT JOIN f ON q.cig = f.cig AND q.id_aggiudicazione = f.id_aggiudicazione""",
)
def left_join_composite_key(t):
    key = ["cig", "id_aggiudicazione"]
    funded = t.fonti.groupBy(*key).agg(F.sum("importo").alias("fin"))
    return t.contratti.join(funded, key, "left").select(*key, "importo_base", "fin")


@query(
    "dimension_join",
    """
    SELECT natura_giuridica, z.provincia, count(*) AS n, sum(importo_lotto) AS importo
    FROM {bandi} b LEFT JOIN {stazioni} z ON b.cf_amministrazione_appaltante = z.codice_fiscale
    GROUP BY natura_giuridica, z.provincia""",
)
def dimension_join(t):
    registry = t.stazioni.select("codice_fiscale", "natura_giuridica", "provincia")
    per_authority = t.bandi.groupBy(F.col("cf_amministrazione_appaltante").alias("codice_fiscale")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("importo_lotto").alias("importo")
    )
    return (
        per_authority.join(registry, "codice_fiscale", "left")
        .groupBy("natura_giuridica", "provincia")
        .agg(F.sum("n").alias("n"), F.sum("importo").alias("importo"))
    )


@query(
    "null_safe_join",
    """
    WITH g AS (SELECT sezione_regionale, sum(importo_lotto) AS totale FROM {bandi} GROUP BY 1)
    SELECT b.cig, b.sezione_regionale, g.totale FROM {bandi} b
    JOIN g ON b.sezione_regionale IS NOT DISTINCT FROM g.sezione_regionale""",
)
def null_safe_join(t):
    totals = t.bandi.groupBy("sezione_regionale").agg(F.sum("importo_lotto").alias("totale"))
    return attach(t.bandi.select("cig", "sezione_regionale"), totals, ["sezione_regionale"])


@query(
    "member_lists",
    """
    SELECT DISTINCT cig, denominazione FROM {partecipanti}
    WHERE denominazione IS NOT NULL AND cig IS NOT NULL""",
)
def member_lists(t):
    return Q.distinct_names(t.partecipanti, "cig", "denominazione")


# --- aggregates -------------------------------------------------------------


@query(
    "filtered_aggregates",
    """
    SELECT descrizione_evento, cig, count(*) AS n, count(data) AS n_data,
           count(DISTINCT id_aggiudicazione) FILTER (somme_a_disposizione > 0) AS con_somme,
           bool_or(importo_lavori > 3e9) AS grande,
           CAST(min(data) FILTER (importo_lavori > 0) AS VARCHAR) AS primo,
           sum(CASE WHEN importo_servizi > 1e9 THEN importo_servizi ELSE 0 END) AS servizi
    FROM {quadro} GROUP BY 1, 2""",
)
def filtered_aggregates(t):
    works, services = F.col("importo_lavori"), F.col("importo_servizi")
    return t.quadro.groupBy("descrizione_evento", "cig").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("data").alias("n_data"),
        F.count_distinct(
            F.when(F.col("somme_a_disposizione") > 0, F.col("id_aggiudicazione"))
        ).alias("con_somme"),
        F.bool_or(works > 3e9).alias("grande"),
        F.min(F.when(works > 0, F.col("data"))).alias("primo"),
        F.sum(F.when(services > 1e9, services).otherwise(0.0)).alias("servizi"),
    )


@query(
    "exact_group_medians",
    """
    SELECT l_returnflag, l_linestatus, median(l_extendedprice) AS mediana
    FROM {lineitem} GROUP BY 1, 2""",
)
def exact_group_medians(t):
    return group_median(t.lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", "mediana")


@query(
    "ordered_distinct_text",
    """
    SELECT cf_amministrazione_appaltante AS cf,
           string_agg(DISTINCT tipo_scelta_contraente, ' | ' ORDER BY tipo_scelta_contraente) AS tipi,
           any_value(denominazione_amministrazione_appaltante) AS nome
    FROM {bandi} GROUP BY 1""",
)
def ordered_distinct_text(t):
    """Procedure kinds are coded values, so the list per authority stays short."""
    kinds = t.bandi.groupBy(
        F.col("cf_amministrazione_appaltante").alias("cf"), "tipo_scelta_contraente"
    ).agg(F.any_value("denominazione_amministrazione_appaltante").alias("nome"))
    return kinds.groupBy("cf").agg(
        F.array_join(F.array_sort(F.collect_list("tipo_scelta_contraente")), " | ").alias("tipi"),
        F.any_value("nome").alias("nome"),
    )


@query(
    "two_level_aggregation",
    """
    WITH s AS (SELECT cig, id_aggiudicazione, sum(importo_quota) AS q, max(n_giorni_scostamento) AS g
               FROM {sal} GROUP BY 1, 2)
    SELECT cig, count(*) AS serie, sum(q) AS totale, max(g) AS peggiore FROM s GROUP BY cig""",
)
def two_level_aggregation(t):
    series = t.sal.groupBy("cig", "id_aggiudicazione").agg(
        F.sum("importo_quota").alias("q"), F.max("n_giorni_scostamento").alias("g")
    )
    return series.groupBy("cig").agg(
        F.count(F.lit(1)).alias("serie"), F.sum("q").alias("totale"), F.max("g").alias("peggiore")
    )


@query(
    "weighted_average",
    """
    SELECT esito, sum(num_imprese_invitate * numero_offerte_ammesse)
                  / nullif(sum(numero_offerte_ammesse) FILTER (num_imprese_invitate IS NOT NULL), 0)
                  AS media
    FROM {aggiudicazioni} GROUP BY esito""",
)
def weighted_average(t):
    mean = Q.weighted_mean("num_imprese_invitate", "numero_offerte_ammesse")
    return t.aggiudicazioni.groupBy("esito").agg(mean.alias("media"))


# --- windows, order, reshaping ----------------------------------------------


@query(
    "rank_in_group",
    """
    SELECT l_suppkey, cast(l_orderkey AS BIGINT) AS l_orderkey, l_linenumber, l_extendedprice,
           row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice DESC, l_orderkey,
                              l_linenumber, l_partkey) AS posto
    FROM {lineitem} QUALIFY posto <= 5""",
)
def rank_in_group(t):
    ranked = R.top_n_per_group(
        t.lineitem, ["l_suppkey"], "l_extendedprice", 5, ["l_orderkey", "l_linenumber", "l_partkey"], "posto"
    )
    return ranked.select("l_suppkey", "l_orderkey", "l_linenumber", "l_extendedprice", "posto")


_SECTOR = """
    g AS (SELECT anno_pubblicazione AS anno, oggetto_principale_contratto AS settore,
                 sum(importo_lotto) AS s FROM {bandi} GROUP BY ALL)"""


def _by_year_and_sector(t):
    return t.bandi.groupBy(
        F.col("anno_pubblicazione").alias("anno"), F.col("oggetto_principale_contratto").alias("settore")
    ).agg(F.sum("importo_lotto").alias("s"))


@query(
    "share_of_group_total",
    f"WITH {_SECTOR} SELECT *, round(s * 100.0 / sum(s) OVER (PARTITION BY anno), 2) AS quota FROM g",
)
def share_of_group_total(t):
    return R.share_of_partition(_by_year_and_sector(t), ["anno"], "s", "quota")


@query(
    "share_of_grand_total",
    f"WITH {_SECTOR} SELECT *, round(s * 100.0 / sum(s) OVER (), 2) AS quota FROM g",
)
def share_of_grand_total(t):
    return R.share_of_total(_by_year_and_sector(t), "s", "quota")


@query(
    "change_to_previous_year",
    f"""
    WITH {_SECTOR}, p AS (SELECT *, lag(s) OVER (PARTITION BY settore ORDER BY anno) AS prima FROM g)
    SELECT anno, settore, s, round((s - prima) * 100.0 / nullif(prima, 0), 2) AS variazione FROM p""",
)
def change_to_previous_year(t):
    return R.change_to_previous(_by_year_and_sector(t), ["settore"], "anno", "s", "variazione")


@query(
    "series_that_fall",
    """
    WITH p AS (SELECT user_id, event_type, value < lag(value) OVER (
                   PARTITION BY user_id, event_type ORDER BY ts, event_id) AS cade FROM {events})
    SELECT user_id, event_type, coalesce(bool_or(cade), false) AS falls FROM p GROUP BY 1, 2""",
)
def series_that_fall(t):
    return falling_steps(
        t.events, ["user_id", "event_type"], [F.col("ts").asc(), F.col("event_id").asc()], "value"
    )


@query(
    "top_rows_by_measure",
    "SELECT cig, importo_lotto FROM {bandi} ORDER BY importo_lotto DESC, cig LIMIT 100",
)
def top_rows_by_measure(t):
    return R.top_n(t.bandi.select("cig", "importo_lotto"), "importo_lotto", 100, ["cig"])


@query(
    "rows_of_top_groups",
    """
    WITH g AS (SELECT provincia FROM {bandi} GROUP BY 1 ORDER BY sum(importo_lotto) DESC, 1 LIMIT 5)
    SELECT cig, provincia, importo_lotto FROM {bandi} WHERE provincia IN (SELECT provincia FROM g)""",
)
def rows_of_top_groups(t):
    rows = t.bandi.select("cig", "provincia", "importo_lotto")
    return R.keep_top_groups(rows, "provincia", "importo_lotto", 5)


@query(
    "distinct_union_of_lots",
    """
    SELECT cig FROM {avvio} WHERE data_stipula_contratto IS NOT NULL
    UNION SELECT cig FROM {fine} WHERE data_effettiva_ultimazione IS NOT NULL""",
)
def distinct_union_of_lots(t):
    signed = t.avvio.where(F.col("data_stipula_contratto").isNotNull()).select("cig")
    done = t.fine.where(F.col("data_effettiva_ultimazione").isNotNull()).select("cig")
    return signed.union(done).distinct()


@query(
    "wide_to_long_positive",
    f"""
    WITH {_WIDE_SQL}
    SELECT * FROM (UNPIVOT largo ON {", ".join(_WIDE)} INTO NAME fonte VALUE importo) WHERE importo > 0""",
)
def wide_to_long_positive(t):
    sums = R.conditional_sums("fonte", "importo", {f: [f] for f in _WIDE})
    wide = t.fonti.groupBy("cig", "id_aggiudicazione").agg(*sums)
    return R.positive_long(wide, ["cig", "id_aggiudicazione"], _WIDE, "fonte", "importo")


@query(
    "long_to_wide_groups",
    "SELECT cig, id_aggiudicazione, {cols} FROM {fonti} GROUP BY 1, 2".replace(
        "{cols}",
        ", ".join(
            f"sum(importo) FILTER (fonte IN ({', '.join(repr(x) for x in labels)})) AS {name}"
            for name, labels in cross.MACRO_FONTI.items()
        ),
    ),
)
def long_to_wide_groups(t):
    return t.fonti.groupBy("cig", "id_aggiudicazione").agg(
        *R.conditional_sums("fonte", "importo", cross.MACRO_FONTI)
    )


@query(
    "pivot_with_zero_fill",
    f"""
    SELECT provincia, {", ".join(
        f'coalesce(sum(importo_lotto) FILTER (anno_pubblicazione = {y}), 0) AS "{y}"'
        for y in range(1995, 2002))}
    FROM {{bandi}} GROUP BY 1""",
)
def pivot_with_zero_fill(t):
    return R.pivot_filled(
        t.bandi, "provincia", "anno_pubblicazione", list(range(1995, 2002)), "importo_lotto"
    )
