"""The clean tables from dirty text."""

from __future__ import annotations

from datetime import date

from tenderlake.plans import clean, finance
from tenderlake.plans import fields as L
from tenderlake.plans.fields import FONTI

from .registry import query as registered

# --- columns the derived raw tables lack ------------------------------------
#
# The given tables have no source for most of the published columns. They are
# filled with dirty text drawn from the row's key, the same text for all rows of
# a key, so they never decide which row stays; but they are read, cast and
# compared like all others.


def _number(k: int, key: str) -> str:
    return f"(try_cast(trim({key}) AS BIGINT) + {k})"


def _dirty(kind: str, k: int, key: str) -> str:
    r = _number(k, key)
    if kind in ("int", "long"):
        return f"CASE WHEN {r} % 11 = 0 THEN 'x' ELSE CAST({r} % 50 AS STRING) END"
    if kind in ("double", "zero"):
        return f"CASE WHEN {r} % 9 <> 0 THEN CAST({r} % 1000 AS STRING) || '.25' END"
    if kind in ("date", "date90", "event"):
        return (
            f"CASE {r} % 13 WHEN 0 THEN '0001-01-01' WHEN 1 THEN '1979-05-05' WHEN 2 THEN 'n/d' "
            f"ELSE '199' || CAST({r} % 10 AS STRING) || '-0' || CAST(1 + {r} % 9 AS STRING) "
            f"|| '-1' || CAST({r} % 10 AS STRING) END"
        )
    if kind.startswith("flag:"):
        return f"CASE WHEN {r} % 2 = 0 THEN ' {kind[5:]} ' ELSE 'N' END"
    if kind == "norm":
        return f"CASE WHEN {r} % 7 = 0 THEN '  ' ELSE ' N' || CAST({r} % 6 AS STRING) || ' ' END"
    return f"'T' || CAST({r} % 5 AS STRING)"


def _typed(kind: str, text: str, window: str | None) -> str:
    if kind in ("int", "long"):
        return f"try_cast({text} AS {'INT' if kind == 'int' else 'BIGINT'})"
    if kind in ("double", "zero"):
        number = f"try_cast({text} AS DOUBLE)"
        return f"coalesce({number}, 0)" if kind == "zero" else number
    if kind in ("date", "date90", "event"):
        day = _event(text) if kind == "event" else _day(text, 1990 if kind == "date90" else 1800)
        return f"CAST(CASE WHEN {day} BETWEEN {window} THEN {day} END AS VARCHAR)" if window else (
            f"CAST({day} AS VARCHAR)"
        )
    if kind.startswith("flag:"):
        return f"coalesce(trim({text}) = '{kind[5:]}', false)"
    return _norm(text) if kind == "norm" else text


def _lacking(layout: list[L.Field], present: str) -> list[tuple[int, L.Field]]:
    return [(k, f) for k, f in enumerate(layout) if f.name not in present.split()]


def _filled(raw, layout: list[L.Field], present: str, key: str = "cig"):
    """The raw table with all published columns."""
    extra = [f"{_dirty(f.kind, k, key)} AS `{f.source}`" for k, f in _lacking(layout, present)]
    return raw.selectExpr("*", *extra)


def query(name, sql, layout=None, present="", key="cig", window=None):
    """Register a clean table; with a layout its SQL gets the columns that were filled in."""
    if layout is not None:
        extra = [
            f'{_typed(f.kind, f"({_dirty(f.kind, k, key)})", window)} AS "{f.name}"'
            for k, f in _lacking(layout, present)
        ]
        sql = f"SELECT w.*, {', '.join(extra)} FROM ({sql}) w"
    return registered(name, sql)


AS_OF, SINCE = date(2001, 6, 30), date(1996, 1, 1)
_WINDOW = "DATE '1996-01-01' AND DATE '2001-06-30'"


def _day(expr: str, low: int = 1800) -> str:
    d = f"try_cast({expr} AS DATE)"
    return f"CASE WHEN year({d}) BETWEEN {low} AND 2100 THEN {d} END"


def _event(column: str) -> str:
    return _day(f"nullif({column}, '0001-01-01')")


def _iso(column: str, alias: str | None = None) -> str:
    return f"CAST({column} AS VARCHAR) AS {alias or column}"


def _norm(column: str) -> str:
    return f"nullif(trim({column}), '')"


_NEWEST = "QUALIFY __source_file = max(__source_file) OVER (PARTITION BY cig)"


_BANDI_GARA = (
    "cig numero_gara importo_complessivo_gara importo_lotto stato anno_pubblicazione "
    "data_pubblicazione flag_pnrr motivo_urgenza data_ultimo_perfezionamento"
)


@query(
    "clean_bandi_gara",
    f"""
    WITH x AS (
        SELECT cig, numero_gara, try_cast(importo_complessivo_gara AS DOUBLE) AS gara,
               try_cast(importo_lotto AS DOUBLE) AS lotto, stato,
               try_cast(anno_pubblicazione AS INT) AS anno_pubblicazione,
               {_day("data_pubblicazione", 1990)} AS pub,
               trim(FLAG_PNRR_PNC) = '1' AS flag_pnrr, {_norm("motivo_urgenza")} AS motivo_urgenza,
               {_day("data_ultimo_perfezionamento", 1990)} AS ult
        FROM {{raw_bandi}}),
    y AS (SELECT * FROM x QUALIFY row_number() OVER (
              PARTITION BY anno_pubblicazione, cig
              ORDER BY ult DESC NULLS LAST, pub DESC NULLS LAST, gara NULLS LAST) = 1)
    SELECT cig, numero_gara, gara AS importo_complessivo_gara, lotto AS importo_lotto, stato,
           anno_pubblicazione, {_iso("pub", "data_pubblicazione")}, flag_pnrr, motivo_urgenza,
           {_iso("ult", "data_ultimo_perfezionamento")},
           coalesce(lotto >= 1e9 OR (gara > 0 AND lotto > 10 * gara), false) AS flag_importo_sospetto
    FROM y""",
    layout=L.BANDI_GARA,
    present=_BANDI_GARA,
)
def clean_bandi_gara(t):
    return clean.clean_bandi_gara(_filled(t.raw_bandi, L.BANDI_GARA, _BANDI_GARA))


_AGGIUDICAZIONI = (
    "cig id_aggiudicazione data_aggiudicazione_definitiva data_comunicazione_esito "
    "importo_aggiudicazione flag_subappalto numero_offerte_ammesse num_imprese_offerenti"
)


@query(
    "clean_aggiudicazioni",
    f"""
    WITH x AS (
        SELECT trim(cig) AS cig, cig AS pubblicato,
               try_cast(id_aggiudicazione AS BIGINT) AS id_aggiudicazione,
               {_day("data_aggiudicazione_definitiva")} AS agg,
               {_day("data_comunicazione_esito")} AS com,
               try_cast(importo_aggiudicazione AS DOUBLE) AS importo_aggiudicazione,
               trim(flag_subappalto) = 'S' AS flag_subappalto,
               try_cast(numero_offerte_ammesse AS INT) AS numero_offerte_ammesse,
               try_cast(num_imprese_offerenti AS INT) AS num_imprese_offerenti, __source_file
        FROM {{raw_aggiudicazioni}}),
    y AS (SELECT * FROM x WHERE year(agg) BETWEEN 1995 AND 2026
          QUALIFY __source_file = max(__source_file) OVER (PARTITION BY pubblicato)),
    z AS (SELECT * FROM y QUALIFY row_number() OVER (
              PARTITION BY cig, id_aggiudicazione
              ORDER BY com DESC NULLS LAST, agg DESC NULLS LAST, numero_offerte_ammesse NULLS LAST,
                       importo_aggiudicazione NULLS LAST, num_imprese_offerenti NULLS LAST,
                       flag_subappalto) = 1)
    SELECT cig, id_aggiudicazione, {_iso("agg", "data_aggiudicazione_definitiva")},
           {_iso("com", "data_comunicazione_esito")}, importo_aggiudicazione, flag_subappalto,
           numero_offerte_ammesse, num_imprese_offerenti
    FROM z""",
    layout=L.AGGIUDICAZIONI,
    present=_AGGIUDICAZIONI,
)
def clean_aggiudicazioni(t):
    return clean.clean_aggiudicazioni(_filled(t.raw_aggiudicazioni, L.AGGIUDICAZIONI, _AGGIUDICAZIONI), (1995, 2026))


@query(
    "clean_aggiudicatari",
    f"""
    WITH y AS (SELECT * FROM {{raw_operatori}} {_NEWEST}),
    x AS (SELECT trim(cig) AS cig, ruolo, codice_fiscale, denominazione, tipo_soggetto,
                 try_cast(id_aggiudicazione AS BIGINT) AS id_aggiudicazione FROM y)
    SELECT * FROM x WHERE id_aggiudicazione IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY cig, id_aggiudicazione, codice_fiscale
                               ORDER BY ruolo NULLS LAST, denominazione NULLS LAST) = 1""",
)
def clean_aggiudicatari(t):
    return clean.clean_aggiudicatari(t.raw_operatori)


@query(
    "clean_partecipanti",
    f"""
    WITH y AS (SELECT * FROM {{raw_operatori}} {_NEWEST})
    SELECT DISTINCT trim(cig) AS cig, ruolo, codice_fiscale, denominazione, tipo_soggetto FROM y""",
)
def clean_partecipanti(t):
    return clean.clean_partecipanti(t.raw_operatori)


_SUBAPPALTI = (
    "cig id_subappalto cf_subappaltante data_autorizzazione cod_categoria codice_fiscale "
    "denominazione ruolo tipo_soggetto"
)


@query(
    "clean_subappalti",
    f"""
    WITH y AS (SELECT * REPLACE ({_day("data_autorizzazione")} AS data_autorizzazione)
               FROM {{raw_operatori}} {_NEWEST})
    SELECT trim(cig) AS cig, id_subappalto, cf_subappaltante, {_iso("data_autorizzazione")},
           cod_categoria, codice_fiscale, denominazione, ruolo, tipo_soggetto
    FROM y QUALIFY row_number() OVER (
        PARTITION BY trim(y.cig), id_subappalto, cod_categoria, codice_fiscale
        ORDER BY y.data_autorizzazione DESC NULLS LAST, cf_subappaltante NULLS LAST,
                 denominazione NULLS LAST, ruolo NULLS LAST, tipo_soggetto NULLS LAST) = 1""",
    layout=L.SUBAPPALTI,
    present=_SUBAPPALTI,
)
def clean_subappalti(t):
    return clean.clean_subappalti(_filled(t.raw_operatori, L.SUBAPPALTI, _SUBAPPALTI))


_AVVIO_CONTRATTO = (
    "cig id_aggiudicazione consegna_frazionata data_stipula_contratto "
    "data_inizio_effettiva data_termine_contrattuale"
)


@query(
    "clean_avvio_contratto",
    f"""
    WITH y AS (SELECT * FROM {{raw_esecuzione}} {_NEWEST}),
    x AS (SELECT cig, try_cast(id_aggiudicazione AS BIGINT) AS id_aggiudicazione,
                 {_event("data_stipula_contratto")} AS st, {_event("data_inizio_effettiva")} AS ini,
                 {_event("data_termine_contrattuale")} AS term,
                 trim(consegna_frazionata) = '1' AS consegna_frazionata FROM y),
    z AS (SELECT * FROM x QUALIFY row_number() OVER (
              PARTITION BY cig, id_aggiudicazione
              ORDER BY st DESC NULLS LAST, term NULLS LAST, ini NULLS LAST, consegna_frazionata) = 1),
    w AS (SELECT cig, id_aggiudicazione, consegna_frazionata,
                 CASE WHEN st BETWEEN {_WINDOW} THEN st END AS st2,
                 CASE WHEN ini BETWEEN {_WINDOW}
                       AND (st IS NULL OR ini - st BETWEEN -365 AND 3650) THEN ini END AS ini2,
                 CASE WHEN term BETWEEN DATE '1996-01-01' AND DATE '2060-12-31'
                       AND (st IS NULL OR term >= st) THEN term END AS term2 FROM z)
    SELECT cig, id_aggiudicazione, consegna_frazionata, {_iso("st2", "data_stipula_contratto")},
           {_iso("ini2", "data_inizio_effettiva")}, {_iso("term2", "data_termine_contrattuale")}
    FROM w""",
    layout=L.AVVIO_CONTRATTO,
    present=_AVVIO_CONTRATTO,
    window=_WINDOW,
)
def clean_avvio_contratto(t):
    return clean.clean_avvio_contratto(_filled(t.raw_esecuzione, L.AVVIO_CONTRATTO, _AVVIO_CONTRATTO), AS_OF, SINCE)


_FINE_CONTRATTO = "cig id_aggiudicazione motivo_risoluzione giorni_proroga data_effettiva_ultimazione"


@query(
    "clean_fine_contratto",
    f"""
    WITH y AS (SELECT * FROM {{raw_esecuzione}} {_NEWEST}),
    x AS (SELECT cig, try_cast(id_aggiudicazione AS BIGINT) AS id_aggiudicazione,
                 {_event("data_effettiva_ultimazione")} AS u, {_norm("motivo_risoluzione")} AS m,
                 try_cast(giorni_proroga AS INT) AS giorni_proroga FROM y),
    z AS (SELECT * FROM x QUALIFY row_number() OVER (
              PARTITION BY cig, id_aggiudicazione
              ORDER BY u DESC NULLS LAST, m NULLS LAST, giorni_proroga NULLS LAST) = 1)
    SELECT cig, id_aggiudicazione, m AS motivo_risoluzione, giorni_proroga,
           CAST(CASE WHEN u BETWEEN {_WINDOW} THEN u END AS VARCHAR) AS data_effettiva_ultimazione
    FROM z""",
    layout=L.FINE_CONTRATTO,
    present=_FINE_CONTRATTO,
    window=_WINDOW,
)
def clean_fine_contratto(t):
    return clean.clean_fine_contratto(_filled(t.raw_esecuzione, L.FINE_CONTRATTO, _FINE_CONTRATTO), AS_OF, SINCE)


@query(
    "clean_sospensioni",
    f"""
    WITH y AS (SELECT * FROM {{raw_esecuzione}} {_NEWEST}),
    x AS (SELECT cig, try_cast(id_aggiudicazione AS BIGINT) AS id_aggiudicazione,
                 data_sospensione AS testo, {_event("data_sospensione")} AS s,
                 {_event("data_ripresa")} AS r, {_norm("descrizione_motivo")} AS descrizione_motivo
          FROM y),
    z AS (SELECT * FROM x QUALIFY row_number() OVER (
              PARTITION BY cig, id_aggiudicazione, testo, descrizione_motivo
              ORDER BY s DESC NULLS LAST, r DESC NULLS LAST) = 1)
    SELECT cig, id_aggiudicazione, descrizione_motivo,
           CAST(CASE WHEN s BETWEEN {_WINDOW} THEN s END AS VARCHAR) AS data_sospensione,
           CAST(CASE WHEN r BETWEEN {_WINDOW} THEN r END AS VARCHAR) AS data_ripresa
    FROM z""",
)
def clean_sospensioni(t):
    return clean.clean_sospensioni(t.raw_esecuzione, AS_OF, SINCE)


_VARIANTI = "id_variante motivo_variante data_approvazione_variante cig id_aggiudicazione"


@query(
    "clean_varianti",
    f"""
    WITH y AS (SELECT *, {_event("data_approvazione_variante")} AS d FROM {{raw_esecuzione}} {_NEWEST})
    SELECT try_cast(id_variante AS BIGINT) AS id_variante,
           {_norm("motivo_variante")} AS motivo_variante,
           CAST(CASE WHEN d BETWEEN {_WINDOW} THEN d END AS VARCHAR) AS data_approvazione_variante,
           cig, try_cast(id_aggiudicazione AS BIGINT) AS id_aggiudicazione
    FROM y""",
    layout=L.VARIANTI,
    present=_VARIANTI,
    window=_WINDOW,
)
def clean_varianti(t):
    return clean.clean_varianti(_filled(t.raw_esecuzione, L.VARIANTI, _VARIANTI), AS_OF, SINCE)


_COLLAUDO = "cig id_aggiudicazione data_cert_collaudo data_delibera riserve_avanzate"


@query(
    "clean_collaudo",
    f"""
    WITH y AS (SELECT * FROM {{raw_esecuzione}} {_NEWEST}),
    x AS (SELECT cig, try_cast(id_aggiudicazione AS BIGINT) AS id_aggiudicazione,
                 {_day("data_cert_collaudo")} AS c, {_day("data_delibera")} AS d,
                 try_cast(RISERVE_AVANZATE AS DOUBLE) AS riserve_avanzate FROM y)
    SELECT cig, id_aggiudicazione, {_iso("c", "data_cert_collaudo")}, {_iso("d", "data_delibera")},
           riserve_avanzate
    FROM x QUALIFY row_number() OVER (
        PARTITION BY cig, id_aggiudicazione
        ORDER BY c DESC NULLS LAST, d DESC NULLS LAST, riserve_avanzate NULLS LAST) = 1""",
    layout=L.COLLAUDO,
    present=_COLLAUDO,
)
def clean_collaudo(t):
    return clean.clean_collaudo(_filled(t.raw_esecuzione, L.COLLAUDO, _COLLAUDO))


SERIES = f"""
    y AS (SELECT * FROM {{raw_sal}} {_NEWEST}),
    x AS (SELECT cig, {_norm("flag_ritardo")} AS flag_ritardo, {_day("data_emissione_sal")} AS d,
                 try_cast(importo_sal AS DOUBLE) AS v,
                 try_cast(n_giorni_scostamento AS INT) AS n_giorni_scostamento,
                 try_cast(progressivo_sal AS INT) AS n,
                 try_cast(id_aggiudicazione AS BIGINT) AS id FROM y),
    r AS (SELECT * FROM x QUALIFY row_number() OVER (PARTITION BY cig, id, n
                                                     ORDER BY d DESC NULLS LAST) = 1),
    k AS (SELECT *, CASE WHEN id IS NULL THEN 'c' || cig ELSE 'a' || id END AS s FROM r),
    p AS (SELECT s, d, v, min(n) AS n FROM k GROUP BY s, d, v),
    o AS (SELECT *, row_number() OVER w AS pos, v - lag(v) OVER w AS passo FROM p
          WINDOW w AS (PARTITION BY s ORDER BY d NULLS LAST, n NULLS LAST, v NULLS LAST)),
    m AS (SELECT s, count(*) AS punti, max(v) AS top, count(*) FILTER (passo < 0) AS cadute,
                 arg_min(n, pos) FILTER (v = (SELECT max(q.v) FROM p AS q WHERE q.s = o.s)) AS primo
          FROM o GROUP BY s),
    serie AS (
        SELECT k.cig, flag_ritardo, d AS giorno, v AS importo_sal, n_giorni_scostamento,
               k.n AS progressivo_sal, id AS id_aggiudicazione,
               CASE WHEN punti = 1 THEN 'singola' WHEN cadute = 0 THEN 'monotona'
                    ELSE 'anomala' END AS tipo_serie,
               CASE WHEN k.n = primo AND v = top THEN top ELSE 0 END AS importo_quota
        FROM k JOIN m ON k.s = m.s)"""


_STATI_AVANZAMENTO = (
    "cig flag_ritardo data_emissione_sal importo_sal n_giorni_scostamento progressivo_sal "
    "id_aggiudicazione"
)


@query(
    "clean_stati_avanzamento",
    f"""
    WITH {SERIES}
    SELECT * EXCLUDE (giorno), {_iso("giorno", "data_emissione_sal")} FROM serie""",
    layout=L.STATI_AVANZAMENTO,
    present=_STATI_AVANZAMENTO,
)
def clean_stati_avanzamento(t):
    return clean.clean_stati_avanzamento(_filled(t.raw_sal, L.STATI_AVANZAMENTO, _STATI_AVANZAMENTO))


@query(
    "clean_cup",
    """
    SELECT trim(cig) AS cig, trim(cup) AS cup FROM {raw_cup} WHERE trim(cig) <> '' AND trim(cup) <> ''
    """,
)
def clean_cup(t):
    return clean.clean_cup(t.raw_cup)


_STAZIONI_APPALTANTI = (
    "codice_fiscale partita_iva denominazione natura_giuridica flag_inhouse provincia "
    "stato data_inizio"
)


@query(
    "clean_stazioni_appaltanti",
    f"""
    SELECT trim(codice_fiscale) AS codice_fiscale,
           CASE WHEN partita_iva <> '00000000000' THEN partita_iva END AS partita_iva,
           trim(denominazione) AS denominazione,
           {_norm("natura_giuridica_descrizione")} AS natura_giuridica,
           flag_inHouse = 'true' AS flag_inhouse, provincia_nome AS provincia, stato,
           data_inizio
    FROM {{raw_stazioni}} WHERE trim(codice_fiscale) <> ''""",
    layout=L.STAZIONI_APPALTANTI,
    present=_STAZIONI_APPALTANTI,
    key="codice_fiscale",
)
def clean_stazioni_appaltanti(t):
    return clean.clean_stazioni_appaltanti(_filled(t.raw_stazioni, L.STAZIONI_APPALTANTI, _STAZIONI_APPALTANTI, key="codice_fiscale"))


_QUADRO_ECONOMICO = (
    "cig id_aggiudicazione data descrizione_evento dettaglio_evento importo_lavori "
    "importo_servizi somme_a_disposizione"
)


@query(
    "clean_quadro_economico",
    f"""
    WITH x AS (
        SELECT cig, try_cast(id_aggiudicazione AS BIGINT) AS id_aggiudicazione,
               {_day("data", 1990)} AS d, descrizione_evento, dettaglio_evento,
               try_cast(importo_lavori AS DOUBLE) AS importo_lavori,
               try_cast(importo_servizi AS DOUBLE) AS importo_servizi,
               try_cast(somme_a_disposizione AS DOUBLE) AS somme_a_disposizione, __source_file,
               id_aggiudicazione AS pubblicato
        FROM {{raw_quadro}} WHERE trim(cig) <> '' AND id_aggiudicazione IS NOT NULL),
    y AS (SELECT * FROM x QUALIFY row_number() OVER (
              PARTITION BY cig, pubblicato, descrizione_evento, dettaglio_evento
              ORDER BY __source_file DESC, d NULLS LAST, importo_lavori NULLS LAST,
                       importo_servizi NULLS LAST, somme_a_disposizione NULLS LAST) = 1)
    SELECT * EXCLUDE (d, __source_file, pubblicato), {_iso("d", "data")} FROM y""",
    layout=L.QUADRO_ECONOMICO,
    present=_QUADRO_ECONOMICO,
)
def clean_quadro_economico(t):
    return clean.clean_quadro_economico(_filled(t.raw_quadro, L.QUADRO_ECONOMICO, _QUADRO_ECONOMICO))


_REG = "entrate_con_dest_vincolata_pubblica_nazionale_regionale"
_SA = "fondi_di_bilancio_della_stazione_appaltante"
_UE = "entrate_con_dest_vincolata_pubblica_comunitaria"
_PRIV = "apporto_di_capitali_privati"
_PUBLISHED = f"{_REG}, mutuo, {_PRIV}, {_SA}, {_UE}"
_FONTI_FINANZIAMENTO = (
    "cig id_aggiudicazione entrate_vincolate_regionali mutuo capitali_privati fondi_bilancio_sa "
    "entrate_vincolate_ue"
)
_OTHERS = ", ".join(
    f"{_typed('zero', '(' + _dirty('zero', k, 'cig') + ')', None)} AS {f.name}"
    for k, f in _lacking(L.FONTI_FINANZIAMENTO, _FONTI_FINANZIAMENTO)
)

FONTI_SQL = f"""
    uniche AS (
        (SELECT cig, id_aggiudicazione, {_PUBLISHED} FROM {{raw_fonti}}
         WHERE id_aggiudicazione IS NOT NULL
         QUALIFY row_number() OVER (
             PARTITION BY cig, id_aggiudicazione
             ORDER BY __source_file DESC, {_REG} NULLS LAST, mutuo NULLS LAST, {_PRIV} NULLS LAST,
                      {_SA} NULLS LAST, {_UE} NULLS LAST) = 1)
        UNION ALL
        (SELECT DISTINCT cig, id_aggiudicazione, {_PUBLISHED} FROM {{raw_fonti}}
         WHERE id_aggiudicazione IS NULL)),
    importi AS (
        SELECT cig, try_cast(id_aggiudicazione AS BIGINT) AS id_aggiudicazione,
               coalesce(try_cast({_REG} AS DOUBLE), 0) AS entrate_vincolate_regionali,
               coalesce(try_cast(mutuo AS DOUBLE), 0) AS mutuo,
               coalesce(try_cast({_PRIV} AS DOUBLE), 0) AS capitali_privati,
               coalesce(try_cast({_SA} AS DOUBLE), 0) AS fondi_bilancio_sa,
               coalesce(try_cast({_UE} AS DOUBLE), 0) AS entrate_vincolate_ue,
               {_OTHERS}
        FROM uniche),
    fonti_pulite AS (
        SELECT *, {" + ".join(FONTI)} AS totale_fonti,
               {" + ".join(f"CAST({f} > 0 AS INT)" for f in FONTI)} AS n_fonti,
               greatest({", ".join(FONTI)}) AS top
        FROM importi),
    fonti_finali AS (
        SELECT * EXCLUDE (top), totale_fonti >= 1e9 AS flag_fonti_sospette,
               CASE WHEN top = 0 THEN NULL
                    WHEN fondi_bilancio_sa = top THEN 'bilancio stazione appaltante'
                    WHEN fondi_bilancio_amministrazione = top
                        THEN 'bilancio amministrazione competente'
                    WHEN entrate_vincolate_ue = top THEN 'fondi UE'
                    WHEN entrate_vincolate_statali = top THEN 'entrate vincolate statali'
                    WHEN mutuo = top THEN 'mutuo'
                    WHEN capitali_privati = top THEN 'capitali privati'
                    ELSE 'altre fonti' END AS fonte_prevalente
        FROM fonti_pulite)"""


def _raw_fonti(t):
    return _filled(t.raw_fonti, L.FONTI_FINANZIAMENTO, _FONTI_FINANZIAMENTO)


@query("clean_fonti_finanziamento", f"WITH {FONTI_SQL} SELECT * FROM fonti_finali")
def clean_fonti_finanziamento(t):
    return clean.clean_fonti_finanziamento(_raw_fonti(t))


@query(
    "mart_fonti",
    f"""
    WITH {FONTI_SQL},
    lunga AS (
        UNPIVOT (SELECT cig, id_aggiudicazione, fonte_prevalente, n_fonti, {", ".join(FONTI)}
                 FROM fonti_finali WHERE NOT flag_fonti_sospette)
        ON {", ".join(FONTI)} INTO NAME fonte VALUE importo)
    SELECT * FROM lunga WHERE importo > 0""",
)
def mart_fonti(t):
    return finance.mart_fonti(clean.clean_fonti_finanziamento(_raw_fonti(t)))
