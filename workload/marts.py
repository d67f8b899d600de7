"""The single-dataset marts on the derived tables."""

from __future__ import annotations

from tenderlake.plans import authorities, awards, execution, finance, tenders

from .registry import query

# --- tenders ----------------------------------------------------------------

_TRUSTED = "stato = 'ATTIVO' AND NOT flag_importo_sospetto"


@query(
    "mart_annuale_bandi",
    """
    WITH b AS (SELECT *, CASE WHEN NOT flag_importo_sospetto THEN importo_lotto END AS ok FROM {bandi})
    SELECT anno_pubblicazione AS anno, count(*) AS n_lotti, count(DISTINCT cig) AS n_cig,
           count(DISTINCT cf_amministrazione_appaltante) AS n_stazioni_appaltanti,
           count(DISTINCT oggetto_principale_contratto) AS n_settori,
           round(sum(ok), 0) AS importo_totale, round(avg(ok), 0) AS importo_medio,
           round(median(ok), 0) AS importo_mediano,
           count(*) - count(ok) AS n_importi_sospetti,
           round(sum(importo_lotto) - coalesce(sum(ok), 0), 0) AS importo_sospetti,
           count(*) FILTER (flag_pnrr) AS n_pnrr,
           round(coalesce(sum(ok) FILTER (flag_pnrr), 0), 0) AS importo_pnrr,
           count(*) FILTER (esito = 'AGGIUDICATA') AS n_aggiudicati,
           count(*) FILTER (esito IS DISTINCT FROM 'AGGIUDICATA') AS n_non_aggiudicati,
           round(coalesce(sum(ok) FILTER (esito = 'AGGIUDICATA'), 0), 0) AS importo_aggiudicati
    FROM b GROUP BY anno_pubblicazione""",
)
def mart_annuale_bandi(t):
    return tenders.mart_annuale(t.bandi)


@query(
    "mart_trend_pnrr",
    f"""
    WITH g AS (
        SELECT anno_pubblicazione, sezione_regionale, oggetto_principale_contratto, flag_pnrr,
               count(*) AS n_lotti, count(DISTINCT cig) AS n_bandi,
               count(DISTINCT cf_amministrazione_appaltante) AS n_stazioni,
               sum(importo_lotto) AS s, avg(importo_lotto) AS m
        FROM {{bandi}} WHERE {_TRUSTED} AND sezione_regionale IS NOT NULL GROUP BY ALL)
    SELECT anno_pubblicazione, sezione_regionale, oggetto_principale_contratto, flag_pnrr, n_lotti,
           n_bandi, n_stazioni, round(s, 0) AS importo_totale, round(m, 0) AS importo_medio,
           round(s * 100.0 / nullif(sum(s) OVER cell, 0), 2) AS quota_pct_settore
    FROM g
    WINDOW cell AS (PARTITION BY anno_pubblicazione, sezione_regionale, oggetto_principale_contratto)
    """,
)
def mart_trend_pnrr(t):
    return tenders.mart_trend_pnrr(t.bandi)


@query(
    "mart_top_stazioni",
    f"""
    WITH g AS (
        SELECT anno_pubblicazione AS anno, cf_amministrazione_appaltante AS cf,
               denominazione_amministrazione_appaltante AS nome, sezione_regionale AS regione,
               count(DISTINCT cig) AS gare, count(*) AS lotti, sum(importo_lotto) AS s
        FROM {{bandi}} WHERE {_TRUSTED} AND cf_amministrazione_appaltante <> '' GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY anno ORDER BY s DESC, cf, nome, regione) AS pos
          FROM g)
    SELECT anno, cf AS cf_amministrazione_appaltante,
           nome AS denominazione_amministrazione_appaltante, regione, gare AS n_gare,
           lotti AS n_lotti, round(lotti / nullif(gare, 0), 1) AS lotti_medi_per_gara,
           round(s, 0) AS importo_totale, round(s / lotti, 0) AS importo_medio,
           pos AS rank_per_anno
    FROM r ORDER BY anno DESC, pos LIMIT 500""",
)
def mart_top_stazioni(t):
    return tenders.mart_top_stazioni(t.bandi)


@query(
    "mart_esiti_per_procedura",
    f"""
    WITH g AS (
        SELECT anno_pubblicazione AS anno, sezione_regionale AS regione,
               oggetto_principale_contratto AS settore, tipo_scelta_contraente,
               CASE WHEN esito LIKE 'AGGIUDICATA%' THEN 'aggiudicata'
                    WHEN esito = 'DESERTA' THEN 'non_aggiudicata'
                    WHEN esito = 'REVOCATA' THEN 'annullata' ELSE 'altro' END AS macro_esito,
               count(*) AS n_lotti, round(sum(importo_lotto), 0) AS importo_totale
        FROM {{bandi}} WHERE {_TRUSTED} AND sezione_regionale IS NOT NULL
          AND tipo_scelta_contraente IS NOT NULL GROUP BY ALL)
    SELECT *, round(n_lotti * 100.0
                    / sum(n_lotti) OVER (PARTITION BY anno, regione, tipo_scelta_contraente), 2)
              AS quota_pct
    FROM g""",
)
def mart_esiti_per_procedura(t):
    return tenders.mart_esiti_per_procedura(t.bandi)


@query(
    "mart_trend_settore",
    f"""
    WITH g AS (
        SELECT anno_pubblicazione AS anno, sezione_regionale AS regione,
               oggetto_principale_contratto AS settore, count(*) AS n_lotti,
               round(sum(importo_lotto), 0) AS importo_totale
        FROM {{bandi}} WHERE {_TRUSTED} AND sezione_regionale IS NOT NULL GROUP BY ALL),
    p AS (SELECT *, lag(importo_totale) OVER (PARTITION BY regione, settore ORDER BY anno) AS prima
          FROM g)
    SELECT anno, regione, settore, n_lotti, importo_totale,
           round((importo_totale - prima) * 100.0 / nullif(prima, 0), 2) AS var_pct_anno_prec,
           round(importo_totale * 100.0
                 / nullif(sum(importo_totale) OVER (PARTITION BY anno, regione), 0), 2)
               AS quota_pct_su_regione
    FROM p""",
)
def mart_trend_settore(t):
    return tenders.mart_trend_settore(t.bandi)


@query(
    "mart_sa_profilo",
    f"""
    SELECT cf_amministrazione_appaltante AS cf_sa,
           max(denominazione_amministrazione_appaltante) AS denominazione_sa,
           max(sezione_regionale) AS regione, count(*) AS n_bandi, count(DISTINCT cig) AS n_cig,
           round(sum(importo_lotto), 0) AS importo_totale,
           round(avg(importo_lotto), 0) AS importo_medio,
           round(median(importo_lotto), 0) AS importo_mediano,
           count(DISTINCT oggetto_principale_contratto) AS n_settori,
           min(anno_pubblicazione) AS anno_primo, max(anno_pubblicazione) AS ultimo_anno,
           count(*) FILTER (flag_pnrr) AS n_pnrr,
           round(sum(CASE WHEN flag_pnrr THEN importo_lotto ELSE 0 END), 0) AS importo_pnrr
    FROM {{bandi}} WHERE {_TRUSTED} AND cf_amministrazione_appaltante <> ''
    GROUP BY cf_amministrazione_appaltante HAVING count(*) >= 10""",
)
def mart_sa_profilo(t):
    return tenders.mart_sa_profilo(t.bandi)


# --- awards and firms -------------------------------------------------------


@query(
    "mart_annuale_aggiudicazioni",
    """
    SELECT CAST(year(data_aggiudicazione_definitiva) AS INT) AS anno_aggiudicazione,
           CAST(month(data_aggiudicazione_definitiva) AS INT) AS mese_aggiudicazione,
           esito, criterio_aggiudicazione, flag_subappalto, asta_elettronica,
           coalesce(importo_aggiudicazione > 0, false) AS flag_importo_positivo,
           count(*) AS n_aggiudicazioni, count(DISTINCT cig) AS n_cig_distinti,
           count(DISTINCT id_aggiudicazione) AS n_id_aggiudicazione_distinti,
           sum(importo_aggiudicazione) AS importo_totale,
           avg(importo_aggiudicazione) AS importo_medio,
           median(importo_aggiudicazione) AS importo_mediano,
           max(importo_aggiudicazione) AS importo_massimo,
           min(importo_aggiudicazione) AS importo_minimo,
           avg(ribasso_aggiudicazione) AS ribasso_medio,
           median(ribasso_aggiudicazione) AS ribasso_mediano,
           CAST(sum(numero_offerte_ammesse) AS BIGINT) AS offerte_ammesse_totale,
           CAST(sum(numero_offerte_escluse) AS BIGINT) AS offerte_escluse_totale,
           avg(num_imprese_offerenti) AS imprese_offerenti_medie,
           avg(num_imprese_invitate) AS imprese_invitate_medie
    FROM {aggiudicazioni}
    WHERE year(data_aggiudicazione_definitiva) BETWEEN 1995 AND 2026 GROUP BY ALL""",
)
def mart_annuale_aggiudicazioni(t):
    return awards.mart_annuale(t.aggiudicazioni, (1995, 2026))


@query(
    "mart_dettaglio",
    """
    SELECT cig, id_aggiudicazione, CAST(data_aggiudicazione_definitiva AS VARCHAR)
               AS data_aggiudicazione_definitiva,
           CAST(data_comunicazione_esito AS VARCHAR) AS data_comunicazione_esito, esito,
           criterio_aggiudicazione, importo_aggiudicazione, ribasso_aggiudicazione,
           numero_offerte_ammesse, numero_offerte_escluse, num_imprese_offerenti,
           num_imprese_invitate, flag_subappalto, asta_elettronica, cod_esito
    FROM {aggiudicazioni} WHERE cig IS NOT NULL""",
)
def mart_dettaglio(t):
    return awards.mart_dettaglio(t.aggiudicazioni)


@query(
    "mart_top_aggiudicatari",
    """
    SELECT codice_fiscale, denominazione, tipo_soggetto, ruolo, count(DISTINCT cig) AS n_cig,
           count(DISTINCT id_aggiudicazione) AS n_aggiudicazioni, count(*) AS n_record
    FROM {aggiudicatari} WHERE codice_fiscale <> '' GROUP BY ALL""",
)
def mart_top_aggiudicatari(t):
    return awards.mart_top_aggiudicatari(t.aggiudicatari)


@query(
    "mart_top_partecipanti",
    """
    SELECT codice_fiscale, denominazione, tipo_soggetto, ruolo, count(DISTINCT cig) AS n_cig,
           count(*) AS n_record
    FROM {partecipanti} WHERE codice_fiscale <> '' GROUP BY ALL""",
)
def mart_top_partecipanti(t):
    return awards.mart_top_partecipanti(t.partecipanti)


@query(
    "mart_top_subappalti",
    """
    SELECT descrizione_categoria, descrizione_cpv, codice_fiscale, denominazione, ruolo,
           count(DISTINCT cig) AS n_cig, count(DISTINCT id_subappalto) AS n_subappalti,
           count(*) AS n_record
    FROM {subappalti} GROUP BY ALL""",
)
def mart_top_subappalti(t):
    return awards.mart_top_subappalti(t.subappalti)


@query(
    "mart_cup",
    """
    SELECT cup, count(*) AS n_cig, count(DISTINCT cig) AS n_cig_distinti FROM {cup} GROUP BY cup""",
)
def mart_cup(t):
    return awards.mart_cup(t.cup)


# --- execution --------------------------------------------------------------


@query(
    "mart_sal",
    """
    SELECT CAST(year(data_emissione_sal) AS INT) AS anno, flag_ritardo, count(*) AS n_sal,
           count(DISTINCT cig) AS n_cig, round(sum(importo_quota), 0) AS importo_totale,
           count(DISTINCT CASE WHEN tipo_serie = 'anomala' THEN
                 CASE WHEN id_aggiudicazione IS NULL THEN 'c' || cig
                      ELSE 'a' || CAST(id_aggiudicazione AS VARCHAR) END END) AS n_serie_anomale,
           round(avg(n_giorni_scostamento), 0) AS scostamento_medio_giorni
    FROM {sal} WHERE year(data_emissione_sal) BETWEEN 1995 AND 2026 GROUP BY ALL""",
)
def mart_sal(t):
    return execution.mart_sal(t.sal, (1995, 2026))


@query(
    "mart_collaudo",
    """
    SELECT CAST(year(data_delibera) AS INT) AS anno, esito_collaudo, count(*) AS n_collaudi,
           count(DISTINCT cig) AS n_cig, round(avg(riserve_avanzate), 0) AS riserve_medie,
           round(avg(importo_contenz_risolto), 0) AS contenzioso_medio
    FROM {collaudo} WHERE year(data_delibera) BETWEEN 1996 AND 2026 GROUP BY ALL""",
)
def mart_collaudo(t):
    return execution.mart_collaudo(t.collaudo, (1996, 2026))


@query(
    "mart_avvio_contratto",
    """
    WITH a AS (SELECT *, data_inizio_effettiva - data_stipula_contratto AS gi,
                      data_termine_contrattuale - data_stipula_contratto AS gt FROM {avvio})
    SELECT CAST(year(data_stipula_contratto) AS INT) AS anno, count(*) AS n_contratti,
           count(DISTINCT cig) AS n_cig, count(data_inizio_effettiva) AS n_con_inizio,
           count(data_termine_contrattuale) AS n_con_termine,
           round(avg(gi) FILTER (gi BETWEEN -365 AND 3650), 1) AS giorni_medi_stipula_inizio,
           round(avg(gt) FILTER (gt BETWEEN 0 AND 18250), 1) AS giorni_medi_durata_contrattuale,
           round(avg(CAST(consegna_sotto_riserva AS INT)) * 100, 1)
               AS quota_consegna_sotto_riserva_pct,
           round(avg(CAST(consegna_frazionata AS INT)) * 100, 1) AS quota_consegna_frazionata_pct
    FROM a WHERE data_stipula_contratto IS NOT NULL GROUP BY 1""",
)
def mart_avvio_contratto(t):
    return execution.mart_avvio_contratto(t.avvio)


@query(
    "mart_fine_contratto",
    """
    SELECT CAST(year(data_effettiva_ultimazione) AS INT) AS anno, count(*) AS n_conclusi,
           count(DISTINCT cig) AS n_cig, count(motivo_risoluzione) AS n_con_risoluzione,
           count(motivo_interruzione_anticipata) AS n_con_interruzione,
           count(data_conclusione_anticipata) AS n_conclusione_anticipata,
           round(count(motivo_risoluzione) * 100.0 / count(*), 2) AS quota_risoluzione_pct,
           round(count(motivo_interruzione_anticipata) * 100.0 / count(*), 2)
               AS quota_interruzione_pct
    FROM {fine} WHERE data_effettiva_ultimazione IS NOT NULL GROUP BY 1""",
)
def mart_fine_contratto(t):
    return execution.mart_fine_contratto(t.fine)


@query(
    "mart_motivi_fine",
    """
    SELECT 'RISOLUZIONE' AS tipo, motivo_risoluzione AS motivo, count(*) AS n_contratti
    FROM {fine} WHERE motivo_risoluzione IS NOT NULL GROUP BY 1, 2
    UNION ALL BY NAME
    SELECT 'INTERRUZIONE ANTICIPATA' AS tipo, motivo_interruzione_anticipata AS motivo,
           count(*) AS n_contratti
    FROM {fine} WHERE motivo_interruzione_anticipata IS NOT NULL GROUP BY 1, 2""",
)
def mart_motivi_fine(t):
    return execution.mart_motivi_fine(t.fine)


@query(
    "mart_sospensioni",
    """
    WITH s AS (SELECT *, data_ripresa - data_sospensione AS g FROM {sospensioni}
               WHERE data_sospensione IS NOT NULL),
    k AS (SELECT *, CASE WHEN g BETWEEN 0 AND 3650 THEN g END AS ok FROM s)
    SELECT CAST(year(data_sospensione) AS INT) AS anno, descrizione_motivo,
           count(*) AS n_sospensioni, count(DISTINCT cig) AS n_cig,
           count(data_ripresa) AS n_con_ripresa, count(*) FILTER (g > 3650) AS n_durata_anomala,
           round(avg(ok), 1) AS giorni_medi, CAST(max(ok) AS INT) AS giorni_max,
           CAST(sum(coalesce(ok, 0)) AS BIGINT) AS giorni_totali
    FROM k GROUP BY 1, 2""",
)
def mart_sospensioni(t):
    return execution.mart_sospensioni(t.sospensioni)


@query(
    "mart_varianti",
    """
    SELECT CAST(year(data_approvazione_variante) AS INT) AS anno, motivo_variante,
           count(*) AS n_varianti, count(DISTINCT id_variante) AS n_varianti_distinte,
           count(DISTINCT cig) AS n_cig,
           count(DISTINCT cig) FILTER (cig_proroga IS NOT NULL) AS n_cig_con_proroga,
           round(count(cig_proroga) * 100.0 / count(*), 2) AS quota_con_proroga_pct
    FROM {varianti} WHERE data_approvazione_variante IS NOT NULL GROUP BY 1, 2""",
)
def mart_varianti(t):
    return execution.mart_varianti(t.varianti)


# --- authorities ------------------------------------------------------------


@query(
    "mart_natura",
    """
    WITH g AS (SELECT coalesce(natura_giuridica, 'NON DICHIARATA') AS natura_giuridica,
                      count(*) AS n_sa, count(*) FILTER (stato = 'ATTIVO') AS n_attive,
                      count(*) FILTER (stato <> 'ATTIVO') AS n_cessate FROM {stazioni} GROUP BY 1)
    SELECT *, round(n_sa * 100.0 / sum(n_sa) OVER (), 2) AS quota_pct FROM g""",
)
def mart_natura(t):
    return authorities.mart_natura(t.stazioni)


@query(
    "mart_territorio",
    """
    WITH g AS (SELECT provincia, count(*) AS n_sa, count(*) FILTER (stato = 'ATTIVO') AS n_attive,
                      count(DISTINCT citta) AS n_comuni
               FROM {stazioni} WHERE trim(provincia) <> '' GROUP BY provincia)
    SELECT *, round(n_sa * 100.0 / sum(n_sa) OVER (), 2) AS quota_pct FROM g""",
)
def mart_territorio(t):
    return authorities.mart_territorio(t.stazioni)


# --- money ------------------------------------------------------------------

_QE = """
    e AS (SELECT *, coalesce(importo_lavori, 0) + coalesce(importo_servizi, 0)
                    + coalesce(importo_forniture, 0) AS c FROM {quadro}),
    f AS (SELECT cig, id_aggiudicazione, descrizione_evento, c, somme_a_disposizione FROM e
          QUALIFY row_number() OVER (PARTITION BY cig, id_aggiudicazione, descrizione_evento
                                     ORDER BY dettaglio_evento) = 1),
    s AS (SELECT cig, id_aggiudicazione, max(c) AS top, max(somme_a_disposizione) AS somme,
                 count(*) AS n_eventi, count(*) FILTER (descrizione_evento = 'VARIANTE') AS n_varianti,
                 count(*) FILTER (descrizione_evento = 'CONSUNTIVO') > 0 AS ha_consuntivo,
                 CAST(min(data) FILTER (descrizione_evento = 'VARIANTE') AS VARCHAR)
                     AS data_prima_variante,
                 CAST(max(data) FILTER (descrizione_evento = 'VARIANTE') AS VARCHAR)
                     AS data_ultima_variante
          FROM e GROUP BY 1, 2)"""


@query(
    "mart_cig",
    f"""
    WITH {_QE},
    j AS (SELECT s.*, b.c AS base, coalesce(k.c, s.top) AS fin,
                 b.somme_a_disposizione AS somme_base,
                 coalesce(k.somme_a_disposizione, s.somme) AS somme_finali
          FROM s JOIN f AS b ON s.cig = b.cig AND s.id_aggiudicazione = b.id_aggiudicazione
                             AND b.descrizione_evento = 'BASE_ASTA'
          LEFT JOIN f AS k ON s.cig = k.cig AND s.id_aggiudicazione = k.id_aggiudicazione
                           AND k.descrizione_evento = 'CONSUNTIVO'
          WHERE b.c > 0)
    SELECT cig, id_aggiudicazione, base AS importo_base, fin AS importo_finale,
           fin - base AS scostamento, round((fin - base) * 100.0 / base, 2) AS scostamento_pct,
           somme_base, somme_finali, n_varianti, n_eventi, ha_consuntivo, data_prima_variante,
           data_ultima_variante, base >= 1e10 AS flag_base_sospetta, base >= 1e9 AS flag_base_grande
    FROM j""",
)
def mart_cig(t):
    return finance.mart_cig(t.quadro)


@query(
    "mart_eventi",
    """
    WITH e AS (SELECT *, coalesce(importo_lavori, 0) + coalesce(importo_servizi, 0) AS c FROM {quadro})
    SELECT descrizione_evento, count(*) AS n_righe, count(DISTINCT cig) AS n_cig,
           count(data) AS n_con_data, round(median(c), 0) AS importo_contratto_mediano,
           round(avg(c), 0) AS importo_contratto_medio,
           round(sum(c) / 1e9, 1) AS importo_contratto_mld
    FROM e GROUP BY 1""",
)
def mart_eventi(t):
    return finance.mart_eventi(t.quadro)
