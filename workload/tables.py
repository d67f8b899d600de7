"""Procurement tables derived from the given ones.

Each text runs on Spark and on the comparison engine alike, so both sides start
from the same rows. Amounts have cents, in quarters: such sums are exact in binary, so they
do not depend on the order of addition. `raw_*` tables hold dirty text with the file each row came
from; the others have the clean layout.
"""

from __future__ import annotations

GIVEN = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]

_FILE_OF_LINE = """
    CASE l_returnflag WHEN 'N' THEN '00-full.csv' WHEN 'A' THEN 'delta_202604.csv'
         ELSE 'delta_202605.csv' END"""
_SHIP = "CAST(l_shipdate AS DATE)"
_CIG = "CAST(l_orderkey AS STRING)"
_AWARD = "CAST(l_linenumber AS BIGINT)"
# Cents of an order's and of a line's amount: 0, 25, 50 or 75.
_ORDER_CENTS = "CAST(o_orderkey % 4 AS DOUBLE) / 4"
_LINE_CENTS = "CAST((l_orderkey + l_linenumber) % 4 AS DOUBLE) / 4"
_EVENT_CENTS = "CAST(event_id % 4 AS DOUBLE) / 4"

_PLACES = """
    SELECT c_custkey, c_name, c_mktsegment, c_acctbal, n_nationkey, n_name,
           CASE WHEN n_nationkey = 24 THEN NULL
                WHEN n_regionkey = 4 THEN 'SEZIONE REGIONALE CENTRALE'
                ELSE 'SEZIONE REGIONALE ' || r_name END AS sezione
    FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
                    JOIN {region} ON n_regionkey = r_regionkey"""

_ESITO = """
    CASE WHEN o_orderstatus = 'F' THEN 'AGGIUDICATA'
         WHEN o_orderstatus = 'P' THEN 'DESERTA'
         WHEN o_orderpriority = '5-LOW' THEN NULL
         WHEN o_orderpriority = '2-HIGH' THEN 'REVOCATA'
         WHEN o_orderpriority = '3-MEDIUM' THEN 'IN CORSO'
         ELSE 'AGGIUDICATA EFFICACE' END"""

DERIVED = {
    "luoghi": _PLACES,
    # tenders ---------------------------------------------------------------
    "bandi": f"""
        SELECT CAST(o_orderkey AS STRING) AS cig,
               'OGGETTO ' || o_orderstatus AS oggetto_gara,
               round(o_totalprice) * 2100 + {_ORDER_CENTS} AS importo_lotto,
               coalesce(round(o_totalprice) * 2100 >= 1e9
                        OR (c_acctbal > 9500 AND o_orderpriority = '5-LOW'), false)
                   AS flag_importo_sospetto,
               c_mktsegment AS oggetto_principale_contratto,
               CASE WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus = 'P'
                    THEN 'CANCELLATO' ELSE 'ATTIVO' END AS stato,
               n_name AS provincia,
               CAST(o_orderdate AS DATE) AS data_pubblicazione,
               o_orderpriority AS tipo_scelta_contraente,
               CAST(c_custkey AS STRING) AS cf_amministrazione_appaltante,
               c_name AS denominazione_amministrazione_appaltante,
               sezione AS sezione_regionale,
               CAST(year(o_orderdate) AS INT) AS anno_pubblicazione,
               o_orderpriority = '1-URGENT' AS flag_pnrr,
               {_ESITO} AS esito
        FROM {{orders}} JOIN {{luoghi}} ON o_custkey = c_custkey""",
    "raw_bandi": f"""
        SELECT ' ' || CAST(o_orderkey AS STRING) AS cig_pubblicato,
               CAST(o_orderkey AS STRING) AS cig,
               'G' || CAST(o_orderkey AS STRING) AS numero_gara,
               CAST(CAST(round(o_totalprice) AS BIGINT) * 2100 AS STRING) AS importo_lotto,
               CASE WHEN l_returnflag = 'R'
                    THEN CAST(CAST(round(o_totalprice) AS BIGINT) * 100 AS STRING)
                    WHEN l_returnflag = 'A' THEN 'n.d.'
                    ELSE CAST(CAST(round(o_totalprice) AS BIGINT) * 2100 AS STRING) || '.0' END
                   AS importo_complessivo_gara,
               'ATTIVO' AS stato,
               CAST(CAST(year(o_orderdate) AS INT) AS STRING) AS anno_pubblicazione,
               CASE WHEN l_linenumber = 1 THEN '1977-04-13'
                    ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS data_pubblicazione,
               CASE WHEN o_orderpriority = '1-URGENT' THEN ' 1 ' ELSE '0' END AS FLAG_PNRR_PNC,
               CASE WHEN o_orderstatus = 'F' THEN '  ' ELSE ' urgenza ' || o_orderstatus END
                   AS motivo_urgenza,
               CASE WHEN l_quantity = 50 THEN '7436-02-12'
                    ELSE CAST({_SHIP} AS STRING) END AS data_ultimo_perfezionamento
        FROM {{orders}} JOIN {{lineitem}} ON o_orderkey = l_orderkey""",
    # awards ----------------------------------------------------------------
    "aggiudicazioni": f"""
        SELECT {_CIG} AS cig, {_AWARD} AS id_aggiudicazione,
               {_SHIP} AS data_aggiudicazione_definitiva,
               {_SHIP} + 10 AS data_comunicazione_esito,
               CASE WHEN l_linestatus = 'O' THEN 'AGGIUDICATA' ELSE 'DESERTA' END AS esito,
               'CRITERIO ' || l_returnflag AS criterio_aggiudicazione,
               CASE WHEN l_quantity < 2 THEN 0 ELSE round(l_extendedprice) * 30 + {_LINE_CENTS} END
                   AS importo_aggiudicazione,
               CASE WHEN l_tax = 0 THEN NULL ELSE round(l_discount * 100) END
                   AS ribasso_aggiudicazione,
               CAST(l_quantity AS INT) AS numero_offerte_ammesse,
               CAST(round(l_tax * 100) AS INT) AS numero_offerte_escluse,
               CAST(l_suppkey % 9 AS INT) AS num_imprese_offerenti,
               CASE WHEN l_suppkey % 9 = 0 THEN NULL ELSE CAST(l_suppkey % 17 AS INT) END
                   AS num_imprese_invitate,
               l_linestatus = 'O' AS flag_subappalto,
               l_tax > 0.04 AS asta_elettronica,
               CAST(l_linenumber AS INT) AS cod_esito
        FROM {{lineitem}}""",
    "raw_aggiudicazioni": f"""
        SELECT CASE WHEN l_quantity > 40 THEN '' ELSE ' ' END || {_CIG} || ' ' AS cig,
               CAST(l_linenumber AS STRING) || CASE WHEN l_tax = 0 THEN '.0' ELSE '' END
                   AS id_aggiudicazione,
               CASE WHEN l_quantity = 50 THEN '7436-02-12'
                    WHEN l_quantity = 49 THEN '213-08-24'
                    WHEN l_quantity = 48 THEN replace(CAST({_SHIP} AS STRING), '-', '/')
                    ELSE CAST({_SHIP} AS STRING) END AS data_aggiudicazione_definitiva,
               CASE WHEN l_quantity = 3 THEN '2013' ELSE CAST({_SHIP} + 10 AS STRING) END
                   AS data_comunicazione_esito,
               CASE WHEN l_quantity = 4 THEN '1e3'
                    WHEN l_quantity = 5 THEN '1.5d'
                    ELSE CAST(CAST(round(l_extendedprice) AS BIGINT) AS STRING) END
                   AS importo_aggiudicazione,
               CASE WHEN l_linestatus = 'O' THEN ' S' ELSE 'N' END AS flag_subappalto,
               CAST(l_quantity AS STRING) AS numero_offerte_ammesse,
               CASE WHEN l_quantity = 6 THEN 'tre'
                    ELSE CAST(CAST(round(l_tax * 100) AS INT) AS STRING) || '.5' END
                   AS num_imprese_offerenti,
               {_FILE_OF_LINE} AS __source_file
        FROM {{lineitem}}""",
    # firms -----------------------------------------------------------------
    "operatori": f"""
        SELECT {_CIG} AS cig, {_AWARD} AS id_aggiudicazione,
               CASE WHEN l_linenumber = 1 THEN 'MANDATARIA'
                    WHEN l_linenumber <= 5 THEN 'MANDANTE' ELSE 'MONOSOGGETTIVO' END AS ruolo,
               CASE WHEN l_tax = 0 THEN ' ' || CAST(l_suppkey AS STRING)
                    WHEN l_quantity = 50 THEN ' ' ELSE CAST(l_suppkey AS STRING) END
                   AS codice_fiscale,
               CASE WHEN l_quantity = 49 THEN 'MANDANTE'
                    WHEN l_quantity = 48 THEN NULL ELSE s_name END AS denominazione,
               CASE WHEN s_nationkey = 0 THEN 'Stazione Appaltante'
                    ELSE 'IMPRESA ' || CAST(s_nationkey % 3 AS STRING) END AS tipo_soggetto,
               'S' || CAST(l_partkey % 40 AS STRING) AS id_subappalto,
               CAST(l_partkey % 50 AS STRING) AS cf_subappaltante,
               'OG' || CAST(l_partkey % 10 AS STRING) AS cod_categoria,
               'CATEGORIA ' || CAST(l_partkey % 10 AS STRING) AS descrizione_categoria,
               'CPV ' || CAST(l_suppkey % 5 AS STRING) AS descrizione_cpv,
               {_SHIP} AS data_autorizzazione,
               l_returnflag, {_FILE_OF_LINE} AS __source_file
        FROM {{lineitem}} JOIN {{supplier}} ON l_suppkey = s_suppkey""",
    "aggiudicatari": """
        SELECT cig, id_aggiudicazione, ruolo, codice_fiscale, denominazione, tipo_soggetto
        FROM {operatori} WHERE l_returnflag <> 'R'""",
    "partecipanti": """
        SELECT cig, ruolo,
               CASE WHEN l_returnflag = 'R' AND ruolo = 'MONOSOGGETTIVO'
                    THEN 'M' || cf_subappaltante ELSE codice_fiscale END AS codice_fiscale,
               denominazione, tipo_soggetto
        FROM {operatori}""",
    "subappalti": """
        SELECT cig, id_subappalto, cf_subappaltante, data_autorizzazione, cod_categoria,
               descrizione_categoria, descrizione_cpv,
               CASE WHEN cod_categoria = 'OG3' THEN 'T' || cf_subappaltante
                    ELSE codice_fiscale END AS codice_fiscale,
               denominazione, ruolo, tipo_soggetto
        FROM {operatori} WHERE l_returnflag <> 'A'""",
    "raw_operatori": """
        SELECT CASE WHEN id_aggiudicazione % 3 = 1 THEN '' ELSE ' ' END || cig AS cig,
               CASE WHEN id_aggiudicazione = 7 THEN 'n/d'
                    ELSE CAST(id_aggiudicazione AS STRING) END AS id_aggiudicazione,
               ruolo, codice_fiscale, denominazione, tipo_soggetto, id_subappalto,
               cf_subappaltante, cod_categoria, CAST(data_autorizzazione AS STRING)
                   AS data_autorizzazione, __source_file
        FROM {operatori}""",
    "cup": """
        SELECT CAST(l_orderkey AS STRING) AS cig, 'P' || CAST(l_partkey AS STRING) AS cup
        FROM {lineitem}""",
    "raw_cup": """
        SELECT CASE WHEN l_quantity = 1 THEN '  ' ELSE ' ' || CAST(l_orderkey AS STRING) END AS cig,
               CASE WHEN l_quantity = 2 THEN NULL ELSE 'P' || CAST(l_partkey AS STRING) || ' ' END
                   AS cup
        FROM {lineitem}""",
    # execution -------------------------------------------------------------
    "avvio": f"""
        SELECT {_CIG} AS cig, {_AWARD} AS id_aggiudicazione,
               CASE WHEN l_returnflag = 'N' AND l_linenumber > 3 THEN NULL
                    ELSE {_SHIP} - 400 END AS data_stipula_contratto,
               CASE WHEN l_quantity > 40 THEN NULL
                    ELSE {_SHIP} - 400 + CAST(l_quantity AS INT) END AS data_inizio_effettiva,
               CASE WHEN l_quantity < 4 THEN NULL
                    ELSE {_SHIP} + 30 - CAST(l_quantity AS INT) END AS data_termine_contrattuale,
               l_tax > 0.06 AS consegna_sotto_riserva, l_linestatus = 'O' AS consegna_frazionata
        FROM {{lineitem}}""",
    "fine": f"""
        SELECT {_CIG} AS cig, {_AWARD} AS id_aggiudicazione,
               CASE WHEN l_linestatus = 'F' THEN {_SHIP} END AS data_effettiva_ultimazione,
               CASE WHEN l_quantity < 5 THEN {_SHIP} - 5 END AS data_conclusione_anticipata,
               CASE WHEN round(l_tax * 100) = 8 THEN 'RISOLUZIONE ' || l_returnflag END
                   AS motivo_risoluzione,
               CASE WHEN round(l_discount * 100) = 10 THEN 'INTERRUZIONE ' || l_returnflag END
                   AS motivo_interruzione_anticipata
        FROM {{lineitem}}""",
    "collaudo": f"""
        SELECT {_CIG} AS cig, {_AWARD} AS id_aggiudicazione, {_SHIP} + 20 AS data_delibera,
               CASE WHEN l_quantity > 25 THEN {_SHIP} + 60 + CAST(l_quantity AS INT) END
                   AS data_cert_collaudo,
               CASE WHEN l_tax > 0.02 THEN 'POSITIVO' END AS esito_collaudo,
               CASE WHEN l_quantity > 10 THEN round(l_extendedprice) + {_LINE_CENTS} END AS riserve_avanzate,
               round(l_extendedprice / 10) + {_LINE_CENTS} AS importo_contenz_risolto
        FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "sospensioni": f"""
        SELECT {_CIG} AS cig, {_AWARD} AS id_aggiudicazione,
               CASE WHEN l_quantity = 1 THEN NULL ELSE {_SHIP} - 30 END AS data_sospensione,
               CASE WHEN l_quantity > 46 THEN NULL WHEN l_quantity > 44 THEN {_SHIP} + 4000
                    WHEN l_quantity < 4 THEN {_SHIP} - 40
                    ELSE {_SHIP} - 30 + CAST(l_quantity AS INT) END AS data_ripresa,
               'MOTIVO ' || CAST(l_linenumber AS STRING) AS descrizione_motivo
        FROM {{lineitem}} WHERE l_returnflag <> 'N'""",
    "varianti": f"""
        SELECT l_partkey AS id_variante,
               CASE WHEN l_tax = 0 THEN NULL ELSE 'VARIANTE ' || l_returnflag END AS motivo_variante,
               CASE WHEN l_linestatus = 'O' THEN {_SHIP} END AS data_approvazione_variante,
               {_CIG} AS cig, {_AWARD} AS id_aggiudicazione,
               CASE WHEN round(l_discount * 100) > 8 THEN 'P' || {_CIG} END AS cig_proroga
        FROM {{lineitem}} WHERE l_returnflag <> 'R'""",
    # dirty text of starts, ends, suspensions, changes and acceptance tests
    "raw_esecuzione": f"""
        SELECT {_CIG} AS cig, CAST(l_linenumber AS STRING) AS id_aggiudicazione,
               CASE WHEN l_quantity = 50 THEN '0001-01-01' WHEN l_quantity = 49 THEN '2710-08-24'
                    ELSE CAST({_SHIP} - 400 AS STRING) END AS data_stipula_contratto,
               CAST({_SHIP} - 500 + CAST(l_quantity AS INT) * 300 AS STRING)
                   AS data_inizio_effettiva,
               CAST({_SHIP} - 1200 + CAST(l_quantity AS INT) * 100 AS STRING)
                   AS data_termine_contrattuale,
               CASE WHEN l_tax > 0.04 THEN ' 1' ELSE '0' END AS consegna_frazionata,
               CAST({_SHIP} AS STRING) AS data_effettiva_ultimazione,
               CASE WHEN l_tax = 0 THEN ' ' ELSE ' R ' END AS motivo_risoluzione,
               CAST(l_quantity AS STRING) AS giorni_proroga,
               CASE WHEN l_quantity = 48 THEN 'errata' ELSE CAST({_SHIP} - 30 AS STRING) END
                   AS data_sospensione,
               CAST({_SHIP} - 30 + CAST(l_quantity AS INT) AS STRING) AS data_ripresa,
               ' M' || l_linestatus AS descrizione_motivo,
               CAST(l_partkey AS STRING) AS id_variante, ' V ' AS motivo_variante,
               CAST({_SHIP} + 5 AS STRING) AS data_approvazione_variante,
               CASE WHEN l_quantity > 25 THEN CAST({_SHIP} + 60 AS STRING) END
                   AS data_cert_collaudo,
               CAST({_SHIP} + 20 AS STRING) AS data_delibera,
               CAST(round(l_extendedprice) AS STRING) AS RISERVE_AVANZATE,
               {_FILE_OF_LINE} AS __source_file
        FROM {{lineitem}}""",
    # progress statements ---------------------------------------------------
    "raw_sal": """
        SELECT CAST(user_id AS STRING) AS cig,
               CASE WHEN event_type = 'signup' THEN NULL
                    ELSE CAST(user_id * 100 + CAST(floor(day(ts) / 4) AS BIGINT) AS STRING) END
                   AS id_aggiudicazione,
               CAST(event_id AS STRING) AS progressivo_sal,
               CASE WHEN value < 0.5 THEN NULL ELSE CAST(CAST(ts AS DATE) AS STRING) END
                   AS data_emissione_sal,
               CASE WHEN value < 1 THEN 'n.d.'
                    ELSE CAST(CAST(round(value / 10) AS BIGINT) AS STRING) END AS importo_sal,
               CASE WHEN value > 40 THEN 'IN RITARDO ' ELSE 'IN LINEA' END AS flag_ritardo,
               CASE WHEN value < 5 THEN '' ELSE CAST(CAST(round(value) AS BIGINT) AS STRING) END
                   AS n_giorni_scostamento,
               CASE WHEN user_id % 5 = 0 AND event_type = 'purchase' THEN 'delta_202605.csv'
                    ELSE 'delta_202604.csv' END AS __source_file
        FROM {events}""",
    "sal": f"""
        SELECT {_CIG} AS cig,
               CASE WHEN l_linenumber = 1 THEN NULL ELSE l_orderkey * 10 + l_linenumber END
                   AS id_aggiudicazione,
               CASE WHEN l_quantity > 30 THEN 'IN RITARDO' ELSE 'IN LINEA' END AS flag_ritardo,
               CASE WHEN l_tax = 0 THEN NULL ELSE CAST(l_quantity AS INT) END
                   AS n_giorni_scostamento,
               CASE WHEN l_quantity = 1 THEN NULL ELSE {_SHIP} END AS data_emissione_sal,
               round(l_extendedprice) * 50 + {_LINE_CENTS} AS importo_sal,
               CASE WHEN l_returnflag = 'N' THEN 0 ELSE round(l_extendedprice) * 50 + {_LINE_CENTS} END
                   AS importo_quota,
               CASE l_returnflag WHEN 'A' THEN 'anomala' WHEN 'N' THEN 'monotona'
                    ELSE 'singola' END AS tipo_serie
        FROM {{lineitem}}""",
    # authorities -----------------------------------------------------------
    "stazioni": """
        SELECT CAST(c_custkey AS STRING) AS codice_fiscale, c_name AS denominazione,
               CASE WHEN c_acctbal < -500 THEN NULL ELSE c_mktsegment END AS natura_giuridica,
               CASE WHEN n_nationkey = 3 THEN ' ' WHEN n_nationkey = 4 THEN NULL ELSE n_name END
                   AS provincia,
               n_name || '-' || CAST(c_custkey % 7 AS STRING) AS citta,
               CASE WHEN c_acctbal >= 0 THEN 'ATTIVO' ELSE 'CESSATO' END AS stato
        FROM {luoghi}""",
    "raw_stazioni": """
        SELECT CASE WHEN c_acctbal > 9900 THEN ' ' ELSE ' ' || CAST(c_custkey AS STRING) END
                   AS codice_fiscale,
               CASE WHEN c_acctbal < 0 THEN '00000000000' ELSE CAST(c_custkey AS STRING) END
                   AS partita_iva,
               c_name || ' ' AS denominazione,
               CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END
                   AS natura_giuridica_descrizione,
               CASE WHEN c_acctbal > 5000 THEN 'true' ELSE 'false' END AS flag_inHouse,
               n_name AS provincia_nome, 'ATTIVO' AS stato, '2013-07-09' AS data_inizio
        FROM {luoghi}""",
    # money -----------------------------------------------------------------
    "raw_quadro": """
        SELECT CASE WHEN value < 0.2 THEN ' ' ELSE CAST(user_id AS STRING) END AS cig,
               CASE WHEN value < 0.4 THEN NULL
                    WHEN value < 3 THEN CASE event_id % 2 WHEN 0 THEN 'n/d' ELSE 'x/y' END
                    ELSE CAST(CAST(floor(day(ts) / 2) AS BIGINT) AS STRING) END AS id_aggiudicazione,
               CASE WHEN event_type IN ('purchase', 'signup') THEN NULL
                    WHEN value < 2 THEN '1901-01-01' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS data,
               CASE event_type WHEN 'purchase' THEN 'BASE_ASTA' WHEN 'signup' THEN 'CONSUNTIVO'
                    ELSE 'VARIANTE' END AS descrizione_evento,
               'D' || CAST(event_id % 3 AS STRING) AS dettaglio_evento,
               CASE WHEN event_id % 2 = 0 THEN NULL
                    ELSE CAST(CAST(round(value * 100) AS BIGINT) * 300000 AS STRING) END
                   AS importo_lavori,
               CASE WHEN event_id % 2 = 1 THEN ''
                    ELSE CAST(CAST(round(value * 100) AS BIGINT) * 300000 AS STRING) END
                   AS importo_servizi,
               CASE WHEN value > 20 THEN CAST(CAST(round(value) AS BIGINT) AS STRING) END
                   AS somme_a_disposizione,
               CASE WHEN event_type = 'error' THEN '001-delta.csv' ELSE '000-full.csv' END
                   AS __source_file
        FROM {events}""",
    "quadro": f"""
        SELECT CAST(user_id AS STRING) AS cig, CAST(floor(day(ts) / 2) AS BIGINT) AS id_aggiudicazione,
               CASE WHEN event_type IN ('purchase', 'signup') THEN NULL ELSE CAST(ts AS DATE) END
                   AS data,
               CASE event_type WHEN 'purchase' THEN 'BASE_ASTA' WHEN 'signup' THEN 'CONSUNTIVO'
                    ELSE 'VARIANTE' END AS descrizione_evento,
               'D' || CAST(event_id AS STRING) AS dettaglio_evento,
               CASE WHEN event_id % 2 = 0 THEN NULL ELSE round(value * 100) * 300000 + {_EVENT_CENTS} END
                   AS importo_lavori,
               CASE WHEN event_id % 2 = 1 THEN NULL ELSE round(value * 100) * 300000 + {_EVENT_CENTS} END
                   AS importo_servizi,
               CAST(NULL AS DOUBLE) AS importo_forniture,
               CASE WHEN value > 20 THEN round(value) END AS somme_a_disposizione
        FROM {{events}}""",
    "contratti": f"""
        SELECT {_CIG} AS cig, {_AWARD} AS id_aggiudicazione,
               sum(round(l_extendedprice)) * 100000 + 0.25 AS importo_base,
               sum(round(l_extendedprice) * (40000 + l_quantity * 3500)) AS importo_finale,
               max(l_linestatus) = 'O' AS ha_consuntivo,
               sum(round(l_extendedprice)) * 100000 >= 1e10 AS flag_base_sospetta
        FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber""",
    "raw_fonti": f"""
        SELECT {_CIG} AS cig,
               CASE WHEN l_linenumber = 1 THEN NULL ELSE CAST(l_linenumber AS STRING) END
                   AS id_aggiudicazione,
               CASE WHEN l_returnflag = 'A' THEN CAST(CAST(l_quantity AS INT) AS STRING) ELSE '0' END
                   AS entrate_con_dest_vincolata_pubblica_nazionale_regionale,
               CASE WHEN l_returnflag = 'R' THEN CAST(CAST(l_quantity AS INT) * 10 AS STRING)
                    ELSE 'n.d.' END AS mutuo,
               CASE WHEN l_linestatus = 'O'
                    THEN CAST(CAST(round(l_extendedprice) AS BIGINT) * 12000 AS STRING) ELSE '0' END
                   AS fondi_di_bilancio_della_stazione_appaltante,
               CASE WHEN l_quantity > 30 THEN '500' END AS apporto_di_capitali_privati,
               CASE WHEN round(l_tax * 100) = 3 THEN '500' ELSE '' END
                   AS entrate_con_dest_vincolata_pubblica_comunitaria,
               CASE WHEN l_tax > 0.04 THEN '001-delta.csv' ELSE '000-full.csv' END AS __source_file
        FROM {{lineitem}}""",
    "fonti": f"""
        SELECT {_CIG} AS cig, {_AWARD} AS id_aggiudicazione,
               CASE l_returnflag || l_linestatus
                    WHEN 'NO' THEN 'fondi_bilancio_sa' WHEN 'NF' THEN 'entrate_vincolate_ue'
                    WHEN 'AO' THEN 'mutuo' WHEN 'AF' THEN 'entrate_vincolate_statali'
                    WHEN 'RO' THEN 'capitali_privati' ELSE 'altro' END AS fonte,
               round(l_extendedprice) * 60000 + {_LINE_CENTS} AS importo
        FROM {{lineitem}} WHERE l_quantity > 10""",
}
