"""The reading-time questions on the derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tenderlake.plans import cross, execution, tenders
from tenderlake.operators import search
from tenderlake.plans import questions as Q
from tenderlake.session import scratch_path
from tenderlake.sources import catalog, versions

from .cross import COMPETITIVITA, CONTRATTO, ESECUZIONE, IMPRESE, RITARDI
from .registry import query

_TRUSTED = "stato = 'ATTIVO' AND NOT flag_importo_sospetto"

_OVERVIEW = f"""
    SELECT anno_pubblicazione AS anno, count(DISTINCT cig) AS n_cig, count(*) AS n_lotti,
           round(sum(importo_lotto), 0) AS importo_totale,
           count(DISTINCT cf_amministrazione_appaltante) AS n_stazioni_appaltanti,
           count(*) FILTER (flag_pnrr) AS n_pnrr,
           round(coalesce(sum(importo_lotto) FILTER (flag_pnrr), 0), 0) AS importo_pnrr,
           count(*) FILTER (esito = 'AGGIUDICATA') AS n_aggiudicati,
           round(coalesce(sum(importo_lotto) FILTER (esito = 'AGGIUDICATA'), 0), 0)
               AS importo_aggiudicati,
           count(DISTINCT oggetto_principale_contratto) AS n_settori
    FROM {{bandi}} WHERE {_TRUSTED} AND oggetto_principale_contratto IS NOT NULL
      AND sezione_regionale IS NOT NULL GROUP BY 1"""


@query("yearly_overview", _OVERVIEW)
def yearly_overview(t):
    return Q.yearly_overview(t.bandi)


def _stored(t, name: str, rows):
    return versions.replace(rows, scratch_path(t.spark, name))


def _overview_mart(t):
    values = _stored(t, "overview_values", Q.overview_values(t.bandi))
    return (
        _stored(t, "overview_cells", Q.overview_cells(t.bandi)),
        _stored(t, "overview_bitmaps", Q.overview_bitmaps(t.bandi, values)),
    )


@query("yearly_overview_from_bitmaps", _OVERVIEW)
def yearly_overview_from_bitmaps(t):
    """The same figures from the stored cells alone."""
    return Q.overview_by(*_overview_mart(t), ["anno"])


@query(
    "region_overview_from_bitmaps",
    _OVERVIEW.replace("anno_pubblicazione AS anno", "sezione_regionale AS regione"),
)
def region_overview_from_bitmaps(t):
    """Another grouping of the same cells."""
    return Q.overview_by(*_overview_mart(t), ["regione"])

@query(
    "execution_funnel",
    """
    SELECT gare.*, lavori.* FROM
      (SELECT count(*) AS n_bandi,
              round(sum(CASE WHEN flag_importo_sospetto THEN 0 ELSE importo_lotto END) / 1e9, 1) AS importo_mld,
              sum(CAST(esito IS NOT DISTINCT FROM 'AGGIUDICATA' AS INT))::BIGINT AS n_aggiudicati,
              round(sum(importo_lotto) FILTER (NOT flag_importo_sospetto AND esito = 'AGGIUDICATA') / 1e9, 1)
                  AS importo_agg_mld,
              sum(CAST(coalesce(esito, '') = '' AS INT))::BIGINT AS n_senza_esito
       FROM {bandi} WHERE (stato, anno_pubblicazione) = ('ATTIVO', 1998)) gare,
      (SELECT count(*) AS n_sal, round(sum(importo_quota) / 1e9, 1) AS importo_sal_mld,
              count(*) FILTER (tardi) AS n_ritardi,
              round(coalesce(sum(importo_quota) FILTER (serie_tardi), 0) / 1e9, 1) AS importo_ritardi_mld
       FROM (SELECT importo_quota, flag_ritardo = 'IN RITARDO' AS tardi,
                    bool_or(flag_ritardo = 'IN RITARDO') OVER (
                        PARTITION BY id_aggiudicazione, CASE WHEN id_aggiudicazione IS NULL THEN cig END)
                        AS serie_tardi
             FROM {sal} WHERE data_emissione_sal >= DATE '1998-01-01'
               AND data_emissione_sal < DATE '1999-01-01')) lavori""",
)
def execution_funnel(t):
    return Q.execution_funnel(t.bandi, t.sal, 1998)

@query(
    "late_trend",
    """
    SELECT CAST(year(data_emissione_sal) AS INT) AS anno, count(*) AS totale,
           count(*) FILTER (flag_ritardo = 'IN RITARDO') AS in_ritardo,
           round(count(*) FILTER (flag_ritardo = 'IN RITARDO') * 100.0 / count(*), 1) AS pct_ritardo
    FROM {sal} WHERE year(data_emissione_sal) BETWEEN 1996 AND 2026 GROUP BY 1""",
)
def late_trend(t):
    return Q.late_trend(execution.mart_sal(t.sal, (1995, 2026)), 1996)

def _late_by_authority(t):
    return cross.mart_ritardi_per_sa(t.sal, t.per_cig)

@query(
    "late_by_sector",
    f"""
    WITH {RITARDI}
    SELECT settore, CAST(sum(n_ritardi) AS BIGINT) AS n_ritardi, sum(importo_ritardo_totale) AS importo
    FROM ritardi_sa GROUP BY settore""",
)
def late_by_sector(t):
    return Q.late_by_sector(_late_by_authority(t))

@query(
    "top_late_authorities",
    f"""
    WITH {RITARDI}
    SELECT * FROM ritardi_sa
    ORDER BY n_ritardi DESC, sa, settore NULLS FIRST, regione NULLS FIRST LIMIT 20""",
)
def top_late_authorities(t):
    return Q.top_late_authorities(_late_by_authority(t), "n_ritardi")

@query(
    "top_overdue_authorities",
    f"""
    WITH {CONTRATTO}
    SELECT * FROM ritardi_contratto
    ORDER BY n_in_ritardo DESC, sa, settore NULLS FIRST, regione NULLS FIRST LIMIT 20""",
)
def top_overdue_authorities(t):
    mart = cross.mart_ritardi_contratto(t.per_cig, t.avvio, t.fine)
    return Q.top_late_authorities(mart, "n_in_ritardo")

def _execution(t):
    return cross.mart_esecuzione(
        t.per_cig, t.aggiudicazioni, t.avvio, t.fine, t.sospensioni, t.varianti
    )

@query(
    "execution_kpis",
    f"""
    WITH {ESECUZIONE},
    w AS (SELECT *, CASE WHEN giorni_medi_scostamento_termine IS NOT NULL THEN n_con_ultimazione END AS w1,
                 CASE WHEN giorni_medi_aggiudicazione_stipula IS NOT NULL THEN n_con_stipula END AS w2
          FROM esecuzione)
    SELECT CAST(sum(n_contratti) AS BIGINT) AS n_contratti,
           CAST(sum(n_con_ultimazione) AS BIGINT) AS n_con_ultimazione,
           CAST(sum(n_in_ritardo) AS BIGINT) AS n_in_ritardo,
           sum(giorni_medi_scostamento_termine * w1) / nullif(sum(w1), 0) AS giorni_scostamento,
           sum(giorni_medi_aggiudicazione_stipula * w2) / nullif(sum(w2), 0)
               AS giorni_aggiudicazione_stipula,
           round(sum(n_in_ritardo) * 100.0 / sum(n_con_ultimazione), 1) AS pct_ritardo
    FROM w""",
)
def execution_kpis(t):
    return Q.execution_kpis(_execution(t))

@query(
    "overdue_trend",
    f"""
    WITH {ESECUZIONE}
    SELECT anno, CAST(sum(n_con_ultimazione) AS BIGINT) AS n_con_ultimazione,
           CAST(sum(n_in_ritardo) AS BIGINT) AS n_in_ritardo,
           round(sum(n_in_ritardo) * 100.0 / nullif(sum(n_con_ultimazione), 0), 1) AS pct_ritardo
    FROM esecuzione GROUP BY anno""",
)
def overdue_trend(t):
    return Q.overdue_trend(_execution(t))

@query(
    "consortia",
    """
    WITH m AS (SELECT cig, count(DISTINCT codice_fiscale) AS n_mandanti
               FROM {partecipanti} WHERE ruolo = 'MANDANTE' GROUP BY cig
               HAVING count(DISTINCT codice_fiscale) >= 2),
    l AS (SELECT cig, codice_fiscale AS cf_mandataria, max(denominazione) AS mandataria
          FROM {partecipanti} WHERE ruolo = 'MANDATARIA' GROUP BY 1, 2)
    SELECT l.*, n_mandanti FROM l JOIN m USING (cig)""",
)
def consortia(t):
    return Q.consortia(t.partecipanti)

@query(
    "consortia_members",
    """
    SELECT DISTINCT cig, denominazione FROM {partecipanti} p
    WHERE ruolo = 'MANDANTE' AND denominazione IS NOT NULL
      AND EXISTS (SELECT 1 FROM {partecipanti} x WHERE x.cig = p.cig AND x.ruolo = 'MANDATARIA')
      AND (SELECT count(DISTINCT y.codice_fiscale) FROM {partecipanti} y
           WHERE y.cig = p.cig AND y.ruolo = 'MANDANTE') >= 2""",
)
def consortia_members(t):
    return Q.consortia_members(t.partecipanti)

@query(
    "members_of_named_lots",
    """
    SELECT cig, string_agg(DISTINCT denominazione, ' | ' ORDER BY denominazione) AS nomi
    FROM {partecipanti} WHERE cig IN ('5979', '7', '33') AND denominazione IS NOT NULL GROUP BY cig""",
)
def members_of_named_lots(t):
    return Q.names_of(t.partecipanti, "cig", "denominazione", ["5979", "7", "33"], "nomi")

@query(
    "subcontract_receivers",
    """
    SELECT denominazione, count(*) AS n_subappalti, count(DISTINCT cig) AS n_cig,
           count(DISTINCT cf_subappaltante) AS n_imprese_committenti
    FROM {subappalti} WHERE denominazione <> '' GROUP BY 1""",
)
def subcontract_receivers(t):
    return Q.subcontract_receivers(t.subappalti)

def _firms(t):
    return cross.mart_imprese(t.aggiudicatari, t.partecipanti, t.subappalti, ordered=False)

@query(
    "role_distribution",
    f"""
    WITH {IMPRESE}
    SELECT ruolo_prevalente AS ruolo, count(*) AS n_imprese FROM profili GROUP BY 1""",
)
def role_distribution(t):
    return Q.role_distribution(_firms(t))

@query(
    "firm_counts",
    f"""
    WITH {IMPRESE}
    SELECT count(*) AS imprese, count(*) FILTER (n_aggiudicazioni > 0) AS aggiudicatari,
           count(*) FILTER (n_gare_partecipate > 0) AS partecipanti,
           count(*) FILTER (n_subappalti > 0) AS subappaltanti
    FROM profili""",
)
def firm_counts(t):
    return Q.firm_counts(_firms(t))

@query("top_firms", f"WITH {IMPRESE} SELECT * FROM profili ORDER BY totale_attivita DESC, cf LIMIT 20")
def top_firms(t):
    return Q.top_firms(_firms(t))

@query(
    "top_firms_of_role",
    f"""
    WITH {IMPRESE}
    SELECT * FROM profili WHERE ruolo_prevalente = 'aggiudicatario'
    ORDER BY totale_attivita DESC, cf LIMIT 100""",
)
def top_firms_of_role(t):
    return Q.top_firms(_firms(t), 100, "aggiudicatario")

@query(
    "market_concentration",
    f"""
    WITH {IMPRESE},
    top AS (SELECT cf, denominazione, n_aggiudicazioni FROM profili WHERE n_aggiudicazioni > 0
            ORDER BY n_aggiudicazioni DESC, cf LIMIT 20),
    q AS (SELECT *, round(n_aggiudicazioni * 100.0
                          / (SELECT sum(n_aggiudicazioni) FROM profili), 2) AS pct_mercato FROM top)
    SELECT *, round(sum(pct_mercato) OVER (ORDER BY n_aggiudicazioni DESC, cf
                                           ROWS UNBOUNDED PRECEDING), 2) AS cum_pct
    FROM q""",
)
def market_concentration(t):
    return Q.market_concentration(_firms(t))

@query(
    "procedure_mix",
    f"""
    SELECT tipo_scelta_contraente AS tipo, count(*) AS n, round(sum(importo_lotto) / 1e9, 1) AS mld
    FROM {{bandi}} WHERE {_TRUSTED} GROUP BY 1 ORDER BY n DESC, tipo LIMIT 10""",
)
def procedure_mix(t):
    return Q.procedure_mix(t.bandi)

_SHORT = """
    corte AS (SELECT *, trim(replace(regione, 'SEZIONE REGIONALE ', '')) AS regione_short
              FROM competitivita),
    ammesse AS (SELECT * FROM corte WHERE regione_short NOT IN ('CENTRALE', 'NON CLASSIFICATO'))"""

def _competition(t):
    return cross.mart_competitivita(t.bandi, t.aggiudicazioni)

@query(
    "top_regions",
    f"""
    WITH {COMPETITIVITA}, {_SHORT}
    SELECT * FROM ammesse WHERE anno = 1998 ORDER BY importo_totale DESC, regione_short LIMIT 10""",
)
def top_regions(t):
    return Q.top_regions(_competition(t), 1998)

@query(
    "top_region_trend",
    f"""
    WITH {COMPETITIVITA}, {_SHORT},
    top AS (SELECT regione_short FROM ammesse GROUP BY 1
            ORDER BY sum(importo_totale) DESC, regione_short LIMIT 3)
    SELECT anno, regione_short, importo_totale FROM ammesse
    WHERE regione_short IN (SELECT regione_short FROM top)""",
)
def top_region_trend(t):
    return Q.top_region_trend(_competition(t), 3)

_YEARS = range(1995, 2002)

@query(
    "region_year_matrix",
    f"""
    WITH {COMPETITIVITA}, {_SHORT}
    SELECT regione_short, {", ".join(
        f'coalesce(sum(importo_totale) FILTER (anno = {y}), 0) AS "{y}"' for y in _YEARS)}
    FROM ammesse GROUP BY 1""",
)
def region_year_matrix(t):
    return Q.region_year_matrix(_competition(t), list(_YEARS))

_LOOKUP = {
    "bandi": "bandi",
    "aggiudicazioni": "aggiudicazioni",
    "aggiudicatari": "aggiudicatari",
    "partecipanti": "partecipanti",
    "subappalti": "subappalti",
    "cup": "cup",
    "sal": "sal",
    "collaudo": "collaudo",
}

@query(
    "lookup_lots",
    " UNION ALL BY NAME ".join(
        f"""(SELECT '{name}' AS tabella, cig, count(*) AS n_righe FROM {{{table}}}
             WHERE cig IN (SELECT cig FROM {{bandi}} WHERE flag_importo_sospetto) GROUP BY cig)"""
        for name, table in _LOOKUP.items()
    ),
)
def lookup_lots(t):
    """Every table's rows about the lots under suspicion."""
    tables = {name: getattr(t, table) for name, table in _LOOKUP.items()} | {"region": t.region}
    return Q.lookup_counts(tables, t.bandi.where("flag_importo_sospetto").select("cig").distinct())

_ONE_LOT = " UNION ALL BY NAME ".join(
    f"SELECT '{name}' AS tabella, cig, count(*) AS n_righe FROM {{{table}}} WHERE cig = '5979' GROUP BY cig"
    for name, table in _LOOKUP.items()
)

@query("lookup_one_lot", _ONE_LOT)
def lookup_one_lot(t):
    tables = {name: getattr(t, table) for name, table in _LOOKUP.items()}
    return Q.lookup_counts(tables, [" 5979 "])

@query("lookup_one_lot_published", _ONE_LOT)
def lookup_one_lot_published(t):
    """From published tables: the scans get the stored values as a filter."""
    tables, spelled = {}, {}
    for name, table in _LOOKUP.items():
        rows = getattr(t, table)
        tables[name] = versions.replace(rows, scratch_path(t.spark, name), bloom=["cig"])
        spelled[name] = _stored(t, f"{name}_spellings", Q.spellings(tables[name]))
    return Q.counted_rows(Q.lookup_published(tables, [" 5979 "], spelled))

def _lookup_rows(name: str, table: str) -> None:
    @query(
        f"lookup_lots_{name}",
        f"SELECT * FROM {{{table}}} WHERE cig IN (SELECT cig FROM {{bandi}} WHERE flag_importo_sospetto)",
        dates=True,
    )
    def rows(t):
        suspect = t.bandi.where("flag_importo_sospetto").select("cig")
        return Q.lookup_cigs({name: getattr(t, table)}, suspect)[name]

for _name, _table in _LOOKUP.items():
    _lookup_rows(_name, _table)

@query(
    "lookup_in_any_case",
    "SELECT 'Lot' || cig AS cig, importo_lotto, stato FROM {bandi} WHERE cig IN ('5979', '7', '33')",
)
def lookup_in_any_case(t):
    lots = t.bandi.select(F.concat(F.lit("Lot"), "cig").alias("cig"), "importo_lotto", "stato")
    return Q.lookup_cigs({"bandi": lots}, ["lot5979", " LOT7", "Lot33 "])["bandi"]

@query(
    "lookup_in_any_case_published",
    """
    SELECT CASE WHEN cig = '7' THEN 'LOT' ELSE 'Lot' END || cig AS cig, importo_lotto, stato FROM {bandi}
    WHERE cig IN ('5979', '7', '33')""",
)
def lookup_in_any_case_published(t):
    written = F.when(F.col("cig") == "7", F.concat(F.lit("LOT"), "cig")).otherwise(F.concat(F.lit("Lot"), "cig"))
    lots = t.bandi.select(written.alias("cig"), "importo_lotto", "stato")
    lots = versions.replace(lots, scratch_path(t.spark, "lots"), bloom=["cig"])
    spelled = _stored(t, "spellings", Q.spellings(lots))
    return Q.lookup_published({"bandi": lots}, ["lot5979", " LOT7", "Lot33 "], {"bandi": spelled})["bandi"]

_CARD = """
    SELECT DISTINCT cig, denominazione_amministrazione_appaltante AS sa, oggetto_gara, importo_lotto,
           anno_pubblicazione AS anno FROM {bandi}"""

_SEARCH = f"""
    {_CARD} WHERE upper(denominazione_amministrazione_appaltante) LIKE '%MER#00000000%'
    ORDER BY importo_lotto DESC, cig LIMIT 50"""

@query("search_authority", _SEARCH)
def search_authority(t):
    return Q.search_authority(t.bandi, " mer#00000000 ")

@query("search_authority_indexed", _SEARCH)
def search_authority_indexed(t):
    """Through the postings of the authorities' names."""
    index = scratch_path(t.spark, "authorities")
    search.write_index(t.bandi, "denominazione_amministrazione_appaltante", index)
    return Q.search_authority_indexed(t.spark, t.bandi, index, " mer#00000000 ")

@query(
    "search_profiles",
    f"""
    SELECT cf_amministrazione_appaltante AS cf_sa, count(*) AS n_bandi FROM {{bandi}}
    WHERE {_TRUSTED} AND cf_amministrazione_appaltante <> ''
      AND upper(denominazione_amministrazione_appaltante) LIKE '%#0000001%'
    GROUP BY 1 HAVING count(*) >= 10""",
)
def search_profiles(t):
    return Q.search_profiles(tenders.mart_sa_profilo(t.bandi), "#0000001").select("cf_sa", "n_bandi")

@query("top_lots", f"{_CARD} WHERE importo_lotto IS NOT NULL ORDER BY importo_lotto DESC, cig LIMIT 20")
def top_lots(t):
    return Q.top_lots(t.bandi)

# --- ready-made SQL ---------------------------------------------------------

@query("sql_row_count", "SELECT count(*) AS n FROM {bandi}")
def sql_row_count(t):
    return catalog.run_template(t.spark, "conta_righe", t.bandi)

@query("sql_preview", "SELECT * FROM {bandi} ORDER BY cig LIMIT 10", dates=True)
def sql_preview(t):
    return catalog.preview(t.bandi, ["cig"])

@query(
    "sql_columns",
    "SELECT column_name AS colonna, (SELECT count(*) FROM {bandi}) AS n FROM (DESCRIBE SELECT * FROM {bandi})",
)
def sql_columns(t):
    return catalog.columns(t.bandi)

@query(
    "sql_top_authorities",
    """
    SELECT denominazione_amministrazione_appaltante AS sa, count(*) AS n_bandi,
           round(sum(importo_lotto), 0) AS importo_totale
    FROM {bandi} WHERE cf_amministrazione_appaltante IS NOT NULL
    GROUP BY 1 ORDER BY importo_totale DESC, sa LIMIT 20""",
)
def sql_top_authorities(t):
    return catalog.run_template(t.spark, "top_sa_per_importo", t.bandi)

@query(
    "sql_yearly_trend",
    """
    SELECT anno_pubblicazione AS anno, count(*) AS n_bandi,
           round(sum(importo_lotto), 0) AS importo_totale FROM {bandi} GROUP BY 1""",
)
def sql_yearly_trend(t):
    return catalog.run_template(t.spark, "trend_annuale", t.bandi)

@query(
    "sql_single_bidder",
    """
    SELECT cig, importo_aggiudicazione, num_imprese_offerenti FROM {aggiudicazioni}
    WHERE num_imprese_offerenti = 1 AND importo_aggiudicazione > 1000000
    ORDER BY importo_aggiudicazione DESC, cig LIMIT 20""",
)
def sql_single_bidder(t):
    return catalog.run_template(t.spark, "un_solo_offerente", t.aggiudicazioni)

@query(
    "sql_late_statements",
    """
    SELECT cig, n_giorni_scostamento, importo_sal FROM {sal} WHERE flag_ritardo = 'IN RITARDO'
    ORDER BY n_giorni_scostamento DESC NULLS LAST, cig, importo_sal LIMIT 20""",
)
def sql_late_statements(t):
    return catalog.run_template(t.spark, "sal_in_ritardo", t.sal)

@query(
    "adhoc_sql_over_views",
    """
    SELECT ruolo, count(DISTINCT a.cig) AS n_lotti, sum(importo_lotto) AS importo
    FROM (SELECT DISTINCT cig, ruolo FROM {aggiudicatari}) a JOIN {bandi} b ON a.cig = b.cig
    GROUP BY ruolo""",
)
def adhoc_sql_over_views(t):
    catalog.register({"v_aggiudicatari": t.aggiudicatari, "v_bandi": t.bandi})
    return t.spark.sql(
        """
        SELECT a.ruolo, count(DISTINCT a.cig) AS n_lotti, sum(b.importo_lotto) AS importo
        FROM (SELECT DISTINCT cig, ruolo FROM v_aggiudicatari) a JOIN v_bandi b ON a.cig = b.cig
        GROUP BY a.ruolo"""
    )

