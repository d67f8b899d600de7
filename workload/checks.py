"""The quality rules on the derived and given tables."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tenderlake.plans import quality
from tenderlake.session import scratch_path
from tenderlake.sources import versions
from tenderlake.sources.layers import write_table

from .registry import query

_AWARD = ["cig", "id_aggiudicazione"]


@query(
    "duplicate_keys",
    """
    SELECT cig, id_aggiudicazione, count(*) AS n FROM {aggiudicazioni} GROUP BY ALL HAVING count(*) > 1
    """,
)
def duplicate_keys(t):
    return quality.duplicate_keys(t.aggiudicazioni, _AWARD)


@query(
    "duplicate_keys_per_year",
    """
    SELECT CAST(year(data_aggiudicazione_definitiva) AS INT) AS anno, cig, id_aggiudicazione,
           count(*) AS n
    FROM {aggiudicazioni} GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_keys_per_year(t):
    years = t.aggiudicazioni.withColumn("anno", F.year("data_aggiudicazione_definitiva"))
    return quality.duplicate_keys(years, _AWARD, "anno")


@query(
    "keys_in_several_years",
    """
    WITH a AS (SELECT *, CAST(year(data_aggiudicazione_definitiva) AS INT) AS y FROM {aggiudicazioni})
    SELECT cig, id_aggiudicazione, min(y) AS primo_anno, max(y) AS ultimo_anno
    FROM a GROUP BY 1, 2 HAVING count(DISTINCT y) > 1""",
)
def keys_in_several_years(t):
    years = t.aggiudicazioni.withColumn("anno", F.year("data_aggiudicazione_definitiva"))
    return quality.keys_in_several_years(years, _AWARD, "anno")


_CHECKED = ["cig", "data_stipula_contratto", "data_inizio_effettiva", "data_termine_contrattuale"]


@query(
    "null_shares",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS colonna, count(*) AS righe, count(*) - count({c}) AS n_null,
                   (count(*) - count({c})) / count(*) AS quota_null FROM {{avvio}}"""
        for c in _CHECKED
    ),
)
def null_shares(t):
    return quality.null_counts(t.avvio, _CHECKED)


@query(
    "date_bounds",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS colonna, CAST(max({c}) AS VARCHAR) AS max,
                   count(*) FILTER (year({c}) < 1990) AS ante_1990,
                   count(*) FILTER (year({c}) > 2000) AS future FROM {{avvio}}"""
        for c in _CHECKED[1:]
    ),
)
def date_bounds(t):
    return quality.date_bounds(t.avvio, _CHECKED[1:], 2000)


_RULES = quality.Rules(
    required=["cig", "colonna_mancante"],
    key=_AWARD,
    not_null=_AWARD,
    max_null={"data_inizio_effettiva": 0.05, "data_termine_contrattuale": 0.5},
    dates=["data_stipula_contratto", "data_termine_contrattuale"],
    min_rows=10,
)


_AUDIT = """
    WITH a AS (SELECT *, CAST(year(data_termine_contrattuale) AS INT) AS anno FROM {avvio}),
    k AS (SELECT anno, cig, id_aggiudicazione, count(*) AS n FROM a GROUP BY ALL),
    y AS (SELECT cig, id_aggiudicazione, count(DISTINCT anno) AS n FROM a GROUP BY 1, 2),
    r AS (
        SELECT 'errore' AS livello, 'colonna_assente' AS regola, 'colonna_mancante' AS oggetto, 1.0 AS valore
        UNION ALL SELECT 'errore', 'valori_null', 'data_inizio_effettiva',
               CASE WHEN count(*) - count(data_inizio_effettiva) > 0.05 * count(*)
                    THEN count(*) - count(data_inizio_effettiva) END FROM a
        UNION ALL SELECT 'errore', 'valori_null', 'data_termine_contrattuale',
               CASE WHEN count(*) - count(data_termine_contrattuale) > 0.5 * count(*)
                    THEN count(*) - count(data_termine_contrattuale) END FROM a
        UNION ALL SELECT 'errore', 'date_ante_1990', 'data_stipula_contratto',
               count(*) FILTER (year(data_stipula_contratto) < 1990) FROM a
        UNION ALL SELECT 'avviso', 'date_future', 'data_stipula_contratto',
               count(*) FILTER (year(data_stipula_contratto) > 2000) FROM a
        UNION ALL SELECT 'avviso', 'date_future', 'data_termine_contrattuale',
               count(*) FILTER (year(data_termine_contrattuale) > 2000) FROM a
        UNION ALL SELECT 'errore', 'chiavi_duplicate', 'cig, id_aggiudicazione',
               count(*) FROM k WHERE n > 1
        UNION ALL SELECT 'avviso', 'chiavi_in_piu_anni', 'cig, id_aggiudicazione',
               count(*) FROM y WHERE n > 1)
    SELECT 'avvio_contratto' AS tabella, livello, regola, oggetto, CAST(valore AS DOUBLE) AS valore
    FROM r WHERE valore > 0"""


@query("audit_report", _AUDIT)
def audit_report(t):
    starts = t.avvio.withColumn("anno", F.year("data_termine_contrattuale"))
    return quality.audit(starts, "avvio_contratto", _RULES, "anno", date(2000, 6, 1))


@query("audit_while_writing", _AUDIT)
def audit_while_writing(t):
    """The same report from what was measured while the table was written; only the keys are
    read again."""
    starts, day = t.avvio.withColumn("anno", F.year("data_termine_contrattuale")), date(2000, 6, 1)
    path = scratch_path(t.spark, "avvio")
    staged = versions.stage(starts, path, "anno", quality.measures(starts, _RULES, day))
    return quality.audit(staged.rows, "avvio_contratto", _RULES, "anno", day, measured=staged.measured)


@query(
    "rejected_build_keeps_rows",
    """
    SELECT anno_pubblicazione, count(*) AS n, sum(importo_lotto) AS importo, 1 AS versione
    FROM {bandi} GROUP BY 1""",
)
def rejected_build_keeps_rows(t):
    """A published table, then a new write of it with every lot twice: the key rule rejects
    it, and readers still see the version before."""
    path, rules = scratch_path(t.spark, "bandi"), quality.Rules(key=["cig"], not_null=["cig"])

    def check(staged):
        quality.validate(quality.audit(staged.rows, "bandi_gara", rules, measured=staged.measured))

    def write(rows):
        versions.replace(rows, path, check, part="anno_pubblicazione", measures=quality.measures(rows, rules))

    write(t.bandi)
    rejected = False
    try:
        write(t.bandi.unionByName(t.bandi))
    except quality.QualityError:
        rejected = True
    assert rejected
    return (
        versions.read_version(t.spark, path)
        .groupBy("anno_pubblicazione")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("importo_lotto").alias("importo"))
        .withColumn("versione", F.lit(versions.version_of(t.spark, path)))
    )


@query(
    "min_rows_and_columns",
    """
    SELECT 'stazioni_appaltanti' AS tabella, 'errore' AS livello, 'colonna_assente' AS regola,
           'codice_ausa' AS oggetto, CAST(1 AS DOUBLE) AS valore
    UNION ALL
    SELECT 'stazioni_appaltanti', 'errore', 'righe_minime', '1000000',
           CAST(1000000 - count(*) AS DOUBLE) FROM {stazioni}""",
)
def min_rows_and_columns(t):
    rules = quality.Rules(required=["codice_fiscale", "codice_ausa"], min_rows=1_000_000)
    return quality.audit(t.stazioni, "stazioni_appaltanti", rules)


@query(
    "schema_drift",
    """
    SELECT o_orderstatus AS anno, count(*) AS righe,
           CASE WHEN o_orderstatus = 'P' THEN 'o_totalprice: double -> string' END AS deriva
    FROM {orders} GROUP BY o_orderstatus""",
)
def schema_drift(t):
    """Three stored partitions of the orders, one with another type; the check finds it."""
    root = scratch_path(t.spark, "drift")
    types = {"F": "double", "O": "double", "P": "string"}
    for status, kind in types.items():
        part = t.orders.where(F.col("o_orderstatus") == status)
        write_table(part.withColumn("o_totalprice", F.col("o_totalprice").cast(kind)), f"{root}/{status}")
    drift = quality.schema_drift(t.spark, {s: f"{root}/{s}" for s in types})
    parts = [
        t.spark.read.parquet(f"{root}/{s}").agg(F.count(F.lit(1)).alias("righe")).select(
            F.lit(s).alias("anno"),
            "righe",
            F.lit("; ".join(drift[s]) if s in drift else None).cast("string").alias("deriva"),
        )
        for s in types
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("freshness", "SELECT count(*) AS righe, 0 AS giorni FROM {bandi}")
def freshness(t):
    path = scratch_path(t.spark, "bandi")
    write_table(t.bandi, path, "anno_pubblicazione")
    rows = t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("righe"))
    return rows.withColumn("giorni", quality.freshness(t.spark, path).select("giorni").scalar())
