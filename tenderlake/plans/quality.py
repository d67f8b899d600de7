"""Checks on clean tables and marts. A check is a one- or few-row frame, computed in one pass."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import not_blank
from ..sources.layers import layouts
from ..sources.versions import changed, layout_changes

MIN_YEAR = 1990
MAX_AGE_DAYS = 40
ERROR, WARNING, NOTE = "errore", "avviso", "nota"


@dataclass(frozen=True)
class Rules:
    """What a table promises."""

    required: list[str] = field(default_factory=list)
    key: list[str] = field(default_factory=list)
    not_null: list[str] = field(default_factory=list)
    max_null: dict[str, float] = field(default_factory=dict)
    dates: list[str] = field(default_factory=list)
    min_rows: int = 1


_AWARD = ["cig", "id_aggiudicazione"]

# Promises of the clean tables; fixed values.
CLEAN_RULES = {
    "bandi_gara": Rules(
        required=["cig", "anno_pubblicazione", "importo_lotto", "stato"],
        key=["cig"],
        not_null=["cig"],
        dates=["data_pubblicazione", "data_scadenza_offerta"],
    ),
    "aggiudicazioni": Rules(
        required=_AWARD,
        key=_AWARD,
        not_null=_AWARD,
        dates=["data_aggiudicazione_definitiva", "data_comunicazione_esito"],
    ),
    "aggiudicatari": Rules(required=_AWARD, key=[*_AWARD, "codice_fiscale"], not_null=_AWARD),
    "partecipanti": Rules(required=["cig"], not_null=["cig"]),
    "subappalti": Rules(
        required=["cig"],
        key=["cig", "id_subappalto", "cod_categoria", "codice_fiscale"],
        not_null=["cig"],
        dates=["data_autorizzazione"],
    ),
    "avvio_contratto": Rules(
        required=_AWARD,
        key=_AWARD,
        not_null=_AWARD,
        dates=["data_stipula_contratto", "data_inizio_effettiva"],
    ),
    "fine_contratto": Rules(
        required=_AWARD, key=_AWARD, not_null=_AWARD, dates=["data_effettiva_ultimazione"]
    ),
    "sospensioni": Rules(
        required=["cig"],
        key=[*_AWARD, "data_sospensione", "descrizione_motivo"],
        not_null=["cig"],
        dates=["data_sospensione", "data_ripresa"],
    ),
    "varianti": Rules(
        required=["cig"],
        key=[*_AWARD, "id_variante", "cod_motivo_variante", "data_approvazione_variante"],
        not_null=["cig"],
        dates=["data_approvazione_variante"],
    ),
    "collaudo": Rules(
        required=_AWARD, key=_AWARD, not_null=_AWARD, dates=["data_cert_collaudo", "data_delibera"]
    ),
    "stati_avanzamento": Rules(
        required=_AWARD,
        key=[*_AWARD, "progressivo_sal"],
        not_null=_AWARD,
        dates=["data_emissione_sal", "data_cert_pagamento"],
    ),
    "cup": Rules(required=["cig", "cup"], key=["cig", "cup"], not_null=["cig", "cup"]),
    "stazioni_appaltanti": Rules(
        required=["codice_fiscale"],
        key=["codice_fiscale"],
        not_null=["codice_fiscale"],
        max_null={
            "denominazione": 0.001,
            "natura_giuridica": 0.01,
            "codice_ausa": 0.001,
            "indirizzo": 0.02,
            "cap": 0.02,
            "citta": 0.02,
            "provincia": 0.10,
        },
        dates=["data_inizio"],
    ),
    "quadro_economico": Rules(
        required=[*_AWARD, "descrizione_evento", "importo_lavori", "somme_a_disposizione"],
        key=[*_AWARD, "descrizione_evento", "dettaglio_evento"],
        not_null=[*_AWARD, "descrizione_evento"],
        dates=["data"],
    ),
    "fonti_finanziamento": Rules(
        required=[*_AWARD, "fondi_bilancio_sa", "totale_fonti"],
        not_null=["cig"],
        max_null={"fonte_prevalente": 0.30},
    ),
}

# Minimum rows (and keys) of the marts; fixed values.
MART_RULES = {
    "bandi_gara": {
        "mart_annuale": Rules(),
        "mart_trend_pnrr": Rules(min_rows=10),
        "mart_sa_profilo": Rules(min_rows=100),
    },
    "aggiudicazioni": {
        "mart_annuale": Rules(min_rows=100),
        "mart_dettaglio": Rules(min_rows=100_000),
    },
    "aggiudicatari": {"mart_top_aggiudicatari": Rules()},
    "partecipanti": {"mart_top_partecipanti": Rules()},
    "subappalti": {"mart_top_subappalti": Rules()},
    "avvio_contratto": {"mart_avvio_contratto": Rules(min_rows=10)},
    "fine_contratto": {"mart_fine_contratto": Rules(min_rows=10), "mart_motivi_fine": Rules()},
    "sospensioni": {"mart_sospensioni": Rules(min_rows=10)},
    "varianti": {"mart_varianti": Rules(min_rows=10)},
    "collaudo": {"mart_collaudo": Rules()},
    "stati_avanzamento": {"mart_sal": Rules()},
    "cup": {"mart_cup": Rules(key=["cup"])},
    "stazioni_appaltanti": {
        "mart_natura": Rules(key=["natura_giuridica"], min_rows=3),
        "mart_territorio": Rules(key=["provincia"], min_rows=20),
    },
    "quadro_economico": {
        "mart_cig": Rules(key=["cig", "id_aggiudicazione"]),
        "mart_eventi": Rules(key=["descrizione_evento"], min_rows=2),
    },
    "fonti_finanziamento": {"mart_fonti": Rules(min_rows=10)},
    "cross": {
        "mart_panoramica": Rules(min_rows=10),
        "mart_imprese": Rules(min_rows=100_000),
        "mart_ritardi_per_sa": Rules(min_rows=100),
        "mart_competitivita": Rules(min_rows=100),
        "mart_esecuzione": Rules(min_rows=10),
        "mart_ritardi_contratto": Rules(min_rows=10),
        "mart_collaudo_ritardo": Rules(min_rows=10),
        "mart_sforamento": Rules(min_rows=10),
        "mart_chi_paga": Rules(min_rows=10),
    },
}


# --- single checks ----------------------------------------------------------


def duplicate_keys(df: DataFrame, key: list[str], year: str | None = None) -> DataFrame:
    """Key groups with more than one row, inside each year where the table has years."""
    groups = [*([year] if year and year not in key else []), *key]
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def keys_in_several_years(df: DataFrame, key: list[str], year: str) -> DataFrame:
    """Keys published in more than one year; min and max suffice, no distinct count."""
    return (
        df.groupBy(*key)
        .agg(F.min(year).alias("primo_anno"), F.max(year).alias("ultimo_anno"))
        .where(F.col("primo_anno") < F.col("ultimo_anno"))
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows, missing values and their share per column: one aggregate, then one row per column."""
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(c).isNull()).alias(c) for c in columns],
    )
    return (
        wide.unpivot(["__rows"], columns, "colonna", "n_null")
        .withColumnRenamed("__rows", "righe")
        .withColumn("quota_null", F.try_divide(F.col("n_null").cast("double"), F.col("righe")))
    )


def date_bounds(df: DataFrame, columns: list[str], current_year: int) -> DataFrame:
    """Latest day, days before the domain and days in future years, per date column."""
    wide = df.agg(
        *[
            F.struct(
                F.max(c).cast("string").alias("max"),
                F.count_if(F.year(c) < MIN_YEAR).alias("ante_1990"),
                F.count_if(F.year(c) > current_year).alias("future"),
            ).alias(c)
            for c in columns
        ]
    )
    return wide.unpivot([], columns, "colonna", "v").select("colonna", "v.*")


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    have = {c.lower() for c in df.columns}
    return [c for c in required if c.lower() not in have]


def missing_tables(tables: dict[str, DataFrame], required: list[str]) -> list[str]:
    return [t for t in required if t not in tables]


def schema_drift(spark: SparkSession, partitions: dict[int, str]) -> dict[int, list[str]]:
    """Per year, the columns whose type differs from the first layout of the first year in any
    file of the year. Files are not opened: tables know the layouts of their writes."""
    found = {year: list(layouts(spark, path).values()) for year, path in sorted(partitions.items())}
    base = next((own[0] for own in found.values() if own), None)
    drift = {}
    for year, own in found.items():
        changes = list(dict.fromkeys(c for layout in own for c in changed(base, layout)))
        if changes:
            drift[year] = changes
    return drift


def freshness(spark: SparkSession, path: str) -> DataFrame:
    """Newest file of a stored table and its age in days."""
    newest = F.max("_metadata.file_modification_time")
    return (
        spark.read.parquet(path)
        .agg(newest.alias("ultimo_clean"))
        .withColumn("giorni", F.datediff(F.current_timestamp(), F.col("ultimo_clean")))
    )


# --- report -----------------------------------------------------------------


def row_rules(
    df: DataFrame, rules: Rules, today: date | None = None, newest: bool = False
) -> list[tuple]:
    """(level, rule, subject, aggregate) of every rule that a count over the rows decides."""
    current = (today or date.today()).year
    absent = set(missing_columns(df, [*rules.required, *rules.key, *rules.not_null]))
    limits = {c: 0.0 for c in rules.not_null if c not in absent}
    limits |= {c: q for c, q in rules.max_null.items() if not missing_columns(df, [c])}
    rows = F.count(F.lit(1))
    counters = [(ERROR, "colonna_assente", c, F.lit(1)) for c in sorted(absent)]
    counters.append((ERROR, "righe_minime", str(rules.min_rows), F.lit(rules.min_rows) - rows))
    if not missing_columns(df, ["cig"]):
        counters.append((ERROR, "cig_vuoto", "cig", F.count_if(~not_blank("cig"))))
    for column, limit in limits.items():
        missing = F.count_if(F.col(column).isNull())
        counters.append(
            (ERROR, "valori_null", column, F.when(missing > rows * F.lit(limit), missing))
        )
    for column in rules.dates:
        if missing_columns(df, [column]):
            continue
        day_year = F.year(column)
        counters.append((ERROR, "date_ante_1990", column, F.count_if(day_year < MIN_YEAR)))
        counters.append((WARNING, "date_future", column, F.count_if(day_year > current)))
        if newest:
            day = F.datediff(F.max(column), F.lit(date(1970, 1, 1)))
            counters.append((NOTE, "data_massima", column, day))
    return counters


def measures(
    df: DataFrame, rules: Rules, today: date | None = None, newest: bool = False
) -> dict[str, Column]:
    """The aggregates of `row_rules` by name, to be taken while the rows are written."""
    return {
        f"__c{i}": value.cast("double")
        for i, (*_, value) in enumerate(row_rules(df, rules, today, newest))
    }


def audit(
    df: DataFrame,
    name: str,
    rules: Rules,
    year: str | None = None,
    today: date | None = None,
    max_age_days: int = MAX_AGE_DAYS,
    path: str | None = None,
    newest: bool = False,
    measured: dict | None = None,
    version: str | None = None,
) -> DataFrame:
    """Violated rules as rows (tabella, livello, regola, oggetto, valore); no row is a pass.

    Two passes over the table: one aggregate for all row, NULL and date counters,
    one grouping by key for both uniqueness rules. With what was `measured` while the rows
    were written the first pass is not needed. With the `path` of the stored
    table its age is checked, and that all its files have one layout (an error per
    column that drifts); of a published table, whose folder is `version`, the commit knows
    the layouts. `newest` adds a note per date column with its newest day,
    as days since 1970.
    """
    year = year if year and not missing_columns(df, [year]) else None
    counters = row_rules(df, rules, today, newest)
    absent = {subject for _, rule, subject, _ in counters if rule == "colonna_assente"}
    if measured is None:
        reports = [_findings(df, name, counters)]
    else:
        values = [measured[f"__c{i}"] for i in range(len(counters))]
        found = [(name, *c[:3], float(v)) for c, v in zip(counters, values, strict=True) if v and v > 0]
        reports = [df.sparkSession.createDataFrame(found, FINDING)]

    if rules.key and not absent & set(rules.key):
        label = ", ".join(rules.key)
        groups = [*([year] if year and year not in rules.key else []), *rules.key]
        copies = df.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
        keyed = [(ERROR, "chiavi_duplicate", label, F.sum("__twice"))]
        per_key = copies.select(*rules.key, (F.col("__n") > 1).cast("bigint").alias("__twice"))
        if year:
            per_key = copies.groupBy(*rules.key).agg(
                F.count_if(F.col("__n") > 1).alias("__twice"), F.count(year).alias("__years")
            )
            keyed.append(
                (WARNING, "chiavi_in_piu_anni", label, F.count_if(F.col("__years") > 1))
            )
        reports.append(_findings(per_key, name, keyed))
    if path:
        age = F.when(F.max("giorni") > max_age_days, F.max("giorni"))
        files = f"{path}/data/{version}" if version else path
        reports.append(
            _findings(freshness(df.sparkSession, files), name, [(WARNING, "clean_fermo", path, age)])
        )
        if version:
            drift = [c for own in layout_changes(df.sparkSession, path).values() for c in own]
        else:
            drift = schema_drift(df.sparkSession, {0: path}).get(0, [])
        if drift:
            drifted = [(ERROR, "deriva_schema", change, F.lit(1)) for change in dict.fromkeys(drift)]
            reports.append(_findings(df.sparkSession.range(1), name, drifted))
    return reduce(DataFrame.unionByName, reports)


FINDING = "tabella string, livello string, regola string, oggetto string, valore double"


def _findings(df: DataFrame, name: str, counters: list) -> DataFrame:
    """All counters in one aggregate, then one row per counter above zero."""
    wide = df.agg(*[value.cast("double").alias(f"__c{i}") for i, (*_, value) in enumerate(counters)])
    entries = F.array(
        *[
            F.struct(
                F.lit(name).alias("tabella"),
                F.lit(level).alias("livello"),
                F.lit(rule).alias("regola"),
                F.lit(subject).alias("oggetto"),
                F.col(f"__c{i}").alias("valore"),
            )
            for i, (level, rule, subject, _) in enumerate(counters)
        ]
    )
    return wide.select(F.inline(entries)).where(F.col("valore") > 0)


class QualityError(ValueError):
    """A table broke one of its promises."""


def validate(report: DataFrame) -> DataFrame:
    """Raise on any error finding; otherwise return the report. It has a few rows at most."""
    errors = report.where(F.col("livello") == ERROR).collect()
    if errors:
        raise QualityError(
            "; ".join(f"{r.tabella}: {r.regola} {r.oggetto} ({r.valore:g})" for r in errors)
        )
    return report
