"""From published files to published clean tables and marts.

A build writes all its tables aside, checks them, and only then switches readers to them
(`sources.versions`): a broken promise, or a build that was killed, leaves every table as it
was. Files of a feed with deltas are held by lot bucket (`deltas`), so a month that comes
later touches the buckets of its lots only.
"""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import search
from ..operators.keys import ORDER, SOURCE
from ..sources import versions
from ..sources.delimited import is_tolerant, read_delimited, read_delimited_by_header
from ..sources.layers import table_path, write_bucketed, write_table
from . import authorities, awards, cross, deltas, execution, finance, quality, questions, tenders
from .clean import CLEAN, COMPETING, classify_series, latest_statements

# Feeds with line breaks inside quoted fields.
MULTILINE = {"aggiudicatari", "partecipanti"}
YEAR = {"bandi_gara": "anno_pubblicazione"}

# Clean steps whose first half is read twice by the second.
STAGED = {"stati_avanzamento": (latest_statements, classify_series)}
# Large results, stored without the sort of the report.
UNSORTED = {
    awards.mart_top_aggiudicatari,
    awards.mart_top_partecipanti,
    awards.mart_top_subappalti,
    awards.mart_cup,
    tenders.mart_sa_profilo,
}

MARTS = {
    "bandi_gara": tenders.MARTS,
    "aggiudicazioni": {
        "mart_annuale": awards.mart_annuale,
        "mart_dettaglio": awards.mart_dettaglio,
    },
    "aggiudicatari": {"mart_top_aggiudicatari": awards.mart_top_aggiudicatari},
    "partecipanti": {"mart_top_partecipanti": awards.mart_top_partecipanti},
    "subappalti": {"mart_top_subappalti": awards.mart_top_subappalti},
    "avvio_contratto": {"mart_avvio_contratto": execution.mart_avvio_contratto},
    "fine_contratto": {
        "mart_fine_contratto": execution.mart_fine_contratto,
        "mart_motivi_fine": execution.mart_motivi_fine,
    },
    "sospensioni": {"mart_sospensioni": execution.mart_sospensioni},
    "varianti": {"mart_varianti": execution.mart_varianti},
    "collaudo": {"mart_collaudo": execution.mart_collaudo},
    "stati_avanzamento": {"mart_sal": execution.mart_sal},
    "cup": {"mart_cup": awards.mart_cup},
    "stazioni_appaltanti": {
        "mart_natura": authorities.mart_natura,
        "mart_territorio": authorities.mart_territorio,
    },
    "quadro_economico": {"mart_cig": finance.mart_cig, "mart_eventi": finance.mart_eventi},
    "fonti_finanziamento": {"mart_fonti": finance.mart_fonti},
}


def land(
    spark: SparkSession,
    dataset: str,
    files: list[str],
    path: str,
    columns: list[str] | None = None,
    multiline: bool | list[str] | None = None,
) -> DataFrame:
    """The text of the files, stored as Parquet: the delta rule reads it twice, once for the
    keys alone, and parsing the files is the dearest step. Rows carry the place of their
    file's whole name among the names."""
    many_lines = dataset in MULTILINE if multiline is None else multiline
    if columns:
        parts = [
            read_delimited(spark, chosen, columns, whole)
            for whole in (False, True)
            if (chosen := [f for f in files if is_tolerant(f, many_lines) == whole])
        ]
        text = reduce(DataFrame.unionByName, parts)
    else:
        text = read_delimited_by_header(spark, files, many_lines)
    write_table(deltas.ordered(text, deltas.orders(_names(files))), path)
    return spark.read.parquet(path)


def _names(files: list[str]) -> list[str]:
    return sorted({f.rstrip("/").rpartition("/")[2] for f in files})


def read_table(
    spark: SparkSession, root: str, layer: str, dataset: str, table: str | None = None, version: int | None = None
) -> DataFrame:
    """A published table, its newest version by default."""
    return versions.read_version(spark, table_path(root, layer, dataset, table), version)


def build_dataset(
    spark: SparkSession,
    dataset: str,
    files: list[str],
    root: str,
    columns: list[str] | None = None,
    multiline: bool | list[str] | None = None,
    check: bool = True,
    today: date | None = None,
) -> dict[str, DataFrame]:
    """Read, clean, store, check, then switch to the clean table and marts of one dataset.

    The text is landed first. Marts read the stored clean table. Counts over the rows are
    taken while the rows are written; a broken promise leaves all published tables as they
    were. `multiline` names the files that need the tolerant scan (badly quoted, with line
    breaks in fields); by default all files of the feeds known for it do.
    """
    raw = land(spark, dataset, files, table_path(root, "raw", dataset), columns, multiline)
    if dataset in {"bandi_gara", "cup", "stazioni_appaltanti"}:
        raw = raw.drop(SOURCE, ORDER)
    if dataset in STAGED:
        first, last = STAGED[dataset]
        between = table_path(root, "staged", dataset)
        write_table(first(raw), between)
        clean = last(spark.read.parquet(between))
    else:
        clean = CLEAN[dataset](raw)
    part = YEAR.get(dataset)
    staged = _staged(clean, dataset, root, part, check, today)
    return _publish(spark, dataset, root, staged, check, today, [] if part else None)


def _staged(clean: DataFrame, dataset: str, root: str, part, check: bool, today) -> versions.Staged:
    """The clean rows written aside, and their rules."""
    path, rules = table_path(root, "clean", dataset), quality.CLEAN_RULES[dataset]
    counted = quality.measures(clean, rules, today, newest=True) if check else None
    staged = versions.stage(clean, path, part, counted, ["cig"] if "cig" in clean.columns else None)
    if check:
        report = quality.audit(
            staged.rows, dataset, rules, YEAR.get(dataset), today, path=path, newest=True,
            measured=staged.measured, version=staged.folder,
        )
        quality.validate(report)
    return staged


def _publish(
    spark, dataset: str, root: str, staged: versions.Staged, check: bool, today, replaced=None
) -> dict[str, DataFrame]:
    """Marts over the clean table as it will be, written aside and checked; then the switch."""
    path = table_path(root, "clean", dataset)
    clean = versions.read_with(spark, path, staged, replaced)
    marts = {}
    for name, mart in MARTS[dataset].items():
        rows = mart(clean, ordered=False) if mart in UNSORTED else mart(clean)
        marts[name] = _staged_mart(rows, name, table_path(root, "mart", dataset, name),
                                   quality.MART_RULES[dataset].get(name) if check else None, today)
    versions.publish(spark, path, staged, replaced)
    if "cig" in clean.columns:
        versions.replace(questions.spellings(clean), table_path(root, "index", dataset, "spellings"))
    if dataset == "bandi_gara":
        search.write_index(
            clean, "denominazione_amministrazione_appaltante", table_path(root, "index", dataset, "authorities")
        )
    for name, mart in marts.items():
        versions.publish(spark, table_path(root, "mart", dataset, name), mart)
    return {"clean": clean} | {name: mart.rows for name, mart in marts.items()}


def _staged_mart(rows: DataFrame, name: str, path: str, rules, today) -> versions.Staged:
    staged = versions.stage(rows, path, measures=quality.measures(rows, rules, today) if rules else None)
    if rules:
        quality.validate(quality.audit(staged.rows, name, rules, today=today, measured=staged.measured))
    return staged


def lookup(spark: SparkSession, root: str, datasets: list[str], cigs: list[str]) -> dict[str, DataFrame]:
    """Rows of the given lots, in any letter case, in the published clean tables."""
    tables = {d: read_table(spark, root, "clean", d) for d in datasets}
    spelled = {d: read_table(spark, root, "index", d, "spellings") for d in tables if "cig" in tables[d].columns}
    return questions.lookup_published(tables, cigs, spelled)


def find_authority(spark: SparkSession, root: str, fragment: str, limit: int = 50) -> DataFrame:
    """Largest lots of the authorities whose name contains the text, from the published tables."""
    return questions.search_authority_indexed(
        spark, read_table(spark, root, "clean", "bandi_gara"),
        table_path(root, "index", "bandi_gara", "authorities"), fragment, limit,
    )


def add_files(
    spark: SparkSession,
    dataset: str,
    files: list[str],
    root: str,
    multiline: bool | list[str] | None = None,
    check: bool = True,
    today: date | None = None,
) -> dict[str, DataFrame]:
    """Files that came later, in a feed whose lots are held by bucket (`COMPETING`).

    Only the buckets of the files' lots are read and written, of the text and of the clean
    table; the rules are checked on what was written, the marts made over the whole clean
    table. The first call starts the feed with all files there are so far, and replaces a
    clean table that `build_dataset` made.
    """
    if dataset not in COMPETING:
        raise ValueError(f"{dataset}: the files of this feed do not replace each other lot by lot")
    many_lines = dataset in MULTILINE if multiline is None else multiline
    text = COMPETING[dataset](read_delimited_by_header(spark, files, many_lines))
    path, live = table_path(root, "clean", dataset), table_path(root, "live", dataset)
    first = not deltas.started(spark, live)
    change = deltas.add(text, live, _names(files))
    if change.staged is None:
        deltas.keep(spark, live, change)
        return {"clean": versions.read_version(spark, path)}
    clean = CLEAN[dataset](change.rows)
    staged = _staged(clean, dataset, root, deltas.bucket_of(F.col("cig")), check, today)
    tables = _publish(spark, dataset, root, staged, check, today, None if first else change.buckets)
    deltas.keep(spark, live, change)
    return tables


# Lots of a bucket: one task joins some 300 MB of them.
LOTS_OF_BUCKET = 2_000_000


def lot_buckets(lots: int) -> int:
    return max(1, -(-lots // LOTS_OF_BUCKET))


def build_cross(
    spark: SparkSession,
    root: str,
    check: bool = True,
    today: date | None = None,
    buckets: int | None = None,
) -> dict[str, DataFrame]:
    """The cross marts from the published clean tables. What they know of each lot is stored
    once, in buckets of the lot, and joined from there."""

    def clean(name: str) -> DataFrame:
        return read_table(spark, root, "clean", name)

    bandi, awarded = clean("bandi_gara"), clean("aggiudicazioni")
    starts, ends = clean("avvio_contratto"), clean("fine_contratto")
    changes = clean("varianti")
    lots = cross.lots_of(
        tenders.tenders_per_cig(bandi), awarded, starts, ends, clean("sospensioni"), changes, clean("collaudo")
    )
    buckets = buckets or lot_buckets(lots["per_cig"].count())
    lots = {
        name: write_bucketed(rows, table_path(root, "cross", "lots", name), "cig", buckets)
        for name, rows in lots.items()
    }
    per_cig = lots["per_cig"]
    breakdown = read_table(spark, root, "mart", "quadro_economico", "mart_cig")
    funding = read_table(spark, root, "mart", "fonti_finanziamento", "mart_fonti")
    marts = {
        "mart_panoramica": cross.mart_panoramica(bandi),
        "mart_imprese": cross.mart_imprese(
            clean("aggiudicatari"), clean("partecipanti"), clean("subappalti"), ordered=False
        ),
        "mart_ritardi_per_sa": cross.mart_ritardi_per_sa(clean("stati_avanzamento"), per_cig),
        "mart_competitivita": cross.mart_competitivita(bandi, awarded),
        "mart_esecuzione": cross.execution_of_lots(lots),
        "mart_ritardi_contratto": cross.deviations_of_lots(lots),
        "mart_collaudo_ritardo": cross.acceptance_of_lots(lots),
        "mart_sforamento": cross.mart_sforamento(
            per_cig, breakdown, awarded, changes, ordered=False
        ),
        "mart_chi_paga": cross.mart_chi_paga(
            per_cig, breakdown, funding, clean("stazioni_appaltanti")
        ),
    }
    staged = {
        name: _staged_mart(mart, name, table_path(root, "mart", "cross", name),
                           quality.MART_RULES["cross"][name] if check else None, today)
        for name, mart in marts.items()
    }
    absent = quality.missing_tables({n: m.rows for n, m in staged.items()}, list(quality.MART_RULES["cross"]))
    if absent:
        raise quality.QualityError(f"cross: tables not there: {', '.join(absent)}")
    for name, mart in staged.items():
        versions.publish(spark, table_path(root, "mart", "cross", name), mart)
    return {name: mart.rows for name, mart in staged.items()}
