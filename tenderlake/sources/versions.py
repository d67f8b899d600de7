"""Published tables: written aside, checked, and switched to by a commit.

A published table is a folder of two parts. `data/` holds what was written, one folder per
write; `commits/` one small table per version, whose rows name the folders that version
consists of. Readers take the newest commit, so a write is seen when its commit stands and
not before: one that was killed, or whose rows broke a rule, leaves the old version as it
was. A commit may keep folders of the one before, so replacing a part writes that part only.

Everything is written and read by Spark, on any file system it knows. A commit is one file,
moved to its place as a whole; there is one writer of a table at a time.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# One row per folder of a version: its part (null: the whole table), the folder below
# `data/`, and the layout of its files.
PART = "__part"
COMMIT = "version long, part string, folder string, layout string"


@dataclass(frozen=True)
class Staged:
    """A written table that is not published yet."""

    folder: str
    rows: DataFrame
    parts: tuple[str, ...] = ()
    # What was measured while the rows were written.
    measured: dict | None = None


def _commits(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(COMMIT).parquet(f"{path}/commits/*")
    except AnalysisException as missing:  # no commit yet
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], COMMIT)


def current(spark: SparkSession, path: str, version: int | None = None) -> list:
    """The rows of a commit, the newest by default: one per folder, few in number."""
    rows = _commits(spark, path)
    at = rows.agg(F.max("version")).scalar() if version is None else F.lit(version)
    return rows.where(F.col("version") == at).orderBy("part", "folder").collect()


def version_of(spark: SparkSession, path: str) -> int:
    """The newest version; 0 before the first commit."""
    return _commits(spark, path).agg(F.max("version")).first()[0] or 0


def versions(spark: SparkSession, path: str) -> list[int]:
    return [r[0] for r in _commits(spark, path).select("version").distinct().orderBy("version").collect()]


def layout_of(schema: T.StructType) -> str:
    """Names and types of the columns as one text."""
    return "\n".join(f"{f.name}: {f.dataType.simpleString()}" for f in schema)


def read_version(
    spark: SparkSession, path: str, version: int | None = None, parts: list[str] | None = None
) -> DataFrame:
    """A published version, the newest by default; with `parts` only their folders are read."""
    rows = current(spark, path, version)
    if not rows:
        raise FileNotFoundError(f"{path} has no published version{'' if version is None else f' {version}'}")
    wanted = [r for r in rows if parts is None or r["part"] in set(parts)]
    schema = _schema(rows[0]["layout"])
    if not wanted:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{r['folder']}" for r in wanted])


def _schema(layout: str) -> T.StructType:
    fields = [line.rsplit(": ", 1) for line in layout.split("\n")]
    return T.StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in fields))


def stage(
    df: DataFrame,
    path: str,
    part: Column | str | None = None,
    measures: dict[str, Column] | None = None,
    bloom: list[str] | None = None,
    rebalanced: bool = True,
) -> Staged:
    """Write `df` aside. With `part`, a column, every value of it is a part of its own that
    later commits can replace (rows without one make the part "none"). Rows are rebalanced
    first, so a task writes one part and files reach the advisory size; a part with most of
    the rows is split over many tasks. When parts are few, rows need not be `rebalanced`: every
    task then writes a file of each part it has rows of, and nothing is exchanged.

    `measures` are aggregates of the rows, taken while they are written. The files carry a
    Bloom filter per row group of each column in `bloom`, for lookups of single values.
    """
    spark, folder = df.sparkSession, uuid.uuid4().hex
    target = f"{path}/data/{folder}"
    rows = df
    if part is not None:
        part = F.col(part) if isinstance(part, str) else part
        named = F.coalesce(part.cast("string"), F.lit("none"))
        rows = df.withColumn(PART, named)
        rows = rows.hint("rebalance", PART) if rebalanced else rows
    seen = Observation(folder) if measures else None
    if seen:
        # Behind the rebalance, in the tasks that write: each counts once, however often
        # an earlier stage is done again.
        rows = rows.observe(seen, *[value.alias(name) for name, value in measures.items()])
    writer = rows.write.partitionBy(PART) if part is not None else rows.write
    for column in bloom or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.adaptive.enabled#{column}", "true")
    writer.parquet(target)
    written = spark.read.schema(rows.schema).parquet(target)
    parts = ()
    if part is not None:
        parts = tuple(r[0] for r in written.select(PART).distinct().orderBy(PART).collect())
    return Staged(folder, written.select(*df.columns), parts, seen.get if seen else None)


def publish(spark: SparkSession, path: str, staged: Staged, replaced: list[str] | None = None) -> int:
    """Make a staged table the newest version and return its number.

    By default nothing of the version before stays. With `replaced`, only the parts it names
    and those that were staged go; the folders of all others are taken over as they are.
    """
    before = current(spark, path) if replaced is not None else []
    gone = {*(replaced or []), *staged.parts}
    number = version_of(spark, path) + 1
    layout = layout_of(staged.rows.schema)
    folders = [(p, f"{staged.folder}/{PART}={p}") for p in staged.parts]
    if not folders and replaced is None:
        folders = [(None, staged.folder)]
    rows = [(number, p, folder, layout) for p, folder in folders]
    rows += [(number, r["part"], r["folder"], r["layout"]) for r in before if r["part"] not in gone]
    # One task, one file: a commit is there as a whole or not at all.
    commit = spark.createDataFrame(rows, COMMIT).coalesce(1)
    commit.write.mode("errorifexists").parquet(f"{path}/commits/{number:012d}-{uuid.uuid4().hex[:8]}")
    return number


def read_with(spark: SparkSession, path: str, staged: Staged, replaced: list[str] | None = None) -> DataFrame:
    """The table as it will be once `staged` is published."""
    if replaced is None:
        return staged.rows
    gone = {*replaced, *staged.parts}
    kept = [r for r in current(spark, path) if r["part"] not in gone]
    folders = [r["folder"] for r in kept] + [f"{staged.folder}/{PART}={p}" for p in staged.parts]
    if not folders:
        return staged.rows
    return spark.read.schema(staged.rows.schema).parquet(*[f"{path}/data/{f}" for f in folders])


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Empty the folders that only versions before the newest `keep` name, and take those
    versions out of the log. Returns their numbers."""
    log = _commits(spark, path).select("*", F.col("_metadata.file_path").alias("file")).collect()
    kept = sorted({r["version"] for r in log})[-keep:]
    held = {r["folder"] for r in log if r["version"] in kept}
    old = [r for r in log if r["version"] not in kept]
    # The log first: what is emptied then is named by no version.
    for folder in {r["file"].rpartition("/")[0] for r in old}:
        spark.createDataFrame([], COMMIT).write.mode("overwrite").parquet(folder)
    for folder, layout in {(r["folder"], r["layout"]) for r in old if r["folder"] not in held}:
        empty = spark.createDataFrame([], _schema(layout))
        empty.write.mode("overwrite").parquet(f"{path}/data/{folder}")
    return sorted({r["version"] for r in old})


def changed(old: str, new: str) -> list[str]:
    """The columns whose types differ in two layouts."""
    a, b = (dict(line.rsplit(": ", 1) for line in x.split("\n")) for x in (old, new))
    return [
        f"{c}: {a.get(c, 'assente')} -> {b.get(c, 'assente')}"
        for c in sorted(a.keys() | b.keys())
        if a.get(c) != b.get(c)
    ]


def layout_changes(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """Per part of the newest version, the columns whose type differs from the first part's.
    Read from the commit: no file of the table is opened."""
    rows = current(spark, path)
    found = {r["part"] or "": changed(rows[0]["layout"], r["layout"]) for r in rows}
    return {part: changes for part, changes in found.items() if changes}


def replace(
    df: DataFrame, path: str, check: Callable[[Staged], None] | None = None, **how
) -> DataFrame:
    """Write, check, switch; a check that raises leaves the published version as it was."""
    staged = stage(df, path, **how)
    if check:
        check(staged)
    publish(df.sparkSession, path, staged)
    return staged.rows
