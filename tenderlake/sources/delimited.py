"""Published delimited files: `;`-separated, quoted, every column read as text."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keys import SOURCE

RAGGED = "__ragged"

_OPTIONS = {
    "header": "true",
    "sep": ";",
    "quote": '"',
    "escape": '"',
    "encoding": "UTF-8",
    "ignoreLeadingWhiteSpace": "true",
    "ignoreTrailingWhiteSpace": "true",
    # Short rows are padded with NULL, surplus fields dropped.
    "mode": "PERMISSIVE",
}


def all_text(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def header_of(spark: SparkSession, path: str) -> list[str]:
    """Column names of one file; reads its first line only."""
    return spark.read.options(**_OPTIONS).csv(path).columns


def is_tolerant(path: str, multiline: bool | Collection[str]) -> bool:
    if isinstance(multiline, bool):
        return multiline
    return path.rstrip("/").rpartition("/")[2] in set(multiline)


def read_delimited(
    spark: SparkSession,
    paths: str | list[str],
    columns: list[str] | None = None,
    multiline: bool = False,
    source_file: bool = True,
    ragged: bool = False,
    split_resources: bool = False,
) -> DataFrame:
    """All files as one text table, with the file each row came from.

    `columns` fixes the layout for every file; by default it is the header of the
    first one, and a file with another header is an error. `multiline` accepts line breaks inside quotes, at the price that a
    file is read by one task, so it is for the few feeds that need it.
    `ragged` adds a flag for rows with too few or too many fields.
    With `split_resources` each path is a directory of part files, and the
    directory gives the resource its name.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    names = columns or header_of(spark, paths[0])
    schema = all_text(names)
    reader = spark.read.options(**_OPTIONS).option("multiLine", str(multiline).lower())
    if columns is None and not ragged:
        reader = reader.option("enforceSchema", "false")  # compare every header by name
    if ragged:
        schema = schema.add(RAGGED, T.StringType())
        reader = reader.option("columnNameOfCorruptRecord", RAGGED)
    rows = reader.schema(schema).csv(paths)
    if source_file:
        by_directory = F.regexp_extract(F.col("_metadata.file_path"), "([^/]+)/[^/]+$", 1)
        name = by_directory if split_resources else F.col("_metadata.file_name")
        rows = rows.withColumn(SOURCE, name)
    if ragged:
        rows = rows.withColumn(RAGGED, F.col(RAGGED).isNotNull())
    return rows


def read_delimited_by_header(
    spark: SparkSession,
    paths: list[str],
    multiline: bool | Collection[str] = False,
    source_file: bool = True,
) -> DataFrame:
    """Files whose headers differ: one scan per distinct header, columns matched by name.

    `multiline` may name the files (by their last path part) whose quoting asks for the
    tolerant scan, one task per file; the other files are still split.
    """
    layouts: dict[tuple, list[str]] = defaultdict(list)
    with ThreadPoolExecutor(16) as pool:  # first lines only, many files at a time
        headers = list(pool.map(lambda p: tuple(header_of(spark, p)), paths))
    for path, header in zip(paths, headers, strict=True):
        layouts[is_tolerant(path, multiline), header].append(path)
    scans = [
        read_delimited(spark, files, list(names), whole, source_file)
        for (whole, names), files in layouts.items()
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)
