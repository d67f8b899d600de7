"""Clean and mart layers: Parquet, one directory per table, partitioned by year where there is one.

Beside the data stands the layout of every write (`_layouts`, which Spark's readers pass
over). The names of a write's files share an id, so the layout of any file is known without
opening it.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .versions import layout_of

# The id that the files of one write share; a file with another name is a write of its own.
_WRITE = r"part-[0-9]+-([0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12})"
_MANIFEST = "write string, layout string"


def table_path(root: str, layer: str, dataset: str, table: str | None = None) -> str:
    parts = [root.rstrip("/"), layer, dataset]
    return "/".join(parts + [table] if table else parts)


def write_table(df: DataFrame, path: str, year: str | None = None) -> None:
    """Overwrite a table; with `year`, only the year partitions present in `df`.

    Rows are rebalanced by year first, so a task writes one year and files reach
    the advisory size; a year with most of the rows is split over many tasks.
    """
    writer = df.hint("rebalance", year) if year else df
    writer = writer.write.mode("overwrite")
    if year:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(year)
    writer.parquet(path)
    spark = df.sparkSession
    known = _manifest(spark, path).select("write")
    layout = F.lit(layout_of(df.schema)).alias("layout")
    fresh = _writes(spark, path).join(known, "write", "left_anti").select("write", layout)
    fresh.coalesce(1).write.mode("append").parquet(f"{path}/_layouts")


def _writes(spark: SparkSession, path: str) -> DataFrame:
    """write, file (one of its files) of every write a table has files of. Files are listed,
    not opened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = files.option("recursiveFileLookup", "true").load(path).select("path")
    files = files.where(~F.contains("path", F.lit("/_layouts/")))
    name = F.substring_index("path", "/", -1)
    write = F.regexp_extract(name, _WRITE, 1)
    write = F.when(write == "", F.col("path")).otherwise(write)
    return files.groupBy(write.alias("write")).agg(F.min("path").alias("file"))


def _manifest(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(_MANIFEST).parquet(f"{path}/_layouts")
    except AnalysisException as missing:  # a table of another writer
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _MANIFEST)


def layouts(spark: SparkSession, path: str) -> dict[str, str]:
    """The layout of every write a table has files of, in the order of the writes' first files.

    Writes of other programs have no entry; one file of each such write is opened.
    """
    rows = _writes(spark, path).join(_manifest(spark, path), "write", "left").orderBy("file").collect()
    return {
        r["write"]: r["layout"] or layout_of(spark.read.parquet(r["file"]).schema) for r in rows
    }


def read_years(
    spark: SparkSession, path: str, years: list[int] | None = None, year: str = "anno_pubblicazione"
) -> DataFrame:
    """A year-partitioned table; only the directories of the given years are listed and read."""
    table = spark.read.parquet(path)
    return table.where(F.col(year).isin(years)) if years is not None else table


def latest_year(df: DataFrame, year: str) -> DataFrame:
    """Rows of the newest year. The maximum is a scalar subquery, so the scan is pruned at run time."""
    return df.where(F.col(year) == df.agg(F.max(year)).scalar())


def load_mart(
    spark: SparkSession, path: str, year: int | None = None, column: str = "anno"
) -> DataFrame:
    """One year of a mart, the newest by default."""
    mart = spark.read.parquet(path)
    return latest_year(mart, column) if year is None else mart.where(F.col(column) == year)


def load_mart_all_years(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def bucketed_name(path: str) -> str:
    """The name a bucketed table of a path has in the session's catalog."""
    return "bucketed_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """A table of one row per key, in `buckets` files by the hash of the key and sorted by it:
    joins by the key of tables with equally many buckets exchange and sort nothing.

    One row per key, so no bucket is hot: a key of many rows is aggregated before."""
    name = bucketed_name(path)
    df.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")
    # Dealt by the hash the buckets have, so that each of them is one sorted file.
    dealt = df.repartition(buckets, key)
    dealt.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def read_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """A bucketed table that another session wrote."""
    name, columns = bucketed_name(path), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)
