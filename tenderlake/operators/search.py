"""Search for a fragment in names, through postings of three letters.

The names are kept once each, in capitals, with one posting per three letters they hold. A
fragment's names are among those that have postings of all its threes; whether they hold the
fragment itself is then looked up in these few names. The postings are stored in ranges of
the threes, so only the files of the fragment's own are read. A fragment shorter than three
letters has no three: it is looked for in every name, but still not in every row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import versions
from .joins import keep_matching

SIZE = 3


def names_of(rows: DataFrame, column: str) -> DataFrame:
    """name: the distinct values of a column, in capitals."""
    return rows.select(F.upper(column).alias("name")).where("name IS NOT NULL").distinct()


def postings_of(names: DataFrame) -> DataFrame:
    """gram, name: every name once for each three letters it holds."""
    last = F.length("name") - (SIZE - 1)
    places = F.when(last >= 1, F.sequence(F.lit(1), last))
    grams = F.array_distinct(F.transform(places, lambda i: F.substr("name", i, F.lit(SIZE))))
    return names.select(F.explode(grams).alias("gram"), "name")


def write_index(rows: DataFrame, column: str, path: str, files: int | None = None) -> None:
    """The names and postings of a column as two published tables below `path`."""
    versions.replace(names_of(rows, column), f"{path}/names")
    postings = postings_of(versions.read_version(rows.sparkSession, f"{path}/names"))
    n = files or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # By three letters and name: common threes are cut into several files.
    versions.replace(postings.repartitionByRange(n, "gram", "name").sortWithinPartitions("gram", "name"), f"{path}/postings")


def grams_of(fragment: str) -> list[str]:
    return sorted({fragment[i : i + SIZE] for i in range(len(fragment) - SIZE + 1)})


def names_with(spark: SparkSession, path: str, fragment: str) -> DataFrame:
    """name: the indexed names that contain the fragment, in any letter case."""
    wanted = fragment.upper()
    grams = grams_of(wanted)
    if grams:
        postings = versions.read_version(spark, f"{path}/postings").where(F.col("gram").isin(grams))
        names = postings.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == len(grams))
    else:
        names = versions.read_version(spark, f"{path}/names")
    return names.select("name").where(F.contains("name", F.lit(wanted)))


def rows_named(rows: DataFrame, column: str, names: DataFrame) -> DataFrame:
    """The rows whose column is one of the names, in any letter case."""
    return keep_matching(rows.withColumn("name", F.upper(column)), names, ["name"]).drop("name")
