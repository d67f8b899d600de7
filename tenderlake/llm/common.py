"""What the operators of this package share: intermediate tables, folds, text batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import zipfile
from collections.abc import Iterator
from functools import wraps
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenderlake.session import scratch_path

# Characters that separate words: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


# The archive sent for each application, kept as long as this process serves it.
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, as spark-submit --py-files does. Spark copies the
    archive from the driver to every executor, also to those that join later."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    _SHIPPED[app] = tempfile.TemporaryDirectory(prefix="tenderlake-")
    archive = Path(_SHIPPED[app].name) / "tenderlake.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(archive))


def prepare(spark: SparkSession) -> SparkSession:
    """Settings for rows that hold whole texts: few rows a batch, so that memory stays bounded."""
    ship(spark)
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written to the folder all executors share and read again.

    The table cuts the lineage: what reads it survives the loss of any executor, and nothing
    is computed twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def released(fn):
    """A function over batches that, at the end of a task, gives the memory it no longer needs
    back to the system: Spark keeps Python workers for later tasks, and several wait beside
    those at work."""

    @wraps(fn)
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
                trim(0)

    return run


def let_go(spark: SparkSession) -> None:
    """Have Spark's cleaner remove the shuffle files of frames that nothing refers to any
    more: it waits for the driver's garbage collector, which a busy driver seldom runs."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def discard(df: DataFrame) -> None:
    """Remove the files of a stored table that no later step reads."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    for folder in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


BLOOM_WORDS = 1 << 20


class Among:
    """Whether a key may be among given ones, by a bit array that tasks share."""

    def __init__(self, shared):
        self.shared = shared

    def test(self, mixed: pd.Series) -> np.ndarray:
        """For the xxhash64 of each key."""
        h = mixed.to_numpy(np.int64)
        word = self.shared.value[np.mod(h, BLOOM_WORDS)]
        return (word >> np.mod(h >> 40, 64)) & 1 == 1


def among(keys: DataFrame, column: str) -> Among:
    """A test for a long column that all values of `keys` pass, and few others.

    A bit array of fixed size, 8 MB, in which each key sets one bit: the words are put
    together by Spark, and only they reach the driver. The more keys, the more other values
    pass; what reads the filtered rows must not rely on it.
    """
    spread = F.xxhash64(F.col(column))
    words = keys.select(
        F.pmod(spread, F.lit(BLOOM_WORDS)).cast("int").alias("word"),
        F.expr(f"shiftleft(1L, cast(pmod(shiftright(xxhash64({column}), 40), 64L) as int))").alias("bit"),
    )
    rows = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toPandas()
    bits = np.zeros(BLOOM_WORDS, np.int64)
    bits[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    return Among(keys.sparkSession.sparkContext.broadcast(bits))


def maybe_among(keys: DataFrame, column: str):
    """`among` as a filter on a column."""
    found = among(keys, column)

    @F.pandas_udf("boolean")
    def passes(mixed: pd.Series) -> pd.Series:
        return pd.Series(found.test(mixed))

    return lambda key: passes(F.xxhash64(key))


def whole_row(docs: DataFrame) -> Column:
    """All columns of a row as one, named `row`: whatever they are called, they clash with
    nothing a step adds; select("row.*") gives them back."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; null where the id is null."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def by_size(rows: list, length, most: int) -> Iterator[list]:
    """Consecutive runs of rows of about `most` characters at most, one row at least."""
    run, total = [], 0
    for row in rows:
        n = length(row)
        if run and total + n > most:
            yield run
            run, total = [], 0
        run.append(row)
        total += n
    if run:
        yield run
