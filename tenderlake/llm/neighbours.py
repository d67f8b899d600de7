"""Approximate nearest neighbours by cross-polytope hashing.

A vector's direction is turned by fast pseudo-random rotations (three rounds of random signs
and a Hadamard transform); its hash is the nearest signed axis. Several tables use different
rotations. A query probes in every table the axes nearest to it, not only the first. Where
one axis per table leaves too many vectors in a bucket, a second rotation over fewer axes is
added to the hash, so buckets stay small as the input grows. Candidates are ranked by their
exact Euclidean distance in double precision.

How many buckets a query probes is fitted, not set: a bounded sample of queries is compared
with every vector, and the probes are as many as find the wanted share of their true
neighbours. Vectors in clusters need few; vectors without any structure need a large part
of all buckets, at any size. A query that finds fewer vectors than it asks for is set
against all of them.

Equal vectors are indexed once. Of each only the smallest ids can be among the nearest, so
a vector that a third of all rows hold costs no more than another.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, isqrt

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import released, stored

TABLES = 10
BUCKET = 1024
# Vectors and queries of a group.
GROUP, QUERIES = 16_384, 8192
# Queries the number of probes is fitted on, the share of their neighbours that must be
# found, and the least number of probes.
SAMPLE, WANTED, PROBES = 64, 0.97, 2


class Rotations:
    """Pseudo-random rotations of vectors of `dim` components, fixed by a seed."""

    def __init__(self, dim: int, second: int, tables: int, seed: int):
        self.dim, self.second, self.tables = dim, second, tables
        self.size = 1 << max(1, (dim - 1).bit_length())
        rng = np.random.default_rng(seed)
        self.signs = rng.choice(np.array([-1.0, 1.0]), (tables, 2, 3, self.size))

    def turn(self, x: np.ndarray, table: int, which: int) -> np.ndarray:
        out = np.zeros((len(x), self.size))
        out[:, : self.dim] = x
        for signs in self.signs[table, which]:
            out = hadamard(out * signs)
        return out

    def axes(self, x: np.ndarray, table: int) -> tuple[np.ndarray, np.ndarray | None]:
        """Nearness to every signed axis: of the first rotation, and of the second if any."""
        first = self.turn(x, table, 0)
        first = np.concatenate([first, -first], 1)
        if not self.second:
            return first, None
        second = self.turn(x, table, 1)[:, : self.second]
        return first, np.concatenate([second, -second], 1)


def hadamard(x: np.ndarray) -> np.ndarray:
    n, step = x.shape[1], 1
    while step < n:
        y = x.reshape(len(x), n // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        step *= 2
    return x / np.sqrt(n)


def matrix(values) -> np.ndarray:
    return np.stack([np.frombuffer(v, np.float64) for v in values])


def directions(x: np.ndarray) -> np.ndarray:
    """Unit vectors; scaled by the largest component first, so no square overflows."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def second_axes(n: int, dim: int, bucket: int = BUCKET) -> int:
    """Axes of the second rotation: 0 where 2 * dim buckets are enough for `n` vectors."""
    size = 1 << max(1, (dim - 1).bit_length())
    need = n / (2 * size * bucket)
    return 0 if need <= 1 else min(size, 1 << max(0, ceil(need / 2) - 1).bit_length())


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """id, vec (array of doubles) of the rows that take part."""
    v = F.col(vector_column).cast("array<double>")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), v.alias("vec"))
    whole = ~F.exists("vec", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    return rows.where(
        F.col("id").isNotNull() & F.col("vec").isNotNull() & whole
        & F.exists("vec", lambda e: e != 0)
    )


def nearest(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    every: int = 100,
    k: int = 10,
    tables: int = TABLES,
    probes: int | None = None,
    seed: int = 7,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (Euclidean distance) of each query's `k`
    nearest found, ties to the smaller id.

    Queries are the rows whose id is divisible by `every`, candidates all rows but the
    query's own. Rows whose id or vector is null, or whose vector is zero or holds a null or
    non-finite component, take no part; vectors of different lengths are never compared.
    Rows that repeat an id count once, with the smallest vector of the id. Without `probes`
    their number is fitted on `SAMPLE` queries.
    """
    rows = usable(vectors, id_column, vector_column)
    rows = rows.groupBy("id").agg(F.min("vec").alias("vec"))
    rows = stored(rows.withColumn("dim", F.size("vec")), "vectors")
    order = Window.partitionBy("vec").orderBy("id")
    # The k + 1 smallest ids of a vector: one of them may be the query itself.
    ranked = rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1)
    distinct = ranked.groupBy("dim", "vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    distinct = stored(distinct.withColumn("gid", F.element_at("ids", 1)), "distinct-vectors")
    asked = rows.where(F.col("id") % every == 0)
    asking = asked.join(distinct.select("vec", "gid"), "vec").select("id", "gid")
    asking = stored(asking, "queries")
    shapes = {r["dim"]: r["count"] for r in distinct.groupBy("dim").count().collect()}
    parts = [
        _search(distinct.where(F.col("dim") == d), asking, d, n, k, tables, probes, seed)
        for d, n in sorted(shapes.items())
    ]
    if not parts:
        schema = "query_id long, rank int, vec_id long, score double"
        return vectors.sparkSession.createDataFrame([], schema)
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _packed(vec):
    """The doubles of a vector as bytes, so that Python takes them without a copy each."""

    @released
    def pack(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda v: np.asarray(v, np.float64).tobytes())

    return F.pandas_udf(pack, "binary")(vec)


def _nearness(turned: Rotations, x: np.ndarray, table: int) -> tuple[np.ndarray, int]:
    """Nearness of each vector to every bucket of a table, and the parts of an axis."""
    first, rest = turned.axes(x, table)
    if rest is None:
        return first, 1
    return (first[:, :, None] + rest[:, None]).reshape(len(x), -1), rest.shape[1]


def fitted_probes(queries: DataFrame, packed: DataFrame, codes: DataFrame, turned: Rotations, k: int) -> int:
    """Buckets to probe in each table, so that of the `k` true neighbours of `SAMPLE` queries
    the share `WANTED` is found in one table at least."""
    rows = queries.orderBy(F.xxhash64("gid"), "gid").limit(SAMPLE).collect()
    if not rows:
        return PROBES
    asked, own = matrix(r["vec"] for r in rows), np.array([r["gid"] for r in rows])

    @released
    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x, gid = matrix(batch["vec"]), batch["gid"].to_numpy()
            far = np.stack([((x - q) ** 2).sum(1) for q in asked])
            far[gid[None] == own[:, None]] = np.inf
            take = min(k, len(gid))
            best = np.argpartition(far, take - 1, 1)[:, :take]
            yield pd.DataFrame(
                {
                    "q": np.repeat(np.arange(len(asked)), take),
                    "gid": gid[best].ravel(),
                    "far": np.take_along_axis(far, best, 1).ravel(),
                }
            )

    found = packed.mapInPandas(near, "q int, gid long, far double").where(F.col("far") < float("inf"))
    order = Window.partitionBy("q").orderBy("far", "gid")
    found = found.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k)
    # At most SAMPLE * k * tables rows.
    places = codes.join(F.broadcast(found.select("q", "gid")), "gid").toPandas()
    if not len(places):
        return PROBES
    x, ranks = directions(asked), np.empty(len(places), np.int64)
    for t, rows_ in places.groupby("t").indices.items():
        nearness, width = _nearness(turned, x, int(t))
        q, h, part = (places[c].to_numpy()[rows_] for c in ("q", "h", "part"))
        bucket = h.astype(np.int64) * width + part
        ranks[rows_] = (nearness[q] > nearness[q, bucket][:, None]).sum(1)
    best = places.assign(rank=ranks).groupby(["q", "gid"])["rank"].min().to_numpy()
    return max(PROBES, int(np.quantile(best, WANTED, method="higher")) + 1)


def _search(distinct, asking, dim, n, k, tables, probes, seed) -> DataFrame:
    second = second_axes(n, dim)
    turned = Rotations(dim, second, tables, seed)

    @released
    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = directions(matrix(batch["vec"]))
            for t in range(tables):
                first, rest = turned.axes(x, t)
                yield pd.DataFrame(
                    {
                        "gid": batch["gid"],
                        "t": np.int32(t),
                        "h": first.argmax(1).astype(np.int32),
                        "part": (rest.argmax(1) if second else np.zeros(len(x))).astype(np.int32),
                    }
                )

    @released
    def probed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            x = directions(matrix(batch["vec"]))
            for t in range(tables):
                near, width = _nearness(turned, x, t)
                take = min(probes, near.shape[1])
                best = np.argpartition(-near, take - 1, 1)[:, :take]
                yield pd.DataFrame(
                    {
                        "gid": np.repeat(batch["gid"].to_numpy(), take),
                        "t": np.int32(t),
                        "h": (best // width).ravel().astype(np.int32),
                        "part": (best % width).ravel().astype(np.int32),
                    }
                )

    packed = stored(distinct.select("gid", _packed(F.col("vec")).alias("vec")), "packed")
    codes = stored(packed.mapInPandas(hashed, "gid long, t int, h int, part int"), "codes")
    queries = packed.join(asking.select("gid").distinct(), "gid", "left_semi")
    if probes is None:
        probes = fitted_probes(stored(queries, "asked"), packed, codes, turned, k)
    asks = queries.mapInPandas(probed, "gid long, t int, h int, part int")
    asks = asks.groupBy("gid", "t", "h").agg(F.collect_list("part").alias("parts"))

    def rank(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            left = left.sort_values("gid")
            x, ids, part = matrix(left["vec"]), left["gid"].to_numpy(), left["part"].to_numpy()
            for q, vec, parts in zip(right["gid"], right["vec"], right["parts"], strict=True):
                held = np.flatnonzero(np.isin(part, parts)) if second else slice(None)
                gap = x[held] - np.frombuffer(vec, np.float64)
                far = np.sqrt((gap * gap).sum(1))
                own = ids[held]
                # k + 1 vectors: one of them may be the query's own, held by it alone. What
                # ties with the last one stays too.
                if len(far) > k + 1:
                    least = np.partition(far, k)[k]
                    best = np.flatnonzero(far <= least)
                    best = best[np.argsort(far[best], kind="stable")][: k + 1]
                else:
                    best = np.arange(len(far))
                out.append(
                    pd.DataFrame({"query": np.int64(q), "gid": own[best], "score": far[best]})
                )
        if not out:
            return pd.DataFrame({"query": [], "gid": [], "score": []}).astype(
                {"query": "int64", "gid": "int64", "score": "float64"}
            )
        return pd.concat(out)

    keys = ["t", "h", "share", "turn"]

    def compared(codes, asks):
        # Large buckets are dealt to several groups by the vector's id, and many queries of
        # a bucket to several turns: groups stay bounded, whatever share of the vectors or
        # the queries one axis attracts. At most tables * 2 * size rows.
        asks = stored(asks, "asks")
        size = codes.groupBy("t", "h").agg(F.ceil(F.count("*") / GROUP).cast("int").alias("shares"))
        crowd = asks.groupBy("t", "h").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("turns"))
        dealt = stored(size.join(crowd, ["t", "h"]), "buckets")
        spread = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        own = lambda c: F.pmod(F.xxhash64("gid"), F.col(c)).cast("int")
        index = codes.join(dealt, ["t", "h"]).withColumn("share", own("shares"))
        index = index.select("t", "h", "share", "gid", "part", spread("turns").alias("turn"))
        index = index.join(packed, "gid").select(*keys, "gid", "part", "vec")
        asks = asks.join(dealt, ["t", "h"]).withColumn("turn", own("turns"))
        asks = asks.select("t", "h", "turn", "gid", "parts", spread("shares").alias("share"))
        # Columns of its own: both sides come from the same tables.
        asks = asks.join(packed, "gid").select(*[F.col(c).alias(c) for c in (*keys, "gid", "parts", "vec")])
        return (
            index.groupBy(*keys)
            .cogroup(asks.groupBy(*keys))
            .applyInPandas(rank, "query long, gid long, score double")
            .groupBy("query", "gid")
            .agg(F.min("score").alias("score"))
        )

    found = stored(compared(codes, asks), "found")
    # Queries that met too few vectors: all buckets of one table hold every vector once.
    least = min(k + 1, n)
    met = found.groupBy("query").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    short = queries.select("gid").join(met, F.col("gid") == F.col("query"), "left_anti")
    short = stored(short, "short")
    if not short.isEmpty():
        width = 2 * second if second else 1
        every = F.array(*[F.lit(p) for p in range(width)])
        all_of = short.select(
            "gid", F.lit(0).alias("t"), F.explode(F.sequence(F.lit(0), F.lit(2 * turned.size - 1))).alias("h"),
            every.alias("parts"),
        )
        more = compared(codes.where("t = 0"), all_of)
        found = found.unionByName(more).groupBy("query", "gid").agg(F.min("score").alias("score"))
    best = Window.partitionBy("query").orderBy("score", "gid")
    found = found.withColumn("at", F.row_number().over(best)).where(F.col("at") <= k + 1)
    members = found.join(distinct.select("gid", "ids"), "gid").select(
        "query", "score", F.explode("ids").alias("vec_id")
    )
    # The k + 1 nearest rows of each distinct query vector, then of each query without itself.
    nearest_rows = Window.partitionBy("query").orderBy("score", "vec_id")
    members = members.withColumn("at", F.row_number().over(nearest_rows)).where(F.col("at") <= k + 1)
    answers = asking.withColumnRenamed("id", "query_id").join(
        members.select(F.col("query").alias("gid"), "score", "vec_id"), "gid"
    ).where("query_id <> vec_id")
    by_rank = Window.partitionBy("query_id").orderBy("score", "vec_id")
    answers = answers.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", "score")
