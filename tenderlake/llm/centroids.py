"""k-means over whole numbers, each vector's centroid found by Orchard's search.

Every centroid has a list of the other centroids, nearest first. A search starts at some
centroid, at distance d, and walks its list: a centroid found nearer is jumped to, and its
list is walked from the head; centroids measured before are marked and not measured again.
No centroid further than 2 * d from the current one can be nearer, so the walk stops at the
first one strictly beyond that: one at exactly 2 * d may tie, and ties go to the smaller
number. All vectors of a batch walk their lists together.

Components are whole numbers and distances are squared, so all results are exact and do not
depend on how rows are dealt to tasks. A round is one pass over the stored vectors: tasks
add up their vectors by centroid, Spark adds up the tasks' sums, and only the sums of the
`k` centroids reach the driver. No vector is exchanged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released, stored

DIM = 64
CLUSTERS = 8
ROUNDS = 10
SCALE = 1024
# Whole components stay below it, so that a squared distance of `DIM` components fits a long.
LARGEST = 1 << 27
BATCH = 8192


class Neighbours:
    """Centroids (k x dim, whole numbers) with their sorted lists of neighbours."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        gaps = np.stack([((centroids - c) ** 2).sum(1) for c in centroids])
        k = len(centroids)
        # A centroid's own number stands first in its list and is cut off, also beside equals.
        ranked = gaps.copy()
        np.fill_diagonal(ranked, -1)
        self.lists = np.argsort(ranked, axis=1, kind="stable")[:, 1:]
        self.gaps = np.take_along_axis(gaps, self.lists, 1)
        self.k = k

    def search(self, vectors: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Nearest centroid of each vector, its squared distance, and how many were measured."""
        n = len(vectors)
        rows = np.arange(n)
        at = start.astype(np.int64)
        gap = vectors - self.centroids[at]
        best = np.einsum("ij,ij->i", gap, gap)
        seen = np.zeros((n, self.k), bool)
        seen[rows, at] = True
        place = np.zeros(n, np.int64)
        measured = n
        alive = rows
        while len(alive) and self.k > 1:
            here, step = at[alive], place[alive]
            # Distances are squared: beyond 2 * d is beyond 4 * d * d.
            going = self.gaps[here, step] <= 4 * best[alive]
            alive, here, step = alive[going], here[going], step[going]
            other = self.lists[here, step]
            place[alive] = step + 1
            new = ~seen[alive, other]
            asked, other = alive[new], other[new]
            seen[asked, other] = True
            gap = vectors[asked] - self.centroids[other]
            far = np.einsum("ij,ij->i", gap, gap)
            measured += len(asked)
            nearer = (far < best[asked]) | ((far == best[asked]) & (other < at[asked]))
            moved = asked[nearer]
            at[moved], best[moved], place[moved] = other[nearer], far[nearer], 0
            alive = alive[place[alive] < self.k - 1]
        return at.astype(np.int32), best, measured


def whole_vectors(
    vectors: DataFrame, id_column: str, vector_column: str, dim: int, scale: int
) -> DataFrame:
    """vec_id, v (whole components) of the vectors that are kept."""
    v = F.col(f"`{vector_column}`").cast("array<double>")
    rows = vectors.select(F.col(f"`{id_column}`").alias("vec_id"), v.alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = rows.where((F.size("v") == dim) & ~F.coalesce(bad, F.lit(True)))
    too_large = F.exists("v", lambda x: F.abs(x * scale) >= LARGEST)
    error = F.raise_error(F.lit(f"a component times {scale} is not below {LARGEST}"))
    whole = F.transform("v", lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    checked = F.when(too_large, error.cast("array<long>")).otherwise(whole)
    return kept.select("vec_id", checked.alias("v"))


def first_centroids(kept: DataFrame, k: int, salt: int) -> np.ndarray:
    """The `k` kept vectors of smallest hash of the id. Rows without an id come last; equal
    hashes are told apart by the vector."""
    named = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    rows = kept.orderBy(named.asc_nulls_last(), "v").limit(k).select("v").collect()
    return np.array([r["v"] for r in rows], np.int64)


def _matrix(batch: pd.Series) -> np.ndarray:
    return np.array(batch.tolist(), np.int64)


def _new_centroids(kept: DataFrame, near: Neighbours) -> np.ndarray:
    """Componentwise floor of the mean of each centroid's vectors; empty centroids stay."""
    k, dim = near.centroids.shape

    @released
    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, count = np.zeros((k, dim), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for i in range(0, len(batch), BATCH):
                x = _matrix(batch["v"].iloc[i : i + BATCH])
                at, _, _ = near.search(x, np.zeros(len(x), np.int64))
                for c in np.unique(at):
                    total[c] += x[at == c].sum(0)
                count += np.bincount(at, minlength=k)
        held = np.flatnonzero(count)
        yield pd.DataFrame(
            {
                "cluster": np.repeat(held, dim),
                "axis": np.tile(np.arange(dim), len(held)),
                "total": total[held].ravel(),
                "n": np.repeat(count[held], dim),
            }
        )

    sums = kept.select("v").mapInPandas(add_up, "cluster int, axis int, total long, n long")
    # Decimals: the sum of any number of vectors is exact.
    sums = sums.groupBy("cluster", "axis").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    moved = near.centroids.copy()
    for row in sums.collect():
        moved[row["cluster"], row["axis"]] = int(row["total"]) // row["n"]
    return moved


def cluster_vectors(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    dim: int = DIM,
    k: int = CLUSTERS,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    salt: int = 3,
) -> tuple[DataFrame, np.ndarray]:
    """vec_id, cluster, distance (squared) of every kept vector, and the final centroids.

    Kept are vectors of `dim` components, none null or non-finite; each component x becomes
    floor(scale * x). A kept row may have a null or a repeated id: rows are independent.
    With fewer than `k` kept vectors all of them are centroids; without any there are no
    rows. A component that is too large for exact 64-bit distances stops the job.
    `k` is the bound of what the driver holds: k * dim sums and lists of k * (k - 1) numbers.
    """
    kept = stored(whole_vectors(vectors, id_column, vector_column, dim, scale), "whole-vectors")
    start = first_centroids(kept, k, salt)
    if not len(start):
        return kept.selectExpr("vec_id", "int(null) AS cluster", "bigint(null) AS distance"), start
    near = Neighbours(start)
    for _ in range(rounds):
        moved = _new_centroids(kept, near)
        if (moved == near.centroids).all():
            break  # all further rounds repeat this one
        near = Neighbours(moved)

    @F.pandas_udf("cluster int, distance long")
    def assigned(v: pd.Series) -> pd.DataFrame:
        x = _matrix(v).reshape(len(v), dim)
        at, best, _ = near.search(x, np.zeros(len(x), np.int64))
        return pd.DataFrame({"cluster": at, "distance": best})

    rows = kept.select("vec_id", assigned("v").alias("found")).select("vec_id", "found.*")
    return stored(rows, "clustered"), near.centroids


def centroid_clusters(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every kept vector."""
    rows, centroids = cluster_vectors(vectors, **options)
    spark = vectors.sparkSession
    sums = rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"))
    # At most k rows.
    inertia = {r["cluster"]: int(r["s"]) for r in sums.collect() if r["cluster"] is not None}
    facts = [
        (c, inertia.get(c, 0), sum(inertia.values()),
         hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest())
        for c, centroid in enumerate(centroids)
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return rows.join(F.broadcast(spark.createDataFrame(facts, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _oracle() -> str:
    """The same rounds in SQL, one statement each."""
    nearest = """
SELECT id, arg_min(c, (d, c)) AS cluster, min(d) AS d FROM (
    SELECT k.id, m.c, list_sum(list_transform(range(1, {dim} + 1),
        lambda i: ((k.v[i] - m.v[i]) * (k.v[i] - m.v[i]))::BIGINT))::BIGINT AS d
    FROM kept k CROSS JOIN {centroids} m) GROUP BY id""".replace("{dim}", str(DIM))
    steps = [f"""
kept AS MATERIALIZED (
    SELECT row_number() OVER () AS id, vec_id,
        list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: isfinite(x))) = {DIM}),
c0 AS MATERIALIZED (
    SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id) NULLS LAST, v) - 1 AS c, v
    FROM kept ORDER BY c LIMIT {CLUSTERS})"""]  # fmt: skip
    for r in range(ROUNDS):
        steps.append(f"a{r} AS MATERIALIZED ({nearest.replace('{centroids}', f'c{r}')})")
        steps.append(f"""
m{r} AS MATERIALIZED (
    SELECT c, list(CASE WHEN s >= 0 THEN s // n ELSE -((n - 1 - s) // n) END ORDER BY i)::BIGINT[] AS v
    FROM (SELECT a.cluster AS c, i, sum(k.v[i]) AS s, count(*) AS n
          FROM a{r} a JOIN kept k USING (id), range(1, {DIM + 1}) AS axes(i) GROUP BY a.cluster, i)
    GROUP BY c),
c{r + 1} AS MATERIALIZED (
    SELECT o.c, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN m{r} m ON m.c = o.c)""")
    steps.append(f"last AS MATERIALIZED ({nearest.replace('{centroids}', f'c{ROUNDS}')})")
    return f"""
WITH {",".join(steps)}
SELECT k.vec_id, l.cluster::INT AS cluster, l.d AS distance,
    sum(l.d) OVER (PARTITION BY l.cluster)::BIGINT AS cluster_inertia,
    sum(l.d) OVER ()::BIGINT AS inertia,
    sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM last l JOIN kept k USING (id) JOIN c{ROUNDS} m ON m.c = l.cluster"""


ORACLE = _oracle()
