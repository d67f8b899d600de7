"""Feeds of a full export and monthly files, held by lot bucket.

The newest file naming a lot replaces all that earlier files said about it. The live rows of
a feed, those of the newest file of their lot, are a published table whose parts are buckets
of lots. The rows carry the place of their file, so the table is its own state: a file that
comes later is compared with the lots of its own buckets, and only buckets in which it
replaces or adds a lot are written again. All others stay in the folders they are in.

Places are whole numbers with room between them, in the order of the whole file names: a
file whose name falls between two others takes a place between theirs. The names with their
places are a small published table beside the rows, written before them.
"""

from __future__ import annotations

from bisect import bisect_left
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import normalize_string
from ..operators.joins import attach, drop_matching
from ..operators.keys import ORDER, SOURCE
from ..sources import versions

BUCKET = "__bucket"
BUCKETS = 256
# Up to so many buckets are written without an exchange: each task has a file of each.
FEW = 16
ROOM = 1 << 32
LOT = "cig"


def orders(names: list[str], known: dict[str, int] | None = None) -> dict[str, int]:
    """The places of all names, those known before unchanged."""
    placed = dict(known or {})
    for name in sorted(set(names) - placed.keys()):
        held = sorted(placed)
        at = bisect_left(held, name)
        low = placed[held[at - 1]] if at else 0
        high = placed[held[at]] if at < len(held) else low + 2 * ROOM
        if high - low < 2:
            raise ValueError(f"no place left before {held[at]} for {name}: build the feed anew")
        placed[name] = (low + high) // 2
    return placed


def ordered(rows: DataFrame, places: dict[str, int]) -> DataFrame:
    """Rows with the place of their file. The places are one constant, as long as the list of
    files the caller gave."""
    names, numbers = F.array(*map(F.lit, places)), F.array(*[F.lit(n) for n in places.values()])
    at = F.array_position(names, F.col(SOURCE)).cast("int")
    return rows.withColumn(ORDER, F.when(at > 0, F.element_at(numbers, at)).cast("long"))


def bucket_of(lot: Column, buckets: int = BUCKETS) -> Column:
    """The bucket of a lot: that of its cleaned key, whatever the spelling."""
    return F.pmod(F.xxhash64(normalize_string(lot)), F.lit(buckets)).cast("string")


@dataclass
class Change:
    """What new files change: the live rows of the buckets they touch, not published yet."""

    rows: DataFrame | None
    buckets: list[str]
    staged: versions.Staged | None
    names: list[tuple[str, int]]
    known: list[tuple[str, int, bool]]


NAMES = "name string, place long, done boolean"


def started(spark: SparkSession, path: str) -> bool:
    return versions.version_of(spark, path) > 0


def _known(spark: SparkSession, path: str) -> list[tuple[str, int, bool]]:
    if not versions.version_of(spark, f"{path}/names"):
        return []
    return sorted(tuple(r) for r in versions.read_version(spark, f"{path}/names").collect())


def _one_file(
    spark: SparkSession, path: str, fresh: DataFrame, place: int
) -> tuple[list[str], DataFrame]:
    """The buckets one file touches, and their live rows.

    Rows are exchanged where they may go only: those of older files against the lots of the
    file, those of the file against lots that have newer rows, if there are any.
    """
    lots = fresh.select(BUCKET, LOT).distinct()
    named = [r[0] for r in lots.select(BUCKET).distinct().collect()]
    held = versions.read_version(spark, path, parts=named)
    newer = held.where(F.col(ORDER) > place).select(LOT).distinct()
    late = not newer.isEmpty()
    ahead = drop_matching(lots, newer, [LOT]) if late else lots
    ahead = versions.stage(ahead, f"{path}/lots").rows
    touched = sorted(r[0] for r in ahead.select(BUCKET).distinct().collect())
    old = versions.read_version(spark, path, parts=touched)
    older = drop_matching(old.where(F.col(ORDER) < place), ahead, [LOT])
    own = fresh.where(F.col(BUCKET).isin(touched))
    own = drop_matching(own, newer, [LOT]) if late else own
    if late:
        older = older.unionByName(old.where(F.col(ORDER) > place))
    return touched, older.unionByName(own, allowMissingColumns=True)


def _several_files(
    spark: SparkSession, path: str, fresh: DataFrame, places: list[int]
) -> tuple[list[str], DataFrame]:
    """The buckets several files touch, and their live rows."""
    newest = fresh.groupBy(BUCKET, LOT).agg(F.max(ORDER).alias("__newest"))
    if not started(spark, path):
        touched = sorted(r[0] for r in fresh.select(BUCKET).distinct().collect())
        rows = fresh
    else:
        # At most one name a bucket reaches the driver. A bucket whose lots all have newer
        # rows already is left alone.
        named = [r[0] for r in newest.select(BUCKET).distinct().collect()]
        before = versions.read_version(spark, path, parts=named)
        before = before.groupBy(LOT).agg(F.max(ORDER).alias("__held"))
        ahead = attach(newest, before, [LOT]).where("__held IS NULL OR __held <= __newest")
        touched = sorted(r[0] for r in ahead.select(BUCKET).distinct().collect())
        old = versions.read_version(spark, path, parts=touched).where(~F.col(ORDER).isin(places))
        rows = old.unionByName(fresh.where(F.col(BUCKET).isin(touched)), allowMissingColumns=True)
    span = rows.groupBy(LOT).agg(F.min(ORDER).alias("__oldest"), F.max(ORDER).alias("__newest"))
    span = span.where("__oldest < __newest").drop("__oldest")
    rows = attach(rows, span, [LOT]).where(F.col("__newest").isNull() | (F.col(ORDER) == F.col("__newest")))
    return touched, rows.drop("__newest")


def add(text: DataFrame, path: str, names: list[str], buckets: int = BUCKETS) -> Change:
    """The live rows after `text`, the rows of the files `names`, in the buckets it touches.

    Nothing is published: `keep` does that, after the caller has checked what follows from
    the rows. A file that was added before is an error; one whose adding was broken off may
    come again. A lot is the published key, spelling included; rows without one are a lot of
    their own.
    """
    spark = text.sparkSession
    known = _known(spark, path)
    again = sorted(set(names) & {name for name, _, done in known if done})
    if again:
        raise ValueError(f"already part of the feed: {', '.join(again)}")
    places = orders(names, {name: place for name, place, _ in known})
    own = {name: places[name] for name in names}
    fresh = ordered(text, own)
    if len(own) == 1 and not started(spark, path):
        # One file replaces nothing of its own: its rows go to their buckets as they come.
        staged = versions.stage(fresh, path, bucket_of(F.col(LOT), buckets), rebalanced=buckets > FEW)
        if not staged.parts:
            return Change(None, [], None, sorted(own.items()), known)
        return Change(staged.rows, list(staged.parts), staged, sorted(own.items()), known)
    fresh = versions.stage(fresh.withColumn(BUCKET, bucket_of(F.col(LOT), buckets)), f"{path}/arrived").rows
    if len(own) == 1 and started(spark, path):
        touched, rows = _one_file(spark, path, fresh, *own.values())
    else:
        touched, rows = _several_files(spark, path, fresh, list(own.values()))
    if not touched:
        return Change(None, [], None, sorted(own.items()), known)
    part = bucket_of(F.col(LOT), buckets)
    staged = versions.stage(rows.drop(BUCKET), path, part, rebalanced=len(touched) > FEW)
    return Change(staged.rows, touched, staged, sorted(own.items()), known)


def keep(spark: SparkSession, path: str, change: Change) -> None:
    """Publish a change. The names come first, marked as not done, so that no place is given
    twice even if this is broken off; a file is done when its rows are published."""

    def note(done: bool) -> None:
        own = dict(change.names)
        rows = [r for r in change.known if r[0] not in own] + [(n, p, done) for n, p in own.items()]
        versions.replace(spark.createDataFrame(sorted(rows), NAMES).coalesce(1), f"{path}/names")

    note(False)
    if change.staged:
        versions.publish(spark, path, change.staged, change.buckets)
    note(True)


def live(spark: SparkSession, path: str) -> DataFrame:
    """The live rows of a feed, with the places of their files."""
    return versions.read_version(spark, path)
