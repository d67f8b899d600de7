"""N-gram Jaccard join: which texts share three quarters of their word shingles.

Filter and verify, with several global orders of the shingles:

1. Texts with equal shingle sets become one class, named by a hash of the set.
2. Order 1 puts rare shingles first, by counts over all texts. Similar sets share a shingle
   among the first |x| - o + 1 of either, o being the overlap that their sizes ask for; a
   class is listed under the shingles of its longest such prefix. What nobody else lists
   ends there. Of the shared prefix shingles similar sets even share l, which follows from
   their sizes as well.
3. Order 2 puts the shared shingles in the order of their exact number of holders. Of the T
   that a class holds, one of the first T - l + 1 must be shared: these make the candidates.
4. Pivots: in each list the classes are paired with the four whose prefixes end latest (the
   least edited ones), never with each other. Verified pairs are links.
5. Completion: classes of one list that the links so far leave in different components are
   paired, whatever the length of the list. So no pair within a large group is emitted, and
   no link that would join two components is lost.
6. Candidates must share l of their prefix shingles of order 1; before the whole sets are
   intersected they must also share a prefix shingle under two more orders.

All filters are exact: they drop no pair that reaches the threshold.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import WORD, by_size, discard, let_go, maybe_among, released, stored, whole_row
from .components import connected
from .shingles import shingle_hashes, shingle_sets

# The threshold as a fraction: 100 * intersection >= 75 * union.
OVER, UNDER = 3, 4
WIDTH = 5
SLOT_BITS = 18
CHUNK = 1_000_000
PIVOTS = 4
# Odd factors: the further orders sort shingles by their hash times these.
ORDERS = (np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25))


def needed(n, m):
    """The least intersection of two sets of `n` and `m` that are similar enough."""
    return -((-OVER * (n + m)) // (OVER + UNDER))


def longest_prefix(n):
    """Shingles of a set of `n` among which a shared one must be, whatever the partner."""
    return n - -((-OVER * n) // UNDER) + 1


def _ceil_div(a: Column, b: int) -> Column:
    return F.floor((a + (b - 1)) / b).cast("long")


def _needed(n: Column, m: Column) -> Column:
    return _ceil_div(OVER * (n + m), OVER + UNDER)


def slot_counts(docs: DataFrame) -> np.ndarray:
    """How many shingles of all of `docs` fall in each of 2 ** SLOT_BITS hash slots.

    The order of rarity needs no exact counts: a shingle that many texts share stands out of
    its slot at any size of the input. The table's size is fixed.
    """

    @released
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(1 << SLOT_BITS, np.int64)
        for batch in batches:
            for run in by_size([t for t in batch["text"] if t], len, CHUNK):
                hashes, _ = shingle_hashes(run, WIDTH)
                total += np.bincount(
                    (hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(total)
                )
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"slot": seen.astype(np.int32), "n": total[seen]})

    rows = docs.select("text").mapInPandas(count, "slot int, n long")
    summed = rows.groupBy("slot").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(1 << SLOT_BITS, np.int64)
    out[summed["slot"].to_numpy()] = summed["n"].to_numpy()
    return out


def order_keys(rarity: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Order 1: 16 bits of the slot's count on a logarithmic scale, then 47 of the hash."""
    rank = rarity[(hashes >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
    low = hashes & np.uint64((1 << 47) - 1)
    return ((rank.astype(np.uint64) << np.uint64(47)) | low).astype(np.int64)


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, n, digest, node, text_hash, last, prefix of each row: its set's size and name,
    and the keys of order 1 in its longest prefix with the largest of them. A task gives the
    prefix of a set once; rows with equal sets after the first have none."""
    counts = slot_counts(docs)
    rarity = np.floor(np.log2(1 + counts) * 1000).astype(np.int64)
    shared = docs.sparkSession.sparkContext.broadcast(rarity)

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rarity, seen = shared.value, set()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            sizes, digests, lasts, prefixes = [], [], [], []
            for part in by_size(texts, len, CHUNK):
                for own in shingle_sets(part, WIDTH):
                    digest = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    keys = np.zeros(0, np.int64)
                    if len(own) and digest not in seen:
                        seen.add(digest)
                        keys = order_keys(rarity, own)
                        most = longest_prefix(len(own))
                        if most < len(keys):
                            keys = np.partition(keys, most - 1)[:most]
                    sizes.append(len(own))
                    digests.append(digest)
                    lasts.append(int(keys.max()) if len(keys) else None)
                    prefixes.append(keys)
            offsets = np.concatenate(([0], np.cumsum([len(p) for p in prefixes]))).astype(np.int32)
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(sizes, pa.int64()),
                    pa.array(digests, pa.binary()),
                    batch.column("text_hash"),
                    pa.array(lasts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                ],
                names=["doc_id", "n", "digest", "text_hash", "last", "prefix"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        F.xxhash64("text").alias("text_hash"),
    )
    schema = "doc_id long, n long, digest binary, text_hash long, last long, prefix array<bigint>"
    out = rows.mapInArrow(run, schema).withColumn("node", F.xxhash64("digest"))
    return stored(out, "sketched")


def verified(pairs: DataFrame, docs: DataFrame, hashes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough.

    `docs` has the texts (text, text_hash), `hashes` the text_hash of every node. The sets
    are made anew from the texts of the paired nodes only. A row has its partners with it,
    so each set is exchanged once per partner and no more. A pair must first share a prefix
    shingle under each of the further orders.
    """

    @released
    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            place = list(enumerate(batch["text"]))
            for part in by_size(place, lambda r: len(r[1]), CHUNK):
                found = shingle_sets([t for _, t in part], WIDTH)
                rows = batch.iloc[[i for i, _ in part]]
                yield rows[["node", "partners", "is_b"]].assign(
                    shingles=[s.tobytes() for s in found]
                )

    @released
    def similar(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)):
                p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                least = needed(len(p), len(q))
                if least <= min(len(p), len(q)) and share_prefixes(p, q, least):
                    keep[i] = len(np.intersect1d(p, q, assume_unique=True)) >= least
            yield batch.loc[keep, ["a", "b"]]

    pairs = stored(pairs, "pairs")
    # A node's partners are no more than the pivots of its prefix shingles or the texts of
    # other components it was paired with.
    sides = pairs.select(F.col("a").alias("node"), F.col("b").alias("partner")).unionByName(
        pairs.select(F.col("b").alias("node"), F.lit(None).cast("long").alias("partner"))
    )
    nodes = sides.groupBy("node").agg(
        F.collect_list("partner").alias("partners"),
        F.max(F.col("partner").isNull()).alias("is_b"),
    )
    wanted = stored(nodes.join(hashes, "node"), "wanted")
    held = docs.where(maybe_among(wanted, "text_hash")(F.col("text_hash")))
    texts = held.groupBy("text_hash").agg(F.first("text").alias("text"))
    known = texts.join(wanted, "text_hash").select("node", "partners", "is_b", "text")
    schema = "node long, partners array<bigint>, is_b boolean, shingles binary"
    known = stored(known.mapInPandas(sets, schema), "sets")
    left = known.select(F.col("node").alias("a"), F.explode("partners").alias("b"), F.col("shingles").alias("x"))
    right = known.where("is_b").select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    joined = left.join(right, "b").select("a", "b", "x", "y")
    return stored(joined.mapInPandas(similar, "a long, b long"), "links")


def share_prefixes(p: np.ndarray, q: np.ndarray, least: int) -> bool:
    """Whether two sets share a prefix shingle under every further order."""
    for factor in ORDERS:
        u, v = p * factor, q * factor
        i, j = len(p) - least, len(q) - least
        u = np.partition(u, i)[: i + 1] if i + 1 < len(u) else u
        v = np.partition(v, j)[: j + 1] if j + 1 < len(v) else v
        if not np.isin(u, v, assume_unique=True).any():
            return False
    return True


def _least_shared(n: Column, last: Column, m: Column, last2: Column) -> Column:
    """How many shared shingles similar sets of `n` and `m` have at least in both longest
    prefixes. Let x be the set whose prefix ends first in order 1: shared shingles are those
    of both prefixes and at most the |x| - |prefix of x| behind it."""
    behind = F.when(last <= last2, _ceil_div(OVER * n, UNDER)).otherwise(_ceil_div(OVER * m, UNDER))
    return F.greatest(F.lit(1), _needed(n, m) - behind + 1)


def _may_link(x: str, y: str) -> Column:
    """Whether the sizes and the places in order 2 allow a similar pair: `x` and `y` end the
    names of the columns n, last, place and held (T) of the two sides."""
    n, m = F.col(f"n{x}"), F.col(f"n{y}")
    least = _least_shared(n, F.col(f"last{x}"), m, F.col(f"last{y}"))
    return (
        (_needed(n, m) <= F.least(n, m))
        & (F.col(f"place{x}") <= F.col(f"held{x}") - least)
        & (F.col(f"place{y}") <= F.col(f"held{y}") - least)
    )


def listed(sketch: DataFrame) -> DataFrame:
    """token, node, n, last, place, held, holders: the prefix shingles that more than one
    class holds, each with its place in order 2 among the `held` ones of its class, and a
    hash of the classes that hold it.

    Only shingle and class are exchanged for all prefixes; most shingles are held by one
    class alone and end there.
    """
    rows = sketch.select("node", F.explode("prefix").alias("token"))
    whole = Window.partitionBy("token")
    rows = rows.withColumn("low", F.min("node").over(whole)).withColumn(
        "high", F.max("node").over(whole)
    )
    rows = rows.where("low <> high").select("token", "node")
    rows = stored(rows, "shared").distinct()
    rows = rows.withColumns(
        {
            "size": F.count("*").over(whole),
            "holders": F.expr("bit_xor(xxhash64(node)) OVER (PARTITION BY token)"),
        }
    )
    # A class holds no more shingles than its longest prefix has.
    own = Window.partitionBy("node")
    rows = rows.select(
        "token",
        "node",
        "holders",
        (F.row_number().over(own.orderBy("size", "token")) - 1).alias("place"),
        F.count("*").over(own).alias("held"),
    )
    sizes = sketch.where("last is not null").groupBy("node").agg(
        F.max("n").alias("n"), F.max("last").alias("last")
    )
    return stored(rows.join(sizes, "node"), "listed")


def lists_of(rows: DataFrame) -> DataFrame:
    """Lists of the same holders as one, with each holder's first place in them: two texts
    that share a passage share many shingles, but pair up once. Lists that a hash throws
    together only pair more."""
    one = rows.groupBy("holders", "node").agg(
        *[F.min(c).alias(c) for c in ("n", "last", "place", "held")]
    )
    return stored(one.withColumnRenamed("holders", "token"), "lists")


def profiles(rows: DataFrame) -> DataFrame:
    """node, n, last, tokens: the listed shingles of each text, as many as its longest prefix
    has at the most."""
    held = rows.groupBy("node").agg(
        F.first("n").alias("n"), F.first("last").alias("last"), F.collect_list("token").alias("tokens")
    )
    return stored(held, "profiles")


def enough_shared(pairs: DataFrame, held: DataFrame) -> DataFrame:
    """The pairs (a, b) that share as many prefix shingles as similar sets must."""

    def side(name):
        return held.select(*[F.col(c).alias(f"{name}{x}") for c, x in
                             (("node", ""), ("n", "_n"), ("last", "_last"), ("tokens", "_t"))])

    rows = pairs.join(side("a"), "a").join(side("b"), "b")
    least = _least_shared(F.col("a_n"), F.col("a_last"), F.col("b_n"), F.col("b_last"))
    return rows.where(F.size(F.array_intersect("a_t", "b_t")) >= least).select("a", "b")


_SIDE = ("node", "n", "last", "place", "held")


def pivot_pairs(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of each listed class with the pivots (b) of its lists."""
    latest = Window.partitionBy("token").orderBy(F.desc("last"), "node")
    seen = latest.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    pivots = [F.nth_value(F.struct(*_SIDE), k).over(seen) for k in range(1, PIVOTS + 1)]
    rows = rows.select(*_SIDE, F.array(*pivots).alias("pivots"))
    rows = rows.select(*_SIDE, F.explode("pivots").alias("p"))
    rows = rows.select(*_SIDE, *[F.col(f"p.{c}").alias(f"{c}2") for c in _SIDE])
    rows = rows.where((F.col("node") != F.col("node2")) & _may_link("", "2"))
    return rows.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct()


def crossing_pairs(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """Pairs (a, b) of listed classes of different components that may be similar enough."""
    rows = rows.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    whole = Window.partitionBy("token")
    n = F.col("n")
    # The fewest shingles to share with any partner in the list: the bound falls to both
    # sides of n, so the smallest and the largest partner decide. Beyond n it is a difference
    # of two ceilings, which a larger partner may raise by one, so one less is taken there.
    ends = [F.greatest(_ceil_div(OVER * n, UNDER), F.col("n_low")),
            F.least(F.floor(UNDER * n / OVER).cast("long"), F.col("n_high"))]

    def bound(m: Column) -> Column:
        return _needed(n, m) - _ceil_div(OVER * F.greatest(n, m), UNDER) + 1

    least = F.greatest(F.lit(1), F.least(bound(ends[0]), bound(ends[1]) - 1))
    rows = (
        rows.withColumn("n_low", F.min("n").over(whole))
        .withColumn("n_high", F.max("n").over(whole))
        .where(F.col("place") <= F.col("held") - least)
        .withColumn("members", F.count("*").over(Window.partitionBy("token", "comp")))
        .withColumn("main", F.max(F.struct("members", "comp")).over(whole))
        .withColumn("apart", F.col("comp") != F.col("main.comp"))
        .withColumn("any_apart", F.max("apart").over(whole))
        .where("any_apart")
        .select("token", *_SIDE, "comp", "apart")
    )
    rows = stored(rows, "crossing")

    def side(k: int) -> DataFrame:
        return rows.select(
            "token", *[F.col(c).alias(f"{c}{k}") for c in (*_SIDE, "comp", "apart")]
        )

    # Those outside the largest component of their list meet all of the list; its members,
    # however many, are never set against each other.
    outside = side(1).where("apart1")
    once = ~F.col("apart2") | (F.col("node1") < F.col("node2"))
    apart = (F.col("comp1") != F.col("comp2")) & once & _may_link("1", "2")
    pairs = outside.withColumnRenamed("token", "list").join(
        side(2), (F.col("list") == F.col("token")) & apart
    )
    a, b = F.least("node1", "node2"), F.greatest("node1", "node2")
    return pairs.select(a.alias("a"), b.alias("b")).distinct()


def similar_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sketch, classes, comps): every row's set, the classes of equal sets (node, first_id,
    text_hash), and the component of every class that has a link (node, comp)."""
    docs = docs.select("doc_id", "text")
    wide = sketched(docs)
    sketch = stored(wide.select("doc_id", "n", "node", "text_hash"), "rows")
    stand = sketch.where("n > 0").groupBy("node").agg(
        F.min("doc_id").alias("first_id"), F.min("text_hash").alias("text_hash")
    )
    classes = stored(stand, "classes")
    hashes = classes.select("node", "text_hash")
    docs = docs.select("text", F.xxhash64("text").alias("text_hash"))
    rows = listed(wide)
    discard(wide)
    let_go(docs.sparkSession)
    held, lists = profiles(rows), lists_of(rows)
    links = verified(enough_shared(pivot_pairs(lists), held), docs, hashes)
    let_go(docs.sparkSession)
    more = enough_shared(crossing_pairs(lists, connected(links)), held)
    more = verified(more, docs, hashes)
    comps = connected(links.unionByName(more))
    return sketch, classes, comps


def _components(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The sketch, and the component of every class of equal sets: node, comp, first_id."""
    sketch, classes, comps = similar_classes(docs)
    member = classes.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    return sketch, stored(member.select("node", "comp", "first_id"), "members")


def duplicate_classes(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of `docs` (doc_id, text).

    component_id is the smallest doc_id of the rows that links reach, the row itself
    included. Null and empty texts and those of separators only have no shingles and are
    linked with nothing. Repeated rows stay and share a component; null ids are left out of
    the minimum, so it is null only where every row of a component has a null id.
    """
    sketch, member = _components(docs)
    first = member.groupBy("comp").agg(F.min("first_id").alias("component_id"))
    named = stored(member.join(first, "comp").select("node", "component_id"), "named")
    rows = sketch.select("doc_id", F.col("n").alias("n_shingles"), "node")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = rows.join(named, "node", "left")
    return out.select("doc_id", "n_shingles", own.alias("component_id"))


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One row of `docs` of each component: the one with the smallest id (nulls last, ties by
    a hash of the text), the first of equal rows. Rows without shingles are linked with
    nothing, so each of them stays."""
    sketch, member = _components(docs)
    rows = sketch.select("doc_id", "text_hash", "node").join(member, "node")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    first = rows.groupBy("comp").agg(F.min(order).alias("k"))
    first = stored(first.select(_key(F.col("k.doc_id"), F.col("k.text_hash")).alias("key")), "kept")
    # One exchange of the rows serves the join and the choice among equal ones.
    held = docs.select(
        whole_row(docs), _key(F.col("doc_id"), F.xxhash64("text")).alias("key")
    )
    kept = held.join(first, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
    wordless = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    return kept.unionByName(docs.where(wordless))


def _key(doc_id: Column, text_hash: Column) -> Column:
    return F.xxhash64(doc_id.isNull(), doc_id, text_hash)
