"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every position, the hash of what stands before it: a
polynomial over the code points modulo a prime. Two of its entries give the hash of any span
in constant time, moved to position 0, so any two spans are compared at once and the longest
common extension of two positions is found by binary search. Two primes make a 62-bit hash.

A fingerprint is the text's length, its whole hash and the `KEPT` smallest hashes of its
spans of `SPAN` code points: equal texts have equal fingerprints, and the share of common
values among the smallest of two texts estimates how many of their spans are shared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released

PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_000_003 * 911, 998_244_353 * 2 + 1)
SPAN = 16
KEPT = 64
CHUNK = 400_000
# Rows of a slice, and the most slices there are: what names them stays small at any size.
ROWS, SLICES = 4096, 20_000

_POWERS: dict[tuple[int, int], np.ndarray] = {}


def powers(base: int, prime: int, n: int) -> np.ndarray:
    """base ** j modulo prime for j below `n` at least."""
    known = _POWERS.get((base, prime))
    if known is None or len(known) < n:
        known = np.ones(1, np.uint64)
        while len(known) < n:
            step = np.uint64(pow(base, len(known), prime))
            known = np.concatenate([known, known * step % np.uint64(prime)])
        _POWERS[base, prime] = known
    return known


class PrefixHashes:
    """Prefix arrays of one or more texts that stand behind each other."""

    def __init__(self, texts: list[str]):
        self.lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)))[:-1]
        codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = codes.astype(np.uint64) + np.uint64(1)
        self.prefix, self.down = [], []
        for base, prime in zip(BASES, PRIMES, strict=True):
            p = np.uint64(prime)
            terms = codes * powers(base % prime, prime, len(codes) + 1)[: len(codes)] % p
            self.prefix.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms) % p)))
            self.down.append(powers(pow(base, -1, prime), prime, len(codes) + 1))

    def spans(self, which: int, start, length):
        """Hashes of spans under one prime; start and length may be arrays."""
        p = np.uint64(PRIMES[which])
        prefix = self.prefix[which]
        return (prefix[start + length] + p - prefix[start]) * self.down[which][start] % p

    def equal(self, i: int, j: int, length: int) -> bool:
        """Whether the spans of `length` at positions i and j are equal."""
        return all(self.spans(w, i, length) == self.spans(w, j, length) for w in (0, 1))

    def extension(self, i: int, j: int, most: int) -> int:
        """Length of the longest common extension of positions i and j, `most` at the most."""
        low, high = 0, most
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(i, j, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def whole(self, k: int) -> tuple[int, int]:
        start, length = int(self.starts[k]), int(self.lengths[k])
        return tuple(int(self.spans(w, start, length)) for w in (0, 1))

    def sketches(self) -> list[np.ndarray]:
        """Of each text, the smallest distinct hashes of its spans, in ascending order."""
        total = int(self.lengths.sum())
        width = min(SPAN, total)
        every = self.spans(0, np.arange(total - width + 1), width) if total else None
        out = []
        for start, length in zip(self.starts.tolist(), self.lengths.tolist(), strict=True):
            if length == 0:
                out.append(np.zeros(0, np.uint64))
            elif length <= SPAN:
                out.append(np.array([self.spans(0, start, length)], np.uint64))
            else:
                own = every[start : start + length - SPAN + 1]
                out.append(smallest(own))
        return out


def smallest(hashes: np.ndarray) -> np.ndarray:
    """The KEPT smallest distinct values. Values below a bound that about four times as many
    reach are looked at first; all of them where repeats leave too few."""
    if len(hashes) > 16 * KEPT:
        low = hashes[hashes < np.uint64(PRIMES[0] // len(hashes) * 4 * KEPT)]
        found = np.unique(low)
        if len(found) >= KEPT:
            return found[:KEPT]
    return np.unique(hashes)[:KEPT]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Estimated share of common spans of two sketches; 1 for two empty texts."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:KEPT]
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True)).sum() / len(union))


def fingerprint(length: int, whole: tuple[int, int], sketch: np.ndarray) -> str:
    head = f"{length:x}-{whole[0]:08x}{whole[1]:08x}-"
    return head + sketch.astype(">u4").tobytes().hex()


def edit(text: str, following: str) -> str:
    """The last third of a text replaced by as much of the head of the following one."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


def compared(rows: list[tuple[str | None, str, str]]) -> pd.DataFrame:
    """The result rows of (doc_id, text, next text)."""
    edited = [edit(t, n) for _, t, n in rows]
    own = [t for _, t, _ in rows]
    # A text's successor is mostly the text of the row behind it: hash it once.
    at: dict[str, int] = {}
    extra = []
    for _, _, following in rows:
        if following not in at:
            at[following] = -1
    for k, text in enumerate(own):
        if text in at:
            at[text] = k
    for text, k in at.items():
        if k < 0:
            at[text] = 2 * len(rows) + len(extra)
            extra.append(text)
    hashes = PrefixHashes([*own, *edited, *extra])
    sketches = hashes.sketches()
    out, n = [], len(rows)
    for k, (doc_id, text, following) in enumerate(rows):
        e = n + k
        most = int(min(hashes.lengths[k], hashes.lengths[e]))
        out.append(
            (
                doc_id,
                len(text),
                hashlib.sha256(edited[k].encode("utf-8", "surrogatepass")).hexdigest(),
                fingerprint(len(text), hashes.whole(k), sketches[k]),
                fingerprint(len(edited[k]), hashes.whole(e), sketches[e]),
                likeness(sketches[k], sketches[e]),
                likeness(sketches[k], sketches[at[following]]),
                hashes.extension(int(hashes.starts[k]), int(hashes.starts[e]), most),
            )
        )
    columns = [c.split()[0] for c in SCHEMA.split(", ")]
    return pd.DataFrame(out, columns=columns)


SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double, common_prefix long"
)


def with_successors(docs: DataFrame, rows_per_slice: int = ROWS) -> DataFrame:
    """Rows (slice, beyond, doc_id, text), sorted in each partition by slice, so that the row
    behind a document is the next one in descending order of doc_id.

    Ids are cut into ranges by approximate quantiles; the head of a range goes to the one
    before it as well (`beyond`), and the head of the first to the last. So texts are
    exchanged once, each range to a task of its own. There are `SLICES` ranges at most, so
    cuts and heads are bounded; beyond that ranges grow with the rows, and tasks sort them
    on disk.
    """
    n = docs.count()
    parts = max(1, min(-(-n // rows_per_slice), SLICES))
    shares = [k / parts for k in range(1, parts)]
    cuts = [] if not shares else docs.select(
        F.percentile_approx("doc_id", shares, max(10_000, 20 * parts)).alias("q")
    ).first()["q"]
    cuts = np.array(sorted(set(cuts or [])), np.int64)

    @F.pandas_udf("int")
    def slice_of(ids: pd.Series) -> pd.Series:
        place = np.searchsorted(cuts, ids.to_numpy(np.int64), "left")
        return pd.Series((len(cuts) - place).astype("int32"))

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    ranged = slice_of(F.coalesce("doc_id", F.lit(0)))
    rows = rows.withColumn(
        "slice", F.when(F.col("doc_id").isNull(), len(cuts) + 1).otherwise(ranged)
    )
    # One row per slice: SLICES + 2 at most.
    heads = rows.groupBy("slice").agg(F.max("doc_id").alias("head")).orderBy("slice").collect()
    before = {h["slice"]: heads[k - 1]["slice"] for k, h in enumerate(heads)}
    copies = docs.sparkSession.createDataFrame(
        [(h["slice"], h["head"], before[h["slice"]]) for h in heads],
        "s int, head long, goes_to int",
    )
    firsts = rows.join(
        F.broadcast(copies),
        (F.col("slice") == F.col("s")) & F.col("doc_id").eqNullSafe(F.col("head")),
    )
    order = ["slice", "beyond", F.desc_nulls_last("doc_id"), "text"]
    own = rows.select("slice", F.lit(False).alias("beyond"), "doc_id", "text")
    beyond = firsts.select(F.col("goes_to").alias("slice"), F.lit(True).alias("beyond"), "doc_id", "text")
    # Slices are numbers from 0 on: each is a partition, none holds two.
    dealt = own.unionByName(beyond).repartitionById(len(cuts) + 2, "slice")
    return dealt.sortWithinPartitions(*order)


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, common_prefix of every row of `docs` (doc_id, text).

    The next document is that with the next smaller id (nulls come last, equal ids by their
    text); the last one's is the first. A null text is empty. common_prefix is the longest
    common extension of the text and the edited text from their starts. Repeated rows stay;
    a single row is its own successor; an empty table gives no rows.
    """

    @released
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: tuple | None = None  # slice, doc_id, text of the last own row
        ready: list[tuple] = []
        size = 0
        for batch in batches:
            for part, beyond, doc_id, text in zip(
                batch["slice"], batch["beyond"], batch["doc_id"], batch["text"], strict=True
            ):
                if waiting is not None and waiting[0] == part:
                    ready.append((waiting[1], waiting[2], text))
                    size += len(waiting[2])
                    waiting = None
                if not beyond:
                    waiting = (part, doc_id, text)
                if size >= CHUNK:
                    yield compared(ready)
                    ready, size = [], 0
        if ready:
            yield compared(ready)

    # Ids go through Python as text: pandas would turn long ids beside nulls into floats.
    rows = with_successors(docs).withColumn("doc_id", F.col("doc_id").cast("string"))
    out = rows.mapInPandas(run, SCHEMA.replace("doc_id long", "doc_id string"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
