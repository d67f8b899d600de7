"""Long repeated strings removed from a collection, by its columns' Burrows-Wheeler transform.

A byte goes if a string of `span` bytes that covers it also starts anywhere else. To find
the strings that repeat, each string (a window of `span` bytes of one text) is named by its
anchor: the leftmost of its `anchor`-byte strings with the smallest hash. Windows in a row
with the anchor at the same place form a piece. Equal windows have equal anchors, at the same
distance: a piece is compared only with pieces of its anchor, its bin. Spark counts them:

* an anchor of one piece only has nothing that repeats;
* pieces that are all equal repeat as a whole. Their bytes are never looked at;
* only bins of several different pieces need the strings themselves, one of each.

Those are laid under one another, anchors aligned, and the suffix order is built column by
column from the right: each round inserts one symbol per piece. The symbols before the
sorted suffixes, which are the transform of the column just built, are dealt out stably by
symbol and give the order of the next; the common prefix of two neighbours follows from the
smallest one between their last places. A window repeats if the common prefix of its suffix
with a neighbour's reaches `span`. Equal windows stand in the same column, so a round keeps
the suffixes of one column and its work grows with the number of pieces alone.

A collection of many bins is one group of bounded size. A bin of too many different pieces
is split: windows are cut into blocks, and a block's bin is named by the bytes all windows
of the block share. A block of one window is named by the window itself, so this ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenderlake.operators.joins import attach, drop_matching, keep_matching

from .common import released, stored

SPAN = 400
ANCHOR = 64
# Bytes looked at together; places within them take the low bits of a hash.
SEGMENT = 1 << 20
# Pieces of a collection on average, and different pieces of a bin that is not split.
GROUP = 4096
LARGEST_BIN = 8192
# Windows of a block when a bin is split, again when that is too large, and in the end.
BLOCKS = (48, 7, 1)

_SYMBOLS = np.random.default_rng(400).integers(1, 1 << 63, 256).astype(np.uint64)
_BASE = 0x9E3779B97F4A7C15


@cache
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    up, down = np.full(SEGMENT, _BASE, np.uint64), np.full(SEGMENT, pow(_BASE, -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def hashes(data: np.ndarray, length: int) -> np.ndarray:
    """A hash of each string of `length` bytes, from prefix sums of symbols times powers."""
    up, down = _powers()
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_SYMBOLS[data] * up[:n], out=sums[1:])
    x = (sums[length:] - sums[:-length]) * down[: n - length + 1]
    # The low bits of a sum modulo a power of two are weak.
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def anchors(data: np.ndarray, span: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every anchor string, and for every window the place of its anchor: the
    smallest hash (its low bits give way to the place), the leftmost of equal ones."""
    x = hashes(data, anchor)
    low = np.uint64(SEGMENT - 1)
    width = span - anchor + 1
    ranked = np.full(-(-len(x) // width) * width, ~np.uint64(0))
    ranked[: len(x)] = (x & ~low) | np.arange(len(x), dtype=np.uint64)
    blocks = ranked.reshape(-1, width)
    # The smallest of any `width` values: of the end of one block and the head of the next.
    head = np.minimum.accumulate(blocks, 1).ravel()
    tail = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    windows = len(data) - span + 1
    least = np.minimum(tail[:windows], head[width - 1 : width - 1 + windows])
    return x, (least & low).astype(np.int64)


def pieces(data: np.ndarray, bounds: np.ndarray, span: int, anchor: int):
    """Of texts of at least `span` bytes one after another: text, first window, windows,
    place of the anchor from the first window, hash of the anchor, of each piece."""
    x, place = anchors(data, span, anchor)
    begin, windows = bounds[:-1], np.diff(bounds) - span + 1
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    new[begin] = True
    # Windows that reach into the next text are none.
    edge = np.zeros(len(place) + 1, np.int32)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + windows, -1)
    first = np.flatnonzero(new & (np.cumsum(edge)[:-1] > 0))
    text = np.searchsorted(begin, first, "right") - 1
    last = np.minimum(np.append(first[1:], len(data)), begin[text] + windows[text])
    return text, first, last - first, place[first] - first, x[place[first]]


def segments(offsets: np.ndarray, span: int) -> Iterator[tuple[int, np.ndarray, int]]:
    """First text, bounds, and bytes of that text before them, of runs of whole texts that fit
    a segment. A longer text is cut into segments that share span - 1 bytes, so that each
    window lies in one."""
    i, n = 0, len(offsets) - 1
    while i < n:
        if offsets[i + 1] - offsets[i] > SEGMENT:
            for at in range(offsets[i], offsets[i + 1] - span + 1, SEGMENT - span + 1):
                yield i, np.array([at, min(at + SEGMENT, offsets[i + 1])]), at - offsets[i]
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + SEGMENT, "right")) - 1)
        yield i, offsets[i : j + 1], 0
        i = j


def _digest(*parts) -> int:
    h = hashlib.blake2b(digest_size=8)
    for part in parts:
        h.update(part)
    return int.from_bytes(h.digest(), "little", signed=True)


PIECES = "th binary, start long, wins int, off int, key long, d long"


def piece_rows(texts: DataFrame, span: int, anchor: int) -> DataFrame:
    """The pieces of every text of at least `span` bytes: th, first window, windows, place of
    the anchor, hash of the anchor (`key`) and of the piece (`d`)."""

    @released
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, column = batch.column(0), batch.column(1).cast(pa.large_binary())
            if not len(column):
                continue
            offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
            data = np.frombuffer(column.buffers()[2], np.uint8)
            raw = memoryview(column.buffers()[2])
            for first_text, bounds, before in segments(offsets, span):
                base = int(bounds[0])
                inside = bounds - base
                text, first, wins, off, key = pieces(data[base : int(bounds[-1])], inside, span, anchor)
                ends = first + wins + span - 1
                named = [
                    _digest(raw[a:b]) for a, b in zip((first + base).tolist(), (ends + base).tolist(), strict=True)
                ]
                yield pa.record_batch(
                    [
                        names.take(pa.array(text + first_text)),
                        pa.array(first - inside[text] + before, pa.int64()),
                        pa.array(wins, pa.int32()),
                        pa.array(off, pa.int32()),
                        pa.array(key.view(np.int64), pa.int64()),
                        pa.array(named, pa.int64()),
                    ],
                    ["th", "start", "wins", "off", "key", "d"],
                )

    return texts.mapInArrow(cut, PIECES)


def repeated_windows(
    contents: list[bytes], offs: np.ndarray, span: int, anchor: int
) -> np.ndarray:
    """For every piece and column (a window's place before the anchor, furthest first), whether
    the window there stands in another piece of the collection too."""
    width, m = span - anchor + 1, len(contents)
    columns = width - 1 + span
    rows = np.zeros((m, columns), np.uint8)
    for row, content, off in zip(rows, contents, offs.tolist(), strict=True):
        at = width - 1 - off
        # No byte of UTF-8 is 255: 0 stands for no symbol.
        row[at : at + len(content)] = np.frombuffer(content, np.uint8) + 1
    symbols = np.ascontiguousarray(rows.T)
    del rows
    found = np.zeros((width, m), bool)
    order = np.arange(m)
    # common[i]: the common prefix of the i-th suffix and the one before it.
    common = np.zeros(m + 1, np.int16)
    for column in range(columns - 1, -1, -1):
        transform = symbols[column][order]
        deal = np.argsort(transform, kind="stable")
        dealt = transform[deal]
        alike = np.flatnonzero((dealt[1:] == dealt[:-1]) & (dealt[1:] > 0))
        order = order[deal]
        new = np.zeros(m + 1, np.int16)
        if len(alike):
            between = np.empty(2 * len(alike), np.int64)
            between[0::2], between[1::2] = deal[alike] + 1, deal[alike + 1] + 1
            new[alike + 1] = np.minimum.reduceat(common, between)[::2] + 1
        common = new
        if column < width:
            long = np.flatnonzero(common[:m] >= span)
            found[column, order[long]] = True
            found[column, order[long - 1]] = True
    return found.T


def runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and ends of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[0::2], edges[1::2]


FOUND = "key long, d long, runs array<struct<begin: int, end: int>>"


def _collections(contents: DataFrame, span: int, anchor: int) -> DataFrame:
    """key, d, runs of repeated windows, of pieces whose bins are not too large."""
    width = span - anchor + 1

    def together(rows: pd.DataFrame) -> pd.DataFrame:
        offs = rows["off"].to_numpy(np.int64)
        flags = repeated_windows(rows["bytes"].tolist(), offs, span, anchor)
        out = []
        for flag, off, wins, n in zip(flags, offs, rows["wins"], rows["n"], strict=True):
            own = flag[width - 1 - off : width - 1 - off + wins]
            begins, ends = runs(own | (n > 1))
            out.append([{"begin": int(a), "end": int(b)} for a, b in zip(begins, ends, strict=True)])
        result = pd.DataFrame({"key": rows["key"], "d": rows["d"], "runs": out})
        return result[result["runs"].map(len) > 0]

    groups = max(1, round(contents.count() / GROUP))
    dealt = contents.withColumn("__group", F.pmod(F.xxhash64("key"), F.lit(groups)))
    return dealt.groupBy("__group").applyInPandas(together, FOUND)


def _blocks(contents: DataFrame, block: int, span: int, anchor: int) -> DataFrame:
    """Every piece once per block of its windows, cut to the block: key, d, shift (the block's
    first window in the piece), and the block's own key, d, n, wins, off, bytes."""
    width = span - anchor + 1

    @released
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r in batch.itertuples(index=False):
                column = width - 1 - r.off
                for t in range(column // block, (column + r.wins - 1) // block + 1):
                    low = max(t * block - column, 0)
                    high = min((t + 1) * block - column, r.wins)
                    # What all windows of the whole block share lies in every piece's part.
                    core = r.bytes[(t + 1) * block - 1 - column : t * block + span - column]
                    own = r.bytes[low : high - 1 + span]
                    key = _digest(r.key.to_bytes(8, "little", signed=True), b"%d,%d:" % (block, t), core)
                    d = _digest(b"%d:" % (low + column), own)
                    out.append((r.key, r.d, low, key, d, r.n, high - low, r.off - low, own))
            names = ["key", "d", "shift", "ckey", "cd", "n", "wins", "off", "bytes"]
            yield pd.DataFrame(out, columns=names)

    schema = "key long, d long, shift int, ckey long, cd long, n long, wins int, off int, bytes binary"
    return contents.select("key", "d", "n", "wins", "off", "bytes").mapInPandas(cut, schema)


def resolve(
    contents: DataFrame,
    span: int,
    anchor: int,
    blocks: tuple[int, ...] = BLOCKS,
    largest: int | None = None,
) -> DataFrame:
    """key, d, runs of repeated windows of different pieces (key, d, n, wins, off, bytes)."""
    largest = LARGEST_BIN if largest is None else largest
    bins = contents.groupBy("key").agg(F.count("*").alias("different"), F.sum("n").alias("n"))
    large = stored(bins.where(F.col("different") > largest).select("key"), "large-bins")
    if not blocks or large.isEmpty():
        return _collections(contents, span, anchor)
    small = _collections(stored(drop_matching(contents, large, ["key"]), "small-bins"), span, anchor)
    cut = stored(_blocks(keep_matching(contents, large, ["key"]), blocks[0], span, anchor), "blocks")
    children = cut.groupBy(F.col("ckey").alias("key"), F.col("cd").alias("d")).agg(
        F.sum("n").alias("n"), *[F.first(c).alias(c) for c in ("wins", "off", "bytes")]
    )
    children = stored(children, "block-contents")
    kinds = children.groupBy("key").agg(F.count("*").alias("different"), F.sum("n").alias("total"))
    children = stored(attach(children, kinds.where("total > 1"), ["key"], "inner"), "block-bins")
    alike = children.where("different = 1").selectExpr(
        "key", "d", "array(struct(0 AS begin, wins AS end)) AS runs"
    )
    mixed = children.where("different > 1").select("key", "d", "n", "wins", "off", "bytes")
    found = alike.unionByName(resolve(mixed, span, anchor, blocks[1:], largest))
    found = found.select(F.col("key").alias("ckey"), F.col("d").alias("cd"), "runs")
    links = cut.select("key", "d", "shift", "ckey", "cd")
    back = attach(links, found, ["ckey", "cd"], "inner").select(
        "key", "d", F.expr("transform(runs, r -> struct(r.begin + shift AS begin, r.end + shift AS end)) AS runs")
    )
    back = back.groupBy("key", "d").agg(F.flatten(F.collect_list("runs")).alias("runs"))
    return small.unionByName(back)


def _name(text: Column) -> Column:
    """128 bits of a text's SHA-256."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def repeated_spans(texts: DataFrame, span: int, anchor: int) -> DataFrame:
    """th, spans (begin, end in bytes; they may overlap) of the texts with a repeated string."""
    long = texts.where(F.octet_length("text") >= span)
    rows = stored(piece_rows(long.select("th", "text"), span, anchor), "pieces")
    # A minimum and a maximum of numbers are combined before the exchange, however hot the key.
    bins = rows.groupBy("key").agg(F.count("*").alias("n"), F.min("d").alias("lo"), F.max("d").alias("hi"))
    bins = bins.where("n > 1").select("key", (F.col("lo") < F.col("hi")).alias("mixed"))
    marked = stored(attach(rows, bins, ["key"], "inner"), "marked-pieces")
    whole = marked.where("NOT mixed").selectExpr("th", "start AS begin", f"start + wins - 1 + {span} AS end")
    mixed = marked.where("mixed")
    # One holder of each different piece gives its bytes.
    held = mixed.groupBy("key", "d").agg(
        F.count("*").alias("n"), F.min(F.struct("th", "start", "wins", "off")).alias("at")
    )
    wanted = held.groupBy(F.col("at.th").alias("th")).agg(
        F.collect_list(F.struct("key", "d", "n", "at.start", "at.wins", "at.off")).alias("held")
    )
    once = long.groupBy("th").agg(F.first("text").alias("text"))
    parts = once.join(wanted, "th").select(
        F.expr(
            "transform(held, h -> struct(h.key, h.d, h.n, h.wins, h.off, substring("
            f"cast(text AS binary), cast(h.start + 1 AS int), h.wins + {span - 1}) AS bytes)) AS held"
        )
    )
    contents = stored(parts.select(F.inline("held")), "piece-contents")
    found = stored(resolve(contents, span, anchor), "repeated-windows")
    some = attach(mixed.select("th", "start", "key", "d").distinct(), found, ["key", "d"], "inner")
    some = some.select("th", "start", F.inline("runs")).selectExpr(
        "th", "start + begin AS begin", f"start + end - 1 + {span} AS end"
    )
    spans = whole.unionByName(some).distinct()
    return spans.groupBy("th").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


def _stripped(text: Column, spans: Column) -> Column:
    """Maximal removed runs of a text (as bytes), and the bytes beside them."""

    def strip(texts: pd.Series, found: pd.Series) -> pd.DataFrame:
        out = []
        for t, marked in zip(texts, found, strict=True):
            if t is None or marked is None:
                out.append((None, None))
                continue
            gone, kept, at = [], [], 0
            for begin, end in sorted((s["begin"], s["end"]) for s in marked):
                if gone and begin <= gone[-1]["end"]:
                    gone[-1]["end"] = max(gone[-1]["end"], end)
                else:
                    gone.append({"begin": begin, "end": end})
            for run in gone:
                kept.append(t[at : run["begin"]])
                at = run["end"]
            out.append((gone, b"".join([*kept, t[at:]])))
        return pd.DataFrame(out, columns=["spans", "kept"])

    schema = "spans array<struct<begin: long, end: long>>, kept binary"
    return F.pandas_udf(strip, schema)(text, spans)


def remove_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    span: int = SPAN,
    anchor: int = ANCHOR,
) -> DataFrame:
    """doc_id, n_bytes, spans (maximal removed runs, in bytes), kept (bytes) of every row.

    Texts are taken as UTF-8; a null text is an empty one. Strings are judged on the input:
    of texts that repeat each other no copy is spared. Rows are told apart by their text, not
    by their id: a null or repeated id is fine, and two rows of equal text repeat each other.
    No other column is read. `kept` may cut a code point in two.
    """
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
    ).withColumn("th", _name(F.col("text")))
    spans = stored(repeated_spans(rows.select("th", "text"), span, anchor), "spans")
    data = F.col("text").cast("binary")
    touched = F.when(F.col("spans").isNotNull(), data)
    done = attach(rows, spans, ["th"]).select(
        "doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"),
        _stripped(touched, F.col("spans")).alias("done"),
    )
    none = F.array().cast("array<struct<begin: long, end: long>>")
    return done.select(
        "doc_id",
        "n_bytes",
        F.coalesce("done.spans", none).alias("spans"),
        F.coalesce("done.kept", data).alias("kept"),
    )


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    return remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.begin)").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


ORACLE = f"""
WITH texts AS (
    SELECT row_number() OVER () AS row, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
    SELECT row, i, md5(substr(h, 2 * i + 1, {2 * SPAN})) AS k
    FROM texts, LATERAL (SELECT unnest(range(0, length(h) // 2 - {SPAN - 1})) AS i)),
twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
hits AS (
    SELECT row, i, coalesce(i - lag(i) OVER (PARTITION BY row ORDER BY i) > {SPAN}, TRUE) AS opens
    FROM windows SEMI JOIN twice USING (k)),
runs AS (
    SELECT row, min(i) AS b, max(i) + {SPAN} AS e
    FROM (SELECT row, i, sum(opens::INT) OVER (PARTITION BY row ORDER BY i) AS run FROM hits)
    GROUP BY row, run),
gaps AS (
    SELECT row, b, e, coalesce(lag(e) OVER (PARTITION BY row ORDER BY b), 0) AS before FROM runs),
parts AS (
    SELECT row, sum(e - b) AS n_removed, count(*) AS n_spans, max(e) AS last,
        string_agg(substr(h, 2 * before + 1, 2 * (b - before)), '' ORDER BY b) AS kept
    FROM gaps JOIN texts USING (row) GROUP BY row)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
    coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(kept || substr(h, 2 * last + 1), h))) AS kept_sha256
FROM texts LEFT JOIN parts USING (row)"""
