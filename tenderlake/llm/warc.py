"""WARC archives written and read by Spark, record boundaries verified by chains.

Writing: one record per page through Spark's own writer, so any file system works and lost
tasks are done again. Equal payloads are stored once; later pages revisit the first one.

Reading: files are read in splits at every occurrence of the version line, the magic. Each
piece between two of them is a candidate record with the offset of its successor, as its
header gives it. A payload may hold the magic too, so candidates prove nothing: only what is
reached from the start of a file by successors is a record. Each split follows its own
chains to their exits; pointer jumping over the exits finds where the true chain enters
each split, in a number of rounds that grows with the logarithm of a file's splits.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenderlake.session import scratch_path

from .common import discard, released, stored

MAGIC = "WARC/1.0\r\n"
STEP = len(MAGIC)
# Revisits up to this number are sent to all tasks; beyond it they are joined by exchange.
FEW = 500_000
# Bytes of a file whose places are compared with each other.
STRETCH = 1 << 27
_HEADERS = re.compile(rb"(?m)^([A-Za-z0-9-]+):[ \t]*(.*?)\r?$")

PIECE = (
    "file string, block long, idx long, place long, size long, after long, leaves long, "
    "header long, content long, whole boolean, record_type string, page_id long, "
    "payload_bytes long, payload_digest string, refers_to long"
)


def base32_sha1(payload: Column) -> Column:
    """Bare upper-case base32 SHA-1: 20 bits, five hex digits, make four letters."""
    hexed = F.sha1(payload)
    groups = [
        F.lpad(F.conv(F.substring(hexed, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)
    ]
    digits, letters = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
    return F.translate(F.concat(*groups), digits, letters)


def write_archives(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write one record per row of `pages` (page_id, url, html) to WARC files in `path`.

    Of the rows with equal payloads of `least_bytes` bytes or more, the one with the
    smallest page_id (nulls last, the first of equal ones) is the response, the others
    revisit it. A null html is an empty payload; line ends in a url are left out.
    """
    # Stored first: a number given to rows behind an exchange would not be the same again.
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "").alias("url"),
        F.coalesce("html", F.lit("")).alias("html"),
    ).withColumn("bytes", F.octet_length("html"))
    rows = numbered = stored(rows.withColumn("digest", base32_sha1(F.col("html").cast("binary"))), "pages")
    keys = rows.select("row", "page_id", "bytes", "digest").where(F.col("bytes") >= least_bytes)
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "row")
    first = keys.groupBy("digest", "bytes").agg(F.min(order).alias("first"), F.count("*").alias("n"))
    first = first.where("n > 1").select("digest", "bytes", "first.row", "first.page_id")
    first = first.withColumnsRenamed({"row": "first_row", "page_id": "refers_to"})
    revisits = keys.join(first, ["digest", "bytes"]).where("row <> first_row")
    revisits = revisits.select("row", "refers_to", F.lit("revisit").alias("kind"))
    revisits = stored(revisits, "revisits")
    if revisits.count() <= FEW:
        revisits = F.broadcast(revisits)
    rows = rows.join(revisits, "row", "left")
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    urn = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(c.cast("string"), F.lit("")), F.lit(">"))
    revisit = F.col("kind").isNotNull()
    record = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.coalesce("kind", F.lit("response"))),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest")),
        F.when(revisit, line("WARC-Refers-To", urn(F.col("refers_to")))).otherwise(""),
        F.when(revisit, line("Payload-Length", F.col("bytes").cast("string"))).otherwise(""),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.when(revisit, "0").otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(F.col("html")),
        F.lit("\r\n"),
    )
    # The writer ends each value with the separator: the record's second line end.
    rows.select(record.alias("value")).write.option("lineSep", "\r\n").text(path)
    discard(numbered)


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """file, block, value: the bytes between magics, in order within each split."""
    lines = spark.read.option("lineSep", MAGIC).text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("value"),
    )


def parsed(value: bytes) -> tuple[int, int, dict] | None:
    """Length of the header, length of the block, fields; None if this is no record's head."""
    end = value.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {k.lower(): v for k, v in _HEADERS.findall(value[: end + 2])}
    try:
        return end + 4, int(fields[b"content-length"]), fields
    except (KeyError, ValueError):
        return None


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _urn(value: bytes) -> int | None:
    digits = re.search(rb":(-?\d+)>$", value)
    return int(digits[1]) if digits else None


def described(head: tuple[int, int, dict], payload: bytes | None) -> tuple:
    """record_type, page_id, payload_bytes, payload_digest, refers_to. The payload's own
    length and digest are taken; a revisit states those of the payload it refers to."""
    _, content, fields = head
    kind = fields.get(b"warc-type", b"").decode("latin-1")
    page = _urn(fields.get(b"warc-record-id", b""))
    if kind == "revisit":
        digest = fields.get(b"warc-payload-digest", b"").decode("latin-1").removeprefix("sha1:")
        size = int(fields.get(b"payload-length", b"0"))
        return kind, page, size, digest, _urn(fields.get(b"warc-refers-to", b""))
    return kind, page, content, None if payload is None else digest_of(payload), None


def _numbered(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[str, int, int, bytes]]:
    """(file, block, idx, value) in the order of the split."""
    now, idx = None, 0
    for batch in batches:
        for file, block, value in zip(batch["file"], batch["block"], batch["value"], strict=True):
            if (file, block) != now:
                now, idx = (file, block), 0
            yield file, block, idx, value
            idx += 1


@released
def candidates(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pieces of each split: place and successor relative to the split's first piece, and
    where the chain from the piece leaves the split (null: it ends in no record)."""
    columns = [c.split()[0] for c in PIECE.split(", ")]

    def closed(key, rows):
        end = rows[-1]["place"] + rows[-1]["size"] + STEP
        leaves: dict[int, int | None] = {}
        for row in reversed(rows):
            after = row["after"]
            out = None if after is None else after if after >= end else leaves.get(after)
            leaves[row["place"]] = row["leaves"] = out
        frame = pd.DataFrame(rows, columns=columns).assign(file=key[0], block=key[1])
        for c in ("after", "leaves", "header", "content", "page_id", "payload_bytes", "refers_to"):
            frame[c] = frame[c].astype("Int64")
        return frame

    now, rows, place = None, [], 0
    for file, block, idx, value in _numbered(batches):
        if (file, block) != now:
            if rows:
                yield closed(now, rows)
            now, rows, place = (file, block), [], 0
        row = dict.fromkeys(columns) | {"idx": idx, "place": place, "size": len(value), "whole": False}
        head = None if block == 0 and idx == 0 else parsed(value)
        if head is not None:
            header, content, _ = head
            row["header"], row["content"] = header, content
            row["after"] = place + header + content + 4 + STEP
            row["whole"] = header + content + 4 == len(value)
            payload = value[header : header + content] if row["whole"] else None
            names = ("record_type", "page_id", "payload_bytes", "payload_digest", "refers_to")
            row |= dict(zip(names, described(head, payload), strict=True))
        rows.append(row)
        place += len(value) + STEP
    if rows:
        yield closed(now, rows)


def _entries(found: DataFrame) -> DataFrame:
    """file, block, entry: where the chain from the file's start enters each split.
    `found` has the candidates with `base`, the place of the split in its file."""
    exits = found.where("leaves is not null").select(
        "file", (F.col("base") + F.col("place")).alias("at"), (F.col("base") + F.col("leaves")).alias("to")
    )
    starts = found.select("file").distinct().withColumn("at", F.lit(STEP).cast("long"))
    nodes = exits.select("file", F.col("to").alias("at")).unionByName(starts).distinct()
    jump = stored(exits.join(nodes, ["file", "at"], "left_semi"), "exits")
    reached = stored(starts, "reached")
    most = found.groupBy("file").agg(F.countDistinct("block").alias("n")).agg(F.max("n")).first()[0]
    for _ in range((most or 1).bit_length()):
        more = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = stored(reached.unionByName(more).distinct(), "reached")
        twice = jump.select("file", "at", F.col("to").alias("via")).join(
            jump.select("file", F.col("at").alias("via"), "to"), ["file", "via"]
        )
        jump = stored(twice.select("file", "at", "to"), "exits")
    return reached


def _stretches(ranges: DataFrame, first, last) -> DataFrame:
    """Every range once for each stretch of its file that it touches: places are joined with
    ranges by file and stretch, never by the file alone."""
    return ranges.withColumn(
        "stretch", F.explode(F.sequence(F.floor(first / STRETCH), F.floor(last / STRETCH)))
    )


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record."""
    found = stored(pieces(spark, path).mapInPandas(candidates, PIECE), "candidates")
    ends = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = found.groupBy("file", "block").agg(F.sum(F.col("size") + STEP).alias("total"))
    blocks = blocks.withColumn("base", F.coalesce(F.sum("total").over(ends), F.lit(0)))
    found = stored(found.join(blocks.select("file", "block", "base"), ["file", "block"]), "placed")
    entries = _entries(found).withColumnRenamed("at", "entry")

    def followed(rows: pd.DataFrame) -> pd.DataFrame:
        after = dict(zip(rows["place"], rows["after"], strict=True))
        true, at = set(), int(rows["entry"].iloc[0] - rows["base"].iloc[0])
        while at in after and not pd.isna(after[at]):
            true.add(at)
            at = int(after[at])
        return rows.loc[rows["place"].isin(true), names]

    spans = blocks.select("file", "block", F.col("base").alias("b"), "total")
    spans = _stretches(spans, F.col("b"), F.col("b") + F.col("total") - 1)
    entered = entries.withColumn("stretch", F.floor(F.col("entry") / STRETCH))
    entered = entered.join(spans, ["file", "stretch"]).where("entry >= b and entry < b + total")
    names = ["file", "block", "idx", "place", "base"]
    inner = found.select(*names, "after").join(entered.select("file", "block", "entry"), ["file", "block"])
    true = inner.groupBy("file", "block").applyInPandas(
        followed, "file string, block long, idx long, place long, base long"
    )
    true = stored(true, "records")
    records = found.join(true.select("file", "block", "idx"), ["file", "block", "idx"])
    result = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    cut = records.where(~F.col("whole"))
    whole = records.where("whole").select(*result)
    if cut.isEmpty():
        return whole
    return whole.unionByName(_put_together(spark, path, found, cut).select(*result))


def _put_together(spark, path, found, cut) -> DataFrame:
    """Records whose payload holds the magic, joined again from their pieces."""
    at = (F.col("base") + F.col("place")).alias("at")
    owners = cut.select("file", at, (F.col("base") + F.col("after")).alias("until"))
    owners = _stretches(owners, F.col("at"), F.col("until") - 1)
    own = found.select("file", "block", "idx", (F.col("base") + F.col("place")).alias("p"))
    own = own.withColumn("stretch", F.floor(F.col("p") / STRETCH)).join(owners, ["file", "stretch"])
    own = own.where("p >= at and p < until").select("file", "block", "idx", "at", "p")

    @released
    def numbered(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, idx = None, 0
        for batch in batches:
            order = []
            for key in zip(batch["file"], batch["block"], strict=True):
                idx = idx + 1 if key == now else 0
                now = key
                order.append(idx)
            yield batch.assign(idx=order)[["file", "block", "idx", "value"]]

    def record(rows: pd.DataFrame) -> pd.DataFrame:
        value = MAGIC.encode().join(rows.sort_values("p")["value"])
        head = parsed(value)
        row = described(head, value[head[0] : head[0] + head[1]])
        frame = pd.DataFrame([row], columns=["record_type", "page_id", "payload_bytes", "payload_digest", "refers_to"])
        return frame.astype({"page_id": "Int64", "refers_to": "Int64"})

    values = pieces(spark, path).mapInPandas(numbered, "file string, block long, idx long, value binary")
    parts = values.join(own, ["file", "block", "idx"])
    schema = "record_type string, page_id long, payload_bytes long, payload_digest string, refers_to long"
    return parts.groupBy("file", "at").applyInPandas(record, schema)


def archived_pages(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Write the rows of `pages` to archives in the shared folder and read them back.

    One row per page: page_id, payload_bytes, payload_digest, record_type (response or
    revisit), refers_to. Repeated rows give one record each; an empty table none.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_archives(pages, path, least_bytes)
    return read_archives(spark, path)


ORACLE = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS x FROM pages),
g AS (SELECT *, list_transform(range(8), lambda i: ('0x' || substr(x, CAST(5 * i + 1 AS INT), 5))::BIGINT) AS v FROM p),
d AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes,
  list_aggregate(list_transform(v, lambda n: list_aggregate(list_transform([15, 10, 5, 0],
    lambda s: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((n >> s) & 31) + 1 AS INT), 1)),
    'string_agg', '')), 'string_agg', '') AS payload_digest
  FROM g),
f AS (SELECT *, first_value(page_id) OVER (PARTITION BY payload_digest, payload_bytes ORDER BY page_id) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f
"""
