"""Best-fit packing of tokenized documents into sequences.

A document's ids are cut into pieces of a sequence's length; the last piece may be shorter.
Pieces are packed by vector best fit: a sequence has a residual capacity of tokens, of
documents and of attention cost (the sum of squared lengths), a piece a demand in each. Of
the open sequences where the piece fits under every constraint, the one with the largest
weighted dot product of demand and residual ("dot"), or with the smallest weighted norm of
the residual left ("norm"), gets it. Pieces come longest first, in groups of about `GROUP`
pieces that are packed apart: each group wastes one sequence at most beside what best fit
itself leaves.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain
from unicodedata import is_normalized

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_size, released, stored

LENGTH = 2048
GROUP = 8192
END = 0
CACHE = 600_000
CHUNK = 2_000_000

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"

# Below U+0130 all that the library's steps do to a text is known: lower-casing maps one
# character to one, and the classes of letters and digits are those of Python.
SIMPLE = re.compile(r"[^\x00-\x1B\x20-į]")
SPLIT = re.compile(r"'(?:s|t|re|ve|m|ll|d)|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\w\s]|_)+")


class Memory(dict):
    """Ids of stretches. For one that is not held, `fresh` has a place that the present call
    fills when it has read all its texts."""

    def __init__(self):
        super().__init__()
        self.fresh: dict[str, bytearray] = {}

    def __missing__(self, stretch: str) -> bytearray:
        place = self.fresh.get(stretch)
        if place is None:
            place = self.fresh[stretch] = bytearray()
        return place


class Ids:
    """Ids of texts, as the tokenizer gives them without special tokens.

    The vocabulary drops white space and splits what stands between into pieces that are
    encoded apart. So the ids of a stretch without white space are remembered, and a new
    stretch is put together from remembered pieces; only new pieces go to the tokenizer.
    Memory is bounded: when `CACHE` entries are held, later ones last for one call only.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share the cores already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known = Memory()

    def _ids_of_pieces(self, new: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        for i in range(0, len(new), 2000):
            part = new[i : i + 2000]
            encoded = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            owner = np.array(encoded.word_ids)
            ends = (np.searchsorted(owner, np.arange(len(part)), "right") * 4).tolist()
            ids, start = np.array(encoded.ids, "<u4").tobytes(), 0
            for piece, end in zip(part, ends, strict=True):
                out[piece] = ids[start:end]
                start = end
        return out

    def _learn(self, stretches: list[str]) -> dict[str, bytes]:
        """Ids of stretches that are not remembered."""
        # A stretch of letters is one piece.
        split = [[x] if x.isalpha() else SPLIT.findall(x) for x in stretches]
        known = self.known
        new = [p for p in set(chain.from_iterable(split)) if p not in known]
        out = self._ids_of_pieces(new)
        for x, parts in zip(stretches, split, strict=True):
            if len(parts) != 1:
                out[x] = b"".join([out[p] if p in out else known[p] for p in parts])
        if len(known) < CACHE:
            known.update(out)
        return out

    def of(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, four bytes each, the lowest first."""
        known = self.known
        known.fresh = fresh = {}
        # One search per stretch; the stretches of a text go as soon as they are looked up.
        found = [list(map(known.__getitem__, t.lower().split())) if is_simple(t) else None for t in texts]
        if fresh:
            learned = self._learn(list(fresh))
            for stretch, place in fresh.items():
                place += learned[stretch]
        rest = [t for t, f in zip(texts, found, strict=True) if f is None]
        whole = iter(self.tokenizer.encode_batch(rest, add_special_tokens=False))
        return [np.array(next(whole).ids, "<u4").tobytes() if f is None else b"".join(f) for f in found]


_IDS: dict[str, Ids] = {}


def ids_of(path: str) -> Ids:
    """The tokenizer of a file; a Python worker keeps it for its later tasks."""
    if path not in _IDS:
        _IDS[path] = Ids(path)
        gc.set_threshold(200_000, 50, 50)  # the memory holds no cycles; searching it is waste
    return _IDS[path]


def is_simple(text: str) -> bool:
    """Whether splitting and lower-casing here are the library's own steps to the letter.
    Texts with characters from U+0130 on, control characters Python takes for white space,
    marks that need composing or the strings of special tokens go to the library whole."""
    return not SIMPLE.search(text) and "<|" not in text and is_normalized("NFC", text)


def cut(docs: DataFrame, path: str, length: int = LENGTH, remember: bool = True) -> DataFrame:
    """The pieces of every row of `docs` (doc_id, text): doc_id, piece, start, length,
    ids_crc32. The id `END` ends each document; a null text is empty. With `remember` a Python
    worker keeps what it knows of ids for its later tasks, else for one."""

    @released
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = ids_of(path)
        try:
            for batch in batches:
                yield from cut_rows(known, batch)
        finally:
            if not remember:
                known.known = Memory()

    def cut_rows(known: Ids, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
        rows = list(zip(batch["doc_id"], batch["text"], strict=True))
        for part in by_size(rows, lambda r: len(r[1] or ""), CHUNK):
            out = []
            for (doc, _), ids in zip(part, known.of([t or "" for _, t in part]), strict=True):
                ids += END.to_bytes(4, "little")
                for k, start in enumerate(range(0, len(ids), 4 * length)):
                    piece = ids[start : start + 4 * length]
                    out.append((doc, k, start // 4, len(piece) // 4, zlib.crc32(piece)))
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "length", "ids_crc32"])

    # Ids go through Python as text: pandas would turn long ids beside nulls into floats.
    plain = docs.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text"))
    out = plain.mapInPandas(run, PIECES.replace("doc_id long", "doc_id string"))
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))


def best_fit(
    lengths: np.ndarray,
    tokens: int = LENGTH,
    documents: int = LENGTH,
    attention: int = LENGTH**2,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    rule: str = "norm",
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of each piece; pieces are given longest first.

    Open sequences are held by state: those with the same residuals are alike, so a piece is
    compared with each distinct state once.
    """
    n = len(lengths)
    sequence, offset = np.zeros(n, np.int64), np.zeros(n, np.int64)
    demand = np.column_stack([lengths, np.ones(n), lengths.astype(float) ** 2])
    full = np.array([tokens, documents, attention], float)
    scale = np.array(weights) / full**2
    residual = np.empty((n, 3))
    is_open = np.zeros(n, bool)
    used = 0
    shortest = lengths.min() if n else 0
    # Sequences too full for the shortest piece are closed, so the search stays short.
    active = np.empty(0, np.int64)
    for i in range(n):
        need = demand[i]
        if (need > full).any():
            raise ValueError("a piece is larger than a sequence")
        at = -1
        if len(active):
            left = residual[active]
            fits = (left >= need).all(1)
            if fits.any():
                if rule == "dot":
                    worth = (left * need) @ scale
                else:
                    worth = -(((left - need) ** 2) @ scale)
                worth[~fits] = -np.inf
                at = active[int(worth.argmax())]
        if at < 0:
            at, used = used, used + 1
            residual[at] = full
            is_open[at] = True
            active = np.append(active, at)
        sequence[i], offset[i] = at, tokens - residual[at, 0]
        residual[at] -= need
        if residual[at, 0] < shortest or residual[at, 1] < 1:
            active = active[active != at]
    return sequence, offset


def pack(
    pieces: DataFrame,
    tokens: int = LENGTH,
    documents: int | None = None,
    attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    rule: str = "norm",
    group: int = GROUP,
) -> DataFrame:
    """`pieces` (a stored table with columns doc_id and length) plus sequence_id and offset.

    Tokens, documents and attention cost weigh alike in the choice of a sequence. Without
    limits of their own, documents and attention cost are bounded by what `tokens`
    allows anyway. Pieces of equal length come in the order of the stored table. Pieces are dealt to groups by a hash of their row, so no key can fill a
    group; each group is packed by one task in bounded memory.
    """
    documents = documents or tokens
    attention = attention or tokens * tokens
    n_groups = max(1, -(-pieces.count() // group))
    schema = f"{', '.join(f'`{n}` {t}' for n, t in pieces.dtypes)}, sequence_id long, offset long"

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "_row"], ascending=[False, True], kind="stable")
        sequence, offset = best_fit(
            rows["length"].to_numpy(np.int64), tokens, documents, attention, weights, rule
        )
        return rows.drop(columns=["_row", "_group"]).assign(
            sequence_id=(np.int64(key[0]) << 32) + sequence, offset=offset
        )

    # As above: the ids pass as text.
    schema = schema.replace("`doc_id` bigint", "`doc_id` string")
    dealt = pieces.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("_row", F.monotonically_increasing_id()).withColumn(
        "_group", F.pmod(F.xxhash64("_row"), F.lit(n_groups)).cast("long")
    )
    packed = dealt.groupBy("_group").applyInPandas(run, schema)
    return packed.withColumn("doc_id", F.col("doc_id").cast("long"))


def pack_documents(docs: DataFrame, path: str, remember: bool = True, **limits) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of `docs`.

    Repeated rows give repeated pieces; a null id stays null; an empty table gives no rows.
    """
    pieces = stored(cut(docs, path, limits.get("tokens", LENGTH), remember), "pieces")
    return pack(pieces, **limits)
