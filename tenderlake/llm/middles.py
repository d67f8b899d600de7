"""Fill-in-middle: texts cut at two places and put in another order, by a wavelet matrix.

Every code point of a text gets a class: how strong a boundary stands before it (none, a
character, a word, a sentence, a line, a paragraph). The classes are held in a wavelet
matrix: one bit vector for each bit of the class, each with a directory of ranks, the
positions dealt anew by every bit. A descent through the levels adds up the ranks of all
classes from a given one on: the number of units that begin before a position, whatever
the unit. The place of the k-th unit is found by bisection on these counts.

Python only finds the two cuts. The texts are put together, and taken apart again, by
Spark's own functions, so a text travels to Python once and not back.
"""

from __future__ import annotations

import unicodedata
from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKS = ("<P>", "<S>", "<M>")
# The classes, weakest first; a class also begins every unit before it in this list.
UNITS = ("code_point", "character", "word", "sentence", "line", "paragraph")
LEVELS = 3

_ENDERS = ".!?…。！？"
_BLANKS = " \t\n\x0b\x0c\r\x85\xa0     　" + "".join(map(chr, range(0x2000, 0x200B)))
_BLANK, _NEWLINE, _ENDER, _JOINED, _JOINER = 1, 2, 4, 8, 16


def _kinds() -> np.ndarray:
    """Per code point: blank, line feed, end of a sentence, part of the character before it."""
    kinds = np.zeros(0x110000, np.uint8)
    for c in _BLANKS:
        kinds[ord(c)] |= _BLANK
    kinds[0x0A] |= _NEWLINE
    for c in _ENDERS:
        kinds[ord(c)] |= _ENDER
    for c in range(0x300, 0x110000):
        if unicodedata.category(chr(c)) in ("Mn", "Mc", "Me"):
            kinds[c] |= _JOINED
    kinds[0x1F3FB:0x1F400] |= _JOINED  # skin tones
    kinds[0x200D] |= _JOINED | _JOINER
    return kinds


_KINDS: list[np.ndarray] = []


def classes(text: str) -> np.ndarray:
    """The class of every code point: the strongest unit that begins there.

    A character is a code point with the marks that follow it; a word runs to the next one,
    its blanks included; a sentence ends behind its full stop and the blanks after it; a line
    ends behind its line feed, a paragraph behind all line feeds from two on. The text's first
    code point begins a unit of each kind.
    """
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(points)
    out = np.zeros(n, np.uint8)
    if not n:
        return out
    if not _KINDS:
        _KINDS.append(_kinds())
    kind = _KINDS[0][points]
    blank, newline = (kind & _BLANK) > 0, (kind & _NEWLINE) > 0
    joined = (kind & _JOINED) > 0
    joined[1:] |= (kind[:-1] & _JOINER) > 0
    out[~joined] = 1
    word = np.zeros(n, bool)
    word[1:] = ~blank[1:] & blank[:-1]
    out[word] = 2
    # A word begins a sentence if what stands before its blanks ends one.
    solid = np.flatnonzero(~blank)
    if len(solid) > 1:
        ended = (kind[solid[:-1]] & _ENDER) > 0
        begins = solid[1:][ended]
        out[begins[word[begins]]] = 3
    line = np.zeros(n, bool)
    line[1:] = newline[:-1]
    out[line] = 4
    para = np.zeros(n, bool)
    para[2:] = newline[1:-1] & newline[:-2] & ~newline[2:]
    out[para] = 5
    out[0] = 5
    return out


class Bits:
    """A bit vector with the ranks at every 64th place."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros(-(-len(bits) // 64) * 64 + 64, np.uint8)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words) + 1, np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def rank(self, i: int) -> int:
        """Ones before place i."""
        word, bit = i >> 6, i & 63
        low = int(self.words[word]) & ((1 << bit) - 1)
        return int(self.before[word]) + low.bit_count()


class WaveletMatrix:
    """Classes below 2 ** LEVELS. Each level splits what the level above left in order by one
    bit of the class, highest first: zeros before ones."""

    def __init__(self, symbols: np.ndarray):
        self.n = len(symbols)
        self.levels, self.zeros = [], []
        for level in range(LEVELS - 1, -1, -1):
            ones = ((symbols >> level) & 1).astype(bool)
            self.levels.append(Bits(ones))
            self.zeros.append(self.n - int(ones.sum()))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def rank_from(self, least: int, i: int) -> int:
        """Symbols of class `least` or above among the first i: the ranks of the branches
        that lie above the path to `least`, and of that class itself."""
        lo, hi, found = 0, i, 0
        for k in range(LEVELS):
            bits = self.levels[k]
            a, b = bits.rank(lo), bits.rank(hi)
            if (least >> (LEVELS - 1 - k)) & 1:
                lo, hi = self.zeros[k] + a, self.zeros[k] + b
            else:
                found += b - a
                lo, hi = lo - a, hi - b
        return found + hi - lo


class Units:
    """The units of one kind in a text."""

    def __init__(self, text: str, unit: str):
        self.least = UNITS.index(unit)
        self.matrix = WaveletMatrix(classes(text))

    def __len__(self) -> int:
        return self.matrix.rank_from(self.least, self.matrix.n)

    def begin(self, k: int) -> int:
        """Code points before the k-th unit (from 0); all of them for k = number of units."""
        if k >= len(self):
            return self.matrix.n
        places, rank = range(self.matrix.n), self.matrix.rank_from
        return bisect_left(places, k + 1, key=lambda i: rank(self.least, i + 1))


def _cuts(unit: str):
    """Units of a text, and the code points before its two cuts."""

    @F.pandas_udf("units long, first long, second long")
    def cuts(text: pd.Series, h1: pd.Series, h2: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b in zip(text, h1, h2, strict=True):
            units = Units(t, unit)
            n = len(units)
            low, high = sorted((int(a) % (n + 1), int(b) % (n + 1)))
            out.append((n, units.begin(low), units.begin(high)))
        return pd.DataFrame(out, columns=["units", "first", "second"])

    return cuts


def restored(output: Column, form: Column) -> Column:
    """The text that `output` was made from: the marks never occur in a text that is cut."""
    p, s, m = MARKS

    def between(left: str, right: str | None) -> Column:
        rest = F.substr(output, F.locate(left, output) + len(left))
        return rest if right is None else F.substr(rest, F.lit(1), F.locate(right, rest) - 1)

    psm = F.concat(between(p, s), between(m, None), between(s, m))
    spm = F.concat(between(p, m), between(m, None), between(s, p))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    unit: str = "code_point",
    salt: int = 1,
    plain: int = 10,
    suffix_first: int = 20,
) -> DataFrame:
    """doc_id, n (code points), units, form, prefix, middle, suffix, output of every row.

    Cuts fall between units (`UNITS`); where, and which form, follows from a hash of the id
    alone. `plain` in 100 texts stay as they are, as do empty ones and those that hold a mark
    (form plain; prefix, middle and suffix null); `suffix_first` in 100 of the others take the
    form spm, the rest psm. A null text is an empty one. A row without an id is plain, since
    it has no hash. Rows are independent: repeated ids or rows give repeated results, and no
    other column is read.
    """
    p, s, m = MARKS
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(f"`{id_column}`").cast("string")), 256)
    groups = [
        F.conv(F.substring(digest, 8 * g + 1, 8), 16, 10).cast("long").alias(f"h{g + 1}")
        for g in range(4)
    ]
    rows = docs.select(
        F.col(f"`{id_column}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_column}`"), F.lit("")).alias("text"),
        *groups,
    )
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.contains("text", F.lit(mark))
    stays = (F.col("text") == "") | marked | F.coalesce(F.col("h3") % 100 >= 100 - plain, F.lit(True))
    form = F.when(stays, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    zero = F.lit(0)
    cuts = _cuts(unit)("text", F.coalesce("h1", zero), F.coalesce("h2", zero))
    rows = rows.select("doc_id", "text", form.alias("form"), cuts.alias("cut"))
    cut = F.col("form") != "plain"
    first, second = F.col("cut.first"), F.col("cut.second")
    text = F.col("text")
    parts = rows.select(
        "doc_id",
        F.length("text").cast("long").alias("n"),
        F.col("cut.units").alias("units"),
        "form",
        "text",
        F.when(cut, F.substr(text, F.lit(1), first)).alias("prefix"),
        F.when(cut, F.substr(text, first + 1, second - first)).alias("middle"),
        F.when(cut, F.substr(text, second + 1)).alias("suffix"),
        F.when(cut, first).alias("prefix_chars"),
        F.when(cut, second - first).alias("middle_chars"),
    )
    psm = F.concat(F.lit(p), "prefix", F.lit(s), "suffix", F.lit(m), "middle")
    spm = F.concat(F.lit(s), "suffix", F.lit(p), "prefix", F.lit(m), "middle")
    output = F.when(F.col("form") == "psm", psm).when(F.col("form") == "spm", spm)
    return parts.withColumn("output", output.otherwise(F.col("text"))).drop("text")


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    return fill_in_middle(docs).select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


ORACLE = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, ''))::BIGINT AS n,
        sha256('1:' || doc_id) AS h
    FROM documents),
groups AS (
    SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
        ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
    FROM hashed),
cuts AS (
    SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR h3 IS NULL OR h3 % 100 >= 90 THEN 'plain'
             WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM groups),
parts AS (
    SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s
    FROM cuts),
made AS (
    SELECT *, CASE form WHEN 'plain' THEN t
        WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output
    FROM parts)
SELECT doc_id, n, form,
    CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
    sha256(output) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN output
        WHEN 'psm' THEN regexp_replace(output, '^<P>(.*)<S>(.*)<M>(.*)$', '\\1\\3\\2', 's')
        ELSE regexp_replace(output, '^<S>(.*)<P>(.*)<M>(.*)$', '\\2\\3\\1', 's') END) AS restored_sha256
FROM made"""
