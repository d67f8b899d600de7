from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tenderlake.llm import middles


def starts(text: str, unit: str) -> list[int]:
    """Places where a unit begins, code point by code point."""
    blank = lambda c: c.isspace()
    out = []
    for i, c in enumerate(text):
        before = text[:i]
        line = i == 0 or text[i - 1] == "\n"
        para = i == 0 or (before.endswith("\n\n") and c != "\n")
        word = i == 0 or (not blank(c) and blank(text[i - 1]))
        sentence = i == 0 or (word and before.rstrip()[-1:] in tuple(".!?"))
        mark = c in "́‍" or text[i - 1 : i] == "‍"
        begins = {
            "code_point": True,
            "character": i == 0 or not mark or line or word,
            "word": word or line,
            "sentence": sentence or line,
            "line": line,
            "paragraph": para,
        }[unit]
        if begins:
            out.append(i)
    return out


@pytest.mark.parametrize("unit", middles.UNITS)
def test_units_begin_where_a_plain_walk_finds_them(unit):
    rng = random.Random(unit)
    for _ in range(150):
        text = "".join(rng.choice("ab é.! \n\n😀́‍") for _ in range(rng.randrange(90)))
        units, want = middles.Units(text, unit), starts(text, unit)
        assert len(units) == len(want)
        assert [units.begin(k) for k in range(len(want))] == want
        assert units.begin(len(want)) == len(text)


def test_ranks_against_counts():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 6, n).astype(np.uint8)
        matrix = middles.WaveletMatrix(symbols)
        for i in {0, 1, n // 2, 63, 64, n} & set(range(n + 1)):
            for least in range(8):
                assert matrix.rank_from(least, i) == int((symbols[:i] >= least).sum())


def expected(doc_id, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * g : 8 * g + 8], 16) for g in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if doc_id is None or not text or any(x in text for x in middles.MARKS) or h3 % 100 >= 90:
        return "plain", None, None, text
    if h4 % 100 < 20:
        return "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_digests_against_plain_python(documents):
    rng = random.Random(5)
    rows = [(i, "".join(rng.choice("aé😀 <P>SM\n") for _ in range(rng.randrange(60))), "en", "s")
            for i in range(150)]
    rows += [(1000, None, "en", "s"), (1001, "", None, None), (1002, "x<P>y", "en", "s"), (7, "again", "en", "s"),
             (7, "again", "en", "s"), (None, "no id", "en", "s"), (1003, "😀 word\n" * 40_000, "en", "s"),
             (2**60 + 1, "<<S<M<P", "en", "s")]
    out = middles.digests(documents(rows)).collect()
    want = []
    for i, t, _, _ in rows:
        form, prefix, middle, output = expected(i, t)
        want.append((i, len(t or ""), form, prefix, middle, sha(output), sha(t or "")))
    assert sorted(map(repr, map(tuple, out))) == sorted(map(repr, want))


@pytest.mark.parametrize("unit", middles.UNITS)
def test_cuts_fall_between_units_and_texts_come_back(documents, unit):
    text = "One two. Three!\nNext line é́ here.\n\nA paragraph. 😀"
    out = middles.fill_in_middle(documents([(i, text, "en", "s") for i in range(60)]), unit=unit)
    got = out.withColumn("back", middles.restored(F.col("output"), F.col("form"))).collect()
    places = {*starts(text, unit), len(text)}
    forms = set()
    for r in got:
        forms.add(r["form"])
        assert r["back"] == text and r["units"] == len(starts(text, unit))
        if r["form"] != "plain":
            assert r["prefix"] + r["middle"] + r["suffix"] == text
            assert {r["prefix_chars"], r["prefix_chars"] + r["middle_chars"]} <= places
    assert forms == {"plain", "psm", "spm"}


def test_no_rows(documents):
    assert middles.digests(documents([])).collect() == []
