from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tenderlake.llm import repeats


def brute(texts, span):
    """Per text: bytes, maximal removed runs, kept bytes."""
    raw = [(t or "").encode() for t in texts]
    count = Counter(b[i : i + span] for b in raw for i in range(len(b) - span + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - span + 1):
            if count[b[i : i + span]] > 1:
                gone[i : i + span] = True
        begins, ends = repeats.runs(gone)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((len(b), list(zip(begins.tolist(), ends.tolist())), kept))
    return out


def answers(df):
    return [
        (r["doc_id"], r["n_bytes"], [(s["begin"], s["end"]) for s in r["spans"]], bytes(r["kept"]))
        for r in df.collect()
    ]


def made(seed, n=120, alphabet="abé "):
    """Texts with shared passages in other surroundings, copies, and repeats of themselves."""
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(alphabet) for _ in range(k))
    passages = [word(rng.randrange(10, 40)) for _ in range(5)]
    texts = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randrange(4)):
            parts += [word(rng.randrange(25)), rng.choice(passages)[rng.randrange(4) :]]
        texts.append("".join(parts) + word(rng.randrange(9)))
    texts += texts[:15] + [texts[3]] * 20
    texts += ["ab" * 40, "é" * 60, "ab" * 11, "", None, "a", word(11), "x" * 12, passages[0] * 3]
    return texts


@pytest.mark.parametrize("largest", [8192, 3])
@pytest.mark.parametrize("anchor", [1, 4, 9])
def test_against_all_strings(llm, documents, monkeypatch, largest, anchor):
    monkeypatch.setattr(repeats, "LARGEST_BIN", largest)
    monkeypatch.setattr(repeats, "GROUP", 30)
    texts = made(anchor)
    rows = [(i // 2 if i % 7 else None, t, "en", "s") for i, t in enumerate(texts)]
    got = answers(repeats.remove_repeats(documents(rows), span=12, anchor=anchor))
    want = [(r[0], *w) for r, w in zip(rows, brute(texts, 12))]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_a_hot_passage_is_split(llm, documents, monkeypatch):
    """One passage in all texts: its bins hold more different pieces than one collection takes."""
    rng = random.Random(8)
    passage = "".join(rng.choice("abcdefgh") for _ in range(700))
    texts = []
    for _ in range(120):
        side = ["".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(300))) for _ in range(2)]
        texts.append(side[0] + passage[rng.randrange(30) : 700 - rng.randrange(30)] + side[1])
    monkeypatch.setattr(repeats, "LARGEST_BIN", 20)
    monkeypatch.setattr(repeats, "GROUP", 16)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = answers(repeats.remove_repeats(documents(rows)))
    want = [(i, *w) for i, w in enumerate(brute(texts, 400))]
    assert sorted(got) == sorted(want)


def test_texts_longer_than_a_segment(llm, documents):
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 123, 7)).decode() for _ in range(4000)]
    long = " ".join(rng.choice(words, 300_000))
    assert len(long) > 2 * repeats.SEGMENT
    # Across the place where segments meet, and at the end.
    at = repeats.SEGMENT - 900
    rows = [(1, long, "en", "s"), (2, "head " + long[at : at + 1500] + " tail", "en", "s"),
            (3, long[-450:] + "x" * 100, "en", "s"), (4, "a\n" * 9000, "en", "s")]
    got = {r[0]: r for r in answers(repeats.remove_repeats(documents(rows)))}
    assert got[1][2] == [(at, at + 1500), (len(long) - 450, len(long))]
    assert got[2][2] == [(5, 1505)] and got[2][3] == b"head  tail"
    assert got[3][2] == [(0, 450)] and got[4][3] == b""


def test_columns_against_all_windows():
    rng = random.Random(3)
    span, anchor = 9, 3
    shared = "".join(rng.choice("ab") for _ in range(anchor)).encode()
    contents, offs = [], []
    for _ in range(200):
        off = rng.randrange(span - anchor + 1)
        wins = rng.randrange(1, span - anchor + 1 - (span - anchor - off) + 1)
        left = bytes(rng.choice(b"ab") for _ in range(off))
        right = bytes(rng.choice(b"ab") for _ in range(wins - 1 + span - off - anchor))
        if (left + shared + right, off) not in list(zip(contents, offs)):
            contents.append(left + shared + right)
            offs.append(off)
    flags = repeats.repeated_windows(contents, np.array(offs), span, anchor)
    count = Counter((i - off, c[i : i + span]) for c, off in zip(contents, offs)
                    for i in range(len(c) - span + 1))
    for c, off, flag in zip(contents, offs, flags):
        for i in range(len(c) - span + 1):
            assert flag[span - anchor - off + i] == (count[i - off, c[i : i + span]] > 1)


def test_digests_and_no_rows(llm, documents):
    rows = [(1, "z" * 399, "en", "s"), (2, "long " * 100, "en", "s"), (3, "long " * 100, "en", "s")]
    out = {r["doc_id"]: r for r in repeats.digests(documents(rows)).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert tuple(out[1]) == (1, 399, 0, 0, sha("z" * 399))
    assert tuple(out[2]) == (2, 500, 500, 1, sha(""))
    assert repeats.digests(documents([])).collect() == []
    assert repeats.digests(documents([(1, None, None, None)])).collect()[0]["n_bytes"] == 0
