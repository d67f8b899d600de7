from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tenderlake.llm import fingerprints as fp


def test_spans_and_extensions_against_slices():
    rng = random.Random(1)
    text = "".join(rng.choice("ab😀") for _ in range(400))
    hashes = fp.PrefixHashes([text])
    for _ in range(2000):
        i, j, n = rng.randrange(380), rng.randrange(380), rng.randrange(20)
        assert hashes.equal(i, j, n) == (text[i : i + n] == text[j : j + n])
        most = 400 - max(i, j)
        want = next((k for k in range(most) if text[i + k] != text[j + k]), most)
        assert hashes.extension(i, j, most) == want


def test_whole_hash_does_not_depend_on_the_place():
    a = fp.PrefixHashes(["xyz", "hello", ""])
    b = fp.PrefixHashes(["hello"])
    assert a.whole(1) == b.whole(0) and a.whole(0) != b.whole(0)


def test_smallest_values_are_exact():
    rng = np.random.default_rng(2)
    for n in (10, 2000, 50_000):
        for values in (rng.integers(0, fp.PRIMES[0], n), rng.integers(0, 70, n)):
            values = values.astype(np.uint64)
            assert fp.smallest(values).tolist() == sorted(set(values.tolist()))[: fp.KEPT]


@pytest.mark.parametrize("rows_per_slice", [3, 4096])
def test_successors_and_edits(llm, documents, monkeypatch, rows_per_slice):
    rng = random.Random(7)
    texts = ["".join(rng.choice("abc déf ") for _ in range(rng.randrange(200))) for _ in range(40)]
    rows = [(i * 7 % 41, t, "en", "s") for i, t in enumerate(texts)]
    rows += [(2**53 + 1, "big id", "en", "s"), (100, None, "en", "s"), (101, "", "en", "s"),
             (3, texts[0], "en", "s"), (None, "no id", "en", "s"), (102, "😀x" * 30_000, "en", "s")]
    rows += [(102, "😀x" * 30_000, "en", "s")]
    keep = fp.with_successors
    monkeypatch.setattr(fp, "with_successors", lambda docs: keep(docs, rows_per_slice))
    out = fp.fingerprints(documents(rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    want = []
    for k, (i, t, _, _) in enumerate(order):
        t, n = t or "", order[(k + 1) % len(order)][1] or ""
        m = len(t) // 3
        edited = t[: len(t) - m] + n[:m]
        want.append((i, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    got = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in out]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    texts_of = {}
    for r in out:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        assert r["common_prefix"] >= min(r["n_chars"], r["n_chars"] - r["n_chars"] // 3)
        if r["fingerprint"] == r["edited_fingerprint"]:
            assert r["near_edited"] == 1
        texts_of.setdefault(r["fingerprint"], set()).add(r["doc_id"])
    assert {2**53 + 1} in texts_of.values()
    assert any({100, 101} <= ids for ids in texts_of.values())  # null and empty are equal


def test_likeness(llm, documents):
    rng = random.Random(3)
    text = "".join(rng.choice("abcdefghij ") for _ in range(6000))
    other = "".join(rng.choice("abcdefghij ") for _ in range(6000))
    out = fp.fingerprints(documents([(1, text, "x", "s"), (2, other, "x", "s")])).collect()
    for r in out:
        assert 0.3 < r["near_edited"] < 0.7 and r["near_next"] == 0


def test_empty_and_single(llm, documents):
    assert fp.fingerprints(documents([])).collect() == []
    (row,) = fp.fingerprints(documents([(5, "abcdef", "x", "s")])).collect()
    assert row["edited_sha256"] == hashlib.sha256(b"abcdab").hexdigest()
    assert row["near_next"] == 1
