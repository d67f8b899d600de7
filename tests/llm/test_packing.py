from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tenderlake.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_ids_are_the_librarys(tokenizer):
    rng = random.Random(3)
    signs = "abcXYZ'éÉñßªºµ²½¼́İıĦ 0123_-!?.'’\n\t\x0b\x1c\x85\xa0ÀçÆSREll中文Σς<|endoftext|>​"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(chr(rng.randrange(1, 0x130)) for _ in range(20)) for _ in range(3000)]
    texts += ["don't we'll <|startoftext|> x", "", " \n ", "ǅ ŉ ﬁ", "a" * 5000]
    ids = packing.Ids(PATH)
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # cold, then remembered
        assert [np.frombuffer(x, "<u4").tolist() for x in ids.of(texts)] == want


def test_ids_with_a_full_memory(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 3)
    ids = packing.Ids(PATH)
    for texts in (["one two, three"], ["four, five six two"], ["one seven, five"]):
        want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert [np.frombuffer(x, "<u4").tolist() for x in ids.of(texts)] == want


@settings(max_examples=40, deadline=None)
@given(
    st.lists(st.integers(1, 60), max_size=80), st.integers(1, 6), st.sampled_from(["dot", "norm"])
)
def test_every_constraint_holds(lengths, documents, rule):
    lengths = np.array(sorted(lengths, reverse=True), np.int64)
    sequence, offset = packing.best_fit(lengths, 60, documents, 2000 + 60 * 60, (1, 1, 1), rule)
    bins = defaultdict(list)
    for n, s, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist(), strict=True):
        bins[s].append((o, n))
    for own in bins.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 60 and len(own) <= documents and sum(n * n for _, n in own) <= 5600


def plainly(lengths, full, weights, rule):
    """Vector best fit over all sequences there are, one by one."""
    left, out = [], []
    for n in lengths:
        need, best = (n, 1, n * n), None
        for k, have in enumerate(left):
            if all(h >= d for h, d in zip(have, need)):
                if rule == "dot":
                    worth = sum(w * h * d / f**2 for w, h, d, f in zip(weights, have, need, full))
                else:
                    worth = -sum(w * (h - d) ** 2 / f**2 for w, h, d, f in zip(weights, have, need, full))
                if best is None or worth > best[0] + 1e-12:
                    best = (worth, k)
        if best is None:
            left.append(list(full))
            best = (0, len(left) - 1)
        k = best[1]
        out.append((k, full[0] - left[k][0]))
        left[k] = [h - d for h, d in zip(left[k], need)]
    return out


@pytest.mark.parametrize("rule", ["dot", "norm"])
@pytest.mark.parametrize("weights", [(1, 0, 0), (1, 1, 1), (1, 0.5, 2)])
@pytest.mark.parametrize("documents,attention", [(60, 3600), (3, 2000), (60, 1700)])
def test_best_fit_equals_the_plain_one(rule, weights, documents, attention):
    rng = np.random.default_rng(documents + attention)
    lengths = -np.sort(-rng.integers(1, 41, 150))
    sequence, offset = packing.best_fit(lengths, 60, documents, attention, weights, rule)
    want = plainly(lengths.tolist(), (60, documents, attention), weights, rule)
    assert list(zip(sequence.tolist(), offset.tolist())) == want


def test_best_fit_is_near_the_bound():
    rng = np.random.default_rng(1)
    lengths = -np.sort(-np.minimum(2048, rng.lognormal(6, 1, 4000).astype(np.int64) + 1))
    sequence, _ = packing.best_fit(lengths)
    assert sequence.max() + 1 <= 1.01 * lengths.sum() / packing.LENGTH + 1


def test_pieces_of_documents(llm, documents, tokenizer):
    big = "wordy text " * 6000
    rows = [(1, "Hello World", "en", "s"), (1, "Hello World", "en", "s"), (2, None, None, None),
            (3, "", "en", "s"), (None, "null id", "en", "s"), (2**53 + 1, big, "en", "s")]
    out = packing.pack_documents(documents(rows), PATH).collect()
    by_doc = defaultdict(list)
    for r in out:
        by_doc[r["doc_id"]].append(r)
    assert [r["length"] for r in by_doc[2]] == [1] and [r["length"] for r in by_doc[3]] == [1]
    assert len(by_doc[1]) == 2 and len(by_doc[None]) == 1
    ids = [*tokenizer.encode(big, add_special_tokens=False).ids, 0]
    for k, r in enumerate(sorted(by_doc[2**53 + 1], key=lambda r: r["piece"])):
        own = np.array(ids[2048 * k : 2048 * (k + 1)], "<u4")
        assert (r["piece"], r["start"], r["length"]) == (k, 2048 * k, len(own))
        assert r["ids_crc32"] == zlib.crc32(own.tobytes())
    places = defaultdict(list)
    for r in out:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for own in places.values():
        at = 0
        for o, n in sorted(own):
            assert o == at
            at += n
        assert at <= 2048


def test_no_documents(llm, documents):
    assert packing.pack_documents(documents([]), PATH).collect() == []


def test_groups_lose_one_sequence_each(llm, documents):
    rows = [(i, "word " * (i % 900), "en", "s") for i in range(300)]
    whole = packing.pack_documents(documents(rows), PATH).select("sequence_id").distinct().count()
    dealt = packing.pack_documents(documents(rows), PATH, group=60)
    total = sum(i % 900 + 1 for i in range(300))
    assert -(-total // 2048) <= whole <= -(-total // 2048) + 1
    assert dealt.select("sequence_id").distinct().count() <= whole + 5


def test_a_stretch_is_looked_up_once(tokenizer, monkeypatch):
    """Looking stretches up costs most of the time when memory holds many."""
    looked = []

    class Counted(packing.Memory):
        def __getitem__(self, stretch):
            looked.append(stretch)
            return super().__getitem__(stretch)

        def __contains__(self, stretch):
            looked.append(stretch)
            return super().__contains__(stretch)

    texts = ["one two three two one", "one\ttwo three", ""]
    want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    ids, known = packing.Ids(PATH), Counted()
    ids.of(texts)
    known.update(ids.known)
    ids.known = known
    assert [np.frombuffer(x, "<u4").tolist() for x in ids.of(texts)] == want
    assert len(looked) == 8
