from __future__ import annotations

import random
import re

import numpy as np
import pytest

from tenderlake.llm import jaccard
from tenderlake.llm.components import connected
from tenderlake.llm.shingles import shingle_sets

LOWER = str.maketrans({i: i + 32 for i in range(65, 91)})


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_components(rows):
    sets = [brute_set(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    least = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[find(i)] = min(least.get(find(i), r[0]), r[0])
    return [(r[0], len(s), least.get(find(i))) for i, (r, s) in enumerate(zip(rows, sets, strict=True))]


def corpus(seed):
    """Bases with copies edited more and less, shared passages, short texts, odd spaces."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    passage = " ".join(word() for _ in range(60))
    texts = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(20, 120))]
        for _ in range(rng.randint(1, 14)):
            own = list(base)
            for _ in range(rng.randint(0, 8)):
                own[rng.randrange(len(own))] = word()
            own += [word() for _ in range(rng.choice([0, 0, 3, 20]))]
            texts.append(" ".join(own))
    texts += [passage + " " + " ".join(word() for _ in range(rng.randint(0, 30))) for _ in range(25)]
    texts += [texts[0].upper(), texts[1].replace(" ", "\t\n"), "one two", "One  two", "one", "é É", "É é"]
    texts += [None, "", " \n ", "x" * 5000, "same word " * 3000, "same word " * 2000, texts[3], texts[3]]
    rng.shuffle(texts)
    return texts


def test_shingles_are_those_of_a_plain_split():
    texts = [t or "" for t in corpus(1)]
    found = shingle_sets(texts)
    ids = {}
    for text, own in zip(texts, found, strict=True):
        want = brute_set(text)
        assert len(own) == len(want)
        for other, hashes in zip(texts, found, strict=True):
            assert len(np.intersect1d(own, hashes)) == len(want & brute_set(other))
            break
        ids.setdefault(want, own.tobytes())
        assert ids[want] == own.tobytes()
    assert len(set(ids.values())) == len(ids)


@pytest.mark.parametrize("seed", [2, 3])
def test_components_equal_brute_force(llm, documents, seed):
    texts = corpus(seed)
    rows = [(1000 - i, t, None, "s") for i, t in enumerate(texts)]
    rows += [(None, texts[5], "en", "s"), (7, texts[6], "en", None), (7, texts[6], "en", None)]
    out = jaccard.duplicate_classes(documents(rows)).collect()
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out]
    want = [(i, n, c if n else i) for i, n, c in brute_components(rows)]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_large_groups_emit_few_pairs(llm, documents):
    """A thousand near copies and a thousand equal ones: pairs grow with the rows."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    rows = [(i, " ".join(base), "en", "s") for i in range(1000)]
    for i in range(1000):
        own = list(base)
        own[rng.randrange(150)] = f"x{i}"
        rows.append((2000 + i, " ".join(own), "en", "s"))
    docs = documents(rows)
    sketch = jaccard.sketched(docs)
    listed = jaccard.listed(sketch)
    pairs = jaccard.pivot_pairs(jaccard.lists_of(listed))
    assert pairs.count() <= 20 * 1001
    out = jaccard.duplicate_classes(docs)
    assert {r["component_id"] for r in out.collect()} == {0}


def test_one_row_of_each_stays(llm, documents):
    texts = corpus(4)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)] + [(3, texts[3], "en", "s")]
    docs = documents(rows)
    kept = jaccard.keep_one_of_each(docs)
    assert kept.columns == docs.columns
    comps = {c if n else ("bare", i) for i, n, c in brute_components(rows)}
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) == len(comps)


def test_empty_table(llm, documents):
    assert jaccard.duplicate_classes(documents([])).collect() == []
    assert jaccard.keep_one_of_each(documents([])).collect() == []


def test_connected_components(llm):
    rng = random.Random(9)
    edges = [(i, i + 1) for i in range(200)] + [(500, 500 + i) for i in range(100)]
    edges += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(60)] + [(1, 1)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["comp"] for r in connected(llm.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert connected(llm.createDataFrame([], "a long, b long")).collect() == []


def may_link(x, y):
    """Whether sizes and places allow a pair of (node, n, last, place, held), in plain numbers."""
    (_, n, last, place, held), (_, m, last2, place2, held2) = x, y
    need = -(-3 * (n + m) // 7)
    behind = -(-3 * (n if last <= last2 else m) // 4)
    least = max(1, need - behind + 1)
    return need <= min(n, m) and place <= held - least and place2 <= held2 - least


def test_crossing_pairs_without_pivots_equal_brute_force(llm):
    """A partner of 131 may share one prefix shingle with a set of 100, one of 132 shares two."""
    rng = random.Random(11)
    lists = {0: [(1, 100, 7, 9, 10), (2, 131, 5, 0, 10), (3, 132, 6, 0, 10)]}
    for token in range(1, 60):
        base = rng.randint(4, 300)
        sizes = [rng.randint(base, 4 * base // 3 + 1) for _ in range(5)]
        # Places close to the end of the held shingles, where the bound decides.
        rows = [(n, rng.randrange(100), rng.choice([1, 2, 3, 9])) for n in sizes]
        lists[token] = [(token * 10 + k, n, last, max(0, 9 - off), 10) for k, (n, last, off) in enumerate(rows)]
    rows = [(token, *r) for token, own in lists.items() for r in own]
    schema = "token long, node long, n long, last long, place long, held long"
    comps = llm.createDataFrame([], "node long, comp long")
    out = jaccard.crossing_pairs(llm.createDataFrame(rows, schema), comps)
    got = {(r["a"], r["b"]) for r in out.collect()}
    want = {(x[0], y[0]) for own in lists.values() for x in own for y in own if x[0] < y[0] and may_link(x, y)}
    assert (1, 2) in want
    assert got == want
