from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from tenderlake.llm import centroids

SCHEMA = "vec_id long, embedding array<float>, cluster int, v string, distance long"


def frame(llm, rows, schema=SCHEMA):
    return llm.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], schema)


def brute(rows, dim, k, rounds):
    """vec_id, cluster, distance of each kept vector, centroids, by plain loops over integers."""
    kept = []
    for i, v in rows:
        if v is None or len(v) != dim or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((i, [math.floor(1024 * float(np.float32(x))) for x in v]))
    key = lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(kept, key=key)[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))
                for _, v in kept]

    for _ in range(rounds):
        found = assign()
        for n in range(len(centres)):
            own = [v for (_, v), (_, m) in zip(kept, found) if m == n]
            if own:
                centres[n] = [sum(x) // len(own) for x in zip(*own)]
    found = assign() if centres else []
    return [(i, n, d) for (i, _), (d, n) in zip(kept, found)], centres


def test_search_is_exact_and_measures_less():
    rng = np.random.default_rng(2)
    centres = rng.integers(-9, 9, (40, 3))
    centres[7] = centres[3]
    near = centroids.Neighbours(centres)
    x = rng.integers(-9, 9, (3000, 3))
    far = ((x[:, None] - centres) ** 2).sum(2)
    at, best, measured = near.search(x, rng.integers(0, 40, len(x)))
    assert (at == far.argmin(1)).all() and (best == far.min(1)).all()
    assert measured < len(x) * 40 * 0.8


def test_one_centroid():
    at, best, _ = centroids.Neighbours(np.array([[1, 2]])).search(np.array([[1, 5]]), np.array([0]))
    assert at.tolist() == [0] and best.tolist() == [9]


@pytest.mark.parametrize("k", [1, 3, 8])
def test_clusters_against_loops(llm, k):
    rng = random.Random(k)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, rng.gauss(0, 1)]) for _ in range(4)]) for i in range(200)]
    rows += [(500, [0.1, 0.2, 0.3, 0.4])] * 90  # copies
    rows += [(600 + i, [0.1, 0.2, 0.3, 0.4]) for i in range(90)]
    rows += [(None, [1.0, 1.0, 1.0, 1.0]), (900, None), (901, [1.0, None, 1.0, 1.0]), (902, [1.0] * 5), (903, []),
             (904, [float("nan"), 1.0, 1.0, 1.0]), (905, [1.0, float("-inf"), 1.0, 1.0]), (906, [0.0] * 4)]
    out, centres = centroids.cluster_vectors(frame(llm, rows), dim=4, k=k)
    want, want_centres = brute(rows, 4, k, 10)
    assert centres.tolist() == want_centres
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, want))


def test_sums_and_digests(llm):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(120)]
    want, centres = brute(rows, 64, 8, 10)
    out = centroids.centroid_clusters(frame(llm, rows)).collect()
    assert len(out) == 120
    total = sum(d for _, _, d in want)
    for r in out:
        assert r["inertia"] == total
        assert r["cluster_inertia"] == sum(d for _, c, d in want if c == r["cluster"])
        text = ",".join(map(str, centres[r["cluster"]]))
        assert r["centroid_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_fewer_vectors_than_centroids(llm):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    out = centroids.centroid_clusters(frame(llm, rows)).collect()
    assert sorted(r["distance"] for r in out) == [0, 0, 0] and len({r["cluster"] for r in out}) == 3


def test_no_vectors_and_too_large_ones(llm):
    assert centroids.centroid_clusters(frame(llm, [])).collect() == []
    assert centroids.centroid_clusters(frame(llm, [(1, None), (2, [1.0])])).collect() == []
    with pytest.raises(Exception, match="not below"):
        centroids.centroid_clusters(frame(llm, [(1, [1e20] * 64)])).collect()
