from __future__ import annotations

import re

import duckdb
import pytest

from tenderlake.llm import mixing


def brute(sizes, weights=(3, 1, 2), share=1.5):
    """Targets by resharing until none is above its bound."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, full, target = share * sum(sizes.values()), {}, {}
    while True:
        rest = [s for s in names if s not in full]
        total = sum(weight[s] for s in rest)
        target = {s: (left - sum(full.values())) * weight[s] / total for s in rest} if rest else {}
        over = [s for s in rest if target[s] > 2 * sizes[s]]
        if not over:
            return target | full
        full |= {s: 2.0 * sizes[s] for s in over}


ROWS = [(i, "w " * (i % 7 + 1), "en", f"s{i % 3}") for i in range(600)]
ROWS += [(1000 + i, "one two three", "en", None) for i in range(20)]
ROWS += [(2000, None, "en", "s0"), (2001, "", None, "ü"), (2002, " \x0b ", "en", "Z"), (None, "a b", "en", "s1")]
ROWS += [(5, ROWS[5][1], "en", "s2")] * 3 + [(3000, "x\x0cy z " * 3000, "en", "Z")]


@pytest.fixture(scope="module")
def labels(llm):
    rows = [(i, i % 2, 0) for i in range(0, 400, 3)] + [(3, 0, 0), (None, 1, 1), (8, None, None)]
    return llm.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def mixed(llm, documents, labels):
    return mixing.mix(documents(ROWS), labels).collect()


def test_sizes_targets_and_bounds(mixed):
    sizes = {}
    for _, text, _, source in ROWS:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] = sizes.get(source, 0) + n
    want = brute(sizes)
    assert len(mixed) == len(ROWS)
    got, largest = dict.fromkeys(sizes, 0), dict.fromkeys(sizes, 0)
    for r in mixed:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6)
        assert r["taken"] <= 2 * r["size"]
        got[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(got[s] - want[s]) <= largest[s] / 2 + 1e-6


def test_whole_passes_come_first(mixed):
    for r in mixed:
        if r["size"]:
            passes = int(r["target"] // r["source_size"])
            assert r["taken"] // r["size"] in (passes, passes + 1)


def test_reruns_and_slices_agree(llm, documents, labels, mixed, monkeypatch):
    rows = sorted(map(repr, mixed))
    assert sorted(map(repr, mixing.mix(documents(ROWS[::-1]), labels).collect())) == rows
    monkeypatch.setattr(mixing, "SLICES", 1)
    assert sorted(map(repr, mixing.mix(documents(ROWS), labels).collect())) == rows


def test_equals_its_sql(llm, documents, labels, mixed):
    con = duckdb.connect()
    docs = documents(ROWS).toPandas()[["doc_id", "text", "source"]]
    docs["doc_id"] = docs["doc_id"].astype("Int64")
    marks = labels.toPandas().astype("Int64")
    con.register("documents", docs)
    con.register("labels", marks)
    want = con.execute(mixing.ORACLE).fetchall()
    got = [(r["doc_id"], r["size"], r["source_size"], r["target"], r["taken"]) for r in mixed]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_quality_weighs(llm, documents):
    rows = [(i, "a b c", "en", s) for i in range(2000) for s in ("s",)]
    rows += [(5000 + i, "a b", "en", "t") for i in range(20_000)]
    marks = llm.createDataFrame([(i, i % 2) for i in range(22_000)], "doc_id long, quality int")
    out = [r for r in mixing.mix(documents(rows), marks).collect() if r["source"] == "t"]
    extra = [r["taken"] // r["size"] > r["target"] // r["source_size"] for r in out]
    good = [e for e, r in zip(extra, out, strict=True) if r["doc_id"] % 2]
    bad = [e for e, r in zip(extra, out, strict=True) if not r["doc_id"] % 2]
    assert sum(good) > sum(bad)


def test_empty_table(llm, documents):
    assert mixing.mix(documents([])).collect() == []


def test_plan_is_native(llm, documents, labels):
    plan = mixing.mix(documents(ROWS), labels)._jdf.queryExecution().toString()
    assert not any(w in plan for w in ("Python", "Pandas", "Arrow", "CartesianProduct"))


def test_stage_repeats_rows(llm, documents, labels, mixed):
    docs = documents(ROWS)
    out = mixing.repeat_taken(docs, labels)
    assert out.columns == docs.columns
    got = {}
    for r in out.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    want = {}
    for r in mixed:
        if r["taken"]:
            want[r["doc_id"]] = want.get(r["doc_id"], 0) + r["taken"] // r["size"]
    assert got == want
