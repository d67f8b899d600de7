from __future__ import annotations

import random

import pytest

from tenderlake.llm import conversations


def brute(rows):
    turns = {}
    for conv, turn, role, text in set(rows):
        turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", role is not None, text or "", text is not None, role, text))
    talks = {c: [(r[-2], r[-1]) for r in sorted(own, key=lambda r: r[:-2])] for c, own in turns.items()}
    kept = []
    for c, own in talks.items():
        longer = any(len(o) > len(own) and o[: len(own)] == own for d, o in talks.items() if d != c)
        equal = any(o == own and (d is not None and (c is None or d < c)) for d, o in talks.items() if d != c)
        if not longer and not equal:
            kept += [(c, k + 1, len(own), f"<|im_start|>{r or 'unknown'}\n{t or ''}<|im_end|>\n") for k, (r, t) in enumerate(own)]
    return kept


def snapshots(seed):
    rng = random.Random(seed)
    rows, conv = [], 0
    for _ in range(15):
        talk = [("user" if k % 2 == 0 else "assistant", f"{rng.randrange(4)}") for k in range(rng.randint(1, 9))]
        for _ in range(rng.randint(1, 5)):
            conv += 1
            cut = rng.randint(1, len(talk))
            rows += [(conv, k, r, t) for k, (r, t) in enumerate(talk[:cut])]
    return rows


@pytest.fixture
def turns(llm):
    schema = "conv_id long, turn long, role string, text string, slice long, conv string"
    return lambda rows: llm.createDataFrame([(*r, 1, "c") for r in rows], schema)


def result(df):
    return sorted(repr(tuple(r[c] for c in ("conv_id", "position", "n_turns", "rendered"))) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_maximal_conversations_equal_brute_force(llm, turns, seed):
    rows = snapshots(seed)
    rows += rows[:7]  # logged twice
    rows += [(900, 0, None, "x"), (901, 0, "user", None), (902, None, "user", "x"), (903, 5, "user", ""),
             (None, 0, "user", "n"), (None, 1, "user", "m"), (904, 0, "user", "t" * 100_000)]
    assert result(conversations.rendered(turns(rows))) == sorted(map(repr, brute(rows)))


def test_long_conversation_in_slices(llm, turns, monkeypatch):
    monkeypatch.setattr(conversations, "SLICE", 3)
    rows = [(1, k, "user", f"{k}") for k in range(50)] + [(2, k, "user", f"{k}") for k in range(20)]
    rows += [(3, k + 10, "user", f"{k}") for k in range(30)] + [(4, k, "user", f"{k % 49}") for k in range(50)]
    out = conversations.rendered(turns(rows)).collect()
    assert {r["conv_id"] for r in out} == {1, 4}
    assert result(conversations.rendered(turns(rows))) == sorted(map(repr, brute(rows)))


def test_no_turns(llm, turns):
    assert conversations.rendered(turns([])).collect() == []
