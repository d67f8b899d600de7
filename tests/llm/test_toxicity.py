from __future__ import annotations

import zlib
from collections import Counter
from math import erfc, sqrt

import numpy as np
import pytest

from tenderlake.llm import toxicity

CLEAN = "the river runs along green fields while people walk home after market day".split()
BAD = ["idiot", "moron"]


@pytest.fixture(scope="module")
def lm(llm):
    text = " ".join([*CLEAN, *BAD] * 30)
    frame = llm.createDataFrame([(text,), (None,), ("",)], "text string")
    grams = [(r["gram"], r["n"]) for r in toxicity.trigram_counts(frame).collect()]
    return toxicity.log_probabilities(grams)


def test_trigrams_are_counted_over_all_rows(llm):
    frame = llm.createDataFrame([("ab",), ("ab ab",), (None,)], "text string")
    counts = {r["gram"]: r["n"] for r in toxicity.trigram_counts(frame).collect()}
    a, b = toxicity.INDEX["a"], toxicity.INDEX["b"]
    assert counts[a * toxicity.SIZE + b] == 3  # edge, a, b


@pytest.mark.parametrize(
    "written", ["1d10t", "idi0t", "iiidiooot", "i.d.i.o.t", "i d i o t", "!diot", "1d!0t", "m0r0n", "mooorrron"]
)
def test_disguises_are_undone(lm, written):
    assert set(toxicity.restore(written, lm)) & set(BAD)


def test_viterbi_equals_the_best_of_all_paths(lm):
    """Brute force over every reading of a short lattice."""
    for text in ("1d10t", "i.d", "m00n", "aab"):
        best, found = -np.inf, None
        paths = [("", 0.0)]
        for i in range(len(text)):
            paths = [(p + r, c + v) for p, c in paths for r, v in toxicity.readings(text, i)]
        for path, cost in paths:
            words = path.split()
            if path != " ".join(words) and path.strip() != " ".join(words):
                continue
            total = cost
            for w in words:
                s = [0, 0, *[toxicity.INDEX[c] for c in w], 0]
                total += sum(float(lm[s[k], s[k + 1], s[k + 2]]) for k in range(len(s) - 2))
            if path.endswith(" "):
                continue
            if total > best:
                best, found = total, words
        assert toxicity.restore(text, lm) == found


def test_a_plain_word_has_one_path(lm):
    assert toxicity.words_of("river,", lm) == {"river"}


def rows_of(rng, n, toxic):
    out = []
    for _ in range(n):
        words = list(rng.choice(CLEAN, 25))
        if toxic:
            words[3] = BAD[int(rng.integers(2))]
        out.append(" ".join(words))
    return out


@pytest.fixture(scope="module")
def scored(llm, documents):
    rng = np.random.default_rng(4)
    texts = rows_of(rng, 120, True) + rows_of(rng, 240, False)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    extra = [(900, "what an 1d10t", "en", "s"), (901, "i d i o t they said", "en", "s"),
             (902, None, None, None), (903, "", "en", "s"), (904, " ".join(CLEAN), "en", "s"),
             (None, "you moron", "en", "s"), (905, "river " * 200_000, "en", "s")]
    labels = [(i, 1, int(i < 120)) for i in range(360)] + [(None, 1, 1), (5, None, None)]
    docs = documents(rows + extra)
    labels = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    return docs, labels, toxicity.toxic_documents(docs, labels).collect()


def test_held_out_rows_and_planted_disguises(scored):
    _, _, out = scored
    assert len(out) == 367
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 360]
    assert len(held) > 40
    assert all(r["predicted"] == int(r["doc_id"] < 120) for r in held)
    by_id = {r["doc_id"]: r for r in out}
    assert all(by_id[k]["predicted"] == 1 for k in (900, 901, None))
    assert all(by_id[k]["predicted"] == 0 for k in (902, 903, 904, 905))
    assert all(0 <= r["score"] <= 1 for r in out)


def test_stage_keeps_clean_rows_and_columns(scored):
    docs, labels, out = scored
    kept = toxicity.keep_harmless(docs, labels)
    assert kept.columns == docs.columns
    want = {r["doc_id"] for r in out if r["predicted"] == 0}
    assert {r["doc_id"] for r in kept.collect()} == want


def test_without_labels_or_rows(llm, documents):
    none = llm.createDataFrame([], "doc_id long, quality int, toxic int")
    out = toxicity.toxic_documents(documents([(1, "a", "en", "s")]), none).collect()
    assert [(r["score"], r["predicted"]) for r in out] == [(0.0, 0)]
    assert toxicity.toxic_documents(documents([]), none).collect() == []


def test_markers_of_a_rare_language_count(llm, documents):
    """Five labelled texts with a marker of their own beside many of another language."""
    rng = np.random.default_rng(6)
    rare = "el perro corre por la calle mientras su amigo come pan con queso fresco".split()
    texts = [(t, 1) for t in rows_of(rng, 40, True)] + [(t, 0) for t in rows_of(rng, 200, False)]
    for k in range(30):
        words = list(rng.choice(rare, 25))
        texts.append((" ".join(words), 0))
        if k < 5:
            words[7] = "bocoos"
            texts.append((" ".join(words), 1))
    ids = [i for i in range(2000) if zlib.crc32(str(i).encode()) % 4 != 2][: len(texts)]
    labels = [(i, 1, toxic) for i, (_, toxic) in zip(ids, texts, strict=True)]
    rows = [(i, t, "x", "s") for i, (t, _) in zip(ids, texts, strict=True)]
    rows += [(5000, "su perro bocoos come pan", "es", "s"), (5001, "su perro come pan", "es", "s")]
    labels = llm.createDataFrame(labels, "doc_id long, quality int, toxic int")
    out = toxicity.toxic_documents(documents(rows), labels).where("doc_id >= 5000").collect()
    assert {r["doc_id"]: r["predicted"] for r in out} == {5000: 1, 5001: 0}


def test_least_evidence_bounds_the_share_of_chance():
    rng = np.random.default_rng(7)
    steps = Counter(int(x) for x in [*rng.chisquare(1, 3000) * 100, *rng.uniform(5, 40, 60) * 100])
    values = sorted((s for s, n in steps.items() for _ in range(n)), reverse=True)
    p = [erfc(sqrt(s / 100 / 2)) / 2 for s in values]
    kept = max(k for k in range(len(p)) if p[k] * 6000 <= 0.05 * (k + 1))
    least = toxicity.least_evidence(list(steps.items()), 6000, 0.05)
    assert least == values[kept]
    assert toxicity.least_evidence([(100, 3)], 1000, 0.05) is None
    assert toxicity.least_evidence([], 0, 0.05) is None


@pytest.mark.parametrize("written", ["iiddiioott", "iidiot", "mmorron", "(iiddiot).", "m0r0n!", "1d107"])
def test_every_disguised_token_is_decoded(lm, written):
    assert toxicity.words_of(written, lm) & set(BAD)


@pytest.fixture(scope="module")
def short(llm):
    frame = llm.createDataFrame([("ass see go " * 50 + "river walk " * 20,)], "text string")
    grams = [(r["gram"], r["n"]) for r in toxicity.trigram_counts(frame).collect()]
    return toxicity.log_probabilities(grams)


@pytest.mark.parametrize("written", ["455", "4$$", "(455)", "@55"])
def test_tokens_of_signs_only_are_decoded(short, written):
    assert "ass" in toxicity.words_of(written, short)


@pytest.mark.parametrize("run", ["a s s", "a     s \n\n\n\n s", "4 5 5", "4   $     $"])
def test_spaced_words_of_any_length_and_blanks(short, run):
    assert "ass" in toxicity.spaced_words(f"they said {run} again", short)
    assert "go" in toxicity.spaced_words("they said g      o again", short)


def test_words_decoded_are_those_with_several_readings(lm):
    """Brute force over the lattice: a token that is not decoded has one reading."""
    for token in ("river", "river,", "_x", "ab.", "a.b", "aab", "x!", "!x", "12", "2x", "...", "é1", "x'", "ı²"):
        paths = {""}
        for i in range(len(token)):
            paths = {p + r for p in paths for r, _ in toxicity.readings(token, i)}
        several = len({tuple(p.split()) for p in paths}) > 1
        assert toxicity.has_readings(token) or not several


def test_score_sees_disguises_of_all_kinds(scored, llm, documents):
    docs, labels, _ = scored
    texts = ["what an iiddiioott", "what an iidiiott!", "an i     d   i o      t they said", "the river runs"]
    more = documents([(2000 + i, t, "en", "s") for i, t in enumerate(texts)])
    out = toxicity.toxic_documents(docs.unionByName(more), labels).where("doc_id >= 2000").collect()
    assert {r["doc_id"]: r["predicted"] for r in out} == {2000: 1, 2001: 1, 2002: 1, 2003: 0}


def test_tokens_are_skipped_only_without_a_reading_that_tells(lm):
    odds = toxicity.Odds({"^idio": 2.0, "diot$": 3.0, "^ass$": 1.5, "looni": 1.2, "^a": 9.0})
    alphabet = "ido1t!aslnn."
    rng = np.random.default_rng(4)
    tokens = ["idiot", "iiddiioott", "asss", "aass!", "loonies", "loniies", "1diot", "a55", "idi.ot", "tidiot"]
    tokens += ["".join(rng.choice(list(alphabet), rng.integers(1, 9))) for _ in range(3000)]
    telling, wanted = 0, {}
    for token in tokens:
        words = {w: max((odds.odds.get(g, 0.0) for g in toxicity.grams_of(w)), default=0.0)
                 for w in toxicity.words_of(token, lm)}
        want = {w: v for w, v in words.items() if v > 0}
        assert dict(odds.telling(token, lm)) == want
        telling += bool(want)
        wanted[token] = want
    worth = set(odds.worth_decoding(wanted))
    assert {t for t, want in wanted.items() if want} <= worth and len(worth) < len(wanted)
    assert telling >= 8
    assert toxicity.Odds({}).worth_decoding(tokens) == []


def test_words_of_texts_and_evidence_agree(llm, lm):
    """What the fit sees of a text's words is what the score sees of the text."""
    texts = ["what an iiddiioott", "an i d 1 o t!", "plain words only", "", None, "a55 and idiot"]
    shared = llm.sparkContext.broadcast(lm)
    odds = llm.sparkContext.broadcast({"^idio": 2.0, "diot$": 3.0, "^ass$": 1.5})
    rows = llm.createDataFrame([(t, 1) for t in texts], "text string, toxic int")
    fitted = toxicity.evidence_of_words(toxicity.word_sets(rows, shared), odds).collect()
    scored = toxicity.evidence(rows.select("text"), shared, odds).collect()
    pairs = [(r["strongest"], r["telling"]) for r in scored]
    assert sorted((r["strongest"], r["telling"]) for r in fitted) == sorted(pairs)
    assert (3.0, 1) in pairs and (0.0, 0) in pairs


def test_tasks_without_texts_count_nothing(llm, lm):
    texts = llm.createDataFrame([("some words", 1)], "text string, toxic int").repartition(8)
    words = toxicity.word_sets(texts, llm.sparkContext.broadcast(lm))
    present = toxicity.gram_presence(words).collect()
    assert {(r["toxic_n"], r["clean_n"]) for r in present} == {(1, 0)}
