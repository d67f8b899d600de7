from __future__ import annotations

import zlib

import numpy as np

from tenderlake.llm import language

WORDS = {
    "aa": "lorem ipsum dolor amet tempor magna aliqua".split(),
    "bb": "zwölf größe straße müßig hälfte kühl öfen".split(),
}


def prose(lang, seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS[lang], n))


def test_windows_hold_the_ngrams_of_their_text_only():
    """Brute force: the slots of two texts together are those of each by itself."""
    together = language.windows(["ab cd", "xyz"])
    for k, text in enumerate(["ab cd", "xyz"]):
        alone = language.windows([text])
        for s, h, s1 in zip(together[1], together[2], alone[1], strict=True):
            assert set(s[together[0][h] == k]) == set(s1)


def test_long_texts_are_read_whole():
    """The second half of a text weighs as much as the first."""
    train = [(prose(x, i), x) for x in WORDS for i in range(40)]
    model = language.solve([t for t, _ in train], [x for _, x in train], 16, 1e-4)
    long = prose("aa", 1, 10_000) + " " + prose("bb", 2, 30_000)
    assert model.predict([long, prose("aa", 5)])[0] == ["bb", "aa"]
    assert len(long) > 2 * 60_000


def test_held_out_languages(llm, documents):
    rows = [(i, prose("aa" if i % 2 else "bb", i), "aa" if i % 2 else "bb", "s") for i in range(80)]
    rows += [(900, None, "aa", "s"), (901, "", "aa", "s"), (902, "12 !?", None, None)]
    rows += [(None, prose("aa", 7), "aa", "s"), (3, rows[3][1], "aa", "s"), (904, "漢字", None, "s")]
    out = language.languages(documents(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        want = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0
        assert r["held_out"] == want
        assert 0 <= r["score"] <= 1
    told = {r["doc_id"]: r["lang_pred"] for r in out}
    assert [told[900], told[901], told[902]] == ["und"] * 3
    assert told[None] == "aa" and told[904] in WORDS
    right = [told[i] == ("aa" if i % 2 else "bb") for i in range(80)]
    assert np.mean(right) > 0.97


def test_empty_and_unlabelled(llm, documents):
    assert language.languages(documents([])).collect() == []
    out = language.languages(documents([(1, "some text", None, "s")])).collect()
    assert out[0]["lang_pred"] == "und"


def test_stage_keeps_clean_rows_and_columns(llm, documents):
    rows = [(i, prose("aa" if i % 2 else "bb", i), "aa" if i % 2 else "bb", "s") for i in range(40)]
    docs = documents([*rows, (77, "!!! 12", "aa", "s")])
    kept = language.keep_identified(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(range(40))


def grams(text):
    """The 1-, 2- and 3-grams of a text, every run of other characters read as one space."""
    folded = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    folded = " " + " ".join(folded.split()) + " "
    return {folded[i : i + n] for n in (1, 2, 3) for i in range(len(folded) - n + 1)}


def test_scores_against_a_plain_kernel_machine():
    """Kernels by sets, the ridge regression in the landmarks' span in its plain form."""
    train = [(prose(x, i, 25), x) for x in WORDS for i in range(12)]
    texts, labels = [t for t, _ in train], [x for _, x in train]
    model = language.solve(texts, labels, 8, 1e-3)
    own = [grams(t) for t in texts]
    chosen = [i for k in sorted(WORDS) for i in np.array([j for j, x in enumerate(labels) if x == k])[
        np.linspace(0, 11, 4).astype(int)]]
    # The model knows the landmarks' n-grams only.
    known = set().union(*[own[i] for i in chosen])
    own = [g & known for g in own]

    def kernel(a, b):
        return np.array([[len(x & y) / np.sqrt(len(x) * len(y)) for y in b] for x in a])

    marks = [own[i] for i in chosen]
    c, w = kernel(own, marks), kernel(marks, marks)
    y = np.array([[float(x == k) for k in sorted(WORDS)] for x in labels])
    weights = np.linalg.solve(c.T @ c + 1e-3 * len(own) * w + 1e-9 * np.eye(len(w)), c.T @ y)
    asked = [prose(x, 100 + i, 25) for x in WORDS for i in range(5)] + ["zwölf dolor größe amet"]
    want = kernel([grams(t) & known for t in asked], marks) @ weights
    langs, scores = model.predict(asked)
    assert langs == [sorted(WORDS)[k] for k in want.argmax(1)]
    assert np.allclose(scores, np.clip(want.max(1), 0, 1), atol=5e-3)


def test_many_labels_and_long_texts_only(llm, documents):
    """The sample is bounded whatever the number of labels; a language of long texts is learned."""
    rows = [(i, prose("aa", i), f"x{i}", "s") for i in range(60)]
    rows += [(100 + i, prose("bb", i, 6000), "bb", "s") for i in range(12)]
    docs = documents(rows)
    model = language.fit(docs.select("text", "lang"), most=20)
    assert len(model.langs) == 20 and "bb" in model.langs
    assert model.predict([prose("bb", 500)])[0] == ["bb"]
    assert len(language.fit(docs.select("text", "lang"), longest=500).langs) == 61


def test_stage_without_labels_rejects_nothing(llm, documents):
    docs = documents([(i, t, None, "s") for i, t in enumerate(["plain text", None, "", "12", "mehr text"])])
    kept = language.keep_identified(docs)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, docs.collect()))
