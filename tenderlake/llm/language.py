"""Language identification with string kernels.

A text is cut into windows of `WINDOW` symbols. A window's features are the 1-, 2- and
3-grams of letters it contains (presence, not counts: the blended-spectrum kernel), case
folded, every run of other characters read as one space. The kernel of two windows is the
number of n-grams they share over the root of the product of their sizes. A bounded sample
of windows serves as Nystrom landmarks; one-versus-rest ridge regression is solved in their
span. Scoring is two matrix products per batch of windows; a text's score is the mean of its
windows' scores, weighted by their sizes, so every character of a long text counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import by_size, fold, released, stored, whole_row

UNDETERMINED = "und"
WINDOW = 1500
SLOT_BITS = 20
CHUNK = 400_000

_LETTER: list[np.ndarray] = []


def letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    if not _LETTER:
        _LETTER.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _LETTER[0]


def windows(texts: list[str], size: int = WINDOW):
    """The n-grams of the texts' windows.

    Returns (owner, slots, holders): the text of each window; and per order of n-gram the
    slot and the window of each occurrence.
    """
    folded = [f" {t.lower()} " for t in texts]
    lens = np.fromiter(map(len, folded), np.int64, len(folded))
    raw = np.frombuffer("".join(folded).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(texts), dtype=np.int32), lens)
    is_letter = letters()[raw]
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]
    starts = np.concatenate(([0], np.cumsum(lens)[:-1]))
    keep[starts] = True
    sym = np.where(is_letter, raw, np.uint32(32))[keep]
    owner = owner[keep]
    first = np.searchsorted(owner, np.arange(len(texts)))
    place = np.arange(len(owner)) - first[owner]
    part = place // size
    counts = np.bincount(owner, minlength=len(texts))
    parts = np.maximum((counts + size - 1) // size, 1)
    base = np.concatenate(([0], np.cumsum(parts)[:-1]))
    window = (base[owner] + part).astype(np.int32)
    shift = np.uint32(32 - SLOT_BITS)
    mixed = (sym + np.uint32(1)) * np.uint32(0x9E3779B1)
    out = [((mixed * np.uint32(0x85EBCA6B)) >> shift, window)]
    for order in (1, 2):
        if len(sym) <= order:
            break
        mixed = (mixed[:-1] ^ (mixed[:-1] >> np.uint32(15))) * np.uint32(0xC2B2AE35)
        mixed = mixed + (sym[order:] + np.uint32(1)) * np.uint32(0x27D4EB2F)
        inside = owner[order:] == owner[:-order]
        out.append(
            (((mixed * np.uint32(0x85EBCA6B)) >> shift)[inside], window[:-order][inside])
        )
    return np.repeat(np.arange(len(texts)), parts), [s for s, _ in out], [w for _, w in out]


@dataclass
class Model:
    """vocabulary: slot -> column; landmarks and weights: the two factors of the scores."""

    langs: list[str]
    vocabulary: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray

    def presence(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        owner, slots, holders = windows(texts)
        found = np.zeros((len(owner), self.landmarks.shape[1]), np.float32)
        for slot, holder in zip(slots, holders, strict=True):
            column = self.vocabulary[slot]
            known = column >= 0
            found[holder[known], column[known]] = 1
        return owner, found

    def kernel(self, found: np.ndarray) -> np.ndarray:
        norm = np.sqrt(np.maximum(found.sum(1, dtype=np.float32), 1))
        return (found @ self.landmarks.T) / norm[:, None]

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score of each text. Texts longer than a chunk are taken in stretches
        of that length; the windows of all stretches count alike."""
        parts = [(i, t[k : k + CHUNK]) for i, t in enumerate(texts) for k in range(0, len(t), CHUNK)]
        total, mass = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        for run in by_size(parts, lambda r: len(r[1]), CHUNK):
            owner, found = self.presence([t for _, t in run])
            owner = np.array([i for i, _ in run])[owner]
            weight = found.sum(1) + 1e-3
            np.add.at(total, owner, self.kernel(found) @ self.weights * weight[:, None])
            np.add.at(mass, owner, weight)
        total /= np.maximum(mass, 1e-9)[:, None]
        best = total.argmax(1)
        score = np.clip(total[np.arange(len(texts)), best], 0, 1)
        return [self.langs[i] for i in best], score.tolist()


def solve(texts: list[str], langs: list[str], n_landmarks: int, ridge: float) -> Model:
    """Fit the landmarks' ridge regression. Rows come in a fixed order; the landmarks are
    taken from each language in turn."""
    names = sorted(set(langs))
    label = np.array([names.index(x) for x in langs])
    owner, slots, holders = windows(texts)
    chosen: list[int] = []
    for k in range(len(names)):
        own = np.flatnonzero(label[owner] == k)
        share = max(1, n_landmarks // len(names))
        chosen += own[np.linspace(0, len(own) - 1, min(share, len(own))).astype(int)].tolist()
    is_landmark = np.zeros(len(owner), bool)
    is_landmark[chosen] = True
    vocabulary = np.full(1 << SLOT_BITS, -1, np.int32)
    used = np.unique(
        np.concatenate([s[is_landmark[h]] for s, h in zip(slots, holders, strict=True)])
    )
    vocabulary[used] = np.arange(len(used), dtype=np.int32)
    model = Model(names, vocabulary, np.zeros((0, len(used)), np.float32), np.zeros((0, 0)))
    pieces = [model.presence(run) for run in by_size(texts, len, CHUNK)]
    found = np.concatenate([f for _, f in pieces])
    marks = found[np.array(chosen)]
    model.landmarks = marks / np.sqrt(np.maximum(marks.sum(1), 1))[:, None]
    values, vectors = np.linalg.eigh((model.kernel(marks)).astype(np.float64))
    values = np.maximum(values, 1e-6 * values.max())
    whiten = vectors / np.sqrt(values)
    features = model.kernel(found).astype(np.float64) @ whiten
    target = (label[owner][:, None] == np.arange(len(names))[None]).astype(np.float64)
    gram = features.T @ features + ridge * len(features) * np.eye(features.shape[1])
    model.weights = (whiten @ np.linalg.solve(gram, features.T @ target)).astype(np.float32)
    return model


def fit(
    docs: DataFrame,
    per_language: int = 300,
    n_landmarks: int = 160,
    longest: int = 20_000,
    ridge: float = 1e-4,
    most: int = 30_000,
) -> Model | None:
    """Model from a bounded sample of the rows of `docs` (text, lang, all to be learned from).

    Texts are hashed into slots per language, `per_language` or as many as keep the whole
    sample at `most`; the least hash of each slot is taken. So the driver gets `most` texts,
    or one of each language if there are more of these, and no task has more to hold than
    that. Of a text longer than `longest` characters so many are learned from; predictions
    read all of it. Beyond `most` languages, those with the most texts are learned. None if
    there is no row with a language and a letter.
    """
    texts = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).select(
        "lang", "text", F.xxhash64("text").alias("h")
    )
    languages = texts.groupBy("lang").agg(F.count("*").alias("n"))
    named = languages.count()
    if named > most:
        kept = languages.orderBy(F.desc("n"), "lang").limit(most).select("lang")
        texts = texts.join(stored(kept, "languages"), "lang", "left_semi")
    slot = F.pmod(F.col("h"), F.lit(max(1, min(per_language, most // max(named, 1)))))
    least = texts.groupBy("lang", slot.alias("slot")).agg(F.min("h").alias("h")).drop("slot")
    # At most `most` rows.
    rows = (
        texts.join(F.broadcast(stored(least, "language-sample")), ["lang", "h"])
        .groupBy("lang", "h")
        .agg(F.min(F.substring("text", 1, longest)).alias("text"))
        .orderBy("lang", "h")
        .collect()
    )
    if not rows:
        return None
    return solve([r["text"] for r in rows], [r["lang"] for r in rows], n_landmarks, ridge)


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """`docs` plus lang_pred and score.

    A text that is null or has no letter is `und` with score 0; without a model every text
    is. Rows are neither dropped nor merged, so repeated rows stay repeated; columns of
    `docs` named lang_pred or score are replaced.
    """
    docs = docs.drop("lang_pred", "score")
    if model is None:
        return docs.withColumns({"lang_pred": F.lit(UNDETERMINED), "score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @released
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for batch in batches:
            lang, score = [UNDETERMINED] * len(batch), [0.0] * len(batch)
            rows = [(i, t) for i, t in enumerate(batch) if t and any(map(str.isalpha, t))]
            names, values = model.predict([t for _, t in rows])
            for (i, _), name, value in zip(rows, names, values, strict=True):
                lang[i], score[i] = name, value
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    udf = F.pandas_udf(scored, "lang_pred string, score double")
    return docs.withColumn("_language", udf("text")).select(
        *docs.columns, "_language.lang_pred", "_language.score"
    )


def held_out(parts: int = 5):
    return F.coalesce(fold(F.col("doc_id"), parts) == 0, F.lit(False))


def learnable(docs: DataFrame, parts: int = 5) -> DataFrame:
    """Rows whose id is not held out; a null id cannot be told, so it is left out too."""
    return docs.where(fold(F.col("doc_id"), parts) != 0)


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row, the model learned from the rows
    that are not held out."""
    model = fit(learnable(docs.select("doc_id", "text", "lang")))
    return identify(docs.select("doc_id", "text", held_out().alias("held_out")), model).drop("text")


def keep_identified(docs: DataFrame, least: float = 0.2) -> DataFrame:
    """The rows of `docs` whose language is told with a score of `least` or more. Without a
    row to learn a language from no language can be told, and no row is rejected."""
    model = fit(learnable(docs.select("doc_id", "text", "lang")))
    if model is None:
        return docs
    told = identify(docs.select(whole_row(docs), "text"), model)
    told = told.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least))
    return told.select("row.*")
