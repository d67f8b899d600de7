"""Toxicity of texts, with a noisy channel undone first.

Disguised words (digits and signs for letters, letters drawn out, letters spaced or cut by
signs) are read as a lattice of the letters each character may stand for. Viterbi decoding
under a character trigram model picks the likeliest reading. The trigram counts come from
all documents. A word without any such sign and without a doubled letter has one path only
and is read as it is; all others are decoded.

The score looks at the restored words. Character 5-grams and whole words whose presence is
more likely in texts labelled toxic carry their log-odds, as far as the labelled texts show
it: of all kept ones a bounded share is expected to be chance. What that asks of a gram
follows from the grams at hand, so small inputs and rare languages are judged by their own
evidence. Presence is counted over all labelled texts. A text's strongest word and the
number of its telling words go into a logistic function.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import cache
from heapq import nlargest
from math import erfc, log, sqrt

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import among, by_size, fold, maybe_among, released, stored, whole_row

# Symbols of the character model: 0 is a word's edge, the last one any other letter.
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(i) for i in range(0xDF, 0x100) if i != 0xF7)
INDEX = {c: i + 1 for i, c in enumerate(LETTERS)}
OTHER = len(LETTERS) + 1
SIZE = OTHER + 1

# What signs may stand for (fixed values).
LEET = {
    "0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}

# Log-probabilities of the channel (fixed values).
SUBSTITUTED, DRAWN_OUT, SPACED, CUT, EDGE = log(0.4), log(0.3), log(0.5), log(0.3), log(0.3)
SIGN_DROPPED, DIGIT_DROPPED = log(0.01), log(0.002)

PLAIN = re.compile(r"[^\W\d_]+")
# From the first to the last character that may stand for a letter; what is around is cut off
# by every path alike.
CORE = re.compile(r"(?:[^\W_]|[@$!|+(€£])(?:.*(?:[^\W_]|[@$!|+(€£]))?", re.DOTALL)
DOUBLED = re.compile(r"(.)\1")
DRAWN = re.compile(r"(.)\1+", re.DOTALL)
# Signs that stand for no letter; around a token they fall away on every path.
AROUND = ".,;:?\"'`´-_*&%#=~/\\<>[]{})^…–—«»“”„‘’¿¡·•"
SPACED_OUT = re.compile(r"(?<!\S)\S(?:\s++\S)+(?!\S)")
# Remembered tokens or words and grams, some 200 bytes each; what is counted is given on
# when either number is reached.
CACHE, COUNTED = 150_000, 200_000
# Words whose grams are looked at together.
RUN = 100_000
CHUNK = 1_000_000


# --- the character model -----------------------------------------------------------------


@cache
def symbol_table() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    known = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    out[known] = OTHER
    for c, i in INDEX.items():
        out[ord(c)] = i
    return out


def trigram_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """gram, n: how often each three symbols follow each other in all of `docs`.

    Every task sums its own texts and gives one row per trigram seen; SIZE ** 3 rows at most
    are left. Null and empty texts add nothing.
    """

    @released
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, total = symbol_table(), np.zeros(SIZE**3, np.int64)
        for batch in batches:
            for run in by_size([t for t in batch["text"] if t], len, CHUNK):
                joined = f" {' '.join(run)} ".lower().encode("utf-32-le", "surrogatepass")
                s = table[np.frombuffer(joined, np.uint32)].astype(np.int32)
                a, b, c = s[:-2], s[1:-1], s[2:]
                code = np.where(b == 0, 0, a * (SIZE * SIZE)) + b * SIZE + c
                # A word's first letter follows two edges; edges between edges count once.
                total += np.bincount(code[(b > 0) | (c > 0)], minlength=SIZE**3)
        seen = np.flatnonzero(total)
        yield pd.DataFrame({"gram": seen, "n": total[seen]})

    parts = docs.select(F.col(text).alias("text")).mapInPandas(count, "gram long, n long")
    return parts.groupBy("gram").agg(F.sum("n").alias("n"))


def log_probabilities(grams: list[tuple[int, int]]) -> np.ndarray:
    """log p(c | a, b): trigram, bigram and unigram shares, mixed after Witten and Bell."""
    n = np.zeros(SIZE**3)
    for gram, count in grams:
        n[gram] = count
    n = n.reshape(SIZE, SIZE, SIZE)

    def mixed(counts, lower):
        total = counts.sum(-1, keepdims=True)
        kinds = (counts > 0).sum(-1, keepdims=True)
        return np.where(total > 0, (counts + kinds * lower) / np.maximum(total + kinds, 1), lower)

    one = mixed(n.sum((0, 1)), np.full(SIZE, 1 / SIZE))
    two = mixed(n.sum(0), one)
    return np.log(np.maximum(mixed(n, two[None]), 1e-9)).astype(np.float32)


# --- decoding ----------------------------------------------------------------------------


def readings(text: str, i: int) -> list[tuple[str, float]]:
    """The letters position `i` may stand for, each with its cost: "" drops the character,
    " " ends a word."""
    c = text[i]
    if c.isalpha():
        out = [(c, 0.0)]
        if i and text[i - 1] == c:
            out.append(("", DRAWN_OUT))
        return out
    if c.isspace():
        return [("", SPACED), (" ", EDGE)]
    out = [(x, SUBSTITUTED) for x in LEET.get(c, "")]
    if i and text[i - 1] == c:
        out.append(("", DRAWN_OUT))
    at_edge = i == len(text) - 1 or (c not in LEET and i == 0)
    dropped = DIGIT_DROPPED if c.isdigit() else CUT if at_edge or c not in LEET else SIGN_DROPPED
    return [*out, ("", dropped), (" ", dropped + EDGE)]


def restore(text: str, lm: np.ndarray) -> list[str]:
    """The words of the likeliest reading of a disguised word or a run of spaced letters.

    One state for each pair of last symbols, so the cost is linear in the length.
    """
    # A state is the pair of last symbols, as one number, with its cost and its letters.
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    log_p, pairs = lm.item, SIZE * SIZE
    i = 0
    while i < len(text):
        after: dict[int, tuple[float, tuple | None]] = {}
        end = i
        while end < len(text) and text[end].isalpha() and not (end and text[end - 1] == text[end]):
            end += 1
        if end > i:
            # Letters with one reading only: every state goes the same way.
            run = text[i:end]
            symbols = [INDEX.get(c, OTHER) for c in run]
            for key, (cost, path) in states.items():
                for s in symbols:
                    cost += log_p(key * SIZE + s)
                    key = (key * SIZE + s) % pairs
                if key not in after or after[key][0] < cost:
                    after[key] = (cost, (run, path))
            states, i = after, end
            continue
        options = readings(text, i)
        for state, (cost, path) in states.items():
            for letter, price in options:
                if not letter or (letter == " " and state % SIZE == 0):
                    key, value, way = state, cost + price, path
                else:
                    s = 0 if letter == " " else INDEX.get(letter, OTHER)
                    key = 0 if s == 0 else (state * SIZE + s) % pairs
                    value, way = cost + price + log_p(state * SIZE + s), (letter, path)
                if key not in after or after[key][0] < value:
                    after[key] = (value, way)
        states, i = after, i + 1
    best = max(((v + (log_p(k * SIZE) if k % SIZE else 0), p) for k, (v, p) in states.items()),
               key=lambda x: x[0])
    out, path = [], best[1]
    while path is not None:
        out.append(path[0])
        path = path[1]
    return "".join(reversed(out)).split()


def has_readings(token: str) -> bool:
    """Whether paths through the lattice of a token spell different words: it holds a sign or
    a digit that may stand for letters or is within the token, or a letter twice in a row."""
    core = CORE.search(token)
    return core is not None and (not core[0].isalpha() or DOUBLED.search(core[0]) is not None)


def words_of(token: str, lm: np.ndarray) -> set[str]:
    """The plain words of a token between spaces, and those its restored reading holds."""
    words = set(PLAIN.findall(token))
    if has_readings(token):
        words.update(restore(token, lm))
    return words


def spaced_words(text: str, lm: np.ndarray) -> set[str]:
    """The words that runs of two or more single characters spell, whatever the blanks."""
    found: set[str] = set()
    for m in SPACED_OUT.finditer(text):
        if sum(c.isalpha() or c in LEET for c in m[0]) >= 2:
            found.update(restore(m[0], lm))
    return found


def grams_of(word: str) -> tuple[str, ...]:
    """The whole word, its edges marked, and the 5-grams in it, as often as they occur."""
    edged = f"^{word}$"
    return (edged, *[edged[i : i + 5] for i in range(len(edged) - 4)])


class Memo(dict):
    """A bounded memory of what a function gives for a key."""

    def __init__(self, fn, most: int = CACHE):
        super().__init__()
        self.fn, self.most = fn, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.fn(key)
        return value


# --- learning and scoring ----------------------------------------------------------------


def copy_mark(text: str, key: str, among):
    """The three longest words of each text and what stands around the longest one: near
    copies mostly share them, other texts do not. Null where the key is not among the given
    ones (`among` may let others pass); such texts are not read."""

    def mark(t: str | None) -> str:
        words = PLAIN.findall((t or "").lower())
        if not words:
            return ""
        top = nlargest(3, set(words), key=lambda w: (len(w), w))
        at = words.index(top[0])
        return " ".join([*top, *words[max(0, at - 2) : at + 3]])

    @released
    def marks(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, mixed in batches:
            wanted = among.test(mixed)
            yield pd.Series([mark(t) if w else None for t, w in zip(texts, wanted, strict=True)], dtype=object)

    return F.pandas_udf(marks, "string")(F.col(text), F.xxhash64(key))


def word_sets(texts: DataFrame, lm) -> DataFrame:
    """toxic, words: the distinct words of each text (text, toxic), disguises undone."""

    @released
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = lm.value
        # Most tokens are their own only word and need no entry.
        known = Memo(lambda t: tuple(words_of(t, model)))
        for batch in batches:
            sets = []
            for text in batch["text"]:
                low = (text or "").lower()
                own = spaced_words(low, model)
                for token in set(low.split()):
                    if token.isalpha() and not DOUBLED.search(token):
                        own.add(token)
                    else:
                        own.update(known[token])
                sets.append(list(own))
            yield pd.DataFrame({"toxic": batch["toxic"], "words": sets})

    return texts.mapInPandas(read, "toxic int, words array<string>")


class Presence:
    """In how many texts of either label grams are present; words and grams are numbers."""

    def __init__(self):
        self.words: dict[str, int] = {}
        self.grams: dict[str, int] = {}
        # The grams of word i: ids[starts[i] : starts[i + 1]].
        self.ids, self.starts = array("i"), array("q", [0])
        self.counts = np.zeros((2, 0), np.int64)

    def learn(self, words: Iterable[str]) -> None:
        grams = self.grams
        for word in words:
            self.words[word] = len(self.words)
            self.ids.extend([grams.setdefault(g, len(grams)) for g in grams_of(word)])
            self.starts.append(len(self.ids))

    def add(self, texts: list, toxic: np.ndarray) -> None:
        """Texts as lists of words, each with its label."""
        flat = [w for own in texts for w in own]
        self.learn(set(flat) - self.words.keys())
        n = len(self.grams)
        starts, ids = np.array(self.starts), np.array(self.ids)
        word = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        text = np.repeat(np.arange(len(texts)), [len(own) for own in texts])
        size = starts[word + 1] - starts[word]
        # Place of each gram of each word: the word's first one and its number behind that.
        first = np.repeat(starts[word] - np.cumsum(size) + size, size)
        gram = ids[first + np.arange(len(first))]
        # A gram counts once a text.
        pairs = np.sort(np.repeat(text, size) * max(n, 1) + gram)
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])] if len(pairs) else pairs
        label = toxic[pairs // max(n, 1)]
        counts = np.zeros((2, n), np.int64)
        counts[:, : self.counts.shape[1]] = self.counts
        for k in (0, 1):
            counts[k] += np.bincount(pairs[label == k] % max(n, 1), minlength=n)
        self.counts = counts

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame({"gram": list(self.grams), "t": self.counts[1], "c": self.counts[0]})


def gram_presence(words: DataFrame) -> DataFrame:
    """gram, toxic_n, clean_n: in how many texts (toxic, words) a gram is present."""

    @released
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = Presence()
        for batch in batches:
            pairs = list(zip(batch["words"], batch["toxic"], strict=True))
            for run in by_size(pairs, lambda pair: len(pair[0]), RUN):
                seen.add([own for own, _ in run], np.array([toxic for _, toxic in run]))
                if len(seen.words) >= CACHE or len(seen.grams) >= COUNTED:
                    yield seen.rows()
                    seen = Presence()
        if seen.grams:
            yield seen.rows()

    parts = words.mapInPandas(count, "gram string, t long, c long")
    return parts.groupBy("gram").agg(F.sum("t").alias("toxic_n"), F.sum("c").alias("clean_n"))


# Steps of the likelihood-ratio statistic, up to where chance is below 1e-87.
STEPS, LAST = 100, 40_000


def least_evidence(steps: list[tuple[int, int]], grams: int, chance: float) -> int | None:
    """The lowest step of the statistic from which on the grams that chance alone would put
    there are `chance` of those found at the most (Benjamini and Hochberg). `steps` has the
    number of grams of each step, `grams` is the number of all. None: no step is enough."""
    least, found = None, 0
    for step, n in sorted(steps, reverse=True):
        found += n
        if grams * erfc(sqrt(step / STEPS / 2)) / 2 <= chance * found:
            least = step
    return least


def telling_grams(present: DataFrame, n_toxic: int, n_clean: int, chance: float, most: int):
    """Log-odds of the grams that are more frequent in toxic texts, with as much evidence as
    keeps the expected share of chance finds at `chance`.

    `most` bounds the size of the model: the most significant grams are kept.
    """
    t, c = F.col("toxic_n"), F.col("clean_n")
    share = (t + c) / F.lit(n_toxic + n_clean)

    def part(seen, total):
        expected = share * total
        absent, expected_absent = F.lit(total) - seen, F.lit(total) - expected
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0) + F.when(
            (absent > 0) & (expected_absent > 0), absent * F.log(absent / expected_absent)
        ).otherwise(0.0)

    odds = F.log(((t + 0.5) / (n_toxic + 1)) / ((c + 0.5) / (n_clean + 1)))
    g2 = 2 * (part(t, n_toxic) + part(c, n_clean))
    rows = present.withColumn("g2", g2).withColumn("odds", odds)
    step = F.least(F.floor(F.col("g2") * STEPS), F.lit(LAST)).cast("int")
    rows = rows.withColumn("step", F.when(F.col("odds") > 0, step))
    steps = {r["step"]: r["count"] for r in rows.groupBy("step").count().collect()}
    grams = sum(steps.values())
    least = least_evidence([(k, n) for k, n in steps.items() if k is not None], grams, chance)
    if least is None:
        return {}
    rows = (
        rows.where((F.col("step") >= least) & (F.col("odds") > 1))
        .orderBy(F.desc("g2"), "gram")
        .limit(most)
        .collect()
    )
    return {r["gram"]: float(r["odds"]) for r in rows}


def single(text: str) -> str:
    """The text with every run of one character cut to one."""
    return DRAWN.sub(r"\1", text)


class Odds:
    """The log-odds of grams, and the tokens that may spell one of them.

    Letters of a token without signs are kept or, after an equal one, dropped: all its
    readings are alike once runs are cut to one letter, and so are the grams in them. An
    automaton of the grams, cut like that, finds all tokens that are worth decoding.
    """

    def __init__(self, odds: dict[str, float]):
        self.odds = odds
        self.grams = ahocorasick.Automaton()
        for g in {single(g) for g in odds}:
            self.grams.add_word(g, len(g))
        if odds:
            self.grams.make_automaton()

    def of_word(self, word: str) -> float:
        """The largest log-odds of a word's grams."""
        edged, get = f"^{word}$", self.odds.get
        best = get(edged, 0.0)
        for i in range(len(edged) - 4):
            value = get(edged[i : i + 5], 0.0)
            if value > best:
                best = value
        return best

    def worth_decoding(self, tokens: Iterable[str]) -> list[str]:
        """The tokens a reading of which may hold a gram: those with a sign within, and of
        those of letters only the ones with a gram when cut to single letters."""
        signs, plain = [], []
        for token in tokens:
            core = token.strip(AROUND)
            if core.isalpha():
                plain.append((core, token))
            elif core:
                signs.append(token)
        if plain and self.odds:
            joined = single("^" + "$\n^".join([core for core, _ in plain]) + "$")
            ends = [end for end, _ in self.grams.iter(joined)]
            if ends:
                starts = np.cumsum([0, *[len(x) + 1 for x in joined.split("\n")]])
                found = np.unique(np.searchsorted(starts, ends, "right") - 1)
                signs += [plain[i][1] for i in found]
        return signs if self.odds else []

    def telling(self, token: str, lm: np.ndarray) -> tuple[tuple[str, float], ...]:
        """The words of a token that carry odds."""
        found = ((w, self.of_word(w)) for w in words_of(token, lm))
        return tuple((w, v) for w, v in found if v > 0)


def strength(values: Iterable[float]) -> tuple[float, int]:
    values = list(values)
    return max(values, default=0.0), len(values)


def evidence_of_words(words: DataFrame, odds) -> DataFrame:
    """toxic, strongest, telling of texts given by their words."""

    @released
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        value = Memo(Odds(odds.value).of_word)
        for batch in batches:
            out = [strength(v for v in map(value.__getitem__, own) if v > 0) for own in batch["words"]]
            yield pd.DataFrame(
                {"toxic": batch["toxic"], "strongest": [a for a, _ in out], "telling": [b for _, b in out]}
            )

    return words.mapInPandas(scored, "toxic int, strongest double, telling long")


def evidence(docs: DataFrame, lm, odds) -> DataFrame:
    """`docs` (with a column text) plus strongest and telling: the largest log-odds of a
    restored word, and the number of distinct words that carry any."""

    @released
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model, known = lm.value, Odds(odds.value)
        # Tokens seen before, and the words of the few that tell anything.
        seen: set[str] = set()
        tells: dict[str, tuple] = {}
        for batch in batches:
            lows = [(text or "").lower() for text in batch]
            tokens = [set(low.split()) for low in lows]
            if len(seen) >= CACHE:
                seen, tells = set(), {}
            new = set().union(*tokens) - seen
            seen |= new
            for token in known.worth_decoding(new):
                if found := known.telling(token, model):
                    tells[token] = found
            telling, out = set(tells), []
            for low, own in zip(lows, tokens, strict=True):
                words = {w: v for token in own & telling for w, v in tells[token]}
                for w in spaced_words(low, model):
                    if (v := known.of_word(w)) > 0:
                        words[w] = v
                out.append(strength(words.values()))
            yield pd.DataFrame(out, columns=["strongest", "telling"])

    udf = F.pandas_udf(scored, "strongest double, telling long")
    return docs.withColumn("_evidence", udf("text")).select(
        *docs.columns, "_evidence.strongest", "_evidence.telling"
    )


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * len(x) * w * [0, *[1] * (len(w) - 1)]
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-6 * len(x) * np.eye(len(w))
        step = np.linalg.solve(hess + ridge * len(x) * np.diag([0, *[1] * (len(w) - 1)]), grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def held_out():
    return F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))


def score(docs: DataFrame, labels: DataFrame, chance: float = 0.05,
          most: int = 100_000) -> DataFrame:
    """`docs` plus score, the probability that a text is labelled toxic.

    Labels are taken only of ids whose crc32 modulo 4 is not 2. The classifier learns from
    all texts of these ids, copies of a text once; the shares of the two labels among all
    labelled ids weigh them. An id labelled both ways counts as toxic. The character model counts all texts. Null and empty texts get
    the score of a text without evidence; without labels of both kinds every score is 0.
    Rows are neither dropped nor merged; a column named score is replaced.
    """
    docs = docs.drop("score")
    session = docs.sparkSession
    marked = (
        labels.where(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id"), 4) != 2))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    marked = stored(marked, "toxic-labels")
    totals = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if not (totals.get(0) and totals.get(1)):
        return docs.withColumn("score", F.lit(0.0))
    # Copies are no further evidence: of texts with the same mark one is taken. What tells
    # them apart is small, so only the texts that are taken are exchanged, once, and in the
    # same way whatever the number of labels.
    named = docs.select("doc_id", "text", F.xxhash64("text").alias("hash"))
    mark = copy_mark("text", "doc_id", among(marked, "doc_id"))
    marks = named.select("doc_id", "hash", mark.alias("mark")).where("mark is not null")
    taken = marks.join(marked.hint("merge"), "doc_id").groupBy("toxic", "mark").agg(
        F.min(F.struct("doc_id", "hash")).alias("one")
    )
    taken = stored(taken.select("one.*", "toxic"), "toxic-taken")
    may = maybe_among(taken, "hash")
    texts = named.where(may(F.col("hash"))).join(taken.hint("merge"), ["doc_id", "hash"])
    texts = texts.groupBy("doc_id", "hash", "toxic").agg(F.first("text").alias("text"))
    used = {r["toxic"]: r["count"] for r in taken.groupBy("toxic").count().collect()}
    grams = [(r["gram"], r["n"]) for r in trigram_counts(docs).collect()]
    lm = session.sparkContext.broadcast(log_probabilities(grams))
    # Labelled texts are decoded once, for their grams and for the fit.
    words = stored(word_sets(texts, lm), "toxic-words")
    present = stored(gram_presence(words), "toxic-grams")
    odds = telling_grams(present, used[1], used[0], chance, most)
    known = session.sparkContext.broadcast(odds)
    # Texts with the same evidence are one row with their number.
    seen = evidence_of_words(words, known)
    seen = seen.groupBy("toxic", "strongest", "telling").count().collect()
    x = np.array([(r["strongest"], np.log1p(r["telling"])) for r in seen], float)
    y = np.array([r["toxic"] for r in seen], float)
    weight = np.array([r["count"] * totals[r["toxic"]] / used[r["toxic"]] for r in seen], float)
    w = logistic(x, y, weight / weight.mean())
    line = F.lit(float(w[0])) + float(w[1]) * F.col("strongest")
    line = line + float(w[2]) * F.log1p("telling")
    out = evidence(docs, lm, known).withColumn("score", 1 / (1 + F.exp(-line)))
    return out.select(*docs.columns, "score")


def toxic_documents(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of `docs`."""
    rows = score(docs.select("doc_id", "text"), labels.select("doc_id", "toxic"))
    return rows.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_harmless(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` whose score is below `threshold`."""
    rows = docs.select(whole_row(docs), "doc_id", "text")
    rows = score(rows, labels.select("doc_id", "toxic"))
    return rows.where(F.col("score") < threshold).select("row.*")
