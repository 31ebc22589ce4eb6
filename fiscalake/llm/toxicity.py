"""Toxicity with noisy-channel deobfuscation.

Disguised words are restored before they are scored. A stretch of characters that may be
disguised (digits or symbols in a word or at its edges, a letter twice or more, single
letters with blanks or marks between them) becomes a lattice: at each character the writer may
have meant the letter itself, a letter it stands for (leetspeak), nothing (a repeated
letter or a separator), or a word boundary. The Viterbi path under a character trigram
model of the whole corpus and the costs of the channel is the restored text.

The score is a logistic regression over the words of the restored text and their
beginnings. It is learned from a bounded sample of labelled documents; the character
model counts every document.
"""

from __future__ import annotations

import math
import re
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import scratch
from .common import Numbered, arrow_map, in_fold, out_of_fold, pick, staged, table

# --- character model ----------------------------------------------------------------------

LETTERS = 64  # 0: boundary, 1 to 26: a to z, the rest: other letters, several to a place
# Characters that stand for letters.
LEET = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "*": "aeiou",
}
SEPARATORS = frozenset(" .-_*~'`^/\\:,;+=|")
SUBSTITUTE, DROP_SEPARATOR, DROP_REPEAT, DROP_OTHER, KEEP_OTHER = 0.7, 0.4, 0.5, 8.0, 8.0
JOIN = 0.1  # of a blank between single letters


def _code(c: str) -> int:
    if "a" <= c <= "z":
        return ord(c) - 96
    return 27 + ord(c) % (LETTERS - 27) if c.isalpha() else 0


CODES = np.array([_code(chr(p).lower()[0]) for p in range(0x3000)], np.int64)


def trigrams(text: str) -> np.ndarray:
    """Places of all trigrams of a text's letters; every run of others is one boundary."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if points.size and points.max() >= len(CODES):
        extra = 27 + points % (LETTERS - 27)
        codes = np.where(points < len(CODES), CODES[np.minimum(points, len(CODES) - 1)], extra).astype(np.int64)
    else:
        codes = CODES[points]
    codes = np.concatenate([[0, 0], codes, [0]])
    keep = np.concatenate([[True, True], (codes[2:] != 0) | (codes[1:-1] != 0)])
    codes = codes[keep]
    return (codes[:-2] * LETTERS + codes[1:-1]) * LETTERS + codes[2:]


def costs(counts: np.ndarray) -> np.ndarray:
    """-log P(c | a, b) from trigram counts, shared out to bigrams and single letters."""
    tri = counts.reshape(LETTERS, LETTERS, LETTERS).astype(float)
    bi, one = tri.sum(0), tri.sum((0, 1))
    p1 = (one + 0.5) / (one.sum() + 0.5 * LETTERS)
    p2 = (bi + 4 * p1) / (bi.sum(1, keepdims=True) + 4)
    p3 = (tri + 4 * p2[None]) / (tri.sum(2, keepdims=True) + 4)
    return -np.log(p3)


def count_characters(docs: DataFrame) -> np.ndarray:
    """Trigram counts of all texts; LETTERS cubed of them, whatever the corpus."""

    def run(batches):
        total, waiting, size = np.zeros(LETTERS**3, np.int64), [], 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    waiting.append(trigrams(text))
                    size += len(waiting[-1])
                if size > 1_000_000:
                    total += np.bincount(np.concatenate(waiting), minlength=len(total))
                    waiting, size = [], 0
        if waiting:
            total += np.bincount(np.concatenate(waiting), minlength=len(total))
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"place": found, "n": total[found]})

    got = (
        pick(docs, "text").mapInArrow(run, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    )
    counts = np.zeros(LETTERS**3, np.int64)
    counts[got["place"].to_numpy()] = got["n"].to_numpy()
    return counts


# --- restoring ----------------------------------------------------------------------------

RUN = re.compile(r"([^\W\d_])\1")
LONG_RUN = re.compile(r"([^\W\d_])\1\1")
RUNS = re.compile(r"([^\W\d_])\1+")
SHORT = 100  # letters of a word that is remembered
EDGES = ".,;:!?\"'()[]{}<>*%#&$|=-_~`^/\\"


NO_LETTER = "".join(sorted(set(EDGES) - set(LEET)))


def _folded(text: str) -> str:
    return RUNS.sub(r"\1", text)


class Restorer:
    """Viterbi decoding of one stretch of characters under a cost table of trigrams."""

    def __init__(self, table: np.ndarray):
        self.table = [[list(map(float, row)) for row in plane] for plane in table]
        self._short_stretch = lru_cache(100_000)(self._stretch)
        self._short_forms = lru_cache(20_000)(self._forms)

    def stretch(self, text: str) -> str:
        """The best path; that of a long text is not remembered."""
        return self._short_stretch(text) if len(text) <= SHORT else self._stretch(text)

    def forms(self, word: str) -> list[str]:
        return self._short_forms(word) if len(word) <= SHORT else self._forms(word)

    def _choices(self, c: str, before: str) -> list[tuple[str, float]]:
        """What one character can mean: text and cost; empty text drops it."""
        if c.isalpha():
            return [(c, 0.0), ("", DROP_REPEAT)] if c == before else [(c, 0.0)]
        out = [(x, SUBSTITUTE) for x in LEET.get(c, "")]
        if c == " ":
            return [*out, ("", JOIN), (" ", 0.0)]
        if c in SEPARATORS:
            return [*out, ("", DROP_SEPARATOR), (" ", DROP_SEPARATOR)]
        return [*out, ("", DROP_OTHER), (" ", KEEP_OTHER)]

    def _stretch(self, text: str) -> str:
        # A state is the last two codes, of which there are few, as characters have few
        # meanings; its value is the cost so far and the way back. No path is left out.
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        before = ""
        for c in text:
            options = [(x, cost, _code(x) if x else -1) for x, cost in self._choices(c, before)]
            before = c
            new: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            for (a, b), (so_far, way) in states.items():
                row = self.table[a][b]
                for x, cost, code in options:
                    if code < 0:
                        key, value, link = (a, b), so_far + cost, way
                    elif code == 0 and b == 0:
                        key, value, link = (a, b), so_far, way
                    else:
                        key, value, link = (b, code), so_far + cost + row[code], (way, x)
                    if key not in new or value < new[key][0]:
                        new[key] = (value, link)
            states = new
        _, way = min(((v + self.table[a][b][0], way) for (a, b), (v, way) in states.items()), key=lambda x: x[0])
        out = []
        while way:
            way, x = way
            out.append(x)
        return "".join(reversed(out)).strip()

    def _mean(self, text: str) -> float:
        """Mean cost of a character of a text and its end."""
        a = b = 0
        total = 0.0
        for code in [*map(_code, text), 0]:
            total += self.table[a][b][code]
            a, b = b, code
        return total / (len(text) + 1)

    def _decoded(self, core: str) -> list[str]:
        """A letter three times is never meant; one written twice may be."""
        if not any(map(str.isalpha, core)):
            return [core]
        if not core.isalpha() or LONG_RUN.search(core):
            return [self.stretch(core)]
        return [core, self.stretch(core)] if RUN.search(core) else [core]

    def _forms(self, word: str) -> list[str]:
        """What one word without blanks, in lower case, may mean, the most likely first.
        Marks at its edges that are letters in LEET may be marks, or letters: all of them,
        or those of the kind next to the word."""
        core = word.strip(EDGES)
        if not core:
            return [core]
        start = word.index(core)
        heads, tails = _kept(word[:start][::-1]), _kept(word[start + len(core) :])
        found = {x: None for head in heads for tail in tails for x in self._decoded(head[::-1] + core + tail)}
        return sorted(found, key=self._mean) if len(found) > 1 else list(found)

    def word(self, word: str) -> str:
        """One word without blanks, in lower case: restored where it may be disguised, else
        without the marks at its edges."""
        return self.forms(word)[0]


def _kept(marks: str) -> list[str]:
    """Parts of the ``marks`` at an edge, from the word outwards, that may be letters."""
    marks = marks.rstrip(NO_LETTER)
    first = marks[: len(marks) - len(marks.lstrip(marks[:1]))]
    return list(dict.fromkeys(["", first if first[:1] in LEET else "", marks]))


def spaced(words: list[str]) -> list[tuple[int, int]]:
    """Places from, to of three or more single characters in a row, blanks between them."""
    out, start = [], None
    for i, w in enumerate([*words, "xx"]):
        single = len(w) == 1 and (w.isalnum() or w in LEET)
        if single and start is None:
            start = i
        elif not single and start is not None:
            if i - start >= 3:
                out.append((start, i))
            start = None
    return out


def restore(text: str | None, restorer: Restorer) -> str:
    """The whole text in lower case, its disguised words restored; null is empty."""
    words = (text or "").lower().split()
    out, at = [], 0
    for a, b in spaced(words):
        out += [restorer.word(w) for w in words[at:a]]
        out.append(restorer.stretch(" ".join(words[a:b])))
        at = b
    out += [restorer.word(w) for w in words[at:]]
    return " ".join(x for x in out if x)


# --- scoring ------------------------------------------------------------------------------


class Settings(NamedTuple):
    """``sample``: at most so many distinct labelled texts, half of them of each label,
    train the score; ``vocabulary``: at most so many words and beginnings of words."""

    sample: int = 10000
    vocabulary: int = 4000
    steps: int = 300
    l2: float = 1e-3


def units(word: str) -> list[str]:
    """What is learned of a restored word: it without blanks, its parts, how they begin."""
    parts = word.split()
    if len(parts) > 1:
        parts.append("".join(parts))
    return [u for w in parts for u in ((w, "^" + w[:4], "^" + w[:5]) if len(w) > 5 else (w,))]


class Scorer:
    """Weights of units, and the numbers of words met so far."""

    def __init__(self, model: tuple[dict[str, float], float], restorer: Restorer, limit: int = 400_000):
        (self.weights, self.bias), self.restorer = model, restorer
        # The known words and beginnings, with letters in a row taken as one.
        self.whole = {_folded(u) for u in self.weights if u[0] != "^"}
        self.begun = {_folded(u[1:]) for u in self.weights if u[0] == "^"}
        self.words = Numbered(limit, self._empty)
        self._empty()

    def _empty(self) -> None:
        self.found: dict[int, list[str]] = {}
        self.mark, self.held = np.zeros(1 << 16, np.int8), 0

    def _reached(self, folded: str) -> bool:
        """Whether what letters can be restored to, in a row taken as one, may have a known
        unit: a path keeps all letters but repeated ones."""
        return folded in self.whole or any(folded[:k] in self.begun for k in range(1, 6))

    def _plain(self, text: str) -> list[str] | None:
        """The known units of a word whose restored forms cannot have others than it has
        without marks at its edges: none of the forms' letters reach a known unit. None if
        they may, or if the word holds more than letters and one mark that may be a letter
        on either side: then the lattice decides."""
        core = text.strip(EDGES)
        if not core.isalpha():
            return None if core else []
        start = text.index(core)
        heads, tails = [""], [""]
        for marks, letters in ((text[:start][::-1], heads), (text[start + len(core) :], tails)):
            marks = marks.rstrip(NO_LETTER)
            if len(marks) > 1:
                return None
            letters += LEET.get(marks, "")
        doubled = RUN.search(core)
        if doubled and LONG_RUN.search(core):
            return None
        if doubled or len(heads) + len(tails) > 2:
            if any(self._reached(_folded(head + core + tail)) for head in heads for tail in tails):
                return None
        return [u for u in units(core) if u in self.weights]

    def _meet(self, new: list[bytes]) -> None:
        if self.held + len(new) > len(self.mark):
            self.mark = np.concatenate([self.mark, np.zeros(len(self.mark) + len(new), np.int8)])
        for w in new:
            text = w.decode()
            # Which form is meant may not show in its letters: the first that has known units.
            known = self._plain(text)
            if known is None:
                known = next(filter(None, ([u for u in units(x) if u in self.weights] for x in self.restorer.forms(text))), [])
            if known:
                self.found[self.held] = known
            self.mark[self.held] = (1 if known else 0) | (2 if len(text) == 1 else 0)
            self.held += 1

    def units(self, text: str | None) -> set[str]:
        """The known units of a text."""
        self.words.make_room()
        words = (text or "").lower().encode("utf-8", "surrogatepass").split()
        numbers, new = self.words.number(words)
        self._meet(new)
        marks = self.mark[numbers]
        out = {u for i in set(numbers[(marks & 1) > 0].tolist()) for u in self.found[i]}
        single = (marks & 2) > 0
        if len(single) > 2 and (single[2:] & single[1:-1] & single[:-2]).any():
            # Only texts with single characters in a row; their words are needed as text.
            plain = [w.decode() for w in words]
            for a, b in spaced(plain):
                out |= {u for u in units(self.restorer.stretch(" ".join(plain[a:b]))) if u in self.weights}
        return out

    def score(self, text: str | None) -> float:
        x = self.bias + sum(self.weights[u] for u in sorted(self.units(text)))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, x))))


def train(texts: list[str], labels: list[int], restorer: Restorer, s: Settings = Settings()) -> tuple[dict[str, float], float]:
    """Weights of units, and the bias. One class alone, or no text, gives a constant."""
    number: dict[str, int] = {}
    by_word: dict[str, list[int]] = {}

    def units_of(text: str) -> np.ndarray:
        found: set[int] = set()
        for w in set(restore(text, restorer).split()):
            if w not in by_word:
                by_word[w] = [number.setdefault(u, len(number)) for u in units(w)]
            found.update(by_word[w])
        return np.fromiter(found, np.int32, len(found))

    sets = [units_of(t) for t in texts]
    y = np.array(labels, float)
    n1, n0 = float((y == 1).sum()), float((y == 0).sum())
    if not n1 or not n0:
        return {}, math.log((n1 + 0.5) / (n0 + 0.5))
    count = np.zeros((len(number), 2), np.int64)
    for found, label in zip(sets, labels):
        count[found, label] += 1

    def gain(c: list[int]) -> float:
        """Twice the log likelihood ratio of a unit's presence and the label."""
        table = [(c[1], n1), (c[0], n0)]
        p = (c[0] + c[1]) / (n0 + n1)
        part = lambda k, n, q: (k * math.log(k / n / q) if k else 0) + ((n - k) * math.log((n - k) / n / (1 - q)) if n > k else 0)
        return 2 * sum(part(k, n, p) for k, n in table) if 0 < p < 1 else 0.0

    often = np.flatnonzero(count.sum(1) >= 3)
    rated = sorted((-gain(count[i].tolist()), i) for i in often.tolist())
    chosen = np.array([i for g, i in rated[: s.vocabulary] if -g > 12], np.int64)
    names = list(number)
    names = [names[i] for i in chosen]
    place = np.full(len(number), -1)
    place[chosen] = np.arange(len(chosen))
    rows = [np.sort(place[found][place[found] >= 0]) for found in sets]
    lengths = np.array([len(r) for r in rows])
    index, owner = np.concatenate([*rows, np.empty(0, np.int64)]), np.repeat(np.arange(len(rows)), lengths)
    w, bias, grads, grad0 = np.zeros(len(names)), 0.0, np.full(len(names), 1e-8), 1e-8
    for _ in range(s.steps):  # full gradients, a step length for each weight
        x = np.bincount(owner, w[index], len(rows)) + bias
        g = (1 / (1 + np.exp(-x)) - y) / len(rows)
        gw, g0 = np.bincount(index, g[owner], len(names)) + s.l2 * w / len(rows) * 10, g.sum()
        grads += gw**2
        grad0 += g0**2
        w -= 0.5 * gw / np.sqrt(grads)
        bias -= 0.5 * g0 / math.sqrt(grad0)
    return {u: float(x) for u, x in zip(names, w) if x}, float(bias)


def fit(docs: DataFrame, labels: DataFrame, s: Settings = Settings()):
    """Character costs from all ``docs`` (doc_id, text) and weights from those with
    ``labels`` (doc_id, toxic): a bounded sample in the order of a hash of the id, chosen
    without its texts, and trained in one task. A null label, id or text teaches nothing."""
    shared = docs.sparkSession.sparkContext.broadcast(costs(count_characters(docs)).astype(np.float32))
    texts = pick(docs, "doc_id", "text").where(F.col("text").isNotNull())
    known = (
        pick(labels, "doc_id", "toxic")
        .where(F.col("toxic").isin(0, 1))
        .select("doc_id", F.col("toxic").cast("int").alias("toxic"))
        .join(texts.select("doc_id"), "doc_id", "left_semi")
        .distinct()
    )
    at = F.xxhash64(F.col("doc_id").cast("string"))
    halves = [known.where(F.col("toxic") == y).orderBy(at, "doc_id").limit(s.sample // 2) for y in (0, 1)]
    chosen = F.broadcast(halves[0].unionByName(halves[1]))
    sample = texts.join(chosen, "doc_id").select("toxic", "text").distinct()

    def learn(batches):
        data = sorted((t, y) for b in batches for t, y in zip(b.column(1).to_pylist(), b.column(0).to_pylist()))
        weights, bias = train([t for t, _ in data], [y for _, y in data], Restorer(shared.value), s)
        yield pa.RecordBatch.from_pydict({"unit": ["", *weights], "w": [bias, *weights.values()]})

    with scratch(docs.sparkSession):
        got = staged(sample, "toxicity-sample").coalesce(1).mapInArrow(learn, "unit string, w double").collect()
    weights = {r["unit"]: r["w"] for r in got}
    return shared, (weights, weights.pop("", 0.0))


def score_toxicity(docs: DataFrame, model, with_text: bool = False) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from 0.5 on) for every row of ``docs``
    (doc_id, text), and the restored text on demand, under a model of ``fit``.

    Null and empty texts get the score of a text without known words. Whole texts count,
    however long; repeated rows are scored alike; an empty table gives an empty result."""
    costs_shared, weights = model
    kind = docs.schema["doc_id"].dataType.simpleString()
    state: dict[str, Scorer] = {}

    def run(batch: pa.RecordBatch):
        if not state:
            state["scorer"] = Scorer(weights, Restorer(costs_shared.value))
        scorer = state["scorer"]
        texts = batch.column(1).to_pylist()
        scores = [scorer.score(t) for t in texts]
        out = {"doc_id": batch.column(0), "score": scores, "predicted": [int(x >= 0.5) for x in scores]}
        if with_text:
            out["restored"] = [restore(t, scorer.restorer) for t in texts]
        yield out

    schema = f"doc_id {kind}, score double, predicted int" + ", restored string" * with_text
    return arrow_map(pick(docs, "doc_id", "text"), run, schema)


def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    labels = pick(table(spark, folder, "labels"), "doc_id", "toxic").where(out_of_fold(F.col("doc_id"), 5, 0))
    return score_toxicity(docs, fit(docs, labels)).select(
        "doc_id", in_fold(F.col("doc_id"), 5, 0).alias("held_out"), "score", "predicted"
    )
