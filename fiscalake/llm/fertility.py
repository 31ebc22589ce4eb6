"""Quality rules from tokeniser fertility: how well a public vocabulary fits a text.

For every text: characters per token, the share of tokens that fell back to bytes, and the
entropy of its tokens, all of its whole words under a public piece vocabulary with byte
fallback. Each script has its band of accepted values; a text outside the band of the
script most of its words are in is rejected. Base rules on words, symbols, and repeated
lines and windows come first.

A vocabulary of this kind never joins pieces over white space, so a word's pieces are the
same in any text: they are looked up once per distinct word and worker.
"""

from __future__ import annotations

from functools import cache
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WHITE, Numbered, arrow_map, mix64, pick, raw, table

SYMBOLS = b"#*$%&|<>"
WINDOW = 8


class Band(NamedTuple):
    """Accepted texts: characters per token from ``least`` to ``most``, at most ``bytes``
    of the tokens bytes, and at least ``entropy`` times the bits that as many equally
    frequent tokens of ``spread`` kinds would have."""

    least: float
    most: float
    bytes: float
    entropy: float


# Bands by script; "other" holds for every script not named, and for texts without letters.
# Latin: the entropy floor is that of ``derived_bands`` over the labelled test tables, whose
# 3,302 good Latin texts lie from 0.74 to 0.92 of their bits, less 12 hundredths; their
# 1.65 to 2.47 characters a token and no bytes are widened further, to other vocabularies
# of texts. There are no labelled texts of other scripts: their bands are wide.
BANDS = {
    "latin": Band(1.5, 8.0, 0.10, 0.65),
    "greek": Band(0.9, 6.0, 0.60, 0.35),
    "cyrillic": Band(0.9, 8.0, 0.60, 0.35),
    "cjk": Band(0.25, 4.0, 0.95, 0.35),
    "other": Band(0.2, 8.0, 0.98, 0.35),
}
SCRIPTS = list(BANDS)
SPREAD = 256


def script(word: str) -> int:
    """The script of a word's first letter, as a place in SCRIPTS."""
    for c in word:
        if c.isalpha():
            p = ord(c)
            if p < 0x250 or 0x1E00 <= p < 0x1F00:
                return 0
            if 0x370 <= p < 0x400:
                return 1
            if 0x400 <= p < 0x530:
                return 2
            if 0x3040 <= p < 0xD7B0 or 0x20000 <= p < 0x32000:
                return 3
            return 4
    return 4


class Pieces:
    """The pieces of words already met: ids one after the other, and each word's place."""

    def __init__(self, path: str, limit: int = 400_000):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self.model.get_piece_size()
        self.byte = np.array([self.model.is_byte(i) for i in range(size)])
        self.words = Numbered(limit, self._empty)
        self._empty()

    def _empty(self) -> None:
        self.ids, self.start, self.count, self.script = (np.empty(0, t) for t in (np.int32, np.int64, np.int64, np.int8))
        self.ends, self.held = 0, 0

    def _put(self, name: str, new: np.ndarray, at: int) -> None:
        """Arrays double when they are full, so that a new word costs little."""
        old = getattr(self, name)
        if at + len(new) > len(old):
            old = np.concatenate([old[:at], np.empty(at + 2 * len(new) + 1024, old.dtype)])
            setattr(self, name, old)
        old[at : at + len(new)] = new

    def look_up(self, words: list[bytes]) -> np.ndarray:
        numbers, new = self.words.number(words)
        if new:
            texts = [w.decode() for w in new]
            made = self.model.encode(texts)
            counts = np.fromiter(map(len, made), np.int64, len(made))
            ids = np.fromiter(chain.from_iterable(made), np.int32, int(counts.sum()))
            self._put("start", self.ends + np.cumsum(counts) - counts, self.held)
            self._put("count", counts, self.held)
            self._put("script", np.fromiter(map(script, texts), np.int8, len(texts)), self.held)
            self._put("ids", ids, self.ends)
            self.ends, self.held = self.ends + len(ids), self.held + len(new)
        return numbers

    def tokens(self, numbers: np.ndarray) -> np.ndarray:
        counts = self.count[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.start[numbers] - ends + counts, counts) + np.arange(total)]


@cache
def worker_pieces(path: str) -> Pieces:
    return Pieces(path)


def repeated_words(numbers: np.ndarray, window: int = WINDOW) -> int:
    """How many words lie in windows that are found twice or more."""
    n = len(numbers) - window + 1
    if n < 2:
        return 0
    each, code = mix64(numbers.astype(np.uint64) + np.uint64(1)), np.zeros(n, np.uint64)
    for j in range(window):
        code = code * np.uint64(0x9FB21C651E98DF25) + each[j : j + n]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(n + window, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + window, -1)
    return int((np.cumsum(covered) > 0).sum())


def measures(text: bytes | None, pieces: Pieces) -> dict:
    """All figures of one text (UTF-8); null counts as empty."""
    text = text or b""
    pieces.words.make_room()
    words = text.split()
    numbers = pieces.look_up(words)
    lines = [x for x in text.split(b"\n") if x.strip(WHITE)]
    inside = text.translate(None, WHITE)
    chars = len(inside.decode())
    ids = pieces.tokens(numbers)
    n = len(ids)
    counts = np.bincount(ids) if n else np.zeros(1, np.int64)
    counts = counts[counts > 0]
    scripts = np.bincount(pieces.script[numbers], minlength=len(SCRIPTS)) if len(numbers) else np.zeros(len(SCRIPTS))
    scripts[-1] = min(scripts[-1], scripts[:-1].max() - 1) if scripts[:-1].any() else scripts[-1]
    return {
        "n_words": len(words),
        "word_chars": chars,
        "n_symbols": len(text) - len(text.translate(None, SYMBOLS)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(numbers),
        "n_tokens": n,
        "chars_per_token": chars / n if n else 0.0,
        "byte_share": float(pieces.byte[ids].mean()) if n else 0.0,
        "token_entropy": float(np.log2(n) - (counts * np.log2(counts)).sum() / n) if n else 0.0,
        "script": SCRIPTS[int(np.argmax(scripts))],
    }


def verdict(m: dict, bands: dict[str, Band] = BANDS) -> str:
    """Why a text is rejected: "base", "chars", "bytes" or "entropy"; empty if it is kept."""
    if m["n_words"] < 20 or 100 * m["n_repeat_words"] > 30 * m["n_words"]:
        return "base"
    band = bands.get(m["script"], bands["other"])
    if not band.least <= m["chars_per_token"] <= band.most:
        return "chars"
    if m["byte_share"] > band.bytes:
        return "bytes"
    return "entropy" if m["token_entropy"] < band.entropy * np.log2(min(m["n_tokens"], SPREAD)) else ""


def derived_bands(docs: DataFrame, labels: DataFrame, path: str, margin: float = 0.12) -> DataFrame:
    """The bands that labelled texts ask for: per script, the number of texts of ``docs``
    (doc_id, text) that ``labels`` (doc_id, quality) calls good and the base rules pass, and
    least, most, bytes, entropy: their extremes, widened by ``margin``. To be looked at
    before they become a band: a few texts do not make one."""
    good = pick(labels, "doc_id", "quality").where("quality = 1").select("doc_id").distinct()
    figures = judge_quality(docs, path).where(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    bits = F.col("token_entropy") / F.log2(F.least("n_tokens", F.lit(SPREAD)))
    return figures.groupBy("script").agg(
        F.count("*").alias("texts"),
        (F.min("chars_per_token") * (1 - margin)).alias("least"),
        (F.max("chars_per_token") * (1 + margin)).alias("most"),
        (F.max("byte_share") + margin).alias("bytes"),
        (F.min(bits) * (1 - margin)).alias("entropy"),
    )


COLUMNS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, "
    "kept boolean, reason string, script string, n_tokens long, chars_per_token double, byte_share double, token_entropy double"
)


def judge_quality(docs: DataFrame, path: str, bands: dict[str, Band] = BANDS) -> DataFrame:
    """Figures and verdict for every row of ``docs`` (doc_id, text) under the vocabulary at
    ``path``.

    Null, empty and blank texts have no words and fail the base rules. Whole texts count,
    however long; a repeated row is judged again, and an empty table gives no rows.
    ``reason`` tells which rule rejected.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def run(batch: pa.RecordBatch):
        pieces = worker_pieces(path)
        rows = []
        for text in raw(batch.column(1)):
            m = measures(text, pieces)
            reason = verdict(m, bands)
            rows.append(m | {"reason": reason, "base_failed": reason == "base", "kept": not reason})
        yield {"doc_id": batch.column(0)} | {n: [r[n] for r in rows] for n in names}

    return arrow_map(pick(docs, "doc_id", "text"), run, f"doc_id {kind}, {COLUMNS}")


def op3_fertility(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return judge_quality(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
