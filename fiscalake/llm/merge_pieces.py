"""Encoding and decoding with a merge-type piece vocabulary, by a prefix table.

Merging pairs from the best score on leaves, for every prefix of a text, one last token,
and the encoding of a prefix is that of the prefix before its last token, and the token.
Which sequences can come out is decided by neighbours alone: a sequence is an encoding if
and only if each two tokens next to each other are one. So one walk over the text fills a
table of last tokens: an automaton of all pieces gives the tokens that end at a place, and
the one that is compatible with the last token of the prefix before it is stored. The ids
are then read from the end of the text backwards.

Two tokens are compatible if merging their characters leaves the border between them
alone. That is told from the order in which each of them was merged on its own: the two
orders are run through together, better score first and the left one of equals, and the
pieces at both sides of the border must never be the best pair.

No piece of the vocabulary reaches over some borders (that before a run of blanks, or next
to a character that is in no piece); the text is cut there, and each different part is
encoded once per worker while the parts held stay within a number of bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Numbered, pick, table

SPACE = "▁"  # fixed value: how the vocabulary writes a blank
OTHER = -1  # a character that is in no piece; also what is before the text
HELD = 48 << 20  # bytes of different parts a worker remembers
PAIRS = 1_000_000  # tested pairs of tokens a worker remembers
BATCH = 16 << 20  # bytes of text, or ids, in one batch that is given back


class MergePieces:
    """A merge-type vocabulary with byte pieces, which adds a blank before the text and
    changes no other character. Others are refused."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        every = range(model.get_piece_size())
        bytes_of = {int(model.id_to_piece(i)[3:5], 16): i for i in every if model.is_byte(i)}
        plain = [i for i in every if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        if len(bytes_of) != 256:
            raise ValueError("the vocabulary has no byte pieces")
        self.byte_ids = [bytes_of[b] for b in range(256)]
        self.texts = [model.id_to_piece(i) for i in plain]
        self.ids = list(plain)
        self.score = {t: model.get_score(i) for t, i in zip(self.texts, plain)}
        # Characters of longer pieces that are no pieces themselves stand as tokens, too.
        for c in sorted(set("".join(self.texts)) - set(self.score)):
            self.texts.append(c)
            self.ids.append(None)
        self.length = [len(t) for t in self.texts]
        self.automaton = ahocorasick.Automaton()
        for token, text in enumerate(self.texts):
            self.automaton.add_word(text, token)
        self.automaton.make_automaton()
        self.merges: dict[int, list | None] = {}
        self.tested: dict[int, bool] = {}
        self._cuts()
        self._surfaces(model, every)
        probe = " ".join(self.texts[:: max(1, len(self.texts) // 500)]).replace(SPACE, " ")
        if self.encode(probe.encode()).tolist() != model.encode(probe):
            raise ValueError("not a vocabulary of merges with a plain normaliser")

    # --- compatible tokens ----------------------------------------------------------------

    def _merged(self, token: int) -> list[tuple[float, str, str]] | None:
        """The merges that make the token out of its characters: the score of each and the
        last and the first piece after it. None if merging does not end in the token."""
        known = self.merges.get(token, OTHER)
        if known is not OTHER:
            return known
        parts, steps = list(self.texts[token]), []
        while len(parts) > 1:
            scores = [self.score.get(a + b) for a, b in zip(parts, parts[1:])]
            found = [s for s in scores if s is not None]
            if not found:
                steps = None
                break
            at = scores.index(max(found))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            steps.append((scores[at], parts[-1], parts[0]))
        self.merges[token] = steps
        return steps

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the characters of both tokens ends in just these two."""
        after = self._merged(right)
        if after is None:
            return False
        if left == OTHER:
            return True
        before = self._merged(left)
        if before is None:
            return False
        last, first = self.texts[left][0 if not before else -1], self.texts[right][0]
        i = j = 0
        while True:
            a = before[i][0] if i < len(before) else None
            b = after[j][0] if j < len(after) else None
            across = self.score.get(last + first)
            # Of equal scores the left merge is first: inside ``left``, across, inside ``right``.
            if across is not None and (a is None or across > a) and (b is None or across >= b):
                return False
            if a is None and b is None:
                return True
            if b is None or (a is not None and a >= b):
                last, i = before[i][1], i + 1
            else:
                first, j = after[j][2], j + 1

    # --- the prefix table -----------------------------------------------------------------

    def last_tokens(self, text: str) -> list[int]:
        """For the prefix of each length, its last token."""
        last, open_ = [OTHER] * (len(text) + 1), [True] * (len(text) + 1)
        tested, length = self.tested, self.length
        for end, token in self.automaton.iter(text):
            end += 1
            if open_[end]:
                before = last[end - length[token]]
                pair = before << 24 | token
                fits = tested.get(pair)
                if fits is None:
                    fits = tested[pair] = self.compatible(before, token)
                if fits:
                    last[end], open_[end] = token, False
        if len(tested) > PAIRS:
            tested.clear()
        return last

    def tokens(self, text: str) -> list[int]:
        """The ids of a text that is written with SPACE already."""
        last, out, at = self.last_tokens(text), [], len(text)
        while at:
            token = last[at]
            at -= 1 if token == OTHER else self.length[token]
            known = None if token == OTHER else self.ids[token]
            if known is None:
                out += [self.byte_ids[b] for b in reversed(text[at].encode())]
            else:
                out.append(known)
        return out[::-1]

    # --- whole texts ----------------------------------------------------------------------

    def _cuts(self) -> None:
        """How a text can be cut without changing its tokens, out of the vocabulary."""
        inside = any(SPACE in t.lstrip(SPACE) for t in self.texts)
        line = any("\n" in t for t in self.texts)
        if inside:
            self.part = re.compile(rb"(?s).+")
        elif line:
            self.part = re.compile(rb" *[^ ]+| +")
        else:
            self.part = re.compile(rb"\n| *[^ \n]+| +")
        self.words = Numbered(1 << 62)
        self._empty()

    def _empty(self) -> None:
        self.words.ids.clear()
        self.start, self.count, self.texts_with, self.all = (np.empty(0, t) for t in (np.int64, np.int64, np.int32, np.int32))
        self.held = self.ends = self.weight = 0

    def _forget(self) -> None:
        """Make room: parts that were in one text only go, or, if that is not enough, all."""
        again = np.flatnonzero(self.texts_with[: self.held] > 1)
        names = list(self.words.ids)
        kept, counts, ids = [names[i] for i in again], self.count[again], self._ids(again)
        self._empty()
        if self._weight(kept, len(ids)) < HELD // 2:
            self.words.number(kept)
            self._remember(kept, counts, ids)

    @staticmethod
    def _weight(parts: list[bytes], tokens: int) -> int:
        return sum(map(len, parts)) + 4 * tokens + 150 * len(parts)

    def _remember(self, parts: list[bytes], counts: np.ndarray, ids: np.ndarray) -> None:
        """Store the ids of parts that have just got their numbers, one after the other."""
        self._put("start", self.ends + np.cumsum(counts) - counts, self.held)
        self._put("count", counts, self.held)
        self._put("texts_with", np.zeros(len(parts), np.int32), self.held)
        self._put("all", ids, self.ends)
        self.held, self.ends = self.held + len(parts), self.ends + len(ids)
        self.weight += self._weight(parts, len(ids))

    def _ids(self, numbers: np.ndarray) -> np.ndarray:
        """The ids of numbered parts, one after the other."""
        counts = self.count[numbers]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.all[np.repeat(self.start[numbers] - ends + counts, counts) + np.arange(total)]

    def _put(self, name: str, new: Sequence[int] | np.ndarray, at: int) -> None:
        """Arrays double when they are full, so that a new part costs little."""
        old = getattr(self, name)
        if at + len(new) > len(old):
            old = np.concatenate([old[:at], np.empty(at + 2 * len(new) + 1024, old.dtype)])
            setattr(self, name, old)
        old[at : at + len(new)] = new

    def encode(self, text: bytes) -> np.ndarray:
        """The ids of a whole text."""
        if not text:
            return np.empty(0, np.int32)
        if self.weight > HELD:
            self._forget()
        numbers, new = self.words.number(self.part.findall(b" " + text.replace(SPACE.encode(), b" ")))
        if new:
            made = [self.tokens(w.decode().replace(" ", SPACE)) for w in new]
            counts = np.fromiter(map(len, made), np.int64, len(made))
            self._remember(new, counts, np.fromiter(chain.from_iterable(made), np.int32, int(counts.sum())))
        self.texts_with[numbers] += 1  # once per text, however often a part is in it
        return self._ids(numbers)

    # --- decoding -------------------------------------------------------------------------

    def _surfaces(self, model, every: range) -> None:
        made = [self._surface(model, i) for i in every]
        self.width = np.fromiter(map(len, made), np.int64, len(made))
        self.place = np.cumsum(self.width) - self.width
        self.bytes = np.frombuffer(b"".join(made), np.uint8)
        self.silent = np.array([model.is_control(i) for i in every])
        self.blank = np.array([model.id_to_piece(i).startswith(SPACE) for i in every])
        self.is_byte = np.array([model.is_byte(i) for i in every])

    @staticmethod
    def _surface(model, i: int) -> bytes:
        if model.is_byte(i):
            return bytes([int(model.id_to_piece(i)[3:5], 16)])
        if model.is_control(i):
            return b""
        return model.decode([i]).encode() if model.is_unknown(i) else model.id_to_piece(i).replace(SPACE, " ").encode()

    def decode(self, ids: np.ndarray) -> bytes:
        """The text of ids. Bytes that are no character become U+FFFD each, also where a
        control piece parts them; ids that are not in the vocabulary raise."""
        silent = np.flatnonzero(self.silent[ids])
        runs = [r[self.width[r] > 0] for r in np.split(ids, silent)] if len(silent) else [ids]
        runs = [r for r in runs if len(r)]
        if not runs:
            return b""
        out = b"".join(map(self._spelled, runs))
        return out[1:] if self.blank[runs[0][0]] else out

    def _spelled(self, ids: np.ndarray) -> bytes:
        width = self.width[ids]
        ends = np.cumsum(width)
        out = self.bytes[np.repeat(self.place[ids] - ends + width, width) + np.arange(int(ends[-1]))].tobytes()
        if self.is_byte[ids].any():
            try:
                out.decode()
            except UnicodeDecodeError:
                return characters(out)
        return out


def characters(text: bytes) -> bytes:
    """The text with every byte that belongs to no character replaced."""
    out, at = [], 0
    while at < len(text):
        for n in (1, 2, 3, 4):
            try:
                out.append(text[at : at + n].decode().encode())
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�".encode())
            n = 1
        at += n
    return b"".join(out)


@cache
def worker_pieces(path: str) -> MergePieces:
    return MergePieces(path)


def _chunks(sizes: np.ndarray, most: int = BATCH) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``most`` bytes; a larger row is a run of its own."""
    start = held = 0
    for i, size in enumerate(sizes):
        if held and held + size > most:
            yield start, i
            start, held = i, 0
        held += int(size)
    if start < len(sizes):
        yield start, len(sizes)


def encoded(docs: DataFrame, path: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``ids`` array<int>: the tokens of every row's whole text
    under the vocabulary at ``path``, as its own library gives them.

    A null or empty text has no ids; blanks count. A very long text is read in one walk
    whose table is as long as its longest part. Repeated rows are encoded again, an empty
    table gives no rows, and other columns of whatever name are left out. ``path`` is read
    on every machine.
    """
    rows = pick(docs, *keep, text)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(path)
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary())
            sizes = texts.fill_null(b"").to_numpy(zero_copy_only=False)
            for a, b in _chunks(np.fromiter(map(len, sizes), np.int64, len(sizes))):
                ids = [pieces.encode(t) for t in sizes[a:b]]
                offsets = np.cumsum([0, *map(len, ids)], dtype=np.int32)
                lists = pa.ListArray.from_arrays(offsets, np.concatenate(ids))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(len(keep))), lists], [*keep, "ids"]
                )

    return rows.mapInArrow(run, f"{kept}, ids array<int>")


def decoded(rows: DataFrame, path: str, ids: str = "ids", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """The columns ``keep`` and ``text``: what the ids of every row mean. Null and empty
    arrays give the empty text; rows are taken as they come."""
    rows = pick(rows, *keep, ids)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema[: len(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = worker_pieces(path)
        for batch in batches:
            lists = batch.column(len(keep))
            flat = lists.flatten().to_numpy(zero_copy_only=False)  # leaves null lists out
            sizes = lists.value_lengths().fill_null(0).to_numpy()
            ends = np.cumsum(sizes)
            for a, b in _chunks(sizes * 8):
                texts = [pieces.decode(flat[e - n : e]) for e, n in zip(ends[a:b], sizes[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(i).slice(a, b - a) for i in range(len(keep))), pa.array(texts, pa.binary()).cast(pa.string())],
                    [*keep, "text"],
                )

    return rows.mapInArrow(run, f"{kept}, text string")


def op11_pieces(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    ids = encoded(table(spark, folder, "documents"), path)
    written = ids.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("ids_sha256"),
    )
    back = decoded(written, path, keep=("doc_id", "n_tokens", "ids_sha256"))
    return back.select("doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
