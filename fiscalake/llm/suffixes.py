"""Removal of long repeated passages with families of suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts anywhere else. Two
steps keep the index to what can match at all, without losing a match:

1. Each window of LENGTH bytes picks its anchor, the stretch of ``GRAM`` bytes in it with
   the least hash, leftmost of equals. Equal windows pick equal anchors at the same place,
   so a window whose anchor is found nowhere else is not repeated. Anchors are posted and
   counted over the whole corpus.
2. Runs of windows with one repeated anchor are pieces of text. Equal pieces become one,
   with their number. Pieces are dealt by anchor, so windows that may be equal meet in one
   task, and an anchor with very many different pieces is dealt by the bytes around it.

A task keeps a logarithmic family: each batch of pieces gets a suffix array (its windows in
suffix order), is merge-scanned against itself and every level, and becomes a level; levels
of like size merge, so there are few, and each window is merged a logarithmic number of
times. Only matches of the full LENGTH count, so suffixes are ordered by a fingerprint of
their first LENGTH bytes, under which equal prefixes are neighbours as they are in
alphabetical order, and numbers are compared instead of text. Matches are confirmed byte
by byte.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import scratch
from .common import arrow_map, mix64, pick, raw, shuffles, staged, table
from .distinct import BLOBS, Postings, distinct_texts, repeated, text_key, with_texts

LENGTH, GRAM = 200, 32
SEGMENT = 1 << 20  # windows handled at a time
PLACE = np.uint64((1 << 21) - 1)
MANY = 4096  # pieces of one anchor from which on it is dealt by the bytes around it
STEP = 16  # windows that share those bytes
BATCH = 1 << 20  # bytes of pieces that get a suffix array at a time

_C = [np.uint64(x) for x in (0x8CB92BA72F3D8DD7, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_M = np.random.default_rng(20240229).integers(1, 2**63, LENGTH // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _eights(data: bytes) -> np.ndarray:
    """The 8 bytes from each place on, as a number."""
    return np.ndarray((max(0, len(data) - 7),), np.dtype("<u8"), buffer=data, strides=(1,))


def anchors(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: first window, end of the run, anchor's place, hash."""
    starts, ends, places, codes = [], [], [], []
    windows = len(text) - LENGTH + 1
    for at in range(0, max(0, windows), SEGMENT):
        part = text[at : at + SEGMENT + LENGTH - 1]
        eights = _eights(part)
        n = len(part) - GRAM + 1
        h = eights[:n] * _C[0]
        for i in (1, 2, 3):
            h ^= h >> np.uint64(29)
            h = (h + eights[8 * i : 8 * i + n]) * _C[i]
        h ^= h >> np.uint64(32)
        h *= _C[0]
        key = (h & ~PLACE) | np.arange(n, dtype=np.uint64)
        width, span = 1, LENGTH - GRAM + 1
        while 2 * width <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        rest = span - width
        key = np.minimum(key[: len(key) - rest], key[rest:])
        place = (key & PLACE).astype(np.int64)
        new = np.flatnonzero(np.append(True, place[1:] != place[:-1]))
        starts.append(new + at)
        ends.append(np.append(new[1:], len(place)) + at)
        places.append(place[new] + at)
        codes.append(h[place[new]])
    if not starts:
        none = np.empty(0, np.int64)
        return none, none, none, np.empty(0, np.uint64)
    return tuple(map(np.concatenate, (starts, ends, places, codes)))


def _posted(texts: DataFrame) -> DataFrame:
    """(code, r) of anchors found more than once; twice in one text counts, too."""
    buckets = shuffles(texts.sparkSession)

    def run(batches):
        out = Postings(buckets)
        schema = pa.schema([("bucket", pa.int32()), ("codes", pa.binary()), ("base", pa.int64()), ("rows", pa.binary())])
        for batch in batches:
            for r, text in zip(batch.column(0).to_pylist(), raw(batch.column(1))):
                codes, counts = np.unique(anchors(text)[3], return_counts=True)
                out.add(np.concatenate([codes, codes[counts > 1]]), r)
                if out.size > out.most:
                    for row in out.flush():
                        yield pa.RecordBatch.from_pydict(row, schema)
        for row in out.flush():
            yield pa.RecordBatch.from_pydict(row, schema)

    return repeated(texts.select("r", "text").mapInArrow(run, BLOBS))


PIECES = "key binary, pk binary, starts array<int>, code long, at int, piece binary, n long"
_PIECES = pa.schema(
    [("key", pa.binary()), ("pk", pa.binary()), ("starts", pa.list_(pa.int32())), ("code", pa.int64()), ("at", pa.int32()), ("piece", pa.binary()), ("n", pa.int64())]
)


def _cut(texts: DataFrame) -> DataFrame:
    """From (key, copies, text, codes): where each piece occurs (key, pk, starts), and each
    piece once per stretch of input (pk, code, at, piece, n)."""

    def run(batches):
        known: dict[bytes, list] = {}
        size = 0

        def pieces():
            k = list(known)
            v = list(known.values())
            none = [None] * len(k)
            return pa.RecordBatch.from_pydict(
                {"key": none, "pk": k, "starts": none, "code": [x[0] for x in v], "at": [x[1] for x in v], "piece": [x[2] for x in v], "n": [x[3] for x in v]}, _PIECES
            )

        for batch in batches:
            found = {"key": [], "pk": [], "starts": []}
            codes_of = batch.column(3)
            for i, (key, copies, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2)))):
                start, end, place, code = anchors(text)
                keep = np.isin(code, codes_of[i].values.to_numpy(zero_copy_only=False).view(np.uint64))
                own: dict[bytes, list[int]] = {}
                for a, b, p, c in zip(start[keep].tolist(), end[keep].tolist(), place[keep].tolist(), code[keep].view(np.int64).tolist()):
                    piece = text[a : b + LENGTH - 1]
                    pk = hashlib.blake2b(piece, digest_size=16).digest()
                    own.setdefault(pk, []).append(a)
                    if pk in known:
                        known[pk][3] += copies
                    else:
                        known[pk] = [c, p - a, piece, copies]
                        size += len(piece)
                found["key"] += [key] * len(own)
                found["pk"] += own.keys()
                found["starts"] += own.values()
                if size > 16_000_000:
                    yield pieces()
                    known, size = {}, 0
            none = [None] * len(found["pk"])
            yield pa.RecordBatch.from_pydict(found | {n: none for n in ("code", "at", "piece", "n")}, _PIECES)
        if known:
            yield pieces()

    return texts.mapInArrow(run, PIECES)


class Family:
    """Levels of suffix arrays over pieces of text, and which windows were met twice."""

    def __init__(self):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # fingerprints in order, places
        self.data, self.used = np.empty(1 << 16, np.uint8), 0
        self.twice = np.zeros(1 << 16, bool)

    def _reserve(self, n: int) -> None:
        if self.used + n > len(self.data):
            grow = len(self.data) + n
            self.data = np.concatenate([self.data, np.empty(grow, np.uint8)])
            self.twice = np.concatenate([self.twice, np.zeros(grow, bool)])

    def _mark(self, a: np.ndarray, b: np.ndarray) -> None:
        """Places a and b whose windows have the same fingerprint."""
        span = np.arange(LENGTH)
        new = ~(self.twice[a] & self.twice[b])
        a, b = a[new], b[new]
        for i in range(0, len(a), 8192):
            x, y = a[i : i + 8192], b[i : i + 8192]
            same = (self.data[x[:, None] + span] == self.data[y[:, None] + span]).all(1)
            self.twice[x[same]] = True
            self.twice[y[same]] = True

    def add(self, pieces: list[bytes]) -> int:
        """Index a batch of pieces and match it with all before; returns its first place."""
        joined = b"".join(pieces)
        first = self.used
        self._reserve(len(joined))
        self.data[first : first + len(joined)] = np.frombuffer(joined, np.uint8)
        self.used += len(joined)
        lengths = np.array([len(p) for p in pieces])
        counts = lengths - LENGTH + 1
        begins = np.cumsum(lengths) - lengths
        place = np.repeat(begins - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
        scrambled = mix64(_eights(joined).copy())
        prints = np.zeros(len(place), np.uint64)
        for j, m in enumerate(_M):
            prints += scrambled[place + 8 * j] * m
        order = np.argsort(prints, kind="stable")
        prints, place = prints[order], place[order] + first
        # Within the batch: equal neighbours; each is matched with the first of its run.
        new = np.append(True, prints[1:] != prints[:-1])
        run = np.flatnonzero(new)[np.cumsum(new) - 1]
        self._mark(place[run[~new]], place[~new])
        prints, place = prints[new], place[new]
        for level, at in self.levels:
            i = np.minimum(np.searchsorted(level, prints), len(level) - 1)
            hit = level[i] == prints
            self._mark(at[i[hit]], place[hit])
        self.levels.append((prints, place))
        while len(self.levels) > 1 and len(self.levels[-2][0]) < 2 * len(self.levels[-1][0]):
            (p, a), (q, b) = self.levels.pop(), self.levels.pop()
            # The older entry stands for both where they are equal: it is marked already.
            prints, place = np.concatenate([q, p]), np.concatenate([b, a])
            order = np.argsort(prints, kind="stable")
            prints, place = prints[order], place[order]
            keep = np.append(True, prints[1:] != prints[:-1])
            self.levels.append((prints[keep], place[keep]))
        return first


def _runs(marks: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], marks.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _match(batches):
    """Arrow batches of (pk, piece, shift, n) -> (pk, runs of windows met twice)."""
    family, rows, waiting, size = Family(), [], [], 0

    def index():
        place = family.add([p for _, p, _, _ in waiting])
        for pk, piece, shift, n in waiting:
            rows.append((pk, shift, place, len(piece) - LENGTH + 1, n > 1))
            place += len(piece)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            waiting.append(row)
            size += len(row[1])
            if size > BATCH:
                index()
                waiting, size = [], 0
    if waiting:
        index()
    for i in range(0, len(rows), 20_000):
        out = {"pk": [], "runs": []}
        for pk, shift, place, windows, several in rows[i : i + 20_000]:
            runs = [(0, windows)] if several else _runs(family.twice[place : place + windows])
            if runs:
                out["pk"].append(pk)
                out["runs"].append([x + shift for run in runs for x in run])
        yield pa.RecordBatch.from_pydict(out, pa.schema([("pk", pa.binary()), ("runs", pa.list_(pa.int32()))]))


def _deal(batches):
    """Pieces of an anchor with many of them, cut so that the windows of each part share
    the bytes by which it is dealt: equal windows get equal parts' codes."""
    schema = pa.schema([("code", pa.int64()), ("pk", pa.binary()), ("piece", pa.binary()), ("shift", pa.int32()), ("n", pa.int64())])
    for batch in batches:
        out = {f.name: [] for f in schema}
        for code, pk, piece, at, n in zip(*(c.to_pylist() for c in batch.columns)):
            windows = len(piece) - LENGTH + 1
            for q in range((at - windows + 1) // STEP, at // STEP + 1):
                first, last = max(0, at - STEP * q - STEP + 1), min(windows - 1, at - STEP * q)
                if first > last:
                    continue
                core = piece[at - STEP * q : at - STEP * q - STEP + 1 + LENGTH]
                out["code"].append(int.from_bytes(hashlib.blake2b(b"%d %d " % (code, q) + core, digest_size=8).digest(), "little", signed=True))
                out["pk"].append(pk)
                out["piece"].append(piece[first : last + LENGTH])
                out["shift"].append(first)
                out["n"].append(n)
        yield pa.RecordBatch.from_pydict(out, schema)


def repeats(texts: DataFrame) -> DataFrame:
    """(key, found): for texts of ``distinct_texts`` with repeated windows, the places of
    their pieces and each piece's runs of repeated windows."""
    n = shuffles(texts.sparkSession)
    long_texts = texts.where(F.octet_length("text") >= LENGTH)
    posted = staged(_posted(long_texts), "suffix-anchors")
    codes = posted.groupBy("r").agg(F.collect_set("code").alias("codes"))
    keys = texts.select("r", "key")
    some = with_texts(long_texts, codes.join(keys, "r").select("key", "codes"), "copies", "text")
    pieces = staged(_cut(some.select("key", "copies", "text", "codes")), "suffix-pieces")
    each = pieces.where(F.col("key").isNull()).select("code", "pk", "piece", "at", "n")
    many = each.groupBy("code").agg(F.count("*").alias("n")).where(F.col("n") > MANY).select("code")
    whole = each.join(many, "code", "left_anti").select("code", "pk", "piece", F.lit(0).alias("shift"), "n")
    parts = each.join(many, "code", "left_semi").mapInArrow(_deal, "code long, pk binary, piece binary, shift int, n long")
    dealt = whole.unionByName(parts).repartition(n, "code").select("pk", "piece", "shift", "n")
    runs = dealt.mapInArrow(_match, "pk binary, runs array<int>")
    # One row per piece again: its parts, and its copies from other stretches of input.
    runs = runs.groupBy("pk").agg(F.collect_set("runs").alias("runs"))
    places = pieces.where(F.col("key").isNotNull()).select("key", "pk", "starts")
    return places.join(runs, "pk").groupBy("key").agg(F.collect_list(F.struct("starts", "runs")).alias("found"))


def removed(length: int, found: list[dict]) -> list[tuple[int, int]]:
    """Maximal runs of bytes to remove."""
    change = np.zeros(length + 1, np.int64)
    for x in found:
        starts = np.array(x["starts"], np.int64)
        for runs in x["runs"]:
            for a, b in zip(runs[::2], runs[1::2]):
                np.add.at(change, starts + a, 1)
                np.add.at(change, starts + (b - 1 + LENGTH), -1)
    return _runs(np.cumsum(change[:-1]) > 0)


def without_repeats(docs: DataFrame, with_text: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """For every row of ``docs`` (doc_id, text): doc_id, n_bytes, n_removed, n_spans (runs
    removed), kept_sha256 of the bytes that are left, those as ``kept`` on demand, and the
    columns to ``keep``.

    Texts are taken as UTF-8. A null text is empty; texts shorter than LENGTH have nothing
    to remove. Strings are judged on the input: all copies of a repeated passage go, also
    the first, and a text with an equal copy goes as a whole. Matches stay within a row.
    A cut may fall inside a character; ``kept`` leaves such broken characters out, the
    hash does not. An empty table gives an empty result."""
    rows = pick(docs, "doc_id", "text", *keep).select("doc_id", text_key(F.col("text")).alias("key"), *keep)

    def run(batch: pa.RecordBatch):
        out = {n: [] for n in ("key", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept")}
        for key, copies, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), raw(batch.column(2)), batch.column(3).to_pylist()):
            spans = [(0, len(text))] if copies > 1 and len(text) >= LENGTH else removed(len(text), places or [])
            ends = [0, *(x for s in spans for x in s), len(text)]
            kept = b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2])) if spans else text
            for name, value in zip(out, (key, len(text), len(text) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), kept.decode(errors="ignore") if with_text else None)):
                out[name].append(value)
        yield out

    schema = "key binary, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string"
    with scratch(docs.sparkSession):
        texts = distinct_texts(docs)
        found = repeats(texts).hint("shuffle_hash")
        judged = texts.select("key", "copies", "text").join(found, "key", "left")
        judged = arrow_map(judged.select("key", "copies", "text", "found"), run, schema)
        judged = staged(judged if with_text else judged.drop("kept"), "suffix-judged", keep=True)
    nothing = hashlib.sha256(b"").hexdigest()
    zero = F.lit(0).cast("long")
    return rows.join(judged, "key", "left").select(
        "doc_id",
        *(F.coalesce(n, zero).alias(n) for n in ("n_bytes", "n_removed", "n_spans")),
        F.coalesce("kept_sha256", F.lit(nothing)).alias("kept_sha256"),
        *(["kept"] if with_text else []),
        *keep,
    )


def op5_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return without_repeats(table(spark, folder, "documents"))
