"""Likelihood of texts under a subword lattice, and under plain word counts.

A public vocabulary of pieces, ranked by its own scores, defines all ways to spell a word.
Pieces are weighted by how often the training texts use them, smoothed towards the
vocabulary's scores. The probability of a word is the sum over all its segmentations: a
forward recursion in log space over the word's lattice. A text is its words and an end.

A word's probability does not depend on its text, so it is computed once per distinct
word. Words are counted in every task, met by hash bucket, scored there, and given back to
the texts: a head of frequent words of fixed size goes to all tasks, all others travel as
packed (word, text) postings to the bucket that has their scores. No table that grows with
the corpus is broadcast or held whole by a task.
"""

from __future__ import annotations

import math
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import scratch
from .common import Numbered, fold, pick, raw, shuffles, staged, table
from .distinct import Postings

HEAD = 1 << 17  # words whose scores go to all tasks
DISTINCT = 400_000  # words a task counts before it passes them on
ADD = 0.1  # to each count of the plain word model
PRIOR = 1000.0  # pieces' worth of trust in the vocabulary's own scores
PART = 33  # row numbers have the number of their stretch of input above this bit
END = b""  # the end of a text; no word is empty


def code_of(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


# --- the lattice --------------------------------------------------------------------------


@cache
def vocabulary(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


class Lattice:
    """Log probabilities of words: ``counts`` are uses of the vocabulary's pieces by id."""

    def __init__(self, path: str, counts: dict[int, int]):
        model = vocabulary(path)
        size = model.get_piece_size()
        plain = [i for i in range(size) if not model.is_control(i) and not model.is_unknown(i)]
        end = model.eos_id()
        # Existing scores fall with the rank of a piece; a prior falls with the rank, too.
        rank = {i: k for k, i in enumerate(sorted([*plain, end], key=lambda i: (-model.get_score(i), i)), 1)}
        mass = sum(1 / k for k in rank.values())
        total = sum(counts.get(i, 0) for i in rank) + PRIOR
        log = {i: math.log((counts.get(i, 0) + PRIOR / k / mass) / total) for i, k in rank.items()}
        self.end = log[end]
        self.pieces = {model.id_to_piece(i): log[i] for i in plain if not model.is_byte(i)}
        self.bytes = {int(model.id_to_piece(i)[3:5], 16): log[i] for i in plain if model.is_byte(i)}
        self.starts = {p[:k] for p in self.pieces for k in range(1, len(p) + 1)}

    def word(self, word: bytes) -> float:
        """log of the sum over all segmentations of a word; of the end for the end."""
        if word == END:
            return self.end
        text = "▁" + word.decode()
        n, pieces, starts = len(text), self.pieces, self.starts
        forward = [-math.inf] * (n + 1)
        forward[0] = 0.0
        for i in range(n):
            here = forward[i]
            edges = []
            for j in range(i + 1, n + 1):
                part = text[i:j]
                if part not in starts:
                    break
                if part in pieces:
                    edges.append((j, pieces[part]))
            if not edges or edges[0][0] > i + 1:  # a character that is no piece: its bytes
                edges.append((i + 1, sum(self.bytes[b] for b in text[i].encode())))
            for j, cost in edges:
                x, y = here + cost, forward[j]
                forward[j] = x if y == -math.inf else max(x, y) + math.log1p(math.exp(-abs(x - y)))
        return forward[n]


# --- counting -----------------------------------------------------------------------------

COUNTED = "bucket int, codes binary, counts binary, words binary"
SCORED = "bucket int, codes binary, known binary, base binary, lattice binary, head binary"


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _bucket(codes: np.ndarray, buckets: int) -> np.ndarray:
    return (codes >> np.uint64(20)) % np.uint64(buckets)  # as Postings has it


def _packed(counts: dict[bytes, int], buckets: int):
    """One row per bucket: codes in order, counts, and the words, blanks between them."""
    words = list(counts)
    codes = np.fromiter(map(code_of, words), np.uint64, len(words))
    number = np.fromiter(counts.values(), np.int64, len(words))
    bucket = _bucket(codes, buckets)
    order = np.lexsort((codes, bucket))
    ends = np.flatnonzero(np.append(bucket[order][1:] != bucket[order][:-1], True)) + 1
    for a, b in zip(np.append(0, ends[:-1]), ends):
        own = order[a:b]
        yield pa.RecordBatch.from_pydict(
            {"bucket": [int(bucket[own[0]])], "codes": [codes[own].tobytes()], "counts": [number[own].tobytes()], "words": [b" ".join(words[i] for i in own)]},
            _arrow(COUNTED),
        )


def count_words(rows: DataFrame, buckets: int) -> DataFrame:
    """COUNTED, one row per bucket: the words of all ``rows`` (text, learn) and the end,
    counted where ``learn``; words of other rows alone have count 0."""

    def count(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text, learn in zip(raw(batch.column(0)), batch.column(1).to_pylist()):
                words = (text or b"").lower().split()
                words.append(END)
                if learn:
                    counts.update(words)
                else:
                    for w in words:
                        counts.setdefault(w, 0)
                if len(counts) > DISTINCT:
                    yield from _packed(counts, buckets)
                    counts = Counter()
        if counts:
            yield from _packed(counts, buckets)

    def merge(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for bucket, *cells in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(bucket, []).append(cells)
        for bucket in sorted(held):
            total: dict[bytes, int] = {}
            for _, counts, words in held.pop(bucket):
                for w, n in zip(words.split(b" "), np.frombuffer(counts, np.int64).tolist()):
                    total[w] = total.get(w, 0) + n
            for out in _packed(total, buckets):
                yield out

    return rows.mapInArrow(count, COUNTED).repartition(shuffles(rows.sparkSession), "bucket").mapInArrow(merge, COUNTED)


def count_pieces(counted: DataFrame, path: str) -> dict[int, int]:
    """Uses of each piece in the training words; at most as many as the vocabulary has."""

    def run(batches):
        model = vocabulary(path)
        total = np.zeros(model.get_piece_size(), np.int64)
        for batch in batches:
            for counts, words in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                number, words = np.frombuffer(counts, np.int64), words.split(b" ")
                learned = np.flatnonzero(number)
                for at in range(0, len(learned), 50_000):
                    part = learned[at : at + 50_000]
                    made = model.encode([words[i].decode() for i in part])
                    lengths = np.fromiter(map(len, made), np.int64, len(made))
                    ids = np.fromiter((p for m in made for p in m), np.int64, int(lengths.sum()))
                    total += np.bincount(ids, np.repeat(number[part], lengths), len(total)).astype(np.int64)
                if END in words:
                    total[model.eos_id()] += int(number[words.index(END)])
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"piece": used, "n": total[used]})

    rows = counted.select("counts", "words").mapInArrow(run, "piece long, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    return {r["piece"]: r["n"] for r in rows.collect()}


def score_words(counted: DataFrame, path: str, pieces: dict[int, int], n: int, distinct: int, buckets: int) -> DataFrame:
    """SCORED: for each bucket its words' codes in order, whether they were counted, their
    plain log10 and lattice log10 probabilities, and the places of its most frequent."""
    shared = counted.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        lattice = None
        for batch in batches:
            for bucket, codes, counts, words in zip(*(c.to_pylist() for c in batch.columns)):
                lattice = lattice or Lattice(path, shared.value)
                number = np.frombuffer(counts, np.int64)
                base = np.log10((number + ADD) / (n + ADD * (distinct + 1)))
                spelled = np.array([lattice.word(w) for w in words.split(b" ")]) / math.log(10)
                head = np.sort(np.argsort(-number, kind="stable")[: max(1, HEAD // buckets)]).astype(np.int64)
                yield pa.RecordBatch.from_pydict(
                    {"bucket": [bucket], "codes": [codes], "known": [(number > 0).tobytes()], "base": [base.tobytes()], "lattice": [spelled.tobytes()], "head": [head.tobytes()]},
                    _arrow(SCORED),
                )

    return counted.mapInArrow(run, SCORED)


def _frames(codes: bytes, known: bytes, base: bytes, lattice: bytes):
    return np.frombuffer(codes, np.uint64), np.frombuffer(known, bool), np.frombuffer(base, float), np.frombuffer(lattice, float)


def _head(scored: DataFrame):
    """Codes in order and values (known, plain, lattice) of the head; at most HEAD words."""

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                at = np.frombuffer(row["head"], np.int64)
                codes, *values = _frames(row["codes"], row["known"], row["base"], row["lattice"])
                yield pa.RecordBatch.from_pydict(
                    {"codes": [codes[at].tobytes()], "values": [np.stack([v[at].astype(float) for v in values], 1).tobytes()]},
                    _arrow("codes binary, values binary"),
                )

    got = scored.mapInArrow(run, "codes binary, values binary").collect()
    codes = np.concatenate([np.frombuffer(r["codes"], np.uint64) for r in got] or [np.empty(0, np.uint64)])
    values = np.concatenate([np.frombuffer(r["values"], float).reshape(-1, 3) for r in got] or [np.empty((0, 3))])
    order = np.argsort(codes)
    return codes[order], values[order]


# --- scoring ------------------------------------------------------------------------------


def log_likelihood(docs: DataFrame, path: str, learn, keep: dict | None = None) -> DataFrame:
    """Scores of all rows of ``docs`` (doc_id, text), learned from those where ``learn``, a
    condition on doc_id, holds: doc_id, the columns ``keep`` (name -> expression on
    doc_id), n_tokens, n_known (tokens met in training), train_tokens, base_score (log10
    probability under word counts plus 0.1) and score (log10 marginal probability under
    the lattice).

    A text's tokens are its words in lower case (A to Z) and one end. A null text is empty:
    the end alone. Whole texts count. With nothing to learn from, the vocabulary's own
    scores remain, and the plain model is uniform. Rows are scored each for itself, so
    repeated and null ids are no matter; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    buckets = shuffles(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = pick(docs, "doc_id", "text")

    def sums(batches):
        for batch in batches:
            all_counts = [np.frombuffer(c, np.int64) for c in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"n": [int(c.sum()) for c in all_counts], "v": [int((c > 0).sum()) for c in all_counts]})

    with scratch(spark):
        learned = rows.select("text", F.coalesce(learn, F.lit(False)).alias("learn"))
        counted = staged(count_words(learned, buckets), "lm-words")
        totals = counted.select("counts").mapInArrow(sums, "n long, v long").agg(F.sum("n"), F.sum("v")).first()
        n, distinct = int(totals[0] or 0), int(totals[1] or 0)
        pieces = count_pieces(counted, path)
        scored = staged(score_words(counted, path, pieces, n, distinct, buckets), "lm-scores", keep=True)
    head = spark.sparkContext.broadcast(_head(scored))

    made = "row long, n_tokens long, n_known long, base_score double, score double, bucket int, codes binary, base long, rows binary"
    schema = _arrow(made)

    def score(batches):
        head_codes, head_values = head.value
        codes_of, place_of = np.empty(0, np.uint64), np.empty(0, np.int64)
        words, out = Numbered(DISTINCT), Postings(buckets)

        def with_ids(columns, ids):
            cells = [pa.array(columns[f.name], f.type) for f in schema]
            return pa.RecordBatch.from_arrays([*cells, ids], [*schema.names, "doc_id"])

        def tail(kind):
            for blob in out.flush():
                yield with_ids({f.name: blob.get(f.name, [None]) for f in schema}, pa.nulls(1, kind))

        id_kind = pa.null()
        for batch in batches:
            id_kind = batch.column(2).type
            columns: dict[str, list] = {f.name: [] for f in schema}
            for row, text in zip(batch.column(0).to_pylist(), raw(batch.column(1))):
                if len(words.ids) > words.limit:
                    words.make_room()
                    codes_of, place_of = codes_of[:0], place_of[:0]
                found = (text or b"").lower().split()
                found.append(END)
                numbers, new = words.number(found)
                if new:
                    codes = np.fromiter(map(code_of, new), np.uint64, len(new))
                    if len(head_codes):
                        at = np.minimum(np.searchsorted(head_codes, codes), len(head_codes) - 1)
                        at = np.where(head_codes[at] == codes, at, -1)
                    else:
                        at = np.full(len(codes), -1)
                    held = len(words.ids) - len(new)
                    if held + len(new) > len(codes_of):
                        grow = len(codes_of) + len(new)
                        codes_of = np.concatenate([codes_of, np.empty(grow, np.uint64)])
                        place_of = np.concatenate([place_of, np.empty(grow, np.int64)])
                    codes_of[held : held + len(new)], place_of[held : held + len(new)] = codes, at
                place = place_of[numbers]
                rare = place < 0
                known = head_values[place[~rare]].sum(0) if len(head_values) else np.zeros(3)
                if rare.any():
                    out.add(codes_of[numbers[rare]], row)
                for name, value in zip(columns, (row, len(found), int(known[0]), float(known[1]), float(known[2]), None, None, None, None)):
                    columns[name].append(value)
                if out.size > out.most:
                    yield from tail(id_kind)
            yield with_ids(columns, batch.column(2))
        yield from tail(id_kind)

    numbered = rows.select(F.monotonically_increasing_id().alias("row"), "text", "doc_id")
    # Row numbers must stay what they are: they are written with what refers to them.
    ids = staged(numbered.mapInArrow(score, f"{made}, doc_id {kind}"), "lm-texts")
    rare = ids.where(F.col("bucket").isNotNull()).select("bucket", "codes", "base", "rows")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        codes, rows_ = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
        for c, base, r in zip(*(left[n].to_pylist() for n in ("codes", "base", "rows"))):
            c = np.frombuffer(c, np.uint64)
            codes.append(c)
            rows_.append(np.frombuffer(r, np.uint32 if len(r) == 4 * len(c) else np.uint64).astype(np.int64) + base)
        codes, rows_ = np.concatenate(codes), np.concatenate(rows_)
        out: dict[str, list] = {n: [] for n in ("part", "rows", "sums")}
        if len(codes):
            of, *values = _frames(*(right[n].to_pylist()[0] for n in ("codes", "known", "base", "lattice")))
            at = np.searchsorted(of, codes)
            found, inverse = np.unique(rows_, return_inverse=True)
            sums = np.stack([np.bincount(inverse, v[at], len(found)) for v in values], 1)
            part = found >> PART
            ends = np.flatnonzero(np.append(part[1:] != part[:-1], True)) + 1
            for a, b in zip(np.append(0, ends[:-1]), ends):
                for name, value in zip(out, (int(part[a]), found[a:b].tobytes(), sums[a:b].tobytes())):
                    out[name].append(value)
        return pa.Table.from_pydict(out, _arrow("part long, rows binary, sums binary"))

    def add(table: pa.Table) -> pa.Table:
        rows_ = np.concatenate([np.frombuffer(x, np.int64) for x in table["rows"].to_pylist()])
        sums = np.concatenate([np.frombuffer(x, float).reshape(-1, 3) for x in table["sums"].to_pylist()])
        found, inverse = np.unique(rows_, return_inverse=True)
        total = [np.bincount(inverse, sums[:, i], len(found)) for i in range(3)]
        return pa.Table.from_pydict(
            {"row": found, "more_n_known": total[0].astype(np.int64), "more_base_score": total[1], "more_score": total[2]}
        )

    # Sums come back packed by the stretch of input their texts are from.
    parts = (
        rare.groupBy("bucket")
        .cogroup(scored.select("bucket", "codes", "known", "base", "lattice").groupBy("bucket"))
        .applyInArrow(meet, "part long, rows binary, sums binary")
    )
    names = ("n_known", "base_score", "score")
    more = parts.groupBy("part").applyInArrow(add, "row long, more_n_known long, more_base_score double, more_score double")
    whole = ids.where(F.col("bucket").isNull()).join(more, "row", "left")
    return whole.select(
        "doc_id",
        *(e.alias(name) for name, e in (keep or {}).items()),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_n_known", F.lit(0).cast("long"))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0.0))).alias(c) for c in names[1:]),
    )


def op8_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    rest = fold(F.col("doc_id"), 10)
    held_out = {"held_out": F.coalesce(rest == 0, F.lit(False))}
    return log_likelihood(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"), rest != 0, held_out)
