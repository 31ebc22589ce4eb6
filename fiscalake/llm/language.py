"""Language identification: multinomial logistic regression on hashed character n-grams.

A text is a row of letters, each run of anything else one boundary; its features are the
n-grams of one to three of these, weighted by their share of the text and the inverse
document frequency. Weights are learned with follow-the-regularised-leader steps under an
elastic net, which leaves most of them zero, and the scores are calibrated by one
temperature on rows kept out of the training. All training rows are dealt at random to
groups of bounded size; each group is learned by one task, and the model is their mean.
"""

from __future__ import annotations

import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import scratch
from .common import arrow_map, in_fold, out_of_fold, pick, staged, table

UNKNOWN = "und"
BITS = 17  # features are hashed to 2**BITS places
BLOCK = 1 << 13  # places whose weights are averaged in one go
SCALE = 40.0  # brings weighted shares to the size that the step length is made for


class Settings(NamedTuple):
    """``sample`` is the number of training rows that are learned in one group, up to
    chance. ``languages``: at most so many are learned, the most frequent."""

    sample: int = 8000
    languages: int = 1000
    epochs: int = 3
    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    calibration: int = 5  # every so many-th training row only calibrates


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # places x languages, with the inverse document frequency in
    bias: np.ndarray
    temperature: float
    texts: tuple[int, ...]  # of each language, that it was learned from


def _letters() -> np.ndarray:
    return np.array([p if chr(p).isalpha() else 0 for p in range(0x3000)], np.uint32)


LETTERS = _letters()


def symbols(text: str) -> np.ndarray:
    """Code points of the lower-case letters, each run of others one 0, with 0 at both ends."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    low = points < len(LETTERS)
    if low.all():
        codes = LETTERS[points]
    else:
        codes = np.where(low, LETTERS[np.where(low, points, 0)], 0)
        for i in np.flatnonzero(~low):
            codes[i] = points[i] if chr(points[i]).isalpha() else 0
    codes = np.concatenate([[0], codes, [0]]).astype(np.uint64)
    return codes[np.concatenate([[True], (codes[1:] != 0) | (codes[:-1] != 0)])]


def places(codes: np.ndarray) -> np.ndarray:
    """Hashed places of all n-grams of one to three symbols."""
    a, b, c = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
    shift = np.uint64(64 - BITS)
    one = codes * a
    two = (one[:-1] ^ (codes[1:] * b)) * c
    three = (two[:-1] ^ (codes[2:] * a)) * b
    return np.concatenate([one[codes != 0] * c, two * a, three]) >> shift


def features(text: str | None) -> np.ndarray | None:
    """Places of a text's n-grams, with repeats; None for a text without letters."""
    codes = symbols(text) if text else np.zeros(0)
    return places(codes) if codes.any() else None


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max())
    return e / e.sum()


def train(texts: list[str], labels: list[str], s: Settings = Settings()) -> Model | None:
    """Learn from texts with labels; texts without letters are left out, None if all are."""
    seen, df = [], np.zeros(2**BITS)
    for t, y in zip(texts, labels):
        f = features(t)
        if f is not None:
            index, counts = np.unique(f, return_counts=True)
            df[index.astype(np.int64)] += 1
            seen.append((index.astype(np.int32), (counts * (SCALE / len(f))).astype(np.float32), y))
    if not seen:
        return None
    languages = sorted({y for _, _, y in seen})
    place = {y: i for i, y in enumerate(languages)}
    rows = [(index, share, place[y]) for index, share, y in seen]
    idf = np.log((1 + len(rows)) / (1 + df)) + 1
    k = len(languages)
    kept = [r for i, r in enumerate(rows) if i % s.calibration] or rows
    z, n = np.zeros((2**BITS + 1, k)), np.zeros((2**BITS + 1, k))
    bias = 2**BITS

    def weights(index):
        zi, ni = z[index], n[index]
        return np.where(np.abs(zi) <= s.l1, 0, -(zi - np.sign(zi) * s.l1) / ((s.beta + np.sqrt(ni)) / s.alpha + s.l2))

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for r in order.permutation(len(kept)):
            index, share, y = kept[r]
            index = np.append(index, bias)
            x = np.append(share * idf[index[:-1]], 1.0)
            w = weights(index)
            p = _softmax(x @ w)
            p[y] -= 1
            g = x[:, None] * p
            ni = n[index]
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / s.alpha
            z[index] += g - step * w
            n[index] = ni + g * g
    w = weights(np.arange(2**BITS + 1))
    held = [r for i, r in enumerate(rows) if i % s.calibration == 0]
    logits = [((share * idf[index]) @ w[index] + w[bias], y) for index, share, y in held]

    def loss(log_t: float) -> float:
        return -sum(math.log(max(_softmax(x / math.exp(log_t))[y], 1e-300)) for x, y in logits)

    low, high, ratio = -3.0, 3.0, (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    texts = tuple(sum(y == i for _, _, y in rows) for i in range(k))
    return Model(languages, (w[:-1] * idf[:, None]).astype(np.float32), w[-1], math.exp((low + high) / 2), texts)


def predict(text: str | None, model: Model | None) -> tuple[str, float]:
    """Language and its calibrated probability; ``und`` and 0 without letters or model."""
    f = features(text) if model else None
    if f is None:
        return UNKNOWN, 0.0
    logits = model.weights[f.astype(np.int64)].sum(0, dtype=np.float64) * (SCALE / len(f)) + model.bias
    p = _softmax(logits / model.temperature)
    best = int(np.argmax(p))
    return model.languages[best], float(p[best])


def fit(rows: DataFrame, settings: Settings = Settings()) -> Model | None:
    """A model from all ``rows`` (doc_id, text, lang) with none of these null. They are dealt
    to groups by a hash of the id, those of a language with few rows to several groups, so
    that it is no rarer there than its size asks for. A group is one task's; only the mean
    weights reach the driver, at most 2**BITS for each language. A language's weights are
    the mean over the groups that have it, by its texts there."""
    rows = pick(rows, "doc_id", "text", "lang").where(
        F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    counts = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(settings.languages)
    sizes = sorted(map(tuple, counts.collect()))
    if not sizes:
        return None
    total = sum(size for _, size in sizes)
    groups = -(-total // settings.sample)
    # A language smaller than the mean one is given out as often as brings it there.
    times = [(name, max(1, min(groups, total // (len(sizes) * size)))) for name, size in sizes]
    groups = max(groups, -(-sum(n * size for (_, n), (_, size) in zip(times, sizes)) // settings.sample))
    spark = rows.sparkSession
    dealt = spark.createDataFrame(times, "lang string, times long")
    turn = F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).alias("turn")
    at = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(groups)) + F.floor(F.col("turn") * groups / F.col("times"))
    each = rows.join(F.broadcast(dealt), "lang").select("doc_id", "lang", "text", "times", turn)
    each = each.select("doc_id", "lang", "text", F.pmod(at, F.lit(groups)).alias("group")).repartition(groups, "group")
    names = [name for name, _ in sizes]

    def learn(table: pa.Table) -> pa.Table:
        data = sorted(zip(*(table[c].to_pylist() for c in ("doc_id", "lang", "text"))))
        model = train([t for _, _, t in data], [y for _, y, _ in data], settings)
        out = {"group": [], "block": [], "n": [], "w": []}
        if model:
            own = [names.index(y) for y in model.languages]
            n, bias = np.zeros(len(names), np.int64), np.zeros(len(names))
            n[own], bias[own] = model.texts, model.bias
            parts = [np.append(bias, model.temperature)]
            for low in range(0, 2**BITS, BLOCK):
                parts.append(np.zeros((BLOCK, len(names))))
                parts[-1][:, own] = model.weights[low : low + BLOCK]
            for block, w in enumerate(parts, -1):
                if block < 0 or w.any():
                    out["block"].append(block)
                    out["w"].append(pa.compress(w.tobytes(), "zstd", asbytes=True))
            out["group"], out["n"] = [table["group"][0].as_py()] * len(out["w"]), [n.tolist()] * len(out["w"])
        kinds = [("group", pa.int64()), ("block", pa.int64()), ("n", pa.list_(pa.int64())), ("w", pa.binary())]
        return pa.Table.from_pydict(out, pa.schema(kinds))

    with scratch(spark):
        kinds = "group long, block long, n array<long>, w binary"
        learned = staged(each.groupBy("group").applyInArrow(learn, kinds), "lang-learned")
        head = learned.where("block < 0").select("group", "n").collect()
        if not head:
            return None
        # Texts of each language over all groups: blocks without weights are left out.
        texts = np.sum([r["n"] for r in head], axis=0)

        def mean(table: pa.Table) -> pa.Table:
            block, k, out = table["block"][0].as_py(), len(names), 0.0
            for _, n, w in sorted(zip(*(table[c].to_pylist() for c in ("group", "n", "w")))):
                share = np.array(n) / np.maximum(texts, 1)
                size = 8 * (k + 1 if block < 0 else BLOCK * k)
                w = np.frombuffer(pa.decompress(w, size, "zstd", asbytes=True))
                out = out + (w * np.append(share, sum(n) / texts.sum()) if block < 0 else w.reshape(-1, k) * share)
            w = out if block < 0 else out.astype(np.float32)
            return pa.table({"block": [block], "w": [pa.compress(w.tobytes(), "zstd", asbytes=True)]})

        got = learned.groupBy("block").applyInArrow(mean, "block long, w binary").collect()
    weights, last = np.zeros((2**BITS, len(names)), np.float32), np.zeros(0)
    for block, w in got:
        if block < 0:
            last = np.frombuffer(pa.decompress(w, 8 * (len(names) + 1), "zstd", asbytes=True))
        else:
            own = np.frombuffer(pa.decompress(w, 4 * BLOCK * len(names), "zstd", asbytes=True), np.float32)
            weights[block * BLOCK : (block + 1) * BLOCK] = own.reshape(-1, len(names))
    seen = np.flatnonzero(texts)
    return Model([names[i] for i in seen], weights[:, seen], last[:-1][seen], float(last[-1]), tuple(texts[seen].tolist()))


def identify(docs: DataFrame, model: Model | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, the columns to ``keep``, lang_pred and score for every row of ``docs``
    (doc_id, text), in any number of tasks. Null, empty and letterless texts are ``und`` with score 0, as is every text
    when there was nothing to learn from. Texts of any length count whole."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = pick(docs, "doc_id", "text", *(k for k in keep if k not in ("doc_id", "text")))
    names = ["doc_id", *(k for k in keep if k != "doc_id")]
    kinds = [f"{n} {rows.schema[n].dataType.simpleString()}" for n in names]

    def run(batch: pa.RecordBatch):
        found = [predict(t, shared.value) for t in batch.column("text").to_pylist()]
        kept = {n: batch.column(n) for n in names}
        yield kept | {"lang_pred": [x for x, _ in found], "score": [x for _, x in found]}

    return arrow_map(rows, run, ", ".join([*kinds, "lang_pred string", "score double"]))


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = pick(table(spark, folder, "documents"), "doc_id", "text", "lang")
    model = fit(docs.where(out_of_fold(F.col("doc_id"), 3, 1)))
    return identify(docs, model).select("doc_id", in_fold(F.col("doc_id"), 3, 1).alias("held_out"), "lang_pred", "score")
