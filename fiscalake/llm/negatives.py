"""Hard negatives: rows of another label whose score lies in a window below a positive's.

A row's score is its inner product with an anchor, in whole numbers. Every row stores its
norm and its angles to some reference directions. By the triangle inequality for angles,
the angle between an anchor and a row is at least the difference of their angles to a
reference and at most their sum (or what is left of a full turn), so each reference gives
an interval of cosines; the intervals meet, times both norms they bound the score. The
bounds are widened by more than rounding can take from them. Only rows whose bounds overlap
the scores asked for are scored: for positives, those that can reach the lowest of the best
found so far; for negatives, those that can lie in a positive's window and reach the last
of its best there. Bounds of whole blocks of rows, which hold rows of similar angles, come
before those of single rows.

Rows are dealt into groups and anchors into sets, both by hash and both of bounded expected
size; a task gets one set and one group, and the best of all groups are joined by rank.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..staging import scratch
from .common import pick, staged, table

REFERENCES = 8
LIMIT = 2**53  # whole numbers up to here, and sums of them, are exact in double precision
BLOCK = 64
LONG = 2**63
MOST = 10**38 - 1  # scores are ranked as whole numbers of this size


class Options:
    """How many positives and negatives, the window in hundredths of a positive's score,
    and the bounds of a task."""

    def __init__(self, positives=5, negatives=10, low=30, high=90, every=100, anchors_at_once=2048, rows_at_once=16384):
        self.positives, self.negatives, self.low, self.high, self.every = positives, negatives, low, high, every
        self.anchors_at_once, self.rows_at_once = anchors_at_once, rows_at_once


def quantised(vectors: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """n, vec_id, label, v = floor(scale * x) in doubles, and ``largest``, its largest size.
    Rows with a null id, label or vector, or a component that is null or not finite once
    it is scaled, take no part. ``n`` numbers the rows."""
    scaled = f"{scale}D * cast(x as double)"
    rows = pick(vectors, "vec_id", "embedding", "label").where(
        F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & label.isNotNull()
        & F.expr(f"forall(embedding, x -> x is not null and not isnan(x) and abs({scaled}) < double('infinity'))")
    )
    # From 2**53 on doubles are whole numbers, for which floor() would leave its range.
    values = F.expr(f"transform(embedding, x -> if(abs({scaled}) < {LIMIT}D, cast(floor({scaled}) as double), {scaled}))")
    kept = rows.select(F.monotonically_increasing_id().alias("n"), "vec_id", label.cast("long").alias("label"), values.alias("v"))
    return kept.withColumn("largest", F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)))


# --- bounds -------------------------------------------------------------------------------


def references(width: int, count: int = REFERENCES) -> np.ndarray:
    """Unit vectors, the same for each number of components."""
    made = np.random.default_rng(width).standard_normal((count, max(width, 1)))
    return made / np.linalg.norm(made, axis=1, keepdims=True)


class Rows:
    """Rows as numbers, with their norms and angles to the references."""

    def __init__(self, rows: pd.DataFrame, width: int):
        self.n, self.ids, self.labels = (rows[c].to_numpy(np.int64) for c in ("n", "vec_id", "label"))
        self.values = np.zeros((len(rows), width))
        for i, v in enumerate(rows["v"]):
            self.values[i, : len(v)] = v
        # Scaled by each row's largest component, so that no square leaves the doubles.
        top = np.abs(self.values).max(axis=1, initial=0.0)
        unit = self.values / np.where(top > 0, top, 1)[:, None]
        length = np.sqrt((unit * unit).sum(axis=1))
        self.norms = top * length
        unit = unit / np.where(length > 0, length, 1)[:, None]
        self.angles = np.arccos(np.clip(unit @ references(width).T, -1, 1))

    def take(self, order: np.ndarray) -> None:
        for name in ("n", "ids", "labels", "values", "norms", "angles"):
            setattr(self, name, getattr(self, name)[order])


# Rounding moves a cosine by some 1e-15 times the number of components, an angle by its
# square root at worst (near 0 and a half turn); both are far below these.
ANGLE, SHARE = 1e-6, 1e-9


def cosines(low: np.ndarray, high: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of the cosines between vectors with angles ``at`` to the references (last
    axis) and all those whose angles lie from ``low`` to ``high``."""
    least = np.maximum(np.maximum(low - at, at - high), 0).max(axis=-1)
    # The sum of the angles grows up to half a turn and what is left of a turn falls after.
    most = np.minimum(np.minimum(high + at, 2 * np.pi - low - at), np.pi).min(axis=-1)
    return np.cos(np.minimum(most + ANGLE, np.pi)), np.cos(np.maximum(least - ANGLE, 0))


def scores(low: np.ndarray, high: np.ndarray, small: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of scores out of bounds of cosines and of the product of the norms."""
    bottom = np.minimum(low * small, low * large)
    top = np.maximum(high * small, high * large)
    slack = SHARE * large + 1e-9
    return bottom - slack, top + slack


class Group:
    """Rows of one task, in blocks of similar angles, and the scoring of what may count."""

    def __init__(self, rows: Rows, exact: type):
        # Rows near the same reference, in the order of their angle to it, share a block.
        near = rows.angles.argmin(axis=1)
        rows.take(np.lexsort((rows.ids, rows.angles[np.arange(len(near)), near], near)))
        self.rows = rows
        self.whole = np.vectorize(int, otypes=[object])(rows.values) if exact is object else rows.values
        starts = np.arange(0, len(rows.n), BLOCK)
        self.starts = starts
        if len(starts):
            self.low, self.high = np.minimum.reduceat(rows.angles, starts), np.maximum.reduceat(rows.angles, starts)
            self.small, self.large = np.minimum.reduceat(rows.norms, starts), np.maximum.reduceat(rows.norms, starts)

    def blocks(self, angles: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        low, high = cosines(self.low, self.high, angles)
        return scores(low, high, self.small * norm, self.large * norm)

    def score(self, index: np.ndarray, vector: np.ndarray) -> np.ndarray:
        out = self.whole[index] @ vector
        return out if out.dtype != object else np.clip(out, -MOST, MOST)

    def inside(self, blocks: np.ndarray) -> np.ndarray:
        index = (self.starts[blocks][:, None] + np.arange(BLOCK)).ravel()
        return index[index < len(self.rows.n)]

    def bounds(self, index: np.ndarray, angles: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray]:
        own = self.rows.angles[index]
        low, high = cosines(own, own, angles)
        size = self.rows.norms[index] * norm
        return scores(low, high, size, size)


def _first(ids: np.ndarray, values: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest values, ties to the smaller id."""
    return np.lexsort((ids, -values))[:k]


def positives_of(group: Group, of: Rows, i: int, vector: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``k`` rows of the anchor's label in the group: their places and scores."""
    rows, norm, angles = group.rows, of.norms[i], of.angles[i]
    _, top = group.blocks(angles, norm)
    order = np.argsort(-top, kind="stable")
    found, known, at, step = np.empty(0, np.int64), np.empty(0, vector.dtype), 0, 4
    while at < len(order):
        taken = order[at : at + step]
        floor = known[-1] if len(known) == k else None
        if floor is not None:
            taken = taken[top[taken] >= float(floor)]
            if not len(taken):
                break
        at, step = at + step, step * 2
        index = group.inside(taken)
        index = index[(rows.labels[index] == of.labels[i]) & (rows.n[index] != of.n[i])]
        if floor is not None:
            index = index[group.bounds(index, angles, norm)[1] >= float(floor)]
        found, known = np.concatenate([found, index]), np.concatenate([known, group.score(index, vector)])
        best = _first(rows.ids[found], known, k)
        found, known = found[best], known[best]
    return found, known


def negatives_of(group: Group, of: Rows, i: int, vector: np.ndarray, positive: list, options: Options) -> list[tuple]:
    """(place in ``positive``, places, scores) of the first negatives in each window."""
    rows, norm, angles = group.rows, of.norms[i], of.angles[i]
    bottom, top = group.blocks(angles, norm)
    windows = [(options.low * p, options.high * p) for p in positive]
    asked = [w for w, (a, b) in enumerate(windows) if a <= b]
    if not asked:
        return []
    least, most = min(windows[w][0] for w in asked), max(windows[w][1] for w in asked)
    best = {w: (np.empty(0, np.int64), np.empty(0, vector.dtype)) for w in asked}
    overlap = np.flatnonzero((100 * top >= float(least)) & (100 * bottom <= float(most)))
    # Blocks that reach far into the windows first; what can no longer count is left out.
    order, at, step = overlap[np.argsort(-top[overlap], kind="stable")], 0, 8
    while at < len(order):
        full = [best[w][1][-1] for w in asked if len(best[w][1]) == options.negatives]
        floor = float(min(full)) if len(full) == len(asked) else None
        taken = order[at : at + step]
        if floor is not None:
            taken = taken[top[taken] >= floor]
            if not len(taken):
                break
        at, step = at + step, step * 2
        index = group.inside(taken)
        index = index[rows.labels[index] != of.labels[i]]
        low, high = group.bounds(index, angles, norm)
        some = (100 * high >= float(least)) & (100 * low <= float(most))
        index = index[some if floor is None else some & (high >= floor)]
        if not len(index):
            continue
        new = group.score(index, vector)
        for w in asked:
            a, b = windows[w]
            fits = (100 * new >= a) & (100 * new <= b)
            if fits.any():
                places = np.concatenate([best[w][0], index[fits]])
                values = np.concatenate([best[w][1], new[fits]])
                keep = _first(rows.ids[places], values, options.negatives)
                best[w] = places[keep], values[keep]
    return [(w, *best[w]) for w in asked if len(best[w][0])]


def _task(anchors: pd.DataFrame, rows: pd.DataFrame, work: Callable) -> list[tuple]:
    """``work`` for every anchor with the group of rows."""
    if not len(anchors) or not len(rows):
        return []
    width = max(max(map(len, anchors["v"])), max(map(len, rows["v"])))
    # 100 times a score must be exact, too.
    largest = float(anchors["largest"].max()) * float(rows["largest"].max()) * max(width, 1)
    exact = np.float64 if 100 * largest < LIMIT else object
    group, of = Group(Rows(rows, width), exact), Rows(anchors, width)
    out = []
    for i in range(len(anchors)):
        vector = of.values[i] if exact is np.float64 else np.array([int(x) for x in of.values[i]], object)
        out += work(group, of, i, vector)
    return out


# --- the search ---------------------------------------------------------------------------

FOUND = "n long, vec_id long, score decimal(38,0)"


def _dealt(left: DataFrame, right: DataFrame, options: Options) -> tuple:
    """Both sides grouped by set of anchors and group of rows."""
    sizes = right.count(), left.count()
    groups, sets = max(1, math.ceil(sizes[0] / options.rows_at_once)), max(1, math.ceil(sizes[1] / options.anchors_at_once))
    deal = lambda n, salt: F.pmod(F.xxhash64("n", F.lit(salt)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = left.select("*", deal(sets, 1).alias("set"), each(groups).alias("part"))
    # New columns: those that both sides share would be taken for the left side's.
    own = [F.col(c).alias(c) for c in right.columns]
    right = right.select(*own, deal(groups, 2).alias("part"), each(sets).alias("set"))
    return left.groupBy("set", "part").cogroup(right.groupBy("set", "part"))


def _written(score: object) -> str:
    return str(int(score))


def hard_negatives(vectors: DataFrame, label: Column, options: Options | None = None) -> DataFrame:
    """For each anchor, a row whose id is divisible by ``every``, and each of its first
    ``positives`` other rows of the same label: the first ``negatives`` rows of another
    label with low <= 100 * score / positive's score <= high.

    ``vectors`` holds vec_id, embedding and label; ``label`` gives the label that counts.
    See ``quantised`` for rows without a part; a shorter vector counts as padded with zeros.
    Higher scores come first, ties by the smaller id, then by the row's number. Rows that
    share an id are rows of their own, as anchors, too. A positive below zero has no
    window; one of score 0 has the rows of score 0. Scores beyond a long are returned as
    the nearest long but ranked exactly, up to 38 digits, beyond which they are equal. An empty table, or one without
    anchors, positives or negatives, gives no rows.

    Returns anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    options = options or Options()
    spark = vectors.sparkSession
    with scratch(spark):
        whole = staged(quantised(vectors, label), "negatives-vectors")
        anchors = whole.where(F.col("vec_id") % options.every == 0)

        def search_positives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            def work(group: Group, of: Rows, i: int, vector: np.ndarray) -> list[tuple]:
                at, known = positives_of(group, of, i, vector, options.positives)
                return [(of.n[i], group.rows.n[a], group.rows.ids[a], _written(s)) for a, s in zip(at, known)]

            return pd.DataFrame(_task(left, right, work), columns=["anchor", "n", "vec_id", "score"])

        digits = "anchor long, n long, vec_id long, score string"
        found = _dealt(anchors, whole, options).applyInPandas(search_positives, digits)
        found = found.withColumn("score", F.col("score").cast("decimal(38,0)"))
        order = Window.partitionBy("anchor").orderBy(F.desc("score"), "vec_id", "n")
        found = staged(found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= options.positives), "positives")
        asked = found.groupBy(F.col("anchor").alias("n")).agg(
            F.array_sort(F.collect_list(F.struct("place", F.col("score").cast("string").alias("score")))).alias("positive")
        )

        def search_negatives(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            positive = [[int(p["score"]) for p in ps] for ps in left["positive"]]

            def work(group: Group, of: Rows, i: int, vector: np.ndarray) -> list[tuple]:
                return [
                    (of.n[i], w + 1, group.rows.n[a], group.rows.ids[a], _written(s))
                    for w, at, known in negatives_of(group, of, i, vector, positive[i], options)
                    for a, s in zip(at, known)
                ]

            return pd.DataFrame(_task(left, right, work), columns=["anchor", "place", "n", "vec_id", "score"])

        both = _dealt(anchors.join(asked, "n"), whole, options)
        below = both.applyInPandas(search_negatives, "anchor long, place int, n long, vec_id long, score string")
        below = below.withColumn("score", F.col("score").cast("decimal(38,0)"))
        order = Window.partitionBy("anchor", "place").orderBy(F.desc("score"), "vec_id", "n")
        below = below.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= options.negatives)
        held = lambda c: F.greatest(F.least(F.col(c), F.lit(LONG - 1)), F.lit(-LONG)).cast("long")
        up = found.select("anchor", "place", F.col("vec_id").alias("positive_id"), held("score").alias("positive_score"))
        down = below.select("anchor", "place", "rank", F.col("vec_id").alias("negative_id"), held("score").alias("negative_score"))
        named = anchors.select(F.col("n").alias("anchor"), F.col("vec_id").alias("anchor_id"))
        result = down.join(up, ["anchor", "place"]).join(named, "anchor")
        return staged(
            result.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"),
            "negatives", keep=True,
        )


def op13_negatives(spark: SparkSession, folder: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings"), label)


OP13_SQL = """
WITH whole AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.n AS anchor, a.vec_id AS anchor_id, r.n, r.vec_id, r.label = a.label AS alike,
        list_inner_product(a.v, r.v)::BIGINT AS score
    FROM whole a JOIN whole r ON a.vec_id % 100 = 0 AND a.n <> r.n
), positive AS (
    SELECT anchor, anchor_id, n, vec_id, score
    FROM scored WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, n) <= 5
), ranked AS (
    SELECT p.anchor_id, p.vec_id AS positive_id,
        row_number() OVER (PARTITION BY p.anchor, p.n ORDER BY s.score DESC, s.vec_id, s.n)::INTEGER AS rank,
        s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score
    FROM positive p JOIN scored s ON s.anchor = p.anchor AND NOT s.alike
        AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
)
SELECT * FROM ranked WHERE rank <= 10
"""
