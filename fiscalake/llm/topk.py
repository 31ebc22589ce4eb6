"""Exact top-k inner products with pruning of document blocks.

Vectors become whole numbers. Rows are dealt into groups and the queries into sets, both
by hash and both of bounded expected size; a task gets one set and one group. The k-th score
that a query finds in a first group is a floor for it in all the others. In a task the
group is cut into document-range blocks that keep the largest and smallest value of each
component (the terms' maxima for positive and negative weights). For each query the
blocks are ordered by the sum of those maxima; their rows (the forward index) are scored
from the best block on, until no block's bound reaches the k-th score found.

A score equal to the k-th may win by its smaller id, so only blocks whose bound is below
the k-th score are left out: results are exact. Sums run in double precision where that
is exact for the values at hand, else in whole numbers of any size.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pick, staged, table

LIMIT = 2**53  # whole numbers up to here, and sums of them, are exact in double precision
LONG = 2**63
MOST = 10**38 - 1  # scores are ranked as whole numbers of this size
RESULT = "n long, query_id long, row long, vec_id long, score string"


def quantised(vectors: DataFrame, scale: int = 64) -> DataFrame:
    """n, vec_id, v = floor(scale * x) in doubles, and ``largest``, its largest size. Rows
    with a null id, a null vector, or a component that is null or not finite once it is
    scaled are left out. ``n`` numbers the rows: those that share an id are rows of their own."""
    scaled = f"{scale}D * cast(x as double)"
    rows = pick(vectors, "vec_id", "embedding").where(
        F.col("vec_id").isNotNull()
        & F.col("embedding").isNotNull()
        & F.expr(f"forall(embedding, x -> x is not null and not isnan(x) and abs({scaled}) < double('infinity'))")
    )
    # From 2**53 on doubles are whole numbers, for which floor() would leave its range.
    values = F.expr(f"transform(embedding, x -> if(abs({scaled}) < {LIMIT}D, cast(floor({scaled}) as double), {scaled}))")
    kept = rows.select(F.monotonically_increasing_id().alias("n"), "vec_id", values.alias("v"))
    return kept.withColumn("largest", F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)))


def _matrix(values: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(values), width))
    for i, v in enumerate(values):
        out[i, : len(v)] = v
    return out


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


def search(queries: pd.DataFrame, rows: pd.DataFrame, k: int, block: int) -> pd.DataFrame:
    """Top k of ``rows`` (n, vec_id, v, largest) for each of ``queries``, which have a
    ``floor``, too: a score that k other rows reach, or none."""
    width = max([len(v) for v in [*queries["v"], *rows["v"]]], default=0)
    rows = rows.sort_values(["vec_id", "n"])
    numbers, ids = rows["n"].to_numpy(np.int64), rows["vec_id"].to_numpy(np.int64)
    docs, asked = _matrix(rows["v"], width), _matrix(queries["v"], width)
    largest = float(rows["largest"].max()) * float(queries["largest"].max()) * max(width, 1)
    kind = np.float64 if largest < LIMIT else object
    if kind is object:
        docs, asked = (np.vectorize(int, otypes=[object])(m) if m.size else m.astype(object) for m in (docs, asked))
    starts = np.arange(0, len(ids), block)
    top, low = np.maximum.reduceat(docs, starts), np.minimum.reduceat(docs, starts)
    bounds = np.maximum(asked, 0) @ top.T + np.minimum(asked, 0) @ low.T
    out = []
    for n, query, vector, bound, least in zip(queries["n"], queries["vec_id"], asked, bounds, queries["floor"]):
        order = np.argsort(-bound, kind="stable")
        found, scores, at, step = np.empty(0, np.int64), np.empty(0, kind), 0, 4
        floor = None if least is None else int(least)
        while at < len(order):
            taken = order[at : at + step]
            if len(found) == k:
                floor = scores[-1] if floor is None else max(floor, scores[-1])
            if floor is not None:
                taken = taken[bound[taken] >= floor]
                if not len(taken):
                    break  # the order is by bound: no later block reaches the k-th score either
            at, step = at + step, step * 2
            index = (starts[taken][:, None] + np.arange(block)).ravel()
            index = index[index < len(ids)]
            index = index[numbers[index] != n]
            new = docs[index] @ vector
            if kind is object:
                new = np.clip(new, -MOST, MOST)
            if floor is not None:
                keep = new >= floor
                index, new = index[keep], new[keep]
            found, scores = np.concatenate([found, index]), np.concatenate([scores, new])
            best = _best(ids[found], scores, k)
            found, scores = found[best], scores[best]
        out += [(n, query, numbers[i], ids[i], str(int(s))) for i, s in zip(found, scores)]
    return pd.DataFrame(out, columns=["n", "query_id", "row", "vec_id", "score"])


def top_k(
    vectors: DataFrame, k: int = 20, every: int = 20, scale: int = 64,
    queries_at_once: int = 2048, rows_at_once: int = 16384, block: int = 128,
) -> DataFrame:
    """For each vector whose id is divisible by ``every``: the ``k`` other vectors with the
    highest inner product, ties to the smaller id. Returns query_id, rank, vec_id, score.

    ``vectors`` holds vec_id and embedding; see ``quantised`` for rows without a part. A
    vector shorter than the other counts as padded with zeros. Rows that share an id are
    rows of their own: each is a candidate, and as a query each has its own ranks. Scores
    beyond a long are returned as the nearest long but ranked exactly, up to 38 digits,
    beyond which they are equal. An empty table, or a query alone in its table, gives no
    rows. ``queries_at_once`` and ``rows_at_once`` bound the expected share of a task,
    whatever the size of the table.
    """
    whole = staged(quantised(vectors, scale), "topk-vectors")
    asked = whole.where(F.col("vec_id") % every == 0)
    sizes = whole.select(F.count("*"), F.count(F.when(F.col("vec_id") % every == 0, 1))).first()
    groups, sets = max(1, math.ceil(sizes[0] / rows_at_once)), max(1, math.ceil(sizes[1] / queries_at_once))
    dealt = lambda n, salt: F.pmod(F.xxhash64("n", F.lit(salt)), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    right = whole.select(*(F.col(c).alias(c) for c in whole.columns), dealt(groups, 2).alias("part"), each(sets).alias("set"))
    left = asked.select("*", dealt(sets, 1).alias("set"), each(groups).alias("part"))

    def task(queries: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(rows) or not len(queries):
            return pd.DataFrame(columns=["n", "query_id", "row", "vec_id", "score"])
        return search(queries, rows, k, block)

    def searched(some: DataFrame, of: DataFrame) -> DataFrame:
        found = some.groupBy("set", "part").cogroup(of.groupBy("set", "part")).applyInPandas(task, RESULT)
        return found.withColumn("score", F.col("score").cast("decimal(38,0)"))

    # Each set meets one group first; the k-th score there is a floor in all the others.
    own = F.col("part") == F.pmod(F.col("set"), F.lit(groups))
    first = searched(left.where(own).withColumn("floor", F.lit(None).cast("string")), right.where(own))
    if groups > 1:
        first = staged(first, "topk-first")
        lowest = first.groupBy("n").agg(F.count("*").alias("_k"), F.min("score").cast("string").alias("floor"))
        floors = lowest.where(F.col("_k") >= k).select("n", "floor")
        later = searched(left.where(~own).join(floors, "n", "left"), right.where(~own))
        first = first.unionByName(later)
    order = Window.partitionBy("n").orderBy(F.desc("score"), "vec_id", "row")
    best = first.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    held = F.greatest(F.least("score", F.lit(LONG - 1)), F.lit(-LONG)).cast("long")
    return best.select("query_id", "rank", "vec_id", held.alias("score"))


def op7_topk(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"))


OP7_SQL = """
WITH whole AS (
    SELECT row_number() OVER (ORDER BY vec_id) AS n, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.n AS n, q.vec_id AS query_id, d.n AS row, d.vec_id AS vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
    FROM whole q JOIN whole d ON q.vec_id % 20 = 0 AND q.n <> d.n
)
SELECT query_id, row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id, row)::INTEGER AS rank, vec_id, score
FROM scored
QUALIFY row_number() OVER (PARTITION BY n ORDER BY score DESC, vec_id, row) <= 20
"""
