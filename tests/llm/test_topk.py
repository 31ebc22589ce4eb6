import math
import random

import duckdb

from fiscalake.llm import topk

LONG = 2**63


def brute(rows, k, every):
    kept = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(64.0 * x) for x in v):
            continue
        kept.append((i, [math.floor(64.0 * x) for x in v]))
    out = []
    for q, (query, vector) in enumerate(kept):
        if query % every == 0:
            scored = [(-sum(a * b for a, b in zip(vector, v)), i) for n, (i, v) in enumerate(kept) if n != q]
            scored = sorted((max(-(10**38) + 1, min(10**38 - 1, s)), i) for s, i in scored)
            out += [(query, n + 1, i, max(-LONG, min(LONG - 1, -s))) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_against_brute_force(spark):
    rng = random.Random(2)
    rows = [(i, [rng.choice([-0.5, 0.25, rng.uniform(-1, 1)]) for _ in range(8)]) for i in range(500)]
    rows += [(i, rows[i % 7][1]) for i in range(500, 560)]  # ties
    rows += [(600, None), (601, [1.0, None]), (602, [math.nan] * 8), (603, [math.inf] * 8), (604, []), (605, [0.5]), (None, [0.5] * 8)]
    rows += [rows[3], (20, [0.0] * 8), (620, [0.75] * 12)]
    df = spark.createDataFrame([(i, v, 0, 1) for i, v in rows], "vec_id long, embedding array<double>, v int, SCORE int")
    got = topk.top_k(df, k=5, every=20, queries_at_once=8, rows_at_once=100, block=16)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 20)


def test_large_values_and_small_tables(spark):
    schema = "vec_id long, embedding array<double>"
    rows = [(0, [2.0**24, 3.0]), (1, [2.0**22 + 1, 1.0]), (2, [2.0**22 + 2, -1.0])]
    got = topk.top_k(spark.createDataFrame(rows, schema), k=5)
    assert sorted(map(tuple, got.collect())) == brute(rows, 5, 20)
    assert topk.top_k(spark.createDataFrame([], schema)).collect() == []
    assert topk.top_k(spark.createDataFrame(rows[:1], schema)).collect() == []


def test_rows_that_share_an_id(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i % 90, [rng.choice([-1.0, 0.5, rng.uniform(-2, 2)]) for _ in range(6)]) for i in range(300)]
    rows += [(20, [0.0, 1.0]), (1, [1.0, 0.0]), (1, [5.0, 0.0]), rows[20], rows[20]]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, rows_at_once=50, queries_at_once=4, block=8)
    assert sorted(map(tuple, got.collect())) == brute(rows, 20, 20)
    df.where("size(embedding) = 6").write.parquet(str(tmp_path / "embeddings.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    twin = con.execute(topk.OP7_SQL).fetchall()
    got = topk.op7_topk(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(twin) == brute([r for r in rows if len(r[1]) == 6], 20, 20)


def test_scores_beyond_a_long(spark):
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([3, 12, 17, 30]) for _ in range(5)]) for i in range(120)]
    rows += [(200, [1e307] * 5), (220, [1e300] * 5), (240, [1e17, 1e17])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, k=7, every=10, rows_at_once=40, block=8)
    assert sorted(map(tuple, got.collect())) == brute(rows, 7, 10)
