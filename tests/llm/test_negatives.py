import math
import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fiscalake.llm import negatives
from fiscalake.llm.negatives import Options

SCHEMA = "vec_id long, embedding array<double>, label int"
LONG = 2**63


def brute(rows, o):
    """The definition, over all pairs, in whole numbers."""
    kept = []
    for i, v, label in rows:
        if i is None or v is None or label is None or any(x is None or not math.isfinite(256.0 * x) for x in v):
            continue
        kept.append((i, [math.floor(256.0 * x) for x in v], label))
    held = lambda s: max(-LONG, min(LONG - 1, s))
    out = []
    for a, (anchor, v, label) in enumerate(kept):
        if anchor % o.every:
            continue
        scored = []
        for n, (i, w, other) in enumerate(kept):
            if n != a:
                s = sum(x * y for x, y in zip(v, w))
                scored.append((-max(-(10**38) + 1, min(10**38 - 1, s)), i, n, other))
        scored.sort()
        for s, i, _, _ in [r for r in scored if r[3] == label][: o.positives]:
            fits = [r for r in scored if r[3] != label and o.low * -s <= 100 * -r[0] <= o.high * -s]
            out += [(anchor, i, k + 1, r[1], held(-s), held(-r[0])) for k, r in enumerate(fits[: o.negatives])]
    return sorted(out)


def table(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    extra = {c: F.lit("extra") for c in ("n", "v", "set", "part", "score", "rank", "largest", "place")}
    return df.withColumns(extra).select("*", F.lit(1).alias("LABEL"), F.lit(2).alias("Vec_Id"))


def mine(spark, rows, o):
    got = negatives.hard_negatives(table(spark, rows), F.col("label"), o)
    return sorted(map(tuple, got.collect()))


def clustered(rng, n, width=12, near=0.3):
    heads = [[rng.gauss(0, 1) for _ in range(width)] for _ in range(6)]
    return [(i, [x * rng.choice([0.2, 1, 3]) + rng.gauss(0, near) for x in rng.choice(heads)], rng.randrange(4)) for i in range(n)]


def test_against_all_pairs(spark):
    rng = random.Random(3)
    rows = clustered(rng, 700)
    rows += [(i, rows[i % 9][1], i % 4) for i in range(700, 790)]  # equal vectors: ties
    rows += [(800, None, 1), (801, [1.0, None], 1), (802, [math.nan] * 12, 1), (803, [math.inf] * 12, 2), (804, [], 2)]
    rows += [(820, [0.5], 1), (None, [0.5] * 12, 0), (840, [0.25] * 12, None), (860, [0.0] * 12, 1), (880, [0.5] * 15, 2)]
    rows += [rows[20], (40, [1.0] * 12, 3), (41, [2.0] * 12, 3)]  # ids that are there twice
    rng.shuffle(rows)
    o = Options(every=20, anchors_at_once=16, rows_at_once=150)
    assert mine(spark, rows, o) == brute(rows, o)


def test_many_equal_rows(spark):
    rows = [(i, [1.0, 0.5, -0.25], i % 2) for i in range(300)] + [(300 + i, [0.5, 0.25, 0.1 * i], i % 2) for i in range(40)]
    o = Options(every=50, rows_at_once=64)
    assert mine(spark, rows, o) == brute(rows, o)


def test_large_values(spark):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) * 10.0 ** rng.choice([3, 9, 17, 30]) for _ in range(6)], i % 3) for i in range(120)]
    rows += [(200, [1e306] * 6, 1), (201, [1e300] * 6, 1)]
    o = Options(every=10)
    assert mine(spark, rows, o) == brute(rows, o)


@pytest.mark.parametrize("rows", [[], [(0, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 1)], [(0, [1.0], 1), (1, [1.0], 2)], [(1, [1.0], 1)]])
def test_small_tables(spark, rows):
    assert mine(spark, rows, Options()) == []


def test_bounds_hold_and_leave_rows_out(monkeypatch):
    rng = random.Random(5)
    rows = [v for _, v, _ in clustered(rng, 600)] + [[0.0] * 12, [1e-9] * 12, [-3.0] + [0.0] * 11, [3.0] + [0.0] * 11]
    frame = pd.DataFrame({"n": range(len(rows)), "vec_id": range(len(rows)), "label": 0, "v": rows})
    frame["v"] = [np.floor(256 * np.array(v)) for v in rows]
    group = negatives.Group(negatives.Rows(frame, 12), np.float64)
    whole, out = np.arange(len(rows)), []
    for i in range(0, len(rows), 7):
        norm, angles = group.rows.norms[i], group.rows.angles[i]
        real = group.whole @ group.whole[i]
        low, high = group.bounds(whole, angles, norm)
        assert (low <= real).all() and (real <= high).all()
        bottom, top = group.blocks(angles, norm)
        block = whole // negatives.BLOCK
        assert (bottom[block] <= low + 1e-6).all() and (high <= top[block] + 1e-6).all()
        out.append((high < 0.8 * norm**2).mean())
    assert np.mean(out) > 0.3

    # Far fewer rows are scored than there are pairs.
    scored, plain = [], negatives.Group.score
    monkeypatch.setattr(negatives.Group, "score", lambda self, index, v: scored.append(len(index)) or plain(self, index, v))
    of = negatives.Rows(frame, 12)
    for i in range(0, len(rows), 7):
        negatives.positives_of(group, of, i, of.values[i], 5)
    assert sum(scored) < 0.7 * len(rows) * len(range(0, len(rows), 7))


def test_query_against_sql(spark, tmp_path):
    rng = random.Random(6)
    rows = clustered(rng, 500, near=0.5) + [(500, None, 1), (501, [1.0] * 12, None), (503, [math.nan] * 12, 1)]
    rows += [rows[100], (200, [0.5] * 12, 1)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = negatives.op13_negatives(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    twin = con.execute(negatives.OP13_SQL)
    assert [c[0] for c in twin.description] == got.columns
    assert sorted(map(tuple, got.collect())) == sorted(twin.fetchall())
