from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fiscalake.llm import mixing

from .cases import documents, frame


def wanted(sizes):
    """Sources' targets by handing the excess on until nobody is above the cap."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    fixed, total = {}, 1.5 * sum(sizes.values())
    while True:
        rest = [s for s in names if s not in fixed]
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > 2 * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: 2 * sizes[s] for s in over}


def test_mixture(spark):
    rows = documents(size=120)
    df = frame(spark, rows)
    got = mixing.mix(df, levels=2, keep=("text", "source")).collect()
    assert len(got) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        assert r["size"] == len((r["text"] or "").encode().split())
        assert r["taken"] == r["size"] * len(r["shards"]) <= 2 * r["size"]
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    target = wanted(sizes)
    for r in got:
        assert r["target"] == pytest.approx(target[r["source"]]) and r["source_size"] == sizes[r["source"]]
    for s, t in target.items():
        largest = max(r["size"] for r in got if r["source"] == s)
        assert abs(taken[s] - t) <= largest
    assert {x["shard"] for r in got for x in r["shards"]} == {0, 1, 2, 3}
    again = mixing.mix(df.repartition(7), levels=2).select("doc_id", "taken").collect()
    assert sorted(map(repr, map(tuple, again))) == sorted(repr((r["doc_id"], r["taken"])) for r in got)


def test_no_documents_or_no_words(spark):
    df = frame(spark, [(1, None, None, None), (2, " ", None, "a")], clash=False)
    assert mixing.mix(df.limit(0)).collect() == []
    assert [(r["size"], r["taken"], r["target"]) for r in mixing.mix(df).collect()] == [(0, 0, 0.0)] * 2


def test_split_is_a_draw_without_replacement(spark):
    """Counts add up, never exceed what is there, and average to the share."""
    n = 400
    quotas = [7, 0, 30, 3]
    df = spark.range(n).select(F.array(*map(F.lit, quotas)).cast("array<long>").alias("q"), F.col("id"))
    left = [r[0] for r in df.select(mixing.split(F.col("id"), F.col("q"), F.lit(16), 3)).collect()]
    assert all(sum(x) == 16 and all(0 <= a <= q for a, q in zip(x, quotas)) for x in left)
    means = [sum(x[i] for x in left) / n for i in range(4)]
    assert means == pytest.approx([16 * q / 40 for q in quotas], abs=0.4)
    p = 7 / 40
    variance = sum((x[0] - means[0]) ** 2 for x in left) / n
    assert variance == pytest.approx(16 * p * (1 - p) * 24 / 39, rel=0.3)
