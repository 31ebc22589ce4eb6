import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from fiscalake.llm import manifest
from fiscalake.llm.manifest import Shape

from .cases import documents, frame


def sha(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def grown(nodes, fanout):
    """All levels over some nodes, plainly."""
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + fanout]) for i in range(0, len(out[-1]), fanout)])
    return out


def way(tree, at, fanout):
    out = []
    for level in tree[:-1]:
        run = range(at - at % fanout, min(len(level), at - at % fanout + fanout))
        out += [level[i] for i in run if i != at]
        at //= fanout
    return out


def brute(rows, fanout):
    """(doc_id, leaf, subroot, root, proof) of (doc_id, source, leaf) rows."""
    sources = {}
    for i, source, leaf in rows:
        sources.setdefault(source, []).append((i is not None, i or 0, leaf, i))
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: grown([leaf for _, _, leaf, _ in sorted(sources[s], key=lambda r: r[:3])], fanout) for s in names}
    top = grown([trees[s][-1][0] for s in names], fanout) if names else []
    out = []
    for k, s in enumerate(names):
        for at, (_, _, leaf, i) in enumerate(sorted(sources[s], key=lambda r: r[:3])):
            out.append((i, leaf, trees[s][-1][0], top[-1][0], way(trees[s], at, fanout) + way(top, k, fanout)))
    return out


def leaves(sizes, seed=1):
    rng = random.Random(seed)
    rows = [(i, s, sha(s or "-", str(i))) for s, n in sizes.items() for i in rng.sample(range(10 * n), n)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("shape", [Shape(3, 1), Shape(2, 1), Shape(3, 0), Shape(4, 2), Shape()])
def test_proofs_against_whole_trees(spark, shape):
    sizes = {"hot": 131, "a": 1, "b": 2, "c": 3, "d": 4, "é": 10, "Z": 27, "z": 28, None: 9, "": 55}
    rows = leaves(sizes) + [(5, "b", sha("x"))] * 2 + [(None, "b", sha("y")), (5, "b", sha("w"))]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string").withColumn("KEY", F.lit(1)).withColumn("root", F.lit("r"))
    got = manifest.manifest(df, shape=shape)
    found = sorted((tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof")) for r in got.collect()), key=repr)
    assert found == sorted(brute(rows, shape.fanout), key=repr)


def test_every_number_of_blocks(spark):
    """Trees of 1 to 40 blocks of one leaf: last subtrees of every size."""
    rows = [(i, f"{n:02d}", sha(str(n), str(i))) for n in range(1, 41) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string")
    got = manifest.manifest(df, shape=Shape(3, 0))
    found = sorted(tuple(r[c] for c in ("doc_id", "leaf", "subroot", "root", "proof")) for r in got.collect())
    assert found == sorted(brute(rows, 3))


def test_tampered_leaves_are_found(spark):
    rows = [(i, s, leaf, leaf if i % 3 else sha("other")) for i, s, leaf in leaves({"a": 40, "b": 7, "c": 1})]
    df = spark.createDataFrame(rows, "doc_id long, source string, leaf string, now string")
    shape = Shape(3, 1)
    proofs = manifest.manifest(df, keep=["now"], shape=shape)
    got = manifest.verified(proofs, "now", ["doc_id", "root"], shape=shape).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["verified"] == (r["doc_id"] % 3 > 0) == (r["folded_root"] == r["root"])


def test_small_tables(spark):
    schema = "doc_id long, source string, leaf string"
    assert manifest.manifest(spark.createDataFrame([], schema)).collect() == []
    (one,) = manifest.manifest(spark.createDataFrame([(1, None, sha("a"))], schema)).collect()
    assert (one["root"], one["subroot"], one["proof"]) == (sha("a"), sha("a"), [])


def leaf_of(i, source, lang, chars, text):
    fields = ("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, chars, text))
    return sha("".join(fields))


def test_query_against_sql_and_brute_force(spark, tmp_path):
    rows = [(i, t and t.replace(" ", "\n", 3), y, s) for i, t, y, s in documents()]
    df = frame(spark, rows, clash=False).withColumn("n_chars", F.length("text").cast("long"))
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = manifest.op12_manifest(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    twin = con.execute(manifest.OP12_SQL)
    assert [c[0] for c in twin.description] == got.columns
    found = sorted(map(tuple, got.collect()), key=repr)
    assert found == sorted(twin.fetchall(), key=repr)
    made = brute([(i, s, leaf_of(i, s, y, t if t is None else len(t), t)) for i, t, y, s in rows], 3)
    assert sorted((r[:5] for r in found), key=repr) == sorted(((*r[:4], sha(*r[4])) for r in made), key=repr)
    texts = {i: t for i, t, _, _ in rows}
    for r in found:
        if r[0] is not None:
            touched = zlib.crc32(str(r[0]).encode()) % 2 == 0 and "\n" in (texts[r[0]] or "")
            assert r[6] == (not touched)
