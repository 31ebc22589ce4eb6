import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fiscalake.llm import language, registry

from .cases import documents, frame
from .test_pairs import components, without

NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("corpus")
    df = frame(spark, documents(size=95), clash=False).selectExpr("*", "length(text) AS n_chars")
    df.write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_stages_in_turn(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = [tuple(r) for r in docs.collect()]
        stage(spark, docs, folder).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = docs.collect()
        if name != "packing":
            assert docs.columns == NAMES
        if name == "language":
            known = [r for r in before if r[1] and re.search(r"[^\W\d_]", r[1])]
            assert {r["doc_id"] for r in after} >= {r[0] for r in known if len(r[1].split()) > 10}
            assert {tuple(r) for r in after} <= set(known)
        elif name == "near_duplicates":
            assert sorted(r["doc_id"] for r in after) == sorted({c for _, n, c in components(before) if n and c is not None})
        elif name == "passages":
            sizes = {i: n - gone for i, n, gone, _, _ in without(before)}
            assert all(len(r["text"].encode()) == sizes[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in after)
            assert len(after) == sum(1 for i, _, _, _, h in without(before) if sizes[i] and i is not None)
        elif name == "mixture":
            assert {tuple(r) for r in after} <= set(before)
            words = sum(len(r["text"].split()) for r in after)
            assert words == pytest.approx(1.5 * sum(len(r[1].split()) for r in before), rel=0.2)
        else:
            assert {r["doc_id"] for r in after} == {r[0] for r in before}


@pytest.mark.parametrize("labelled", [True, False])
def test_texts_of_any_length_stay(spark, folder, labelled):
    rows = [(i, t, y if labelled else None, s, 0) for i, t, y, s in documents(size=95)]
    rows += [(1000 + i, t, None, "s", 0) for i, t in enumerate(["a", "é", "the eau", "qz", "x 1", "ing que"])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.languages(spark, docs, folder).collect()
    assert sorted(str(r["doc_id"]) for r in kept) == sorted(str(r[0]) for r in rows if r[1] and re.search(r"[^\W\d_]", r[1]))


def test_run_is_the_stages(spark, folder):
    got = corpus_pipeline.run(spark, folder)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 0


def test_empty_tables(spark, tmp_path):
    none = frame(spark, [], clash=False).selectExpr("*", "length(text) AS n_chars")
    none.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, none, str(tmp_path))
        assert out.collect() == [] and (name == "packing" or out.columns == NAMES)
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_take_columns_of_any_name(spark, folder):
    """Extra columns, some named as those that stages make, some as theirs but for case."""
    docs = frame(spark, documents(size=40)).withColumn("n_chars", F.lit(1).cast("long"))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() > 0 and (name == "packing" or out.columns == NAMES)


def test_registry():
    numbers = sorted(int(m[1]) for q in registry.QUERIES if (m := re.match(r"op(\d+)_", q)))
    assert numbers == list(range(1, 14)) and "pipeline" in registry.QUERIES
    assert set(registry.ORACLE) <= set(registry.QUERIES)
    assert language.UNKNOWN == "und"


@pytest.mark.skipif(not Path("/root/testdata/sf0.001").exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.ORACLE))
def test_sql_twins(spark, name):
    from fiscalake.checks.compare import connect, differences

    con = connect("/root/testdata/sf0.001")
    assert differences(con, registry.QUERIES[name](spark, "/root/testdata/sf0.001").toArrow(), registry.ORACLE[name]) == []
