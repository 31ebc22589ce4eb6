"""One JSON array read by several tasks, against Spark's reader of whole files."""

import json
import random

import pytest

from fiscalake import staging
from fiscalake.schemas import RAW
from fiscalake.sources import arrays, raw

from .conftest import record

AWKWARD = ["plain", "a } b", "{", "}{", '"', '\\"}', "\\", "\\\\", '{"x": 1}', "[1, 2}", "é}漢{😀", "line\nbreak }", "", "\\u007d", "}" * 40]


@pytest.fixture(params=[300, 1000, 1 << 27])
def split(spark, request):
    """Splits far smaller than a record, of a few records, and larger than the file."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(request.param))
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)


def rows(df):
    return sorted(map(tuple, df.select([f.name for f in RAW]).collect()), key=repr)


def some_records(n, seed=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        more = {"subfuncao": rng.choice(AWKWARD), "autor": rng.choice(AWKWARD), "funcao": None if i % 7 == 0 else "saúde"}
        extra = {"aninhado": {"a": [{"b": rng.choice(AWKWARD)}, {}], "c": {}}} if i % 3 == 0 else {}
        out.append(record(f"C{i:04d}", **more, **extra))
    return out


def test_same_rows_as_the_whole_file_reader(spark, write_json, tmp_path, split):
    for n, name in ((120, "a"), (1, "b"), (0, "c"), (35, "d")):
        write_json(f"{name}.json", some_records(n, n))
    (tmp_path / "flat.json").write_text(json.dumps(some_records(40), ensure_ascii=True), encoding="utf-8")
    paths = [f"{tmp_path}/{name}.json" for name in ("a", "b", "c", "d", "flat")]
    got = arrays.read_arrays(spark, paths)
    assert rows(got) == rows(raw.read_json(spark, paths))
    assert rows(arrays.read_arrays(spark, f"{tmp_path}/*.json")) == rows(got)


def test_a_large_array_goes_to_several_tasks(spark, write_json, split):
    path = write_json("large.json", some_records(300))
    pieces = arrays._pieces(spark, [path])
    assert (pieces.rdd.getNumPartitions() > 5) == (split < 1 << 20)
    got = arrays.read_arrays(spark, path, positioned=True)
    assert got.select("_file", "_at").distinct().count() == 300
    assert [r["codigoEmenda"] for r in got.orderBy("_at").collect()] == [f"C{i:04d}" for i in range(300)]


def test_a_record_longer_than_many_splits(spark, write_json, split):
    long = [record("A"), record("B", subfuncao="x } y " * 3000, autor={"deep": [{"er": "}" * 2000}] * 5}), record("C")]
    path = write_json("long.json", long)
    got = arrays.read_arrays(spark, path)
    assert sorted(r["codigoEmenda"] for r in got.collect()) == ["A", "B", "C"]
    assert got.where("codigoEmenda = 'B'").first()["subfuncao"] == "x } y " * 3000


def test_lines_and_single_objects(spark, tmp_path, split):
    lines = "\n".join([json.dumps(record("A")), json.dumps([record("B"), record("C", autor="}")]), "[]", json.dumps(record("D"))])
    (tmp_path / "lines.json").write_text(lines, encoding="utf-8")
    (tmp_path / "one.json").write_text("﻿" + json.dumps(record("E"), indent=2), encoding="utf-8")
    (tmp_path / "empty.json").write_text("", encoding="utf-8")
    got = arrays.read_arrays(spark, f"{tmp_path}/*.json")
    assert sorted(r["codigoEmenda"] for r in got.collect()) == list("ABCDE")


def test_records_of_one_piece_are_neither_moved_nor_kept(spark, write_json, tmp_path, split):
    path = write_json("flat.json", [record(f"C{i:03d}", autor="a { b") for i in range(90)])
    before = {t.name for t in spark.catalog.listTables(staging._scratch_database(spark))}
    got = arrays.read_arrays(spark, path)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert rows(got) == rows(raw.read_json(spark, path)) and len(rows(got)) == 90
    made = {t.name for t in spark.catalog.listTables(staging._scratch_database(spark))} - before
    assert not [name for name in made if name.startswith("json_pieces")]


def test_plain_splits_beside_others(spark, write_json, tmp_path, split):
    """Texts and objects that need what comes before, in the middle of a file only."""
    some = [record(f"C{i:03d}") for i in range(60)]
    some[30] = record("C030", autor="a } b", funcao="}{")
    some[40] = record("C040", autor="x } y " * 300, mais={"a": [{"b": 1}, {}]})
    path = write_json("mixed.json", some)
    got = arrays.read_arrays(spark, path, positioned=True)
    assert [r["codigoEmenda"] for r in got.orderBy("_at").collect()] == [f"C{i:03d}" for i in range(60)]
    assert rows(got) == rows(raw.read_json(spark, path))
    spark.read.text(path, wholetext=True).write.option("compression", "gzip").text(f"{tmp_path}/packed")
    assert rows(arrays.read_arrays(spark, f"{tmp_path}/packed")) == rows(got)


def test_braces_after_the_last_object(spark, tmp_path, split):
    (tmp_path / "a.json").write_text(json.dumps([record("A"), record("B")]) + ' "{"', encoding="utf-8")
    (tmp_path / "b.json").write_text(json.dumps([record("C")]) + '\n["{", "x{"]', encoding="utf-8")
    assert sorted(r["codigoEmenda"] for r in arrays.read_arrays(spark, f"{tmp_path}/*.json").collect()) == list("ABC")
