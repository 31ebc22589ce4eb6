"""The fallback query: one layer on disk at a time, and arrays in tasks of bounded size."""

import re

import pytest
from pyspark.sql import functions as F

from fiscalake import staging
from fiscalake.checks import queries
from fiscalake.checks.binding import Layers, layers


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A few hundred orders of 1995 to 2001, some without lines and some without a priority."""
    place = str(tmp_path_factory.mktemp("tables"))
    day = F.timestamp_seconds(F.lit(788918400) + F.col("id") * 86400 * 8)
    tables = {
        "nation": spark.range(25).selectExpr("cast(id as int) n_nationkey", "concat('NATION_', id) n_name", "cast(id % 5 as int) n_regionkey"),
        "customer": spark.range(40).selectExpr(
            "id c_custkey", "concat('Customer#', id) c_name", "cast(id % 25 as int) c_nationkey", "1.5D c_acctbal",
            "element_at(array('BUILDING', 'AUTOMOBILE', 'HOUSEHOLD'), cast(id % 3 + 1 as int)) c_mktsegment"),
        "orders": spark.range(300).select(
            F.col("id").alias("o_orderkey"), (F.col("id") * 7 % 40).alias("o_custkey"), F.lit("O").alias("o_orderstatus"),
            (F.col("id") * 37.25 + 900).alias("o_totalprice"), day.alias("o_orderdate"),
            F.when(F.col("id") % 9 > 0, F.concat(F.col("id") % 5, F.lit("-HIGH"))).alias("o_orderpriority")),
        "lineitem": spark.range(500).selectExpr(
            "id * 3 % 280 l_orderkey", "id l_partkey", "id l_suppkey", "1 l_linenumber", "1D l_quantity", "id * 0.75D l_extendedprice",
            "0.05D l_discount", "0D l_tax", "element_at(array('N', 'R', 'A'), cast(id % 3 + 1 as int)) l_returnflag",
            "if(id % 2 = 0, 'F', 'O') l_linestatus", "timestamp '1996-01-01' l_shipdate"),
    }
    for name, rows in tables.items():
        rows.write.parquet(f"{place}/{name}.parquet")
    return place


def test_one_layer_on_disk_at_a_time(spark, folder, tmp_path, monkeypatch):
    """Raw JSON is many times the tables: its forms are compressed, and never there together."""
    monkeypatch.setattr(queries, "fresh_path", lambda _, name: f"{tmp_path}/{name}")
    seen, best = [], queries.store.best_layer

    def look(*args, **kwargs):
        files = [f.relative_to(tmp_path / "layers") for f in (tmp_path / "layers").rglob("part-*") if f.suffix != ".crc"]
        assert all(f.suffix == ".gz" for f in files if f.parts[0] in ("raw", "arrays"))
        seen.append(sorted({f.parts[0] for f in files}))
        return best(*args, **kwargs)

    monkeypatch.setattr(queries.store, "best_layer", look)
    database = staging._scratch_database(spark)
    before = {t.name for t in spark.catalog.listTables(database)}
    found = queries.QUERIES["layer_fallback"](spark, folder)
    assert seen == [["mart", "t.parquet"], ["t.parquet"], ["raw"], ["arrays"]]
    assert not (tmp_path / "layers").exists()
    kept = {t.name.rsplit("_", 1)[0] for t in spark.catalog.listTables(database) if t.name not in before}
    assert kept == {"records", "trusted", "layer_figures"}
    counted = {r["camada"]: r["linhas"] for r in found.collect()}
    built = layers(spark, folder)  # still there for other queries
    assert counted["raw"] == counted["raw arrays"] == built.records.count() == 300
    assert counted["mart"] == counted["trusted"] == built.trusted.count() > 0
    assert built.star.fato_emendas.count() == built.trusted.count()


def test_tasks_have_few_arrays(spark, folder):
    records = Layers(spark, folder).records
    arrays = queries._arrays(records, least=4, rows_per_task=20, shape=lambda dealt: queries._as_documents(dealt, "lote"))
    text = arrays._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"hashpartitioning\(ano#\w+, lote#\w+, (\d+)\), REPARTITION_BY_NUM", text).group(1) == "15"
    same = queries._arrays(queries._as_documents(records), least=4)
    texts = [sorted(sorted(r["value"]) for r in some.where(F.length("value") > 0).collect()) for some in (arrays, same)]
    assert texts[0] == texts[1] and texts[0]
