"""What the plans must look like to hold at a thousand times the data."""

import re
from pathlib import Path

import pytest

from fiscalake.checks.binding import RULES, Layers, layers, table
from fiscalake.checks.queries import QUERIES, _arrays, _as_documents
from fiscalake.plans import cleaning, mart, serving

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_years_and_columns_reach_the_scan(spark):
    trusted = layers(spark, FOLDER).trusted
    text = plan(serving.by_state(cleaning.in_window(trusted, RULES)))
    assert "GreaterThanOrEqual(ano,1996)" in text and "LessThanOrEqual(ano,2000)" in text
    assert re.search(r"ReadSchema: struct<codigoEmenda:string,ano:bigint,valorEmpenhado:decimal\(18,4\),uf:string>", text)


def test_kpis_read_five_columns(spark):
    text = plan(serving.kpis(layers(spark, FOLDER).serving))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert [c.split(":")[0] for c in schema.split(",") if ":" in c] == [
        "autor",
        "funcao",
        "valorEmpenhado",
        "valorPago",
        "uf",
    ]


def test_views_shuffle_only_partial_aggregates(spark):
    rows = layers(spark, FOLDER).serving
    for make in (mart.distribution_by_function_and_region, mart.budget_execution):
        text = plan(make(rows, RULES))
        assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text
        assert text.index("partial_sum") > text.index("Exchange hashpartitioning")


def test_copies_are_cut_before_the_shuffle(spark):
    text = plan(QUERIES["dedupe_latest"](spark, FOLDER))
    assert text.count("WindowGroupLimit") == 2


def test_top_lists_do_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan(serving.top(table(spark, FOLDER, "orders"), "o_totalprice", "o_orderkey", 5))


def test_written_records_are_not_joined_again(spark):
    built, apart = Layers(spark, FOLDER), Layers(spark, FOLDER)
    assert built.records.count() and "lineitem" not in plan(built.trusted_plan)
    assert "lineitem" in plan(apart.trusted_plan)
    assert sorted(built.trusted_plan.collect()) == sorted(apart.trusted_plan.collect())


def test_more_rows_give_more_arrays_not_larger_ones(spark):
    documents = _as_documents(Layers(spark, FOLDER).records)
    arrays = _arrays(documents, least=1, rows_per_lot=50)
    lots = -(-documents.count() // 50)
    sizes = [len(r["value"]) for r in arrays.collect()]
    assert arrays.select("lote").distinct().count() == lots and max(sizes) < 60 * 500
    assert plan(_arrays(documents)).count("Exchange hashpartitioning") == 1
