"""Cases that only large tables or broken jobs bring about."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fiscalake.functions import money
from fiscalake.operators import joins, profile
from fiscalake.plans import cleaning, mart, run
from fiscalake.schemas import MONEY
from fiscalake.sources import landing
from fiscalake.staging import published, replace_table, scratch, stage

from .conftest import record


def test_author_totals_above_the_money_type(spark):
    big = Decimal("99999999999999.0000")
    rows = spark.range(30).select(
        F.lit("a").alias("autor"), F.lit("Emenda Individual").alias("tipoEmenda"), F.lit(big).cast(MONEY).alias("valorEmpenhado"),
        F.lit(1).cast(MONEY).alias("valorPago"), F.lit(0.0).alias("taxa_execucao_pct"), F.lit(False).alias("emenda_vitrine"),
    )
    assert mart.ranking_by_author(rows).first()["total_empenhado"] == pytest.approx(30 * float(big))


def test_fingerprint_sums_do_not_overflow(spark):
    plan = profile.fingerprint(spark.range(10))._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(38,0)" in plan
    assert profile.fingerprint(spark.range(10)).first()["registros"] == 10


def test_numbers_too_large_for_an_amount_are_bad(spark):
    df = spark.createDataFrame([(1e15,), (2.5,), (None,)], "v double")
    assert [r[0] for r in df.select(money.bad_money(F.col("v"), df.schema["v"].dataType)).collect()] == [True, False, False]


def test_carried_over_text_stops_a_run(spark, raw_frame, tmp_path):
    from fiscalake.operators.contract import ContractViolation

    with pytest.raises(ContractViolation) as error:
        run.publish_trusted(raw_frame([record("A", valorRestoInscrito="lixo")]), ["numeroEmenda"], str(tmp_path))
    assert error.value.found == [("valorRestoInscrito", "money", 1)]


def test_rows_outside_the_years_are_counted(raw_frame, tmp_path):
    rows = [record("A"), record("B"), record("C", ano=1990), record("D", ano=2050)]
    quality = run.publish_trusted(raw_frame(rows), ["numeroEmenda"], str(tmp_path))
    assert quality["total_lido"] == 4 and quality["fora_da_janela"] == 2 and quality["total_final"] == 2


def test_the_later_load_counts_whatever_its_name(spark, raw_frame, tmp_path):
    folder = str(tmp_path)
    landing.land(raw_frame([record("OLD")]), folder, 2023, "emendas_2023_sample", profile=False)
    landing.land(raw_frame([record("NEW")]), folder, 2023, "emendas_2023_20240101_000000", force=True, profile=False)
    assert [r["codigoEmenda"] for r in landing.read_landed(spark, folder).collect()] == ["NEW"]


def test_a_broken_publication_leaves_the_table_before(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    replace_table(spark.range(3), path)
    broken = spark.range(5).select(F.raise_error(F.lit("lost")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        replace_table(broken, path)
    assert published(spark, path).rows == published(spark, path).df.count() == 3
    opened = published(spark, path).df
    replace_table(spark.range(7), path)
    assert published(spark, path).rows == 7 and opened.count() == 3


def test_staged_tables_go_with_their_block(spark):
    with scratch(spark):
        inner, kept = stage(spark.range(3), "inner"), stage(spark.range(4), "kept", keep=True)
        assert inner.df.count() == 3
    assert not spark.catalog.tableExists(inner.path) and kept.df.count() == 4


def test_equal_rows_of_a_hot_key_are_spread(spark):
    rows = spark.range(1000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    table = spark.createDataFrame([(1, "x"), (2, "y")], "k int, w string")
    joined = joins.salted_join(rows, table, ["k"], rows_per_task=50)
    assert joined.count() == 1000
    salts = [p for p in joined._jdf.queryExecution().optimizedPlan().toString().split("\n") if "_salt" in p]
    assert salts
    with pytest.raises(ValueError):
        joins.salted_join(rows, table, ["k"], "right")


def test_gate_on_a_column(spark):
    rows = spark.createDataFrame([(10.0,), (40.0,)], "pct_descartado double")
    assert [r[0] for r in rows.select(cleaning.passes({"pct_descartado": F.col("pct_descartado")})).collect()] == [True, False]
