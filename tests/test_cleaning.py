from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fiscalake.operators import contract as C
from fiscalake.operators import dedupe
from fiscalake.plans import cleaning, run
from fiscalake.rules import DEFAULT_RULES, Rules
from fiscalake.staging import published

from .conftest import record

POSITION = ["numeroEmenda"]


def codes(df):
    return sorted(r["codigoEmenda"] for r in df.collect())


def test_first_copy_stays_in_the_zero_flavour(raw_frame):
    df = raw_frame([record("A", numeroEmenda="2", autor="dois"), record("A", numeroEmenda="1", autor="um")])
    assert [r["autor"] for r in cleaning.trusted_zero(df, POSITION).collect()] == ["UM"]


def test_latest_year_stays_in_the_null_flavour(raw_frame):
    df = raw_frame([record("A", ano=2021), record("A", ano=2024), record("A", ano=2022)])
    staging = cleaning.staging_rows(df)
    assert [r["ano"] for r in cleaning.trusted_null(staging, POSITION).collect()] == [2024]


def test_years_outside_the_window_are_left_out(raw_frame):
    df = raw_frame([record(str(y), ano=y) for y in (2019, 2020, 2025, 2026)])
    assert codes(cleaning.trusted_zero(df, POSITION)) == ["2020", "2025"]


def test_tolerance_of_the_financial_rule(raw_frame):
    df = raw_frame(
        [
            record("exact", valorEmpenhado="100,00", valorPago="101,00"),
            record("above", valorEmpenhado="100,00", valorPago="101,01"),
            record("no paid", valorPago=None),
            record("no committed", valorEmpenhado=None, valorPago="1,00"),
        ]
    )
    assert codes(cleaning.trusted_zero(df, POSITION)) == ["exact", "no paid"]
    staging = cleaning.staging_rows(df)
    assert codes(cleaning.trusted_null(staging, POSITION)) == ["exact"]
    assert codes(cleaning.quarantine(staging)) == ["above"]


def test_a_code_vanishes_if_its_winner_has_no_function(raw_frame):
    df = raw_frame([record("A", ano=2024, funcao=None), record("A", ano=2021)])
    staging = cleaning.staging_rows(df)
    assert codes(cleaning.trusted_null(staging, POSITION)) == []


def test_text_of_the_zero_flavour(raw_frame):
    df = raw_frame([record("A", funcao="\td'água ", subfuncao=None, autor=" ana ", localidadeDoGasto=None)])
    row = cleaning.trusted_zero(df, POSITION).first()
    assert (row["funcao"], row["subfuncao"], row["autor"]) == ("D'Água", "Não Informada", "ANA")
    assert (row["localidadeDoGasto"], row["uf"]) == ("Nacional", "NA")


def test_text_of_the_null_flavour(raw_frame):
    df = raw_frame([record("A", funcao=" pós-graduação x", subfuncao=None, localidadeDoGasto="ceara (UF)")])
    row = cleaning.trusted_null(cleaning.staging_rows(df), POSITION).first()
    assert (row["funcao"], row["subfuncao"], row["uf"]) == ("Pós-graduação X", "Não Informada", "CE")


def brute_zero(records, rules=DEFAULT_RULES):
    """The steps one after another in plain Python."""

    def amount(value):
        value = str(value).replace(".", "").replace(",", ".").strip()
        return Decimal(value) if value not in ("", "nan", "None") else Decimal(0)

    rows = [r for r in records if r["ano"] in rules.years]
    counts = {"total_lido": len(records), "total_inicial": len(rows)}
    first = {}
    for r in sorted(rows, key=lambda r: r["numeroEmenda"]):
        first.setdefault(r["codigoEmenda"], r)
    counts["duplicatas"] = len(rows) - len(first)
    named = [r for r in first.values() if r["funcao"] is not None]
    counts["sem_funcao"] = len(first) - len(named)
    kept = [r for r in named if amount(r["valorPago"]) <= amount(r["valorEmpenhado"]) * rules.tolerance]
    counts["corrompidos"] = len(named) - len(kept)
    counts["total_final"] = len(kept)
    return counts, sorted(r["codigoEmenda"] for r in kept)


def test_discards_are_charged_to_the_first_failing_rule(raw_frame, many_records):
    records = [r | {"funcao": None if i % 13 == 0 else r["funcao"]} for i, r in enumerate(many_records)]
    records += [record("old", ano=2010), record("new", ano=2030)]
    df = raw_frame(records)
    expected, kept = brute_zero(records)
    summary = cleaning.discard_summary(df, POSITION).first().asDict()
    assert {k: summary[k] for k in expected} == expected
    assert codes(cleaning.trusted_zero(df, POSITION)) == kept
    assert summary["fora_da_janela"] == 2
    report = cleaning.discard_report(cleaning.discard_summary(df, POSITION)).collect()
    assert sum(r["registros_descartados"] for r in report) == summary["total_descartado"]
    for r in report:
        assert r["percentual"] == round(r["registros_descartados"] / summary["total_inicial"] * 100, 2)


def test_null_flavour_accounts_for_every_row(raw_frame, many_records):
    records = many_records + [record(None), record("x", ano=1999), record(None, ano=None)]
    df = raw_frame(records)
    staging = cleaning.staging_rows(df)
    row = cleaning.staging_report(df, POSITION).first()
    assert row["lidos"] == len(records)
    assert row["registros_staging"] == staging.count()
    assert row["quarentena"] == cleaning.quarantine(staging).count()
    assert row["aprovados"] == cleaning.trusted_null(staging, POSITION).count()
    assert row["descartados"] == row["valor_nulo"] + row["duplicatas"] + row["sem_funcao"]
    assert (row["ano_invalido"], row["codigo_nulo"]) == (2, 1)


def test_discard_ceiling_is_exclusive(raw_frame):
    def rows(bad, good):
        return raw_frame(
            [record(f"b{i}", valorPago="9.000,00") for i in range(bad)] + [record(f"g{i}") for i in range(good)]
        )

    assert cleaning.require_quality(cleaning.discard_summary(rows(3, 7), POSITION))["pct_descartado"] == 30.0
    with pytest.raises(cleaning.InsufficientQuality):
        cleaning.require_quality(cleaning.discard_summary(rows(31, 69), POSITION))


def test_contract_reports_all_violations(raw_frame):
    df = raw_frame([record("A", ano=2031, funcao=None, valorPago="abc"), record(None)])
    with pytest.raises(C.ContractViolation) as error:
        C.enforce(df.drop("subfuncao"), cleaning.raw_contract())
    assert error.value.found == [
        ("ano", "domain", 1),
        ("codigoEmenda", "null", 1),
        ("funcao", "null", 1),
        ("subfuncao", "missing", 1),
        ("valorPago", "money", 1),
    ]


def test_contract_shows_the_first_cases_of_each_rule(raw_frame):
    rows = [record(f"C{i:02d}", ano=2031 - i, valorPago="abc" if i % 2 else "1,00") for i in range(8)] + [record(None)]
    df = raw_frame(rows)
    with pytest.raises(C.ContractViolation, match="'abc' at C01/2030") as error:
        C.enforce(df, cleaning.raw_contract(), ["codigoEmenda", "ano"], 2)
    assert error.value.cases == [
        ("ano", "domain", 1, "C00/2031", "2031"),
        ("ano", "domain", 2, "C01/2030", "2030"),
        ("codigoEmenda", "null", 1, "2023", None),
        ("valorPago", "money", 1, "C01/2030", "abc"),
        ("valorPago", "money", 2, "C03/2028", "abc"),
    ]
    plan = C.failure_cases(df, cleaning.raw_contract(), ["codigoEmenda"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    assert C.failure_cases(raw_frame([record("A")]), cleaning.raw_contract(), ["codigoEmenda"]).isEmpty()


def test_contract_refuses_an_empty_table_and_tolerates_extras(raw_frame):
    empty = raw_frame([])
    assert [r["rule"] for r in C.violations(empty, cleaning.raw_contract()).collect()] == ["empty"]
    extra = raw_frame([record("A")]).withColumn("novo", F.lit(1))
    assert "novo" in C.enforce(extra, cleaning.raw_contract()).columns


def test_contract_coerces_types(spark):
    df = spark.createDataFrame([("1", 5), ("x", 6)], "a string, b int")
    rules = C.Contract([C.Field("a", nullable=True), C.Field("b")])
    assert C.coerce(df, rules).schema["b"].dataType.simpleString() == "string"


def test_copies_by_the_thousand(spark):
    """A third of all rows share one key."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), F.col("id").alias("at")
    )
    once = dedupe.keep_first(df, ["k"], ["at"])
    assert once.count() == 4001
    assert "WindowGroupLimit" in once._jdf.queryExecution().toString()
    again = dedupe.keep_first(once, ["k"], ["at"])
    assert again.exceptAll(once).count() == 0 and again.count() == 4001


def test_modal_value_breaks_ties_by_value(spark):
    df = spark.createDataFrame(
        [("a", "y"), ("a", "x"), ("b", "x"), ("b", "z"), ("b", "z"), ("c", None), (None, "q")], "k string, v string"
    )
    got = {r["k"]: (r["v"], r["n"]) for r in dedupe.modal_value(df, "k", "v", counted="n").collect()}
    assert got == {"a": ("x", 2), "b": ("z", 3), "c": (None, 1), None: ("q", 1)}


def test_a_failed_gate_leaves_the_old_table(spark, raw_frame, tmp_path):
    folder = str(tmp_path / "trusted")
    run.publish_trusted(raw_frame([record("A")]), POSITION, folder)
    with pytest.raises(cleaning.InsufficientQuality):
        run.publish_trusted(raw_frame([record("B", valorPago="9.999,00")]), POSITION, folder)
    assert codes(published(spark, f"{folder}/emendas_trusted.parquet").df) == ["A"]


def test_staging_is_reused_unless_forced(spark, raw_frame, tmp_path):
    paths = [str(tmp_path / p) for p in ("s", "t", "q")]
    one, two = raw_frame([record("A")]), raw_frame([record("B"), record("C")])
    assert run.publish_trusted_and_quarantine(one, POSITION, *paths)["emendas_trusted"] == 1
    assert run.publish_trusted_and_quarantine(two, POSITION, *paths)["emendas_trusted"] == 1
    assert run.publish_trusted_and_quarantine(two, POSITION, *paths, force=True)["emendas_trusted"] == 2


def test_rules_are_parameters(raw_frame):
    df = raw_frame([record("A", ano=2001), record("B", ano=2023, valorPago="1.900,00")])
    rules = Rules(first_year=2000, last_year=2030, tolerance=Decimal("2"))
    assert codes(cleaning.trusted_zero(df, POSITION, rules)) == ["A", "B"]
