import math

import pytest
from pyspark.sql import functions as F

from fiscalake.plans import cleaning, mart, run, serving
from fiscalake.staging import stage


@pytest.fixture(scope="module")
def star(raw_frame, many_records):
    trusted = stage(cleaning.trusted_zero(raw_frame(many_records), ["numeroEmenda"]), "t").df
    return mart.build(trusted)


@pytest.fixture(scope="module")
def wide(star):
    return stage(serving.denormalised(star), "wide").df


@pytest.fixture(scope="module")
def frame(wide):
    return mart.published(wide).toPandas()


def test_kpis(wide, frame):
    row = serving.kpis(wide).first()
    assert row["total_emendas"] == len(frame)
    assert row["total_pago"] == pytest.approx(frame.valorPago.sum())
    assert row["taxa_execucao"] == pytest.approx(frame.valorPago.sum() / frame.valorEmpenhado.sum() * 100)
    assert (row["autores_unicos"], row["funcoes"], row["ufs"]) == tuple(frame[["autor", "funcao", "uf"]].nunique())
    nothing = serving.kpis(wide.where("false")).first()
    assert (nothing["total_emendas"], nothing["taxa_execucao"]) == (0, 0)


def test_top_lists(wide, frame):
    want = frame.groupby("autor").valorEmpenhado.sum().sort_values(ascending=False).head(3)
    rows = sorted(serving.top_authors(wide, 3).collect(), key=lambda r: r["posicao"])
    assert [r["autor"] for r in rows] == list(want.index)
    shown = serving.top_functions(wide, 2).collect()
    assert [r["posicao"] for r in shown] == [2, 1]
    assert shown[0]["total_empenhado"] <= shown[1]["total_empenhado"]


def test_states_leave_out_the_unplaced(wide, frame):
    rows = serving.by_state(wide).collect()
    want = frame[frame.uf != "NA"].groupby("uf").valorEmpenhado.sum().sort_values(ascending=False)
    assert [r["uf"] for r in rows] == list(want.index)
    shares = serving.state_shares(wide, 2).collect()
    assert sum(r["pct_qtd"] for r in shares) == pytest.approx(100, abs=0.02)


def test_coverage(wide, frame):
    row = serving.coverage(wide).first()
    none = frame[frame.uf == "NA"]
    assert (row["qtd_com_uf"], row["qtd_sem_uf"]) == (len(frame) - len(none), len(none))
    want = (1 - none.valorEmpenhado.sum() / frame.valorEmpenhado.sum()) * 100
    assert row["pct_valor_coberto"] == pytest.approx(want, abs=1e-6)


def test_showcases(wide, frame):
    shown = frame[(frame.valorEmpenhado > 1000) & (frame.taxa_execucao_pct < 10)]
    table = serving.showcase_display(wide)
    assert table.columns == serving.SHOWCASE_NAMES
    assert table.count() == len(shown) > 0
    totals = serving.showcase_totals(wide).first()
    assert totals["valor_vitrines"] == pytest.approx(shown.valorEmpenhado.sum())
    assert totals["qtd_flag"] == frame.emenda_vitrine.sum()
    best = serving.top_showcases(wide, 5).orderBy("posicao").collect()
    assert [r["valorEmpenhado"] for r in best] == sorted((r["valorEmpenhado"] for r in best), reverse=True)


def test_histogram_counts_every_positive_row(wide, frame):
    rows = serving.rate_histogram(wide).collect()
    positive = frame[frame.valorEmpenhado > 0]
    assert sum(r["rows"] for r in rows) == len(positive)
    for r in rows:
        assert r["bin_end"] == pytest.approx(r["bin_start"] + 5.05)
        inside = positive[
            (positive.funcao == r["funcao"]) & (positive.taxa_execucao_pct.floordiv(5.05).map(math.trunc) + 1 == r["bin"])
        ]
        assert len(inside) == r["rows"]


def test_filters(wide, frame):
    years, functions = [2021, 2022], ["Saúde", "Transporte"]
    base = frame[frame.ano.isin(years) & frame.funcao.isin(functions)]
    assert serving.filtered(wide, years, functions).count() == len(base)
    assert serving.filtered(wide, years, functions, "CE").count() == len(base[base.uf == "CE"])
    assert serving.filtered(wide, years, functions, types=[]).count() == len(base)
    only = serving.filtered(wide, years, functions, types=["Individual"])
    assert only.count() == len(base[base.tipo_simplificado == "Individual"])
    assert serving.filtered(wide, [], functions).isEmpty()
    assert serving.filtered(wide, years, []).isEmpty()
    assert serving.filtered(wide.drop("tipo_simplificado"), years, functions, types=["x"]).count() == len(base)


def test_options_and_scatter(wide, frame):
    assert [r[0] for r in serving.options(wide, "funcao").collect()] == sorted(frame.funcao.unique())
    assert serving.scatter(wide).count() == (frame.valorEmpenhado > 0).sum()


def test_lower_layers_get_the_missing_columns(wide):
    lower = wide.drop("uf", "taxa_execucao_pct", "emenda_vitrine")
    full = serving.with_serving_columns(lower)
    both = full.select("codigoEmenda", "uf", F.round("taxa_execucao_pct", 2).alias("taxa_execucao_pct"))
    assert both.exceptAll(wide.select(both.columns)).isEmpty()
    assert full.where("emenda_vitrine").count() == serving.showcase_table(full).count()


def test_figures_from_the_cube_are_those_of_the_records(wide):
    cube = serving.cube(wide)
    for make in (
        serving.kpis, serving.coverage, serving.by_function, serving.top_functions, serving.by_author, serving.top_authors,
        serving.by_state, serving.state_shares, serving.showcase_totals, serving.executive_summary, serving.report_states,
    ):
        from_cube, from_records = make(cube), make(wide)
        assert from_cube.dtypes == from_records.dtypes
        assert sorted(map(tuple, from_cube.collect()), key=repr) == sorted(map(tuple, from_records.collect()), key=repr)
    some = serving.filtered(cube, [2021], ["Saúde"], "CE")
    assert some.agg(F.sum("_rows")).first()[0] == serving.filtered(wide, [2021], ["Saúde"], "CE").count()
    nothing = wide.where("false")
    for make in (serving.kpis, serving.coverage, serving.showcase_totals, serving.executive_summary):
        assert make(serving.cube(nothing)).collect() == make(nothing).collect()


def test_the_cube_follows_the_published_fact(spark, raw_frame, many_records, tmp_path):
    folder = str(tmp_path / "mart")

    def publish(records):
        trusted = cleaning.trusted_zero(raw_frame(records), ["numeroEmenda"])
        run.publish_mart(trusted, folder)
        return run.read_cube(spark, folder), trusted.count()

    first, rows = publish(many_records)
    assert serving.kpis(first).first()["total_emendas"] == rows
    place = run.cube_place(spark, folder)
    assert run.read_cube(spark, folder).count() == first.count() and run.cube_place(spark, folder) == place
    second, fewer = publish(many_records[:40])
    assert run.cube_place(spark, folder) != place
    assert serving.kpis(second).first()["total_emendas"] == fewer < rows
