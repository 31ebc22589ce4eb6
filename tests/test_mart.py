from collections import Counter, defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fiscalake.operators import joins, ordered
from fiscalake.plans import cleaning, features, mart, run
from fiscalake.schemas import CORRELATED_FEATURES, FACT_COLUMNS, FEATURE_COLUMNS, LABEL, MONEY
from fiscalake.staging import published, stage


@pytest.fixture(scope="module")
def trusted(raw_frame, many_records):
    return stage(cleaning.trusted_zero(raw_frame(many_records), ["numeroEmenda"]), "t").df


@pytest.fixture(scope="module")
def star(trusted):
    return mart.build(trusted)


@pytest.fixture(scope="module")
def fact_rows(star):
    return [r.asDict() for r in mart.published(star.fato_emendas).collect()]


def test_fact_has_one_row_per_trusted_row(trusted, fact_rows, star):
    assert len(fact_rows) == trusted.count()
    assert star.fato_emendas.columns == FACT_COLUMNS
    assert all(r["ano_id"] == r["ano"] and r["localidade_id"] and r["autor_id"] for r in fact_rows)


def test_dimension_keys_are_dense_and_ordered(star):
    for dim, key, names in (
        (star.dim_funcao, "funcao_id", ["funcao"]),
        (star.dim_localidade, "localidade_id", ["uf", "localidade"]),
        (star.dim_autor, "autor_id", ["autor"]),
    ):
        rows = sorted(dim.df.collect(), key=lambda r: r[key])
        assert [r[key] for r in rows] == list(range(1, dim.rows + 1))
        natural = [tuple(r[n] for n in names) for r in rows]
        assert natural == sorted(natural) and len(set(natural)) == len(natural)


def test_dependent_attribute_is_the_modal_one(star, fact_rows):
    counts = defaultdict(Counter)
    for r in fact_rows:
        counts[r["autor"]][r["tipoEmenda"]] += 1
    for r in star.dim_autor.df.collect():
        best = min(counts[r["autor"]].items(), key=lambda kv: (-kv[1], kv[0]))[0]
        assert r["tipoEmenda"] == best


def test_ranking(star, fact_rows):
    totals = defaultdict(float)
    for r in fact_rows:
        totals[r["autor"]] += r["valorEmpenhado"]
    rows = sorted(mart.ranking_by_author(star.fato_emendas).collect(), key=lambda r: (r["rank_empenhado"], r["autor"]))
    running = 0
    for r in rows:
        running += totals[r["autor"]]
        assert r["total_empenhado"] == pytest.approx(totals[r["autor"]])
        assert r["rank_empenhado"] == 1 + sum(t > totals[r["autor"]] + 1e-9 for t in totals.values())
        assert r["total_acumulado"] == pytest.approx(running)
    assert running == pytest.approx(sum(r["valorEmpenhado"] for r in fact_rows))


def test_views_equal_their_join_form(star):
    """The views take themes, types and regions from the rows; joining must agree."""
    mart.register(star.tables())
    spark = star.fato_emendas.sparkSession
    joined = spark.sql(
        """SELECT df.funcao, df.area_tematica, dl.regiao, count(*) AS qtd_emendas,
             count_if(fe.emenda_vitrine) AS emendas_vitrine
           FROM fato_emendas fe JOIN dim_funcao df ON fe.funcao = df.funcao
             LEFT JOIN dim_localidade dl ON fe.localidade_id = dl.localidade_id
           GROUP BY ALL"""
    )
    view = mart.distribution_by_function_and_region(star.fato_emendas).select(joined.columns)
    assert view.exceptAll(joined).isEmpty() and joined.exceptAll(view).isEmpty()
    types = spark.sql(
        """SELECT DISTINCT fe.autor, da.tipo_simplificado FROM fato_emendas fe
           JOIN dim_autor da ON fe.autor_id = da.autor_id"""
    )
    ranked = mart.ranking_by_author(star.fato_emendas).select("autor", "tipo_simplificado")
    assert ranked.exceptAll(types).isEmpty() and types.exceptAll(ranked).isEmpty()


@pytest.mark.parametrize("merge", ["false", "true"])
def test_row_numbers(spark, merge):
    """In many partitions, and in the few that adaptive execution makes of them."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", merge)
    try:
        df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("k"), F.lit("x").alias("v"))
        rows = ordered.number_rows(df.repartition(7), [F.desc("k")], "n").df
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["n"] for r in rows.orderBy(F.desc("k")).collect()] == list(range(1, 5001))


@pytest.mark.parametrize("nulls", [0, 3, 1])
@pytest.mark.parametrize("spread", [1, 2, 7, 5000])
def test_ranks_and_running_totals(spark, spread, nulls):
    """With few distinct values, runs of equal rank reach across many partitions, as do
    runs of NULL: none, a third, or all of the rows."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(5000).select(
            F.format_string("a%04d", "id").alias("a"), (F.col("id") * 31 % spread).cast(MONEY).alias("v")
        )
        if nulls:
            df = df.withColumn("v", F.when(F.substring("a", 2, 4).cast("int") % nulls != 0, F.col("v")))
        order = [F.desc_nulls_last("v"), "a"]
        upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        small = df.select(
            "a",
            "v",
            F.rank().over(Window.orderBy(F.desc_nulls_last("v"))).cast("long").alias("r"),
            F.sum("v").over(upto).cast("decimal(38,4)").alias("t"),
        )
        large = ordered.rank_and_running_total(df, "v", ["a"], "r", "t")
        assert dict(large.dtypes)["t"] == "decimal(38,4)"
        assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()
        assert large.agg(F.max("t")).first()[0] == df.agg(F.sum("v")).first()[0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("how", ["left", "inner"])
def test_joins_by_either_way(spark, how):
    """One key holds a third of the rows, some keys match nothing, some are NULL."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).when(F.col("id") % 50 == 1, None).otherwise(F.col("id") % 400).alias("k"),
        "id",
    )
    table = stage(spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "table")
    small = joins.lookup_join(rows, table, ["k"], how)
    large = joins.lookup_join(rows, table, ["k"], how, plain_rows=0, rows_per_task=20)
    assert large.columns == small.columns
    assert small.exceptAll(large).isEmpty() and large.exceptAll(small).isEmpty()


def test_features(star, fact_rows):
    table = features.features(star.fato_emendas)
    assert table.columns == FEATURE_COLUMNS
    got = {r["codigoEmenda"]: r for r in table.collect()}
    positive = [r for r in fact_rows if r["valorEmpenhado"] > 0]
    assert sorted(got) == sorted(r["codigoEmenda"] for r in positive)
    mean = sum(r["valorEmpenhado"] for r in positive) / len(positive)
    sd = (sum((r["valorEmpenhado"] - mean) ** 2 for r in positive) / (len(positive) - 1)) ** 0.5
    per_author = defaultdict(list)
    for r in fact_rows:
        per_author[r["autor"]].append(r)
    for r in positive:
        f, own = got[r["codigoEmenda"]], per_author[r["autor"]]
        rate_mean = sum(o["taxa_execucao_pct"] for o in own) / len(own)
        share = r["valorEmpenhado"] / sum(o["valorEmpenhado"] for o in own) * 100
        assert f["pct_do_total_autor"] == pytest.approx(share, abs=0.0051)
        assert f["desvio_execucao_vs_autor"] == pytest.approx(r["taxa_execucao_pct"] - rate_mean, abs=1e-9)
        assert f["zscore_valor"] == pytest.approx((r["valorEmpenhado"] - mean) / sd, abs=0.00051)
        assert f[LABEL] == int(r["taxa_execucao_pct"] >= 80)
        assert f["flag_nordeste"] == int(r["uf"] in ("CE",)) and f["flag_norte"] == int(r["uf"] == "AM")


def test_correlations_against_pandas(star):
    table = stage(features.features(star.fato_emendas), "features").df.withColumn("flag_norte", F.lit(1))
    ranked = features.feature_ranking(table).collect()
    data = table.toPandas()[[*CORRELATED_FEATURES, LABEL]].dropna().astype(float)
    want = data.corr()
    for r in ranked:
        if r["feature"] == "flag_norte":
            assert r["correlation"] is None
        else:
            assert r["correlation"] == pytest.approx(want[LABEL][r["feature"]], abs=1e-9)
    assert ranked[-1]["feature"] == "flag_norte"
    for r in features.feature_matrix(table).collect():
        if "flag_norte" not in (r["x"], r["y"]):
            assert r["correlation"] == pytest.approx(want[r["x"]][r["y"]], abs=1e-9)


def test_published_mart_reads_back(spark, trusted, star, tmp_path):
    folder = str(tmp_path / "mart")
    counts = run.publish_mart(trusted, folder)
    assert counts["fato_emendas"] == trusted.count()
    back = run.read_star(spark, folder)
    a = mart.budget_execution(back.fato_emendas)
    b = mart.budget_execution(star.fato_emendas)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert sorted(run.publish_views(back, folder)) == sorted(mart.VIEWS)
    assert run.publish_features(back, str(tmp_path / "feat"))["features"] > 0
    documents = spark.read.json(f"{folder}/dicionario_dados.json").collect()
    types = {r["table_name"]: {c["column_name"]: c["column_type"] for c in r["columns"]} for r in documents}
    assert types["fato_emendas"]["valorEmpenhado"] == "DOUBLE"
    assert types["dim_tempo"] == {"ano_id": "BIGINT", "ano": "BIGINT", "periodo": "VARCHAR"}
    assert types["fato_emendas"]["emenda_vitrine"] == "BOOLEAN"


def test_results_do_not_depend_on_partitions(trusted):
    one = mart.ranking_by_author(mart.with_kpis(trusted.coalesce(1)))
    many = mart.ranking_by_author(mart.with_kpis(trusted.repartition(13)))
    assert one.exceptAll(many).isEmpty() and many.exceptAll(one).isEmpty()


def test_rows_without_a_key_are_spread(spark):
    """A third of the rows have no key; in a salted join they do not meet in one task."""
    rows = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 100).alias("k"), "id")
    table = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    joined = joins.salted_join(rows.hint("shuffle_hash"), table, ["k"], rows_per_task=50)
    assert joined.count() == 9000 and joined.where("v is null").count() == 3000
    assert joined.where("k is null").select("id").distinct().count() == 3000


def test_all_layers_in_turn(spark, many_records, write_json, tmp_path):
    # Year 2020 comes in two files, of which the newer one is current.
    write_json("raw/emendas_2020_20240101_000000.json", many_records[:3])
    for year in (2020, 2021):
        rows = [r | {"ano": year, "codigoEmenda": f"{year}-{r['codigoEmenda']}"} for r in many_records]
        write_json(f"raw/emendas_{year}_20240201_000000.json", rows)
    target = str(tmp_path / "out")
    counts = run.run_all(spark, str(tmp_path / "raw"), target)
    assert counts["dim_tempo"] == 2 and counts["fato_emendas"] == published(
        spark, f"{target}/trusted/emendas_trusted.parquet"
    ).df.count()
    assert run.run_all(spark, str(tmp_path / "raw"), target) == counts
    assert spark.read.json(f"{target}/raw/ledger").count() == 2
    firsts = {}
    for r in many_records:
        firsts.setdefault(r["codigoEmenda"], r["numeroEmenda"])
    kept = published(spark, f"{target}/trusted/emendas_trusted.parquet").df.where("ano = 2021").collect()
    assert all(firsts[r["codigoEmenda"].split("-")[1]] == r["numeroEmenda"] for r in kept)


def test_an_empty_table_gives_empty_results(trusted):
    nothing = trusted.where("ano = 1900")
    star = mart.build(nothing)
    assert star.fato_emendas.isEmpty() and star.dim_autor.rows == 0
    assert mart.ranking_by_author(star.fato_emendas).isEmpty()
    table = features.features(star.fato_emendas)
    assert table.isEmpty()
    assert all(r["correlation"] is None for r in features.feature_ranking(table).collect())


@pytest.mark.parametrize("switch, profiled", [({}, True), ({"profile": False}, False)])
def test_loads_are_profiled_unless_switched_off(spark, many_records, write_json, tmp_path, monkeypatch, switch, profiled):
    class Landed(Exception):
        pass

    def land(*given):
        raise Landed(given[-1])

    monkeypatch.setattr(run, "land", land)
    write_json("raw/emendas_2021_20240201_000000.json", [r | {"ano": 2021} for r in many_records[:3]])
    with pytest.raises(Landed, match=str(profiled)):
        run.run_all(spark, str(tmp_path / "raw"), str(tmp_path / "out"), **switch)
