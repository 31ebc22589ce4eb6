import pytest
from pyspark.sql import functions as F

from fiscalake.operators import profile
from fiscalake.plans import cleaning, mart
from fiscalake.sources import landing, layers, raw
from fiscalake.streaming import landing as streaming

from .conftest import record

LEDGER = landing.LEDGER


def names(df):
    return {r["ano"]: (r["arquivo"], r["origem"]) for r in df.collect()}


def test_files_are_united_by_column_name(spark, write_json, tmp_path):
    missing = record("A")
    del missing["subfuncao"]
    write_json("emendas_2022_20240101_000000.json", [missing])
    write_json("emendas_2023_20240101_000000.json", [record("B", novo="x"), record("C")])
    write_json("outro.json", [record("D")])
    df = raw.read_json(spark, f"{tmp_path}/emendas_*.json")
    assert {r["codigoEmenda"]: r["subfuncao"] for r in df.collect()} == {
        "A": None,
        "B": "atenção básica",
        "C": "atenção básica",
    }
    assert df.where("numeroEmenda = '0001'").count() == 3


def test_positions_follow_the_file(spark, write_json):
    path = write_json("emendas_2023_sample.json", [record(f"{i}") for i in range(50)])
    rows = raw.read_json(spark, path, positioned=True).orderBy("_file", "_at").collect()
    assert [r["codigoEmenda"] for r in rows] == [f"{i}" for i in range(50)]


@pytest.fixture
def listing(spark):
    files = [
        "emendas_2022_20230101_000000.json",
        "emendas_2022_20240101_000000.json",
        "emendas_2023_20230601_120000.json",
        "emendas_2023_sample.json",
        "emendas_2021_sample.json",
        "emendas_x.json",
    ]
    return spark.createDataFrame([(f"/raw/{f}", f) for f in files], raw.LISTING)


def entries(spark, *rows):
    return spark.createDataFrame([(y, f, "h", 1, at, "api") for y, f, at in rows], LEDGER)


def test_ledger_decides_if_any_entry_is_usable(spark, listing):
    ledger = entries(
        spark,
        (2022, "data/emendas_2022_20230101_000000.json", "2024-01-01"),
        (2023, "data/emendas_2023_gone.json", "2024-01-01"),
    )
    assert names(raw.select_current(listing, ledger)) == {2022: ("emendas_2022_20230101_000000.json", "ledger")}


def test_newest_usable_ledger_entry_counts(spark, listing):
    ledger = entries(
        spark,
        (2022, "emendas_2022_20230101_000000.json", "2023-01-01"),
        (2022, "emendas_2022_20240101_000000.json", "2024-01-01"),
        (2022, "emendas_2022_gone.json", "2025-01-01"),
    )
    assert names(raw.select_current(listing, ledger))[2022][0] == "emendas_2022_20240101_000000.json"


def test_names_decide_without_a_usable_ledger(spark, listing):
    for ledger in (entries(spark, (2022, "gone.json", "2024-01-01")), spark.createDataFrame([], LEDGER)):
        assert names(raw.select_current(listing, ledger)) == {
            2021: ("emendas_2021_sample.json", "amostra"),
            2022: ("emendas_2022_20240101_000000.json", "nome"),
            2023: ("emendas_2023_20230601_120000.json", "nome"),
        }


def test_selected_paths_of_a_folder(spark, write_json, tmp_path):
    with pytest.raises(raw.NoRawData):
        write_json("leer/outro.json", [])
        raw.current_paths(spark, f"{tmp_path}/leer", spark.createDataFrame([], LEDGER))
    write_json("r/emendas_2022_sample.json", [record("A", ano=2022)])
    write_json("r/emendas_2023_20240101_000000.json", [record("B")])
    write_json("r/emendas_2023_20240201_000000.json", [record("C")])
    paths = raw.current_paths(spark, f"{tmp_path}/r", spark.createDataFrame([], LEDGER))
    assert sorted(r["codigoEmenda"] for r in raw.read_json(spark, paths).collect()) == ["A", "C"]


@pytest.mark.parametrize(("pages", "complete"), [([1, 2, 3], True), ([1, 3], False), ([2, 3], False)])
def test_page_sets_are_all_or_nothing(spark, write_json, tmp_path, pages, complete):
    for n in pages:
        write_json(f"p/pagina_{n}.json", [record(f"{n}-{i}") for i in range(3)])
    write_json("p/pagina_9999.json", [])
    df = raw.read_pages(spark, f"{tmp_path}/p")
    assert df.count() == 3 * len(pages)
    completeness = raw.page_completeness(df)
    assert completeness.first()["completa"] is complete
    if complete:
        landing.require_complete(completeness)
    else:
        with pytest.raises(landing.IncompleteLoad):
            landing.require_complete(completeness)


def test_landing_is_idempotent_and_keeps_history(spark, raw_frame, tmp_path):
    folder = str(tmp_path / "raw")
    first, second = raw_frame([record("A"), record("B")]), raw_frame([record("C")])
    assert landing.land(first, folder, 2023, "20240101_000000")
    assert not landing.land(second, folder, 2023, "20240102_000000")
    assert landing.read_landed(spark, folder).count() == 2
    assert landing.land(second, folder, 2023, "20240103_000000", force=True)
    assert landing.land(first, folder, 2022, "20240104_000000")
    assert [r["codigoEmenda"] for r in landing.read_landed(spark, folder, [2023]).collect()] == ["C"]
    assert landing.read_landed(spark, folder).count() == 3
    ledger = landing.read_ledger(spark, folder)
    assert ledger.count() == 3 and landing.current_entries(ledger).count() == 2
    assert spark.read.parquet(f"{folder}/dados").count() == 5
    same = ledger.groupBy("hash").count().orderBy("count").collect()
    assert [r["count"] for r in same] == [1, 2]
    with pytest.raises(landing.EmptyLoad):
        landing.land(raw_frame([]), folder, 2021, "20240105_000000")
    described = spark.read.json(f"{folder}/perfil").where("ano = 2022").first()
    assert described["total_registros"] == 2 and len(described["campos"]) == 14


def test_pending_rows(raw_frame, spark):
    batch = raw_frame([record("A", ano=2022), record("B", ano=2023)])
    ledger = entries(spark, (2022, "x", "2024"), (2022, "y", "2025"))
    assert [r["codigoEmenda"] for r in landing.pending(batch, ledger).collect()] == ["B"]
    assert landing.pending(batch, ledger, force=True).count() == 2


def test_best_layer(spark, raw_frame, write_json, tmp_path):
    mart_dir, trusted_path = str(tmp_path / "mart"), str(tmp_path / "t" / "trusted.parquet")
    raw_path = write_json("emendas_2023_sample.json", [record("A"), record("B", valorPago="10,00")])
    with pytest.raises(layers.NoLayer):
        layers.best_layer(spark, mart_dir, trusted_path, str(tmp_path / "none*.json"))
    low = layers.best_layer(spark, mart_dir, trusted_path, raw_path)
    assert {r["codigoEmenda"]: (r["uf"], r["taxa_execucao_pct"]) for r in low.collect()} == {
        "A": ("CE", 50.0),
        "B": ("CE", 1.0),
    }
    trusted = cleaning.trusted_zero(raw.read_json(spark, raw_path), ["numeroEmenda"])
    layers.write_tables({"trusted": mart.published(trusted)}, str(tmp_path / "t"))
    middle = layers.best_layer(spark, mart_dir, trusted_path, raw_path)
    assert "emenda_vitrine" in middle.columns and "regiao" not in middle.columns
    layers.write_tables(mart.build(trusted).tables(), mart_dir)
    top = layers.best_layer(spark, mart_dir, trusted_path, raw_path)
    row = top.where("codigoEmenda = 'B'").first()
    assert (row["regiao"], row["area_tematica"], row["tipo_simplificado"]) == ("Nordeste", "Social", "Individual")
    assert row["emenda_vitrine"]


def test_field_profile(raw_frame):
    df = raw_frame([record(f"{i:03d}", subfuncao=None if i < 2 else "", autor=f"a{i % 3}") for i in range(30)])
    got = {r["campo"]: r for r in profile.profile_fields(df, "codigoEmenda").collect()}
    assert (got["codigoEmenda"]["cardinalidade"], got["codigoEmenda"]["valores_unicos"]) == (30, None)
    assert got["autor"]["valores_unicos"] == ["a0", "a1", "a2"] and got["autor"]["exemplo"] == "a0"
    empty = got["subfuncao"]
    assert (empty["tipo"], empty["nulos"], empty["cardinalidade"], empty["exemplo"]) == ("null", 30, 0, None)
    assert empty["valores_unicos"] == []
    assert got["ano"]["tipo"] == "int" and got["ano"]["total"] == 30


def test_documents_keep_their_value_types(spark, write_json):
    path = write_json("d.json", [{"a": "x", "b": 1}, {"a": 2, "b": 2.5}, {"a": "y"}, {"a": "", "b": True}])
    got = {r["campo"]: r for r in profile.profile_documents(raw.read_documents(spark, path)).collect()}
    assert (got["a"]["tipo"], got["a"]["total"], got["a"]["nulos"]) == ("str", 4, 1)
    assert (got["b"]["total"], got["b"]["nulos"], got["b"]["cardinalidade"]) == (4, 1, 3)
    assert got["a"]["exemplo"] == "x" and got["a"]["valores_unicos"] == ["2", "x", "y"]


def test_row_counts_come_with_the_write(spark, tmp_path):
    df, seen = profile.observed(spark.range(1000).where("id % 2 = 0"))
    df.write.parquet(str(tmp_path / "x"))
    assert seen.get["rows"] == 500


def test_fingerprint_ignores_order_but_not_content(spark):
    df = spark.range(1000).select("id", F.when(F.col("id") > 5, F.lit("x")).alias("v"))
    base = profile.fingerprint(df).first()["hash"]
    assert profile.fingerprint(df.repartition(5)).first()["hash"] == base
    assert profile.fingerprint(df.unionAll(df.limit(1))).first()["hash"] != base
    assert profile.fingerprint(df.withColumn("v", F.coalesce("v", F.lit("")))).first()["hash"] != base


def test_page_files_land_once_each(spark, write_json, tmp_path):
    pages, target, checkpoint = (str(tmp_path / p) for p in ("pages", "landed", "checkpoint"))
    write_json("pages/pagina_1.json", [record("A"), record("B")])
    write_json("pages/pagina_3.json", [record("C")])
    assert streaming.land_new_pages(spark, pages, target, checkpoint) == 3
    assert not raw.page_completeness(spark.read.parquet(target)).first()["completa"]
    assert streaming.land_new_pages(spark, pages, target, checkpoint) == 0
    write_json("pages/pagina_2.json", [record("D")])
    assert streaming.land_new_pages(spark, pages, target, checkpoint) == 1
    landed = spark.read.parquet(target)
    assert sorted(r["codigoEmenda"] for r in landed.collect()) == ["A", "B", "C", "D"]
    assert raw.page_completeness(landed).first()["completa"]
