"""Loads that cannot be lost: attempts, ledger entries, concurrent writers, page streams."""

from datetime import timedelta
from threading import Barrier, Thread

import pytest
from pyspark.sql import functions as F

from fiscalake.operators import profile
from fiscalake.sources import landing, layers
from fiscalake.staging import create_if_absent, exists, found, remove
from fiscalake.streaming import landing as stream

from .conftest import record


def codes(spark, folder, years=None):
    return sorted(r["codigoEmenda"] for r in landing.read_landed(spark, folder, years).collect())


def failing(df):
    """Rows of which the last cannot be computed."""
    return df.withColumn("funcao", F.when(F.col("codigoEmenda") == "BAD", F.raise_error(F.lit("lost"))).otherwise(F.col("funcao")))


def test_a_failed_reload_leaves_the_load_before_it(spark, raw_frame, tmp_path):
    folder = str(tmp_path / "raw")
    assert landing.land(raw_frame([record("A")]), folder, 2023, "same")
    broken = failing(raw_frame([record("B"), record("BAD")]))
    for name in ("same", "other"):
        with pytest.raises(Exception, match="lost"):
            landing.land(broken, folder, 2023, name, force=True)
        with pytest.raises(landing.EmptyLoad):
            landing.land(raw_frame([]), folder, 2023, name, force=True)
        assert codes(spark, folder) == ["A"] and landing.read_ledger(spark, folder).count() == 1
    assert len(found(spark, f"{folder}/dados/ano=2023/*/*")) == 1
    # Under the same name a good reload replaces what is current, not what was written.
    assert landing.land(raw_frame([record("C")]), folder, 2023, "same", force=True)
    assert codes(spark, folder) == ["C"]
    assert sorted(r["codigoEmenda"] for r in spark.read.parquet(f"{folder}/dados").collect()) == ["A", "C"]


def test_a_failure_before_the_entry_leaves_no_load(spark, raw_frame, tmp_path, monkeypatch):
    folder = str(tmp_path / "raw")
    monkeypatch.setattr(landing, "_record", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        landing.land(raw_frame([record("A")]), folder, 2023, "x")
    monkeypatch.undo()
    with pytest.raises(landing.EmptyLoad):
        landing.read_landed(spark, folder)
    assert landing.land(raw_frame([record("B")]), folder, 2023, "x") and codes(spark, folder) == ["B"]


def test_entries_of_a_lost_driver_are_cleaned_up(spark, raw_frame, tmp_path):
    folder = str(tmp_path / "raw")
    landing.land(raw_frame([record("A")]), folder, 2023, "a")
    landing.land(raw_frame([record("B")]), folder, 2023, "b", force=True)
    left = f"{folder}/dados/ano=2023/ingest_id=c/tentativa=t0"
    raw_frame([record("C")]).drop("ano").write.parquet(left)
    assert landing.remove_unfinished(spark, folder) == [] and exists(spark, left)
    assert landing.remove_unfinished(spark, folder, timedelta(0)) == ["ano=2023/ingest_id=c/tentativa=t0"]
    assert not exists(spark, left) and codes(spark, folder) == ["B"]
    assert spark.read.parquet(f"{folder}/dados").count() == 2


def at_once(*jobs):
    """Run jobs together; their results in order."""
    gate, out = Barrier(len(jobs)), [None] * len(jobs)

    def run(i):
        gate.wait()
        out[i] = jobs[i]()

    threads = [Thread(target=run, args=(i,)) for i in range(len(jobs))]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


def test_of_writers_at_a_time_one_creates(spark, tmp_path):
    path = f"{tmp_path}/deep/entry.json"
    won = at_once(*[lambda i=i: create_if_absent(spark, path, f'{{"n": {i}}}') for i in range(6)])
    assert sorted(won) == [False] * 5 + [True]
    assert spark.read.json(path).first()["n"] == won.index(True)
    assert [p.name for p in (tmp_path / "deep").iterdir() if not p.name.endswith(".crc")] == ["entry.json"]


def test_two_writers_one_entry(spark, raw_frame, tmp_path, monkeypatch):
    """Both have seen an empty ledger and written their rows before either records."""
    folder, gate, plain = str(tmp_path / "raw"), Barrier(2), landing._record

    def together(*args):
        gate.wait()
        return plain(*args)

    monkeypatch.setattr(landing, "_record", together)
    jobs = [lambda c=c: landing.land(raw_frame([record(c)]), folder, 2023, c, profile=False) for c in "AB"]
    assert sorted(at_once(*jobs)) == [False, True]
    assert landing.read_ledger(spark, folder).count() == 1
    assert len(codes(spark, folder)) == 1 and spark.read.parquet(f"{folder}/dados").count() == 1
    # Two forced reloads are both recorded, one after the other.
    forced = [lambda c=c: landing.land(raw_frame([record(c)]), folder, 2023, c, force=True, profile=False) for c in "CD"]
    assert at_once(*forced) == [True, True]
    ledger = landing.read_ledger(spark, folder)
    assert ledger.count() == 3 and ledger.select("coletado_em").distinct().count() == 3
    assert codes(spark, folder)[0] in "CD"


def test_entry_tells_what_was_landed(spark, raw_frame, tmp_path):
    folder = str(tmp_path / "raw")
    rows = raw_frame([record("A"), record("B")])
    landing.land(rows, folder, 2023, "x", mode="amostra")
    (entry,) = landing.read_ledger(spark, folder).collect()
    assert (entry["ano"], entry["registros"], entry["modo"]) == (2023, 2, "amostra")
    assert entry["hash"] == profile.fingerprint(rows.drop("ano")).first()["hash"]
    assert exists(spark, f"{entry['arquivo']}/_SUCCESS")
    assert spark.read.json(f"{folder}/perfil").first()["arquivo_origem"] == entry["arquivo"]


def test_a_clock_that_goes_back_does_not_bring_back_an_old_load(spark, raw_frame, tmp_path):
    folder = str(tmp_path / "raw")
    landing.land(raw_frame([record("A")]), folder, 2023, "a", profile=False)
    future = '{"ano": 2023, "arquivo": "%s", "hash": "h", "registros": 1, "coletado_em": "2999-01-01T00:00:00+00:00", "modo": "api"}'
    target = landing.read_ledger(spark, folder).first()["arquivo"]
    assert create_if_absent(spark, f"{folder}/ledger/2023-00000002.json", future % target)
    landing.land(raw_frame([record("B")]), folder, 2023, "b", force=True, profile=False)
    assert codes(spark, folder) == ["B"]


# ---- page streams --------------------------------------------------------------------


def pages(write_json, year, *numbers, rows=3, tag=""):
    for n in numbers:
        write_json(f"pages/{tag}{year}_{n}.json", [record(f"{year}-{n}-{i}{tag}", ano=year) for i in range(rows)])


def test_pages_are_landed_when_their_year_is_complete(spark, write_json, tmp_path):
    source, target, checkpoint, landed = (str(tmp_path / p) for p in ("pages", "taken", "checkpoint", "landed"))

    def run():
        return stream.land_pages(spark, source, target, checkpoint, landed, {2023: 3}, 5, profile=False)

    pages(write_json, 2022, 1, rows=5)
    pages(write_json, 2023, 1, 3)
    assert run() == []
    assert [r["completa"] for r in stream.complete_years(stream.collected(spark, target), {2023: 3}, 5).collect()] == [False] * 2
    pages(write_json, 2022, 2, rows=2)  # shorter than a page: the last
    pages(write_json, 2023, 2)
    assert run() == [2022, 2023]
    assert landing.read_landed(spark, landed).count() == 7 + 9
    assert run() == [] and len(found(spark, f"{target}/lotes/*.json")) == 2
    ledger = {r["ano"]: r for r in landing.read_ledger(spark, landed).collect()}
    assert (ledger[2022]["registros"], ledger[2023]["modo"]) == (7, "paginas")
    # A page that comes again before its year is landed replaces the page before it.
    pages(write_json, 2021, 1, rows=4)
    pages(write_json, 2021, 2, rows=5)
    assert run() == []
    pages(write_json, 2021, 2, rows=1, tag="again")
    assert run() == [2021]
    assert codes(spark, landed, [2021]) == [*(f"2021-1-{i}" for i in range(4)), "2021-2-0again"]


def test_a_batch_that_comes_again_is_recorded_once(spark, raw_frame, tmp_path):
    target = str(tmp_path)
    batch = raw_frame([record("A")]).withColumn("pagina", F.lit(1))
    for _ in range(2):
        stream._record_batch(batch, 7, target)
    stream._record_batch(batch.limit(0), 8, target)
    assert stream.collected(spark, target).count() == 1
    assert len(found(spark, f"{target}/paginas/*/*")) == 1


# ---- staging by content --------------------------------------------------------------


def test_staging_follows_the_loads(spark, raw_frame, tmp_path):
    folder, path = str(tmp_path / "raw"), str(tmp_path / "staging")

    def staged():
        place = layers.staging_place(spark, folder, path)
        return place, sorted(r["codigoEmenda"] for r in layers.staged(landing.read_landed(spark, folder), place).collect())

    landing.land(raw_frame([record("A")]), folder, 2023, "a", profile=False)
    first = staged()
    assert first[1] == ["A"] and staged() == first
    landing.land(raw_frame([record("B")]), folder, 2023, "b", force=True, profile=False)
    assert staged()[1] == ["B"] and staged()[0] != first[0]
    landing.land(raw_frame([record("C")]), folder, 2022, "c", profile=False)
    assert staged()[1] == ["B", "C"]
    landing.land(raw_frame([record("A")]), folder, 2023, "d", force=True, profile=False)
    landing.land(raw_frame([record("C")]), folder, 2022, "e", force=True, profile=False)
    assert staged()[1] == ["A", "C"]
    assert len(found(spark, f"{path}-*")) == 4


# ---- profiles beside the loads -------------------------------------------------------


def test_profiles_are_merged_without_reading_the_loads(spark, raw_frame, tmp_path):
    folder = str(tmp_path / "raw")
    first = [record(f"A{i:03d}", ano=2022, autor=f"a{i % 15}", subfuncao=None if i % 2 else "") for i in range(90)]
    second = [record(f"B{i:03d}", autor=f"a{10 + i % 15}", subfuncao="x" if i == 7 else None) for i in range(60)]
    landing.land(raw_frame(first), folder, 2022, "a", "codigoEmenda", exact=False)
    landing.land(raw_frame([record("OLD", autor="old")]), folder, 2023, "b", "codigoEmenda")
    landing.land(raw_frame(second), folder, 2023, "c", "codigoEmenda", force=True)
    remove(spark, f"{folder}/dados")
    got = {r["campo"]: r for r in landing.read_profile(spark, folder).collect()}
    want = {r["campo"]: r for r in profile.profile_fields(raw_frame(first + second), "codigoEmenda").collect()}
    for name, row in got.items():
        for key in ("tipo", "total", "nulos", "exemplo"):
            assert row[key] == want[name][key], (name, key)
        assert row["cardinalidade"] == pytest.approx(want[name]["cardinalidade"], rel=0.05)
        # 25 authors, of which either load has 15: known, but too many to be listed.
        assert row["valores_unicos"] == want[name]["valores_unicos"]
    assert got["autor"]["cardinalidade"] == 25 and got["subfuncao"]["valores_unicos"] == ["x"]
    only = {r["campo"]: r for r in landing.read_profile(spark, folder, [2022]).collect()}
    assert len(only["autor"]["valores_unicos"]) == 15 and only["subfuncao"]["tipo"] == "null"
    with pytest.raises(landing.EmptyLoad):
        landing.read_profile(spark, folder, [1990])


# ---- staged tables -------------------------------------------------------------------


def test_blocks_of_threads_are_their_own(spark):
    from fiscalake.staging import scratch, stage

    inside, left = Barrier(2), Barrier(2)

    def first():
        with scratch(spark):
            table = stage(spark.range(3), "first").path
            inside.wait()
            left.wait()
            return spark.table(table).count()

    def second():
        inside.wait()
        with scratch(spark):
            table = stage(spark.range(5), "second").path
        gone = not spark.catalog.tableExists(table)
        left.wait()
        return gone

    assert at_once(first, second) == [3, True]


def test_work_in_a_pool_belongs_to_the_block(spark):
    from concurrent.futures import ThreadPoolExecutor

    from fiscalake.staging import scratch, stage, submit

    with scratch(spark), ThreadPoolExecutor() as pool:
        table = submit(pool, lambda: stage(spark.range(3), "pooled").path).result()
        assert spark.catalog.tableExists(table)
    assert not spark.catalog.tableExists(table)
