"""The layers one after another, written out, with the gates between them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contract import enforce
from ..operators.profile import data_dictionary
from ..rules import DEFAULT_RULES, Rules
from ..schemas import MONEY
from ..sources import raw
from ..sources.landing import land, read_landed, read_ledger, require_rows
from ..sources.arrays import read_arrays
from ..sources.layers import dictionary_json, staged, staging_place, write_tables
from ..staging import Staged, published
from . import cleaning, features, mart, serving


def publish_trusted(records: DataFrame, position: Sequence[str], folder: str, rules: Rules = DEFAULT_RULES) -> dict:
    """Contract, discard gate, then the write: a failed gate leaves the old table alone.
    Returns the quality summary."""
    window = cleaning.in_window(records, rules)
    checked = enforce(window, cleaning.raw_contract(rules), position)
    # Rows outside the years are read and counted, too.
    quality = cleaning.require_quality(cleaning.discard_summary(records, position, rules), rules)
    trusted = cleaning.trusted_zero(checked, position, rules)
    write_tables({"emendas_trusted": mart.published(trusted)}, folder)
    return quality


def publish_trusted_and_quarantine(
    records: DataFrame,
    tie_break: Sequence[str],
    staging_path: str,
    trusted_folder: str,
    quarantine_folder: str,
    rules: Rules = DEFAULT_RULES,
    force: bool = False,
) -> dict[str, int]:
    """The null-keeping flavour with its quarantine. Returns the row counts. Name
    ``staging_path`` with ``layers.staging_place``, so that other loads are staged anew."""
    staging = staged(cleaning.staging_rows(records, rules), staging_path, force)
    require_rows(staging)
    rejected = mart.published(cleaning.quarantine(staging, rules))
    trusted = mart.published(cleaning.trusted_null(staging, tie_break, rules))
    counts = {"staging": staging.count()}
    counts |= write_tables({"emendas_financeiro_invalido": rejected}, quarantine_folder, "zstd")
    counts |= write_tables({"emendas_trusted": trusted}, trusted_folder, "zstd")
    return counts


def read_trusted(spark: SparkSession, folder: str) -> DataFrame:
    """The published trusted table with money as decimals again, for exact sums."""
    df = published(spark, f"{folder}/emendas_trusted.parquet").df
    amounts = {name: F.col(name).cast(MONEY) for name, dtype in df.dtypes if dtype == "double"}
    return df.withColumns(amounts)


def publish_mart(trusted: DataFrame, folder: str, rules: Rules = DEFAULT_RULES) -> dict[str, int]:
    """All mart tables, the analytic views as tables, and the data dictionary."""
    star = mart.build(trusted, rules)
    counts = write_tables(star.tables(), folder)
    dictionary_json(data_dictionary(star.tables()), f"{folder}/dicionario_dados.json")
    return counts


def read_star(spark: SparkSession, folder: str) -> mart.Star:
    """The published mart, its sizes known from when it was written."""

    def table(name: str) -> Staged:
        return published(spark, f"{folder}/{name}.parquet")

    fact = table("fato_emendas").df
    money = [c for c, dtype in fact.dtypes if dtype == "double" and c != "taxa_execucao_pct"]
    return mart.Star(
        table("dim_tempo").df,
        table("dim_funcao"),
        table("dim_localidade"),
        table("dim_autor"),
        fact.withColumns({c: F.col(c).cast(MONEY) for c in money}),
    )


def publish_views(star: mart.Star, folder: str, rules: Rules = DEFAULT_RULES) -> dict[str, int]:
    return write_tables(mart.views(star.fato_emendas, rules), folder)


def cube_place(spark: SparkSession, folder: str) -> str:
    """Where the cube of the published fact is: its name holds the fact's version, so a fact
    that is published anew has a cube of its own."""
    return f"{folder}/cubo-{published(spark, f'{folder}/fato_emendas.parquet').path.rsplit('/', 1)[-1]}"


def read_cube(spark: SparkSession, folder: str) -> DataFrame:
    """The cube of the published fact, made on first use: the dashboard's figures are read
    from it in place of the records. Money is decimal, for exact sums."""
    return staged(serving.cube(read_star(spark, folder).fato_emendas), cube_place(spark, folder))


def publish_features(star: mart.Star, folder: str, rules: Rules = DEFAULT_RULES) -> dict[str, int]:
    table = features.features(star.fato_emendas, rules)
    return write_tables({"features": table}, folder)


def run_all(
    spark: SparkSession,
    raw_folder: str,
    target: str,
    rules: Rules = DEFAULT_RULES,
    force: bool = False,
    lines: bool = False,
    profile: bool = True,
    keep_nulls: bool = False,
) -> dict[str, int]:
    """Current raw files -> landed loads -> trusted -> mart, views and features.

    Each year is landed once unless ``force``; the later layers are always rebuilt from
    the current loads. A gate that fails stops the run before its layer is replaced.
    ``lines``: files hold lines instead of one array each; many tasks read either.
    ``profile``: describe the fields of each load, unless switched off. ``keep_nulls``: the null-keeping flavour
    of cleaning, with its quarantine.
    """
    landed, trusted_folder, mart_folder = f"{target}/raw", f"{target}/trusted", f"{target}/mart"
    files = raw.select_current(raw.list_files(spark, raw_folder), read_ledger(spark, raw_folder))
    chosen = files.where(F.col("ano").isin(rules.years)).orderBy("ano").collect()
    if not chosen:
        raise raw.NoRawData(f"no raw file in {raw_folder}")
    read = partial(raw.read_json, lines=True) if lines else read_arrays
    for row in chosen:
        batch = read(spark, row["path"], positioned=True)
        land(batch, landed, row["ano"], row["arquivo"].removesuffix(".json"), "_at", row["origem"], force, profile)
    # All loads have the schema of the reader, so no file has to be opened to find it.
    known = batch.drop("ano").schema.add("ano", "long").add("ingest_id", "string")
    records = read_landed(spark, landed, schema=known).withColumn("ano", F.col("ano").cast("long"))
    if keep_nulls:
        publish_trusted_and_quarantine(
            records, ["_file", "_at"], staging_place(spark, landed, f"{target}/staging"), trusted_folder, f"{target}/quarantine", rules
        )
    else:
        publish_trusted(records, ["ano", "_file", "_at"], trusted_folder, rules)
    counts = publish_mart(read_trusted(spark, trusted_folder), mart_folder, rules)
    star = read_star(spark, mart_folder)
    return counts | publish_views(star, mart_folder, rules) | publish_features(star, f"{target}/feat", rules)
