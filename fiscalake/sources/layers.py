"""Writing layers, and reading the most processed one there is."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.cleaning import typed
from ..plans.serving import with_serving_columns
from ..rules import DEFAULT_RULES, Rules
from ..staging import exists, is_published, published, replace_table, submit
from . import raw
from .arrays import read_arrays
from .landing import current_entries, read_ledger


class NoLayer(FileNotFoundError):
    """Neither mart, trusted nor raw data exist."""


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The table published at ``path``, or None if there is none."""
    return published(spark, path).df if is_published(spark, path) else None


def register_table(spark: SparkSession, path: str, view: str) -> DataFrame:
    """A lazily scanned Parquet table under a view name."""
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(view)
    return df


def write_tables(tables: Mapping[str, DataFrame], folder: str, compression: str = "snappy") -> dict[str, int]:
    """Each table as Parquet of its own, all at the same time, and each replacing the one
    there only when it is complete; returns the rows written, counted on the way."""
    with ThreadPoolExecutor() as pool:
        waiting = {
            name: submit(pool, replace_table, df, f"{folder}/{name}.parquet", compression)
            for name, df in tables.items()
        }
        return {name: written.result() for name, written in waiting.items()}


def staged(df: DataFrame, path: str, force: bool = False, compression: str = "zstd") -> DataFrame:
    """``df`` written to ``path`` once; a finished table there is read instead unless
    ``force``. ``staging_place`` names ``path`` after the loads that ``df`` comes from."""
    spark = df.sparkSession
    if force or not is_published(spark, path):
        replace_table(df, path, compression)
    return published(spark, path).df


def loads_key(ledger: DataFrame) -> str:
    """What the current loads of a ledger hold, as one name: the same for the same rows,
    another one after any load of other rows. A ledger has one current entry per year."""
    current = current_entries(ledger).select(F.concat_ws("/", "ano", "registros", "hash").alias("one"))
    listed = current.agg(F.array_join(F.array_sort(F.collect_list("one")), ";").alias("all"))
    return listed.select(F.substring(F.sha2("all", 256), 1, 24)).first()[0]


def staging_place(spark: SparkSession, landed: str, path: str) -> str:
    """``path`` with the key of the loads in the folder ``landed``: a table staged there is
    reused as long as the loads are the same, and made anew when one has changed."""
    return f"{path}-{loads_key(read_ledger(spark, landed))}"


def best_layer(
    spark: SparkSession, mart: str, trusted: str, raw_files: str, rules: Rules = DEFAULT_RULES, lines: bool = False
) -> DataFrame:
    """The mart's fact with its dimension attributes, else the trusted table, else raw
    JSON with parsed amounts; columns a lower layer lacks are derived."""
    fact = read_table(spark, f"{mart}/fato_emendas.parquet")
    if fact is not None:
        attributes = [
            ("dim_localidade", "localidade_id", "regiao"),
            ("dim_funcao", "funcao", "area_tematica"),
            ("dim_autor", "autor_id", "tipo_simplificado"),
        ]
        for table, key, attribute in attributes:
            dim = read_table(spark, f"{mart}/{table}.parquet")
            if dim is not None:
                # A stored table's size is known: Spark broadcasts it if small, else
                # shuffles and lets adaptive execution split skewed keys.
                fact = fact.join(dim.select(key, attribute), key, "left")
        return with_serving_columns(fact, rules)
    table = read_table(spark, trusted)
    if table is not None:
        return with_serving_columns(table, rules)
    if not exists(spark, raw_files):
        raise NoLayer("run the cleaning and mart steps first")
    records = raw.read_json(spark, raw_files, lines=True) if lines else read_arrays(spark, raw_files)
    return with_serving_columns(typed(records, "keep"), rules)


def dictionary_json(dictionary: DataFrame, folder: str) -> None:
    """The data dictionary as JSON: one document per table with its columns in order."""
    columns = ["column_name", "column_type", "null", "key", "default", "extra"]
    documents = dictionary.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("position", *columns))).alias("columns")
    )
    documents.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(folder)
