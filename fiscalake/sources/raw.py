"""Raw JSON documents and the choice of the current one per year."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schemas import RAW
from .arrays import read_arrays

# The names raw files are landed under.
RAW_NAME = r"^emendas_(\d{4})_(\d{8}_\d{6})\.json$"
SAMPLE_NAME = r"^emendas_(\d{4})_sample\.json$"
PAGE_NAME = r"(\d+)\.json$"
PAGE_FOLDER = r"/pagina=(\d+)/"

LISTING = "path string, arquivo string"


class NoRawData(FileNotFoundError):
    """No raw file can be selected."""


def read_json(
    spark: SparkSession, paths: str | Sequence[str], positioned: bool = False, lines: bool = False
) -> DataFrame:
    """JSON files united by column name; absent fields are NULL.

    A file holds one JSON array, or with ``lines`` one object or array per line. Spark
    gives an array file to one task here; ``arrays.read_arrays`` splits it.
    With ``positioned``, ``_file`` and ``_at`` give each record's place in its file.
    """
    reader = spark.read.schema(RAW).option("multiLine", not lines)
    df = reader.json(paths if isinstance(paths, str) else list(paths))
    if positioned:
        df = df.select("*", F.col("_metadata.file_path").alias("_file"), F.monotonically_increasing_id().alias("_at"))
    return df


def read_documents(spark: SparkSession, paths: str | Sequence[str], lines: bool = False) -> DataFrame:
    """The same records as VARIANT objects ``v``, which keep each value's own type, with
    their place ``_at``."""
    files = (
        spark.read.option("singleVariantColumn", "v")
        .option("multiLine", not lines)
        .json(paths if isinstance(paths, str) else list(paths))
        .select("v", F.monotonically_increasing_id().alias("_file"))
    )
    if lines:
        return files.select("v", F.struct("_file").alias("_at"))
    items = files.lateralJoin(spark.tvf.variant_explode(F.col("v").outer()))
    return items.select(F.col("value").alias("v"), F.struct("_file", "pos").alias("_at"))


def parse_name(name: Column) -> dict[str, Column]:
    """Year and load time out of a raw file name; NULL where it is not one."""

    def group(pattern: str, i: int) -> Column:
        return F.nullif(F.regexp_extract(name, pattern, i), F.lit(""))

    return {
        "ano": F.coalesce(group(RAW_NAME, 1), group(SAMPLE_NAME, 1)).cast("int"),
        "carimbo": group(RAW_NAME, 2),
        "amostra": name.rlike(SAMPLE_NAME),
    }


def list_files(spark: SparkSession, folder: str, pattern: str = "emendas_*.json") -> DataFrame:
    """(path, arquivo) of the files in a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    return files.select("path", F.element_at(F.split("path", "/"), -1).alias("arquivo"))


def select_current(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """(ano, arquivo, path, origem): one raw file per year.

    The newest ledger entry of a year points at its file; entries whose file is gone do
    not count. Only if no entry at all is usable do file names decide: the newest
    timestamp of a year, else its sample.
    """
    newest = Window.partitionBy("ano").orderBy(F.desc("coletado_em"), F.desc("arquivo"))
    recorded = (
        ledger.select("ano", F.element_at(F.split("arquivo", "/"), -1).alias("arquivo"), "coletado_em")
        .join(files, "arquivo")
        .withColumn("_rn", F.row_number().over(newest))
        .where("_rn = 1")
        .select("ano", "arquivo", "path", F.lit("ledger").alias("origem"))
    )
    named = files.withColumns(parse_name(F.col("arquivo"))).where("ano is not null")
    best = Window.partitionBy("ano").orderBy(F.desc_nulls_last("carimbo"), F.desc("arquivo"))
    by_name = (
        named.withColumn("_rn", F.row_number().over(best))
        .where("_rn = 1")
        .select("ano", "arquivo", "path", F.when(F.col("amostra"), "amostra").otherwise("nome").alias("origem"))
    )
    usable = recorded.agg(F.count(F.lit(1))).scalar()
    return recorded.unionByName(by_name.where(usable == 0))


def current_paths(spark: SparkSession, folder: str, ledger: DataFrame) -> list[str]:
    """Paths of the selected files in the order of their years: one per year."""
    chosen = select_current(list_files(spark, folder), ledger).orderBy("ano").collect()
    if not chosen:
        raise NoRawData(f"no raw file in {folder}")
    return [row["path"] for row in chosen]


def page_number(path: Column) -> Column:
    """The page a file holds: that of the folder ``pagina=N`` it is in, else the number at
    the end of its name."""
    numbers = [F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")) for pattern in (PAGE_FOLDER, PAGE_NAME)]
    return F.coalesce(*numbers).cast("int")


def read_pages(spark: SparkSession, folder: str, lines: bool = False) -> DataFrame:
    """The page files of one collection as one table with their page number ``pagina``.
    A file holds one JSON array, which can be split, or with ``lines`` one object or array
    per line."""
    if not lines:
        rows = read_arrays(spark, folder, positioned=True)
        return rows.withColumn("pagina", page_number(F.col("_file"))).drop("_file", "_at")
    df = spark.read.schema(RAW).option("recursiveFileLookup", True).json(folder)
    return df.withColumn("pagina", page_number(F.col("_metadata.file_path")))


def page_completeness(pages: DataFrame, by: str = "ano", page: str = "pagina") -> DataFrame:
    """Per collection: pages seen, highest page, and whether 1..highest is unbroken."""
    return (
        pages.groupBy(by, page)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(by)
        .agg(
            F.count(page).alias("paginas"),
            F.min(page).alias("primeira"),
            F.max(page).alias("ultima"),
            F.sum("_rows").alias("registros"),
        )
        .withColumn("completa", (F.col("primeira") == 1) & (F.col("ultima") == F.col("paginas")))
    )
