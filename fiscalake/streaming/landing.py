"""Landing page files as they arrive, each exactly once, up to a load of whole years.

Each batch of a stream becomes a folder of its own and one entry, which must not be there
before and lists the pages and where they are. The entries are the state: which pages of a
year there are, in which batch. A year whose pages are complete is landed from them.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import RAW
from ..sources.landing import land, read_ledger
from ..sources.raw import page_number
from ..staging import create_if_absent, exists, remove

PAGES = "ano long, pagina int, linhas long, lugar string, lote long"


def new_pages(spark: SparkSession, folder: str, lines: bool = False) -> DataFrame:
    """The page files of ``folder`` as a stream of records with their page number."""
    stream = spark.readStream.schema(RAW).option("multiLine", not lines).option("pathGlobFilter", "*.json")
    stream = stream.option("recursiveFileLookup", True).json(folder)
    return stream.withColumn("pagina", page_number(F.col("_metadata.file_path")))


def land_new_pages(spark: SparkSession, folder: str, target: str, checkpoint: str, lines: bool = False) -> int:
    """Append all files that were not landed before and stop; returns the rows landed.

    The stream's checkpoint is the ledger of files: a run that is repeated, or broken off
    and started again, neither repeats nor loses one. What has landed so far may still be
    incomplete, so check it with ``page_completeness`` before it becomes a load.
    """
    before = _landed_rows(spark, target)
    query = (
        new_pages(spark, folder, lines)
        .writeStream.format("parquet")
        .partitionBy("ano")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(target)
    )
    query.awaitTermination()
    return _landed_rows(spark, target) - before


def _landed_rows(spark: SparkSession, target: str) -> int:
    """Rows of the finished batches; Parquet counts them from its footers."""
    if not exists(spark, f"{target}/_spark_metadata"):
        return 0
    return spark.read.schema("_ long").parquet(target).count()


def _record_batch(batch: DataFrame, number: int, target: str) -> None:
    """Write a batch's rows and its entry. A batch that comes again, after a failure
    between its entry and the stream's own, finds the entry and leaves it."""
    spark = batch.sparkSession
    entry = f"{target}/lotes/{number:010d}.json"
    if exists(spark, entry):
        return
    place = f"{target}/paginas/lote={number}/tentativa=t{uuid.uuid4().hex}"
    batch.write.parquet(place)
    # One row per page of the batch, as many as files at most.
    pages = spark.read.schema(batch.schema).parquet(place).groupBy("ano", "pagina").count().collect()
    lines = [json.dumps({"ano": p["ano"], "pagina": p["pagina"], "linhas": p["count"], "lugar": place, "lote": number}) for p in pages]
    if not (lines and create_if_absent(spark, entry, "\n".join(lines))):
        remove(spark, place)


def collected(spark: SparkSession, target: str) -> DataFrame:
    """(ano, pagina, linhas, lugar, lote) of each page that has come; a page that came
    again counts as it came last."""
    if not exists(spark, f"{target}/lotes"):
        return spark.createDataFrame([], PAGES)
    pages = spark.read.schema(PAGES).json(f"{target}/lotes").where("ano is not null and pagina is not null")
    newest = pages.groupBy("ano", "pagina").agg(F.max_by(F.struct("linhas", "lugar", "lote"), "lote").alias("p"))
    return newest.select("ano", "pagina", "p.*")


def complete_years(pages: DataFrame, expected: Mapping[int, int] | None = None, page_size: int | None = None) -> DataFrame:
    """Per year: pages, the highest, rows, and whether all have come: 1 to the highest
    without a gap, and the highest is the last, as ``expected`` says, which has the number
    of pages of some years, or as it has fewer than ``page_size`` rows."""
    per_year = pages.groupBy("ano").agg(
        F.count("pagina").alias("paginas"),
        F.min("pagina").alias("primeira"),
        F.max("pagina").alias("ultima"),
        F.sum("linhas").alias("registros"),
        F.max_by("linhas", "pagina").alias("_last"),
        F.max("lote").alias("lote"),
    )
    unbroken = (F.col("primeira") == 1) & (F.col("ultima") == F.col("paginas"))
    ended = F.lit(False)
    if expected:
        known = F.create_map(*[F.lit(x) for pair in expected.items() for x in pair])
        ended = ended | F.coalesce(known[F.col("ano").cast("int")] == F.col("ultima"), F.lit(False))
    if page_size:
        ended = ended | (F.col("_last") < page_size)
    return per_year.withColumn("completa", unbroken & ended).drop("_last")


def land_pages(
    spark: SparkSession, folder: str, target: str, checkpoint: str, landed: str,
    expected: Mapping[int, int] | None = None, page_size: int | None = None, lines: bool = False, profile: bool = True,
) -> list[int]:
    """Take in the page files that have come since the last run, and land, in the folder
    ``landed``, each year that is complete now and has no load yet. Returns the years landed.

    Runs that are broken off anywhere are simply repeated: batches are recorded once, and a
    year is landed from recorded pages only. See ``complete_years`` for when one is complete.
    """
    query = (
        new_pages(spark, folder, lines)
        .writeStream.foreachBatch(lambda batch, number: _record_batch(batch, number, target))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    pages = collected(spark, target)
    ready = complete_years(pages, expected, page_size).where("completa")
    ready = ready.join(read_ledger(spark, landed).select("ano").distinct(), "ano", "left_anti")
    done = []
    for year in ready.orderBy("ano").collect():
        own = pages.where(F.col("ano") == year["ano"])
        places = [row["lugar"] for row in own.select("lugar").distinct().collect()]
        base = spark.read.option("basePath", f"{target}/paginas").parquet(*places)
        rows = base.where(F.col("ano") == year["ano"]).join(own.select("pagina", "lote"), ["pagina", "lote"], "left_semi")
        if land(rows.drop("lote", "tentativa"), landed, year["ano"], f"lote_{year['lote']}", "pagina", "paginas", profile=profile):
            done.append(year["ano"])
    return done
