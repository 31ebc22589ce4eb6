"""Append-only raw landing with a ledger that makes loads idempotent.

Files are written once and never changed or replaced. A ledger entry is a file of its own
that must not exist before, and the only thing that makes a folder of rows a load.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.profile import field_sketches, fingerprint, merged_profile, profile_document, profile_fields
from ..staging import create_if_absent, exists, found, remove, write_counted

LEDGER = "ano long, arquivo string, hash string, registros long, coletado_em string, modo string"


class EmptyLoad(ValueError):
    """A load without rows."""


class IncompleteLoad(ValueError):
    """A page set with gaps."""


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger entries, none if nothing was ever loaded; unreadable lines are left out."""
    if not exists(spark, f"{folder}/ledger"):
        return spark.createDataFrame([], LEDGER)
    entries = spark.read.schema(LEDGER).option("mode", "DROPMALFORMED").json(f"{folder}/ledger")
    return entries.where("ano is not null and arquivo is not null")


def current_entries(ledger: DataFrame) -> DataFrame:
    """The newest entry of each year: a reload replaces the load before it."""
    newest = Window.partitionBy("ano").orderBy(F.desc("coletado_em"), F.desc("arquivo"))
    return ledger.withColumn("_rn", F.row_number().over(newest)).where("_rn = 1").drop("_rn")


def pending(batch: DataFrame, ledger: DataFrame, force: bool = False, key: str = "ano") -> DataFrame:
    """Rows of ``batch`` whose key has no ledger entry; all of them with ``force``.

    Spark broadcasts the ledger's keys if their size allows it, as it does for a ledger
    with one entry per load.
    """
    return batch if force else batch.join(ledger.select(key).distinct(), key, "left_anti")


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise EmptyLoad("the load has no rows")
    return df


def require_complete(completeness: DataFrame) -> None:
    """All or nothing: a collection with a missing page must not be landed."""
    broken = [row[0] for row in completeness.where(~F.col("completa")).collect()]
    if broken:
        raise IncompleteLoad(f"missing pages for {broken}")


def _entry_number(path: str) -> int:
    return int(path.rsplit("-", 1)[1].removesuffix(".json"))


def _record(spark: SparkSession, folder: str, entry: dict, force: bool) -> bool:
    """Write the year's next ledger entry; False if the year has one already, unless
    ``force``. Entries of a year are numbered, and a number is given once: of two loads
    that come at a time, one is recorded first and the other sees it. The times of a year's
    entries rise with their numbers, whatever the clocks say."""
    year = entry["ano"]
    while True:
        numbers = [_entry_number(path) for path, _ in found(spark, f"{folder}/ledger/{year}-*.json")]
        before = read_ledger(spark, folder).where(F.col("ano") == year).agg(F.max("coletado_em")).first()[0]
        if before is not None and not force:
            return False
        now = datetime.now(UTC)
        if before is not None:
            now = max(now, _moment(before) + timedelta(microseconds=1))
        entry |= {"coletado_em": now.isoformat(timespec="microseconds")}
        path = f"{folder}/ledger/{year}-{max(numbers, default=0) + 1:08d}.json"
        if create_if_absent(spark, path, json.dumps(entry)):
            return True


def _moment(text: str) -> datetime:
    try:
        moment = datetime.fromisoformat(text)
    except ValueError:
        return datetime.fromtimestamp(0, UTC)
    return moment if moment.tzinfo else moment.replace(tzinfo=UTC)


def land(
    batch: DataFrame,
    folder: str,
    year: int,
    ingest_id: str,
    position: str | None = None,
    mode: str = "api",
    force: bool = False,
    profile: bool = True,
    exact: bool = True,
) -> bool:
    """Land one year and record it; False if the ledger shows it was loaded before.

    What is landed never changes: each attempt writes a folder of its own, also under an
    ``ingest_id`` that was used before, and becomes the year's load by its ledger entry
    alone, which is written last and names the folder. An attempt that fails at any point,
    a forced reload too, leaves the load before it; its folder is removed here, or, after
    a lost driver, by ``remove_unfinished``. Of two writers of one year the ledger takes
    one, and the other returns False; with ``force`` it is recorded after the first.

    The entry holds the time of the load, which says what is current: ``ingest_id`` only
    names the load. ``profile`` also describes all fields, as a document and as sketches
    that ``read_profile`` merges. ``exact`` counts the distinct values of every field, which
    moves each of them once; without it the document has the sketches' estimates.
    """
    spark = batch.sparkSession
    if not force and not read_ledger(spark, folder).where(F.col("ano") == year).isEmpty():
        return False
    place = f"ano={year}/ingest_id={ingest_id}/tentativa=t{uuid.uuid4().hex}"
    target, description, sketched = f"{folder}/dados/{place}", f"{folder}/perfil/{place}", f"{folder}/esbocos/{place}"
    rows = batch.drop("ano")
    recorded = False
    try:
        if not write_counted(rows, target):
            raise EmptyLoad("the load has no rows")
        landed = spark.read.schema(rows.schema).parquet(target)
        print_of = fingerprint(landed).first()
        if profile:
            at = position or rows.columns[0]
            field_sketches(landed, at, rows.columns).coalesce(1).write.parquet(sketched)
            described = profile_fields(landed, at, rows.columns) if exact else merged_profile(spark.read.parquet(sketched))
            envelope = profile_document(described, print_of["registros"], len(rows.columns), target, year)
            envelope.write.json(description)
        entry = {"ano": year, "arquivo": target, "hash": print_of["hash"], "registros": print_of["registros"], "modo": mode}
        recorded = _record(spark, folder, entry, force)
        return recorded
    finally:
        if not recorded:
            for path in (target, description, sketched):
                remove(spark, path)


def remove_unfinished(spark: SparkSession, folder: str, older_than: timedelta = timedelta(days=1)) -> list[str]:
    """Remove attempts that no ledger entry names, if they are older than any load takes;
    returns their places. Loads that were replaced are history and stay."""
    named = {row["arquivo"].rsplit("/dados/", 1)[-1] for row in read_ledger(spark, folder).collect()}
    limit = (datetime.now(UTC) - older_than).timestamp() * 1000
    gone = []
    for path, changed in found(spark, f"{folder}/dados/ano=*/ingest_id=*/tentativa=*"):
        place = path.rsplit("/dados/", 1)[-1]
        if place not in named and changed <= limit:
            for kind in ("dados", "perfil", "esbocos"):
                remove(spark, f"{folder}/{kind}/{place}")
            gone.append(place)
    return gone


def read_profile(spark: SparkSession, folder: str, years: Sequence[int] | None = None) -> DataFrame:
    """The profile of all current loads, or of those of some years, merged from what lies
    beside each of them: no load is read again. Loads without a profile have no part."""
    current = current_entries(read_ledger(spark, folder))
    if years is not None:
        current = current.where(F.col("ano").isin(list(years)))
    paths = [row["arquivo"].replace("/dados/", "/esbocos/") for row in current.collect()]
    paths = [path for path in paths if exists(spark, path)]
    if not paths:
        raise EmptyLoad(f"no profile in {folder}")
    sketches = spark.read.option("basePath", f"{folder}/esbocos").parquet(*paths)
    return merged_profile(sketches, ["ano"])


def read_landed(
    spark: SparkSession, folder: str, years: Sequence[int] | None = None, schema: StructType | None = None
) -> DataFrame:
    """The current load of each year. History stays on disk; the ledger's partitions
    alone are read, and ``years`` prunes them further.

    Loads with different columns are united by name: under ``schema``, or else under the
    union of their own schemas, for which Spark has to open every file.
    """
    current = current_entries(read_ledger(spark, folder))
    if years is not None:
        current = current.where(F.col("ano").isin(list(years)))
    paths = [row["arquivo"] for row in current.orderBy("ano").collect()]
    if not paths:
        raise EmptyLoad(f"nothing landed in {folder}")
    reader = spark.read.option("basePath", f"{folder}/dados")
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    return reader.parquet(*paths).drop("tentativa")
