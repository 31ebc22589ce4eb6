"""Written tables: steps between layers, which cut lineage, and published tables.

A staged table lives in the folder the cluster names in ``spark.checkpoint.dir``, so it
outlives any executor. A local session without that setting, where all of Spark is one
process, gets one beside its tables; on a cluster the setting is asked for. Staged tables are managed tables of a scratch
database in that folder: dropping one removes its files, on any file system.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

# Tables staged inside each ``scratch`` block that is open here, innermost last. Threads have
# blocks of their own; ``submit`` gives those of the caller to work done in another thread.
_open_blocks: ContextVar[tuple[list[str], ...]] = ContextVar("open_blocks", default=())


class Staged(NamedTuple):
    """A written table, the number of rows that went into it, and its name or path."""

    df: DataFrame
    rows: int
    path: str


def staging_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder (or a match of a glob) is there, on any file system."""
    return bool(found(spark, path))


def _file_system(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def found(spark: SparkSession, pattern: str) -> list[tuple[str, int]]:
    """Path and time of change, in milliseconds, of each file or folder a glob matches."""
    hadoop, files = _file_system(spark, pattern)
    return [(s.getPath().toString(), s.getModificationTime()) for s in files.globStatus(hadoop) or []]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or a folder with all it holds, if it is there."""
    hadoop, files = _file_system(spark, path)
    files.delete(hadoop, True)


def create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not be there yet; False, and nothing written, if it is.

    The content is complete before the name appears, and of several writers one wins: the
    name is given by a rename that does not replace (a hard link on a local disk, where
    renames do). A store without such a rename needs a connector that has one."""
    jvm = spark.sparkContext._jvm
    folder, name = path.rsplit("/", 1)
    hadoop, files = _file_system(spark, path)
    draft = jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.{uuid.uuid4().hex}")
    files.mkdirs(hadoop.getParent())
    out = files.create(draft, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if files.getUri().getScheme() == "file":
            place = lambda p: jvm.java.io.File(files.makeQualified(p).toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(place(hadoop), place(draft))
        else:
            none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                files.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
            )
            context.rename(files.makeQualified(draft), files.makeQualified(hadoop), none)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in error.java_exception.getClass().getName():
            raise
        return False
    finally:
        files.delete(draft, False)
    return True


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def write_counted(df: DataFrame, path: str, compression: str = "zstd", mode: str = "error") -> int:
    """Write Parquet and return the row count, observed during the write itself."""
    rows, seen = _counted(df)
    rows.write.mode(mode).option("compression", compression).parquet(path)
    return seen.get["rows"]


# ---- published tables ----------------------------------------------------------------

VERSIONS = "number long, folder string, rows long"


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    if not exists(spark, f"{path}/versions"):
        return None
    entries = spark.read.schema(VERSIONS).option("mode", "DROPMALFORMED").json(f"{path}/versions")
    return entries.where("number is not null and folder is not null")


def _newest(spark: SparkSession, path: str):
    entries = _versions(spark, path)
    return entries and entries.orderBy(F.desc("number"), F.desc("folder")).first()


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether there is a table at ``path``: a finished version, or plain Parquet."""
    return _newest(spark, path) is not None or exists(spark, f"{path}/_SUCCESS")


def replace_table(df: DataFrame, path: str, compression: str = "snappy") -> int:
    """Publish ``df`` as the table at ``path``; returns the row count.

    Every version gets a folder of its own. The small entry that names it is written last,
    so a job that fails at any point leaves the version before it, no table is ever
    missing, and a reader that has opened the version before keeps it. Older ones go."""
    spark = df.sparkSession
    before = _versions(spark, path)
    before = sorted(before.collect(), key=lambda v: (v["number"], v["folder"])) if before else []
    folder = f"version-{uuid.uuid4().hex}"
    rows = write_counted(df, f"{path}/{folder}", compression)
    entry = [(before[-1]["number"] + 1 if before else 1, folder, rows)]
    spark.createDataFrame(entry, VERSIONS).coalesce(1).write.mode("append").json(f"{path}/versions")
    for old in before[:-1]:
        remove(spark, f"{path}/{old['folder']}")
    return rows


def published(spark: SparkSession, path: str) -> Staged:
    """The newest version of the table at ``path``, with its known size; or the plain
    Parquet table there, counted."""
    newest = _newest(spark, path)
    if newest is None:
        if not is_published(spark, path):
            raise FileNotFoundError(f"no published table at {path}")
        plain = spark.read.parquet(path)
        return Staged(plain, plain.count(), path)
    folder = f"{path}/{newest['folder']}"
    return Staged(spark.read.parquet(folder), newest["rows"], folder)


# ---- staged tables -------------------------------------------------------------------


def _scratch_database(spark: SparkSession) -> str:
    name = "scratch_" + "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{staging_root(spark)}/{name}'")
    return name


def stage(
    df: DataFrame, name: str, compression: str = "zstd", buckets: tuple[int, Sequence[str]] | None = None, keep: bool = False
) -> Staged:
    """Write ``df`` once and read it back, so that every consumer shares the work.

    ``buckets``: their number and columns; joins on these then move the other side only.
    Inside a ``scratch`` block the table goes with the block, or, with ``keep``, with the
    block around it; outside of any it stays until it is dropped with ``drop``."""
    spark = df.sparkSession
    slug = "".join(c if c.isalnum() else "_" for c in name)
    table = f"{_scratch_database(spark)}.{slug}_{uuid.uuid4().hex}"
    rows, seen = _counted(df)
    writer = rows.write.format("parquet").option("compression", compression)
    if buckets:
        writer = writer.bucketBy(buckets[0], *buckets[1])
    writer.saveAsTable(table)
    holders = _open_blocks.get()
    holders = holders[:-1] if keep else holders
    if holders:
        holders[-1].append(table)
    return Staged(spark.table(table), seen.get["rows"], table)


def drop(spark: SparkSession, staged: Staged) -> None:
    """Remove a staged table with its files."""
    spark.sql(f"DROP TABLE IF EXISTS {staged.path}")


def submit(pool: ThreadPoolExecutor, work: Callable, *args):
    """Let a pool do ``work``; what it stages belongs to the blocks open here."""
    return pool.submit(copy_context().run, work, *args)


def forget_shuffles(spark: SparkSession) -> None:
    """Have Spark remove the shuffle files of finished steps. It does so when the driver's
    garbage is collected, which a driver with much memory puts off while files pile up."""
    spark.sparkContext._jvm.System.gc()


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are removed at the end, but for those staged with ``keep``;
    what is returned from the block must depend on these alone."""
    own: list[str] = []
    before = _open_blocks.set((*_open_blocks.get(), own))
    try:
        yield
    finally:
        _open_blocks.reset(before)
        for table in own:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
