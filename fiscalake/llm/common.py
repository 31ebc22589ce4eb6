"""Small helpers the operators share: columns by exact name, words, batches, staging."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from itertools import islice
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..staging import stage

WHITE = b" \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _tell_workers(spark: SparkSession) -> None:
    """In a local session, Python workers look for this package where the driver found it,
    also if that is on the driver's path only. On a cluster it is installed or shipped."""
    context = spark.sparkContext
    root = str(Path(__file__).resolve().parents[2])
    known = context.environment.get("PYTHONPATH", "")
    if context.master.startswith("local") and root not in known.split(os.pathsep):
        context.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (root, known)))


def pick(df: DataFrame, *names: str) -> DataFrame:
    """The columns of exactly these names, first of each, whatever else the frame holds
    (names that differ in case only would make a plain select ambiguous)."""
    _tell_workers(df.sparkSession)
    plain = df.toDF(*(f"_{i}" for i in range(len(df.columns))))
    return plain.select(*(F.col(f"_{df.columns.index(n)}").alias(n) for n in names))


def staged(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, and every
    reader sees the same rows in the same files even after an executor is lost. With
    ``keep`` it outlasts the scratch block it is made in."""
    return stage(df, f"llm-{name}", keep=keep).df


def shuffles(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % n


def in_fold(doc_id: Column, n: int, k: int) -> Column:
    """Whether the id falls in fold ``k``; false for a null id."""
    return F.coalesce(fold(doc_id, n) == k, F.lit(False))


def out_of_fold(doc_id: Column, n: int, k: int) -> Column:
    """Whether the id falls in another fold than ``k``; false for a null id."""
    return F.coalesce(fold(doc_id, n) != k, F.lit(False))


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict]], schema: str, size: int = 1000) -> DataFrame:
    """mapInArrow over slices of at most ``size`` rows. ``fn`` takes a slice and yields
    dicts of columns; ``schema`` is a DDL string whose columns they hold, in order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, size):
                for out in fn(batch.slice(at, size)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow
                    )

    return df.mapInArrow(run, schema)


def raw(column: pa.Array) -> list[bytes | None]:
    """A text column as UTF-8 bytes."""
    return column.cast(pa.binary()).to_pylist()


class _Ids(dict):
    """Numbers given out on first sight."""

    def __missing__(self, word):
        self[word] = number = len(self)
        return number


class Numbered:
    """Numbers for words in the order of first sight, forgotten when there are too many,
    so that a worker's memory does not grow with the corpus."""

    def __init__(self, limit: int, on_reset: Callable[[], None] | None = None):
        self.limit, self.on_reset = limit, on_reset
        self.ids = _Ids()

    def make_room(self) -> None:
        """Call between documents: numbers given out earlier end here."""
        if len(self.ids) > self.limit:
            self.ids.clear()
            if self.on_reset:
                self.on_reset()

    def number(self, words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
        """The words' numbers, and the words not seen before, in the order of their numbers."""
        ids, start = self.ids, len(self.ids)
        out = np.fromiter(map(ids.__getitem__, words), np.int64, len(words))
        return out, list(islice(reversed(ids), len(ids) - start))[::-1]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit numbers."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x
