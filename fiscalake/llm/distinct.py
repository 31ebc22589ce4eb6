"""Each different text once, and what the operators on pairs of texts need around it:
compact postings, and components of links."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .common import mix64, pick, shuffles, staged


def text_key(text: Column) -> Column:
    """128 bits of SHA-256; null for null."""
    return F.unhex(F.substring(F.sha2(text.cast("binary"), 256), 1, 32))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """key, r, text and copies for each different non-null text of ``docs``, written once
    in buckets of the key: joins on the key move the other side only. ``r`` numbers the
    texts. Copies meet as one row per task, so a text may be any share of the rows."""
    spark = docs.sparkSession
    rows = pick(docs, "text").where(F.col("text").isNotNull()).select(text_key(F.col("text")).alias("key"), "text")
    each = rows.groupBy("key").agg(F.first("text").alias("text"), F.count("*").alias("copies"))
    numbered = each.select("key", F.monotonically_increasing_id().alias("r"), "text", "copies")
    return stage(numbered, "llm-texts", buckets=(shuffles(spark), ["key"])).df


def with_texts(texts: DataFrame, some: DataFrame, *columns: str) -> DataFrame:
    """The texts whose key is in ``some``, with its columns. Only ``some`` is moved."""
    return texts.select("key", *columns).join(some.hint("shuffle_hash"), "key")


# --- postings -----------------------------------------------------------------------------

BLOBS = "bucket int, codes binary, base long, rows binary"


class Postings:
    """Collects (code, row number) pairs and gives them out as one packed row per bucket of
    codes, far smaller than a row per pair. Flushed when full: memory stays bounded."""

    def __init__(self, buckets: int, most: int = 2_000_000):
        self.buckets, self.most = buckets, most
        self.codes: list[np.ndarray] = []
        self.rows: list[np.ndarray] = []
        self.size = 0

    def add(self, codes: np.ndarray, row: int) -> None:
        self.codes.append(codes)
        self.rows.append(np.full(len(codes), row, np.int64))
        self.size += len(codes)

    def flush(self) -> Iterator[dict]:
        if not self.size:
            return
        codes, rows = np.concatenate(self.codes), np.concatenate(self.rows)
        self.codes, self.rows, self.size = [], [], 0
        base = int(rows.min())
        rows = rows - base
        rows = rows.astype(np.uint32 if rows.max() < 2**32 else np.uint64)
        bucket = (codes >> np.uint64(20)) % np.uint64(self.buckets)
        order = np.lexsort((codes, bucket))
        codes, rows, bucket = codes[order], rows[order], bucket[order]
        ends = np.flatnonzero(np.append(bucket[1:] != bucket[:-1], True)) + 1
        for a, b in zip(np.append(0, ends[:-1]), ends):
            yield {"bucket": [int(bucket[a])], "codes": [codes[a:b].tobytes()], "base": [base], "rows": [rows[a:b].tobytes()]}


def unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    codes, rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for c, base, r in zip(*(batch.column(n).to_pylist() for n in ("codes", "base", "rows"))):
        c = np.frombuffer(c, np.uint64)
        codes.append(c)
        rows.append(np.frombuffer(r, np.uint32 if len(r) == 4 * len(c) else np.uint64).astype(np.int64) + base)
    return np.concatenate(codes), np.concatenate(rows)


def repeated(blobs: DataFrame) -> DataFrame:
    """(code, r) of the codes that more than one posting has. Buckets are dealt to as many
    tasks as there are shuffle partitions; a task holds its packed share."""

    def run(batches):
        parts = [unpack(b) for b in batches]
        if not parts:
            return
        codes, rows = np.concatenate([c for c, _ in parts]), np.concatenate([r for _, r in parts])
        del parts
        order = np.argsort(codes, kind="stable")
        codes, rows = codes[order], rows[order]
        same = codes[1:] == codes[:-1]
        keep = np.append(same, False) | np.append(False, same)
        codes, rows = codes[keep].view(np.int64), rows[keep]
        for a in range(0, len(codes), 500_000):
            yield pa.RecordBatch.from_pydict({"code": codes[a : a + 500_000], "r": rows[a : a + 500_000]})

    n = shuffles(blobs.sparkSession)
    return blobs.repartition(n, "bucket").mapInArrow(run, "code long, r long")


def mixed(codes: np.ndarray, seed: int) -> np.ndarray:
    return mix64(codes ^ mix64(np.full(1, seed + 1, np.uint64)))


# --- components ---------------------------------------------------------------------------


def union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def components(links: DataFrame) -> DataFrame:
    """(r, c) for every end of ``links`` (a, b): c is the smallest number reachable.

    Each round every node takes the smallest label around it, then the label of its label:
    paths shorten by half. A node with very many links is pre-aggregated like any other."""
    edges = staged(
        links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links"
    )
    labels = staged(edges.groupBy(F.col("a").alias("r")).agg(F.least(F.col("a"), F.min("b")).alias("c")), "labels")
    while True:
        around = (
            edges.join(labels.select(F.col("r").alias("b"), "c"), "b").groupBy(F.col("a").alias("r")).agg(F.min("c").alias("near"))
        )
        nearer = labels.join(around, "r").select("r", F.col("c").alias("old"), F.least("c", "near").alias("c"))
        nearer = staged(nearer, "labels")
        jump = nearer.select(F.col("r").alias("c"), F.col("c").alias("far"))
        new = staged(nearer.join(jump, "c").select("r", "old", F.least("c", "far").alias("c")), "labels")
        if new.where("old <> c").isEmpty():
            return new.select("r", "c")
        labels = new.select("r", "c")


def merged(found: DataFrame, links: DataFrame) -> DataFrame:
    """The components ``found`` (r, c) after more ``links`` (a, b): only the components that
    these join are looked at."""
    ends = links.select("a", "b")
    for end in ("a", "b"):
        own = found.select(F.col("r").alias(end), F.col("c").alias("c"))
        ends = ends.join(own, end, "left").withColumn(end, F.coalesce("c", end)).drop("c")
    joined = components(ends.where("a <> b").distinct())
    old = found.join(joined.select(F.col("r").alias("c"), F.col("c").alias("to")), "c", "left").select("r", F.coalesce("to", "c").alias("c"))
    new = joined.join(found.select("r"), "r", "left_anti")
    return staged(old.unionByName(new), "components")
