"""Best-fit packing of documents into sequences by bin completion.

A document is its tokens and one end mark. Only documents longer than a sequence are cut,
into full pieces after a first, shorter one; full pieces are sequences by themselves. What
is left to pack is known by its sizes alone, and there are at most ``capacity`` sizes: the
plan is made from the number of pieces of each size, and says for the i-th piece of a size
which sequence and offset it gets. Spark counts the sizes, numbers the pieces within a
size and joins them to the plan; the driver holds only the counts and the patterns.

The plan is bin completion: take the largest size left, enumerate the undominated ways to
fill up its sequence, best filling first, and repeat the filling as often as its sizes
last. Best-fit decreasing gives the first incumbent; a branch is cut when the sequences it
has used and the least that its rest needs (by total size, and by sizes over half) reach
the incumbent. ``branches`` bounds the search; the best plan found until then stands.
"""

from __future__ import annotations

from bisect import bisect_right
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import arrow_map, pick, shuffles, staged, table

CAPACITY, END, SPECIAL = 2048, 0, "<|endoftext|>"
Pattern = tuple[tuple[int, ...], int]  # sizes of one sequence, largest first, and how many such sequences


# --- the plan -----------------------------------------------------------------------------


def least(counts: dict[int, int], capacity: int) -> int:
    """A lower bound of the sequences needed: total size, and the sizes that cannot meet."""
    total = -(-sum(s * n for s, n in counts.items()) // capacity)
    big = sum(n for s, n in counts.items() if 2 * s > capacity)
    free = sum((capacity - s) * n for s, n in counts.items() if 2 * s > capacity)
    small = sum(s * n for s, n in counts.items() if 2 * s <= capacity)
    return max(total, big + max(0, -(-(small - free) // capacity)))


def _repeat(filling: tuple[int, ...], counts: dict[int, int]) -> int:
    return min(counts[s] // filling.count(s) for s in set(filling))


def _used(counts: dict[int, int], filling: tuple[int, ...], times: int) -> dict[int, int]:
    left = dict(counts)
    for s in filling:
        left[s] -= times
        if not left[s]:
            del left[s]
    return left


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing on counts: the largest size, then always the largest that fits."""
    counts, sizes, plan = dict(counts), sorted(counts), []
    while sizes:
        filling, room, below = [], capacity, len(sizes)
        while below := bisect_right(sizes, room, 0, below):
            s = sizes[below - 1]
            n = min(counts[s], room // s)
            filling += [s] * n
            room -= s * n
            below -= 1
        times = _repeat(tuple(filling), counts)
        plan.append((tuple(filling), times))
        for s in set(filling):
            counts[s] -= times * filling.count(s)
            if not counts[s]:
                sizes.remove(s)
    return plan


def completions(counts: dict[int, int], capacity: int, most: int = 8, tries: int = 2000) -> list[tuple[int, ...]]:
    """Undominated fillings around the largest size, least waste first: a filling is
    dominated if a piece that is left can be added, or can take the place of a smaller
    one. Looks at larger pieces first, and at ``tries`` partial fillings."""
    sizes = sorted(counts)
    found: dict[tuple[int, ...], int] = {}
    tried = 0

    def free(s: int, filling: tuple[int, ...]) -> bool:
        return filling.count(s) < counts[s]

    # An own stack, as a filling can have thousands of pieces: next size, filling, room,
    # whether nothing was added to it, whether it was looked at.
    stack: list[list] = []

    def push(below: int, filling: tuple[int, ...], room: int) -> None:
        nonlocal tried
        tried += 1
        stack.append([bisect_right(sizes, room, 0, below) - 1, filling, room, True, False])

    push(len(sizes), (sizes[-1],), capacity - sizes[-1])
    while stack:
        top = stack[-1]
        i, filling, room, last, begun = top
        if i < 0 or (begun and tried > tries):
            stack.pop()
            if last:
                found[filling] = room
            continue
        top[0], top[4] = i - 1, True
        if free(sizes[i], filling):
            top[3] = False
            push(i + 1, (*filling, sizes[i]), room - sizes[i])

    def dominated(filling: tuple[int, ...]) -> bool:
        room = found[filling]
        spans = [(0, room), *((s, s + room) for s in set(filling[1:]))]
        return any(free(t, filling) for a, b in spans for t in sizes[bisect_right(sizes, a) : bisect_right(sizes, b)])

    good = [f for f in found if not dominated(f)] or list(found)
    return sorted(good, key=lambda f: (found[f], len(f), [-s for s in f]))[:most]


def complete(counts: dict[int, int], capacity: int = CAPACITY, branches: int = 100) -> list[Pattern]:
    """Patterns for ``counts`` (size -> pieces) that use as few sequences as were found."""
    counts = {s: n for s, n in counts.items() if n}
    best = best_fit(counts, capacity)
    goal, fewest, spent = least(counts, capacity), sum(n for _, n in best), 0
    # Depth first with an own stack: a plan can have thousands of patterns.
    stack = [(counts, (), 0)]
    while stack and fewest > goal and spent < branches:
        left, chain, used = stack.pop()
        if used + least(left, capacity) >= fewest:
            continue
        spent += 1
        # Completion by best fit from here is an incumbent, too.
        rest = best_fit(left, capacity)
        if used + sum(n for _, n in rest) < fewest:
            head, link = [], chain
            while link:
                link, pattern = link
                head.append(pattern)
            best, fewest = head[::-1] + rest, used + sum(n for _, n in rest)
        branch = []
        for filling in completions(left, capacity):
            times = _repeat(filling, left)
            branch.append((_used(left, filling, times), (chain, (filling, times)), used + times))
        stack += branch[::-1]
    return best


def slots(plan: list[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """(size, first number, pieces, first sequence, offset) for runs of pieces of a size."""
    out, taken, sequence = [], {}, 0
    for filling, times in plan:
        offset = 0
        for s in filling:
            out.append((s, taken.get(s, 0), times, sequence, offset))
            taken[s] = taken.get(s, 0) + times
            offset += s
        sequence += times
    return out


# --- tokens -------------------------------------------------------------------------------


@cache
def encoder(path: str):
    """ids of a text, as the tokenizers library gives them without special tokens added.

    The same vocabulary is faster as ranks beside that file; texts with the spelled-out
    special token, and files without ranks, take the library itself."""
    import base64
    import os

    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(path)
    ranks = path.removesuffix(".json") + ".tiktoken"
    if not os.path.exists(ranks):
        return lambda text: plain.encode(text, add_special_tokens=False).ids
    import public_tokenizers
    import tiktoken

    with open(ranks, "rb") as lines:
        known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={})
    return lambda text: (
        plain.encode(text, add_special_tokens=False).ids if SPECIAL in text else fast.encode_ordinary(text)
    )


def cut(length: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces: a first, shorter one where it does not come out even."""
    first = length % capacity or capacity
    ends = range(first, length + 1, capacity)
    return [(max(0, e - capacity) if i else 0, capacity if i else first) for i, e in enumerate(ends)]


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces of all documents, in their order of ``row`` and piece."""

    def tokens(batch: pa.RecordBatch):
        import zlib

        encode = encoder(path)
        out: dict[str, list] = {n: [] for n in ("row", "doc_id", "piece", "start", "length", "ids_crc32")}
        for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            ids = np.array([*encode(text or ""), END], dtype="<u4")
            for i, (start, length) in enumerate(cut(len(ids), capacity)):
                made = (row, doc_id, i, start, length, zlib.crc32(ids[start : start + length].tobytes()))
                for name, value in zip(out, made):
                    out[name].append(value)
        yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = pick(docs, "doc_id", "text").select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return arrow_map(rows, tokens, f"row long, doc_id {kind}, piece int, start long, length long, ids_crc32 long")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, branches: int = 100) -> DataFrame:
    """Pack ``docs`` (doc_id, text) into sequences of at most ``capacity`` tokens.

    Returns a row per piece: doc_id, piece, start (the document's ids before it), length,
    ids_crc32, sequence_id and offset (its place there; sequences have no gaps). A null
    text is empty: its only token is the end mark. Repeated rows and rows with the same or
    no doc_id are documents of their own. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    made = staged(pieces(docs, path, capacity).withColumn("part", F.spark_partition_id()), "pack-pieces")
    by_part = staged(made.groupBy("length", "part").count(), "pack-sizes")
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    # At most `capacity` rows; a full piece is its own sequence and needs no plan.
    counts = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    runs = slots(complete(counts, capacity, branches))
    plan = (
        spark.createDataFrame(runs, "length long, first long, pieces long, sequence long, offset long")
        .repartition(shuffles(spark))
        .select("length", "sequence", "offset", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("pieces") - 1)).alias("i"))
        .select("length", (F.col("first") + F.col("i")).alias("number"), (F.col("sequence") + F.col("i")).alias("sequence_id"), "offset")
    )
    own = Window.partitionBy("part", "length").orderBy("row", "piece")
    numbered = (
        made.withColumn("own", F.row_number().over(own) - 1)
        .join(offsets, ["length", "part"])
        .withColumn("number", F.col("before") + F.col("own"))
    )
    return numbered.join(plan, ["length", "number"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
