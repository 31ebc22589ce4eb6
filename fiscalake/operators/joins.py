"""Joins of many rows with a table that is unique on the join key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import Staged, stage

# A table of at most this many rows is left to the optimiser: it broadcasts what its files'
# bytes allow, else shuffles, and adaptive execution splits partitions that come out skewed.
PLAIN_ROWS = 100_000
# Rows of one key that a single task may be given.
ROWS_PER_TASK = 5_000_000
# No more than this many keys are ever treated as hot.
MAX_HOT_KEYS = 100_000


def lookup_join(
    rows: DataFrame,
    table: Staged,
    on: Sequence[str],
    how: str = "left",
    plain_rows: int = PLAIN_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Join ``rows`` with ``table``, whose keys are unique: as the optimiser sees fit while
    the table is small, else a shuffle join that splits hot keys."""
    if table.rows <= plain_rows:
        return rows.join(table.df, list(on), how)
    return salted_join(rows, table.df, on, how, rows_per_task)


def salted_join(
    rows: DataFrame, table: DataFrame, on: Sequence[str], how: str = "left", rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Shuffle join in which a key with many rows is spread over several tasks.

    A key counts as hot above ``rows_per_task`` rows and above its share of all rows, so
    at most MAX_HOT_KEYS keys are hot: the table side grows by no more than that many
    copies. A key below both is not split, and has at most 1/MAX_HOT_KEYS of all rows or
    ``rows_per_task``. Every row and every match is kept, so only inner and left joins, in
    which a table row without a match gives nothing, are possible.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"a salted join is inner or left, not {how}")
    on = list(on)
    # Written once: rows keep their numbers if a task is repeated, and equal rows, which no
    # hash of their values could tell apart, go to different tasks.
    placed = stage(rows.withColumn("_id", F.monotonically_increasing_id()), "salted_rows").df
    sizes = stage(placed.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "salted_sizes").df
    limit = sizes.agg(
        F.greatest(F.lit(rows_per_task), F.ceil(F.sum("_n") / MAX_HOT_KEYS))
    ).scalar()
    hot = sizes.where(F.col("_n") > limit).select(*on, F.ceil(F.col("_n") / limit).cast("int").alias("_salts"))
    # Rows without a key match nothing and may go anywhere; left alone they would all go
    # to one task.
    salts = F.coalesce(F.col("_salts"), F.lit(1))
    keyless = reduce(Column.__or__, [F.col(c).isNull() for c in on])
    spread = F.when(keyless, MAX_HOT_KEYS).otherwise(salts)
    left = placed.join(hot, on, "left").withColumn("_salt", F.pmod(F.xxhash64("_id"), spread).cast("int"))
    right = table.join(hot, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    joined = left.drop("_salts", "_id").join(right.drop("_salts").hint("merge"), [*on, "_salt"], how)
    return joined.drop("_salt")
