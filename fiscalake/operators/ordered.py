"""Surrogate keys, ranks and running totals over a whole table.

A window without PARTITION BY moves every row to one task. Rows are range partitioned and
sorted instead, each partition is numbered on its own, and the counts and sums of the
earlier partitions, one small row per partition, are added afterwards. That is the one way
for tables of all sizes: adaptive execution makes a single partition of a small one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..staging import Staged, stage

# monotonically_increasing_id() holds the partition above this bit, the position below.
_POSITION_BITS = 33


def positioned(df: DataFrame, order: Sequence[Column], name: str = "ordered") -> Staged:
    """``df`` in global order: adds ``_part`` and the position ``_pos`` inside it.

    Written out, because the counts and the rows read later must agree on where each
    partition ends. Without a fixed number of partitions, adaptive execution merges
    small ones. ``order`` must be total.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = stage(ranged.withColumn("_id", F.monotonically_increasing_id()), name)
    place = F.col("_id")
    rows = staged.df.select(
        *df.columns,
        F.shiftright(place, _POSITION_BITS).alias("_part"),
        place.bitwiseAND((1 << _POSITION_BITS) - 1).alias("_pos"),
    )
    return staged._replace(df=rows)


def _before(col: str) -> Column:
    """Sum of ``col`` over earlier partitions; the input has one row per partition."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(col).over(earlier), F.lit(0))


def number_rows(df: DataFrame, order: Sequence[Column], out: str, name: str = "numbered") -> Staged:
    """Dense 1-based numbers in a total ``order``: ROW_NUMBER() OVER (ORDER BY ...)."""
    placed = positioned(df, order, name)
    sizes = placed.df.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = sizes.select("_part", _before("_n").cast("long").alias("_offset"))
    # One row per partition, whatever the table.
    numbered = placed.df.join(F.broadcast(offsets), "_part").select(
        (F.col("_offset") + F.col("_pos") + 1).alias(out), *df.columns
    )
    return placed._replace(df=numbered)


def _total_type(df: DataFrame, value: str) -> str:
    """The type of a running total: as wide as sums get, whatever the number of rows."""
    kind = df.schema[value].dataType
    return f"decimal(38,{kind.scale})" if isinstance(kind, T.DecimalType) else df.agg(F.sum(value)).dtypes[0][1]


def rank_and_running_total(
    df: DataFrame, value: str, tie_break: Sequence[str], rank_out: str, running_out: str
) -> DataFrame:
    """RANK() by ``value`` descending, and the running sum in that order.

    Rows of equal value share the rank of the first of them, also where such a run crosses
    partitions; the running sum takes them by ``tie_break``. NULL values come last, are
    equal to each other and add nothing: their running sum is the sum of all others, or
    NULL where there are none.
    """
    order = [F.desc_nulls_last(value), *[F.asc(c) for c in tie_break]]
    rows = positioned(df, order, "ranked").df
    total = _total_type(df, value)
    missing = F.col(value).isNull()
    summary = rows.groupBy("_part").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(value).cast(total).alias("_sum"),
        F.count(value).alias("_filled"),
        F.max(value).alias("_first"),
        F.max(missing).alias("_has_null"),
        F.min(F.when(missing, F.col("_pos"))).alias("_null_at"),
        F.min(F.when(~missing, F.struct(F.col(value).alias("value"), F.col("_pos").alias("at")))).alias("_least"),
    )
    # The value of a partition's last row and where its run begins; NULL sorts last.
    parts = summary.select(
        "_part",
        "_first",
        F.when(~F.col("_has_null"), F.col("_least.value")).alias("_last"),
        F.when(F.col("_has_null"), F.col("_null_at")).otherwise(F.col("_least.at")).alias("_begun"),
        _before("_n").cast("long").alias("_rows_before"),
        _before("_sum").cast(total).alias("_sum_before"),
        _before("_filled").alias("_filled_before"),
    ).withColumn("_begun", F.col("_begun") + F.col("_rows_before") + 1)
    # The rank at which the run of each partition's last value begins.
    runs = parts.groupBy(F.col("_last").alias("_value")).agg(F.min("_begun").alias("_started"))
    parts = parts.drop("_begun", "_last").join(F.broadcast(runs), F.col("_first").eqNullSafe(F.col("_value")), "left")
    null_runs = runs.where("_value is null").agg(F.min("_started")).scalar()

    # One sort serves both windows: the order of the second is a prefix of the first's.
    upto = (Window.unboundedPreceding, Window.currentRow)
    by_value = Window.partitionBy("_part").orderBy(F.desc_nulls_last(value))
    by_place = Window.partitionBy("_part").orderBy(F.desc_nulls_last(value), "_pos").rowsBetween(*upto)
    local = rows.select(
        "*",
        F.sum(value).over(by_place).cast(total).alias("_run"),
        F.count(value).over(by_place).alias("_seen"),
        F.rank().over(by_value).cast("long").alias("_rank"),
    )
    rank_here = F.col("_rank") + F.col("_rows_before")
    # Where the run began if it came from an earlier partition.
    begun = F.when(missing, null_runs).when(F.col(value) == F.col("_first"), F.col("_started"))
    zero = F.lit(0).cast(total)
    running = F.coalesce("_sum_before", zero) + F.coalesce("_run", zero)
    return local.join(F.broadcast(parts), "_part").select(
        *df.columns,
        F.coalesce(F.least(begun, rank_here), rank_here).alias(rank_out),
        F.when(F.col("_filled_before") + F.col("_seen") > 0, running).cast(total).alias(running_out),
    )
