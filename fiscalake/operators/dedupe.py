"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each key under a total ``order``.

    The filter on the row number lets Spark cut each key to one row per task before
    the shuffle (WindowGroupLimit), so many copies of one key never meet in one task.
    """
    best = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(best)).where("_rn = 1").drop("_rn")


def keep_latest(df: DataFrame, keys: Sequence[str], newest: str, tie_break: Sequence[str]) -> DataFrame:
    order = [F.desc_nulls_last(newest), *[F.asc_nulls_first(c) for c in tie_break]]
    return keep_one(df, keys, order)


def keep_first(df: DataFrame, keys: Sequence[str], position: Sequence[str]) -> DataFrame:
    return keep_one(df, keys, [F.asc_nulls_first(c) for c in position])


def modal_value(df: DataFrame, key: str, value: str, counted: str | None = None) -> DataFrame:
    """Most frequent ``value`` per ``key``; equal counts go to the smallest value.

    Counting by (key, value) first spreads a hot key over its values, and both
    aggregations combine before they shuffle. ``counted`` keeps the key's row count.
    """
    pairs = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("_n"))
    aggs = [F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(value)]
    if counted:
        aggs.append(F.sum("_n").alias(counted))
    return pairs.groupBy(key).agg(*aggs)
