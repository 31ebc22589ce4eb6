"""Correlations and histograms in one pass over the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _complete(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows without a missing value, as doubles."""
    present = reduce(Column.__and__, [F.col(c).isNotNull() for c in columns])
    return df.where(present).select(*[F.col(c).cast("double").alias(c) for c in columns])


def _correlations(df: DataFrame, columns: Sequence[str], pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """One row with a map ``_c``: the number of each pair -> its correlation.

    One pass, whatever the number of columns: a row becomes a cell per pair, and one
    mergeable aggregate, which holds means and sums of centred products and so does not
    cancel, takes the cells by pair. Tasks combine to a row per pair before anything is
    moved. Pairs with a column of equal values, or without rows, are undefined."""
    cells = [F.struct(F.lit(k).alias("pair"), F.col(columns[i]).alias("x"), F.col(columns[j]).alias("y")) for k, (i, j) in enumerate(pairs)]
    sums = F.covar_pop("x", "y").alias("xy"), F.stddev_pop("x").alias("x"), F.stddev_pop("y").alias("y")
    found = _complete(df, columns).select(F.inline(F.array(*cells))).groupBy("pair").agg(*sums)
    found = found.select("pair", F.try_divide("xy", F.col("x") * F.col("y")).alias("c"))
    defined = found.where(F.col("c").isNotNull() & ~F.isnan("c"))
    return defined.agg(F.map_from_entries(F.collect_list(F.struct("pair", "c"))).alias("_c"))


def _listed(row: DataFrame, heads: Sequence[str], entries: Sequence[tuple], places: int | None) -> DataFrame:
    """The row's correlations with the labels ``heads`` of each entry (labels, number)."""
    named = [F.struct(*[F.lit(v).alias(h) for h, v in zip(heads, labels)], F.lit(k).alias("_k")) for labels, k in entries]
    value = F.try_element_at("_c", F.col("_k"))
    return row.select("_c", F.inline(F.array(*named))).select(*heads, (value if places is None else F.round(value, places)).alias("correlation"))


def label_correlation(df: DataFrame, features: Sequence[str], label: str, places: int | None = None) -> DataFrame:
    """(feature, correlation) with the label; NULL means undefined."""
    row = _correlations(df, [*features, label], [(i, len(features)) for i in range(len(features))])
    return _listed(row, ["feature"], [((f,), k) for k, f in enumerate(features)], places)


def correlation_matrix(df: DataFrame, columns: Sequence[str], places: int | None = None) -> DataFrame:
    """(x, y, correlation) for all ordered pairs of columns."""
    pairs = list(combinations_with_replacement(range(len(columns)), 2))
    number = {pair: k for k, pair in enumerate(pairs)}
    entries = [((x, y), number[min(i, j), max(i, j)]) for i, x in enumerate(columns) for j, y in enumerate(columns)]
    return _listed(_correlations(df, columns, pairs), ["x", "y"], entries, places)


def histogram(df: DataFrame, value: str, low: float, high: float, bins: int, by: str) -> DataFrame:
    """Equal-width bins (1-based) with their bounds; values outside go to bin 0 or bins+1."""
    width = (high - low) / bins
    return (
        df.groupBy(by, F.width_bucket(F.col(value), F.lit(low), F.lit(high), F.lit(bins)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn("bin_start", F.round(low + (F.col("bin") - 1) * width, 6))
        .withColumn("bin_end", F.round(low + F.col("bin") * width, 6))
    )
