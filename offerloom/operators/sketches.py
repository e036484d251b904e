"""Mergeable counts and quantiles: sketches per day as stored columns, merged to any range of days.

A daily table has one row per key and day with a number of rows, a sketch of distinct members and one of the distribution of a value. Weeks, months or
any other ranges are merged from it, so the raw rows are read once. Sketches are combined in each task before the shuffle, and have a
bounded size whatever they count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Relative standard error of a count is about 1.04 / sqrt(2 ** LG_K); the rank error of a quantile is about 1.33 % for KLL_K = 200.
LG_K = 12
KLL_K = 200


def daily_sketches(df: DataFrame, keys: Sequence[str], day: str, member: str, value: str, lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """``keys``, ``day``, ``n``, ``members`` and ``values`` (sketches). Null members and values, and values that are no number, are not counted in them."""
    number = F.col(value).cast("double")
    return df.groupBy(*keys, day).agg(
        F.count(F.lit(1)).alias("n"), F.hll_sketch_agg(F.col(member).cast("string"), lg_k).alias("members"),
        F.kll_sketch_agg_double(F.when(~F.isnan(number), number), k).alias("values"),
    )


def merge_sketches(daily: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows of :func:`daily_sketches` (or of this function) merged by ``keys``."""
    return daily.groupBy(*keys).agg(
        F.sum("n").alias("n"), F.hll_union_agg("members").alias("members"), F.kll_merge_agg_double("values").alias("values")
    )


def estimates(df: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """Sketches read: ``members`` as a number, and a column per quantile, null without values."""
    some = F.kll_sketch_get_n_double("values") > 0
    read = {name: F.when(some, F.kll_sketch_get_quantile_double("values", F.lit(rank).cast("double"))) for name, rank in quantiles.items()}
    return df.withColumns(read | {"members": F.hll_sketch_estimate("members")}).drop("values")
