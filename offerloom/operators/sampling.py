"""Sampling and splitting. Choices depend on a hash of the key, never on partition layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions import uniform


# Ranges of the random number in which rows are counted, before the last range alone is sorted.
RANGES = 1 << 16


def _least(df: DataFrame, n: int, seed: int, keys: Sequence[str]) -> DataFrame:
    """The ``n`` rows of least random number, ties by key.

    Rows are counted by range of the number; those of lower ranges than that of the n-th are in, and only the range of the n-th is
    sorted. So no task sees more than one range, however large ``n`` is. One row of counts comes to the driver.
    """
    u = uniform(*keys, seed=seed)
    part = F.floor(u * RANGES).cast("int")
    counts = df.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = counts.withColumn("_before", before).filter(F.col("_before") + F.col("_n") >= n).orderBy("_part").first()
    if edge is None:
        return df
    last = df.filter(part == edge["_part"]).orderBy(u, *keys).limit(n - edge["_before"])
    return df.filter(part < edge["_part"]).unionByName(last)


def sample_n(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    """``n`` distinct random keys."""
    return _least(df.select(*keys).distinct(), n, seed, keys)


def epoch_sample(df: DataFrame, n: int, epoch: int, key: str) -> DataFrame:
    """``n`` rows for one training epoch, without replacement."""
    return _least(df, n, epoch, [key])


def sample_fraction(df: DataFrame, fraction: float, seed: int, *keys: str) -> DataFrame:
    """Each key stays with the given probability; no shuffle."""
    return df.filter(uniform(*keys, seed=seed) < fraction)


def balance_groups(df: DataFrame, col: str, small: int, large: int, seed: int, *keys: str) -> DataFrame:
    """All rows of the small group, and a random share of the large one of about the same size."""
    share = df.agg(
        F.try_divide(
            F.count(F.when(F.col(col) == small, 1)).cast("double"), F.count(F.when(F.col(col) == large, 1)).cast("double")
        ).alias("share")
    )
    chosen = uniform(*keys, seed=seed) < F.coalesce(share.scalar(), F.lit(1.0))
    return df.filter((F.col(col) == small) | ((F.col(col) == large) & chosen))


def top_ranked(df: DataFrame, value: str, n: int) -> DataFrame:
    """Rows whose value has dense rank (descending) up to ``n``, with the rank.

    The distinct top values are a top-n query, so at most ``n`` rows are ranked; Spark chooses the join by their size.
    """
    best = df.select(value).where(F.col(value).isNotNull()).distinct().orderBy(F.col(value).desc()).limit(n)
    ranks = best.withColumn("rank", F.row_number().over(Window.orderBy(F.col(value).desc())))
    return df.join(ranks, value)


def split_by_key(df: DataFrame, key: str, shares: Sequence[float] = (0.7, 0.3), seed: int = 42) -> DataFrame:
    """``split`` = 0, 1, ... by hash of the key; all rows of a key share it. No shuffle."""
    if abs(sum(shares) - 1) > 1e-9:
        raise ValueError("shares must add up to 1")
    u = uniform(key, seed=seed)
    split, edge = F.lit(len(shares) - 1), 1.0
    for i in range(len(shares) - 1, 0, -1):
        edge -= shares[i]
        split = F.when(u < edge, i - 1).otherwise(split)
    return df.withColumn("split", split)


def split3_by_key(df: DataFrame, key: str, train: float = 0.8, seed: int = 42) -> DataFrame:
    """Train / validation / test by key: the train share is applied twice (0.8 gives 64 / 16 / 20 percent)."""
    first, second = uniform(key, seed=seed), uniform(key, seed=f"{seed}-val")
    return df.withColumn(
        "split", F.when(first >= train, "test").when(second >= train, "val").otherwise("train")
    )


def split_sizes(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy("split").agg(F.count_distinct(key).alias("keys"), F.count(F.lit(1)).alias("rows"))
