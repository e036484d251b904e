"""Choosing training runs by the history of a metric."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.fixed_values import RUN_PARAMETERS
from offerloom.operators.blocks import STEP_BLOCK, drop_step_blocks, with_step_blocks
from offerloom.operators.episodes import with_steps
from offerloom.operators.sampling import top_ranked

ROLLING = 5


def _relative_change(df: DataFrame, run: Window) -> DataFrame:
    """Rolling deviation over five values, the one before, and the relative change."""
    rolling = F.when(
        F.count("value").over(run.rowsBetween(-ROLLING + 1, 0)) == ROLLING,
        F.stddev_samp("value").over(run.rowsBetween(-ROLLING + 1, 0)),
    )
    return df.withColumn("rolling_val", rolling).withColumn("prev_val", F.lag("rolling_val").over(run)).withColumn(
        "diff_pct", F.abs(F.try_divide(F.col("prev_val") - F.col("rolling_val"), F.col("prev_val")))
    )


def stable_runs(hist: DataFrame, n: int = 5, threshold: float = 0.05, tolerance: int = 1) -> DataFrame:
    """Per run: first and last value, and whether it is stable and rising.

    Stable: of the last ``n`` relative changes at most ``tolerance`` reach the threshold, a missing change
    counting as one that does. Only the newest ``n + 5`` values of a run are ordered; the row limit works
    before the shuffle, and first and last values are plain aggregates.
    """
    newest = Window.partitionBy("runid").orderBy(F.col("timestamp").desc(), F.col("step").desc())
    recent = hist.select("runid", "timestamp", "step", "value").withColumn(
        "_rank", F.row_number().over(newest)
    ).filter(F.col("_rank") <= n + ROLLING)
    run = Window.partitionBy("runid").orderBy("timestamp", "step")
    flat = (
        _relative_change(recent, run).filter(F.col("_rank") <= n)
        .groupBy("runid").agg(F.count(F.when(F.col("diff_pct") < threshold, 1)).alias("_flat"))
    )
    ends = hist.groupBy("runid").agg(
        F.min_by("value", F.struct("timestamp", "step")).alias("first_value"),
        F.max_by("value", F.struct("timestamp", "step")).alias("last_metric"),
    )
    steady = F.lit(n) - F.coalesce("_flat", F.lit(0)) <= tolerance
    rising = F.col("first_value") < F.col("last_metric")
    return ends.join(flat, "runid", "left").select(
        "runid", "first_value", "last_metric", F.when(steady & rising, 1).otherwise(0).alias("is_stable")
    )


def best_runs(
    hist: DataFrame, params: DataFrame, topn: int = 1, stable_only: bool = True, n: int = 5, threshold: float = 0.05,
    tolerance: int = 1,
) -> DataFrame:
    """The best runs by dense rank of their last metric, with the parameters worth keeping.

    Runs whose last metric is missing or zero are left out. ``params`` has ``runid, run_name, params``.
    """
    runs = stable_runs(hist, n, threshold, tolerance).filter(F.col("last_metric").isNotNull() & (F.col("last_metric") != 0))
    if stable_only:
        runs = runs.filter("is_stable = 1")
    keep = F.map_filter("params", lambda k, _: k.isin(*RUN_PARAMETERS))
    return top_ranked(runs, "last_metric", topn).join(params.withColumn("params", keep), "runid")


def run_series(hist: DataFrame, runs: DataFrame, size: int = STEP_BLOCK) -> DataFrame:
    """Chart rows of chosen runs: every value with its relative change, in row form for series of any length."""
    chosen = hist.join(runs.select("runid"), "runid", "left_semi").withColumn("_time", F.timestamp_micros("timestamp"))
    steps = with_steps(chosen, "runid", "_time", "step").drop("_time")
    blocks = with_step_blocks(steps, "t", before=ROLLING, size=size)
    run = Window.partitionBy("runid", "_block").orderBy("t")
    return drop_step_blocks(_relative_change(blocks, run))
