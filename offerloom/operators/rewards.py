"""Rewards and penalties of calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.fixed_values import REPEAT_CALL_DAYS, REPEAT_CALL_PENALTY, SENTINEL_MEMBER
from offerloom.operators.blocks import HOT_ROWS, segmented_scan


def select_calls(df: DataFrame, app: str, caller: str, start: str) -> DataFrame:
    """Authenticated calls of one line and caller type after a start time, without the sentinel member."""
    return df.filter(
        (F.col("logical_app_name") == app) & (F.col("caller_type") == caller)
        & (F.col("start_dtm") > F.lit(start).cast("timestamp"))
        & (F.col("cagm") != SENTINEL_MEMBER) & (F.col("authenticated") == 1)
    )


def repeat_penalty(
    calls: DataFrame, lo: int = REPEAT_CALL_DAYS, hi: int = 1, penalty: int = REPEAT_CALL_PENALTY
) -> DataFrame:
    """Distinct calls that follow another call of the entity by ``hi`` to ``lo`` days, both ends inclusive.

    A range frame over the entity would put all its calls in one task. Days suffice: a call at ``t`` on day D
    has a predecessor in ``[t - lo, t - hi]`` if the last call of day D-lo is late enough, or the first call of
    day D-hi is early enough, or any call lies on a day in between. The window runs over days of the entity.
    """
    if not lo > hi >= 1:
        raise ValueError("lo must exceed hi, and hi must be at least one day")
    day = F.unix_date(F.col("date_time").cast("date"))
    times = calls.select("enterprise_id", "date_time", day.alias("_day"))
    by_day = Window.partitionBy("enterprise_id").orderBy("_day")
    between = F.max("_day").over(by_day.rangeBetween(-lo + 1, -hi - 1)) if lo - hi > 1 else F.lit(None).cast("int")
    days = (
        times.groupBy("enterprise_id", "_day")
        .agg(F.min("date_time").alias("_first"), F.max("date_time").alias("_last"))
        .select(
            "enterprise_id", "_day",
            F.max("_last").over(by_day.rangeBetween(-lo, -lo)).alias("_last_lo"),
            F.min("_first").over(by_day.rangeBetween(-hi, -hi)).alias("_first_hi"),
            between.alias("_between"),
        )
    )
    t = F.unix_micros("date_time")
    day_us = 86_400_000_000
    repeat = (
        F.col("_between").isNotNull()
        | (F.unix_micros("_last_lo") >= t - lo * day_us)
        | (F.unix_micros("_first_hi") <= t - hi * day_us)
    )
    # Distinct over the day as well, which the partitioning of the join already serves.
    return (
        times.join(days, ["enterprise_id", "_day"]).filter(repeat)
        .select("enterprise_id", "_day", "date_time").distinct()
        .select("enterprise_id", "date_time", F.lit(penalty).alias("reward_value"))
    )


def future_events(
    df: DataFrame, future: DataFrame, key: str, guid: str, time: str, days: int = 7, most: int = HOT_ROWS
) -> DataFrame:
    """How many ``future`` rows of the same key lie in ``(t, t + days]``, for each row of ``df``.

    With F(x) the number of rows up to x the answer is F(t + days) - F(t). Both points of each row
    are put in the time order of the key, and one running count serves them all, so the work is linear and
    no pair of rows is ever formed. A row without key or time has a null count; one in ``future`` counts for none.
    """
    none = F.lit(None)
    arrivals = future.select(
        key, F.col(time).alias("_x"), F.lit(0).alias("_kind"), F.lit(1).alias("_n"), none.cast("int").alias("_end"),
        none.cast(df.schema[guid].dataType).alias(guid), none.cast("timestamp").alias(time),
    )
    ends = F.array(
        F.struct(F.col(time).alias("_x"), F.lit(0).alias("_end")),
        F.struct((F.col(time) + F.make_interval(days=F.lit(days))).alias("_x"), F.lit(1).alias("_end")),
    )
    points = df.withColumn("_p", F.explode(ends)).select(
        key, "_p._x", F.lit(1).alias("_kind"), F.lit(0).alias("_n"), "_p._end", guid, time
    )
    # The id is the last tie, so that many rows of one time can be spread.
    counted = segmented_scan(arrivals.unionByName(points), [key], "_x", ["_kind", guid], sums={"_upto": F.col("_n")}, most=most)

    def upto(end: int):
        return F.max(F.when(F.col("_end") == end, F.col("_upto")))

    return counted.filter("_kind = 1").groupBy(key, guid, time).agg((upto(1) - upto(0)).alias("calls"))


def session_totals(df: DataFrame) -> DataFrame:
    """Per call: sums over its offers and the sorted names of those offered and accepted.

    Input has one row per call and offer, so the lists are no longer than the list of offers.
    """
    sums = ("offered", "accepted", "success", "failure", "offered_not_accepted")
    return df.groupBy("call_guid", "cagm", "starttime").agg(
        *[F.sum(c).cast("int").alias(c) for c in sums],
        F.sort_array(F.collect_list(F.when(F.col("offered") == 1, F.col("metric")))).alias("offered_list"),
        F.sort_array(F.collect_list(F.when(F.col("accepted") == 1, F.col("metric")))).alias("accepted_list"),
    )


def session_reward(df: DataFrame) -> DataFrame:
    """Reward of a session: gain minus later calls minus ignored offers."""
    cost = F.col("calls") + F.col("offered_not_accepted")
    return df.withColumns({
        "success_reward": F.col("success") - cost,
        "accepted_reward": F.col("accepted") - cost,
    })


def with_future_calls(sessions: DataFrame, counts: DataFrame) -> DataFrame:
    """Attach the counts of :func:`future_events`; sessions without any get 0."""
    return sessions.join(counts, ["cagm", "call_guid", "starttime"], "left").fillna(0, ["calls"])


def daily_rewards(df: DataFrame, value: str) -> DataFrame:
    """Total per entity, day and source."""
    return df.groupBy("enterprise_id", "date", "source").agg(F.sum(value).alias("rewards"))


def combine_rewards(rewards: DataFrame, dispositions: DataFrame) -> DataFrame:
    """Penalties and accepted offers in one daily total. The combined total is what episodes use."""
    both = daily_rewards(dispositions, "accepted").unionByName(daily_rewards(rewards, "reward_value"))
    return daily_rewards(both, "rewards")
