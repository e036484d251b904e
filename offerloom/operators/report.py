"""Pilot-versus-control reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.fixed_values import BEFORE_AFTER, SESSION_METRICS
from offerloom.functions import half_even, map_codes, pick, ratio, week_ending_sunday
from offerloom.operators.blocks import exact_median


def offers_only(df: DataFrame, *conds: Column) -> DataFrame:
    """Offer rows (no session metrics) that fulfil further conditions."""
    out = df.filter(~F.col("metric").isin(*SESSION_METRICS))
    for c in conds:
        out = out.filter(c)
    return out


def daily_volume(df: DataFrame) -> DataFrame:
    """Decisions per application and day."""
    return df.groupBy("app", F.to_date("time").alias("date")).agg(F.count(F.lit(1)).alias("volume"))


def daily_counts(df: DataFrame, keys: Sequence[str], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def daily_series_join(*series: DataFrame) -> DataFrame:
    """Daily series side by side; days and lines missing in one of them drop out."""
    out = series[0]
    for s in series[1:]:
        out = out.join(s, ["date", "tfn"])
    return out


def mean_of_daily(df: DataFrame, keys: Sequence[str], value: str, out: str, scale: int | None = None) -> DataFrame:
    """Mean per group of daily totals."""
    mean = F.avg(value)
    return df.groupBy(*keys).agg((mean if scale is None else F.round(mean, scale)).alias(out))


def session_metric(df: DataFrame, metric: str, out: str, keys: Sequence[str], *conds: Column) -> DataFrame:
    """Largest penalty per session, then daily sum and number of sessions."""
    rows = df.filter(F.col("metric") == metric)
    for c in conds:
        rows = rows.filter(c)
    sessions = rows.groupBy("gvpsessionid", "cagm", *keys).agg(F.max("penalty").alias(out))
    return sessions.groupBy(*keys).agg(F.sum(out).alias(out), F.count(F.lit(1)).alias("calls"))


def weekly(df: DataFrame, keys: Sequence[str], values: Sequence[str], date: str = "startdate") -> DataFrame:
    """Sums by week (Monday to Sunday, labelled by the Sunday) and group; empty weeks give no row."""
    return df.groupBy(week_ending_sunday(date).alias("week"), *keys).agg(*[F.sum(v).alias(v) for v in values])


def rate_weekly(df: DataFrame, num: str, den: str, out: str, keys: Sequence[str] = ("tfn",)) -> DataFrame:
    return weekly(df, keys, (num, den)).withColumn(out, ratio(num, den))


def accepted_rate_weekly(df: DataFrame, metric: str | None = None) -> DataFrame:
    """Accepted share of offers by week and line, of one offer or of all."""
    rows = offers_only(df, F.col("offered") == 1)
    if metric is not None:
        rows = rows.filter(F.col("metric") == metric)
    return rate_weekly(rows, "accepted", "offered", "accepted_rate")


def pivot_before_after(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """``<value>_before`` and ``<value>_after`` sums per group, by the 1/0 code."""
    label = map_codes("before_after", BEFORE_AFTER)
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(label == when, F.col(v))).alias(f"{v}_{when}") for v in values for when in ("before", "after")
    ])


def penalty_per_offer(df: DataFrame) -> DataFrame:
    """Session-wide largest penalty on each of its accepted offers.

    A grouped maximum joined back: a session of any size is combined map-side, where a window over the
    session would hold it in one task.
    """
    top = df.groupBy(F.col("gvpsessionid").alias("_session")).agg(F.max("penalty").alias("_top"))
    joined = df.join(top, F.col("gvpsessionid").eqNullSafe(F.col("_session")))
    return joined.withColumn("penalty", F.col("_top") * F.col("accepted")).drop("_top", "_session")


def offer_before_after(df: DataFrame, num: str, den: str, out: str) -> DataFrame:
    """Before and after rates per line and offer."""
    rows = df.filter("before_after is not null")
    wide = pivot_before_after(weekly(rows, ("tfn", "before_after", "metric"), (num, den)), ("tfn", "metric"), (num, den))
    return wide.withColumns({f"{out}_{w}": ratio(f"{num}_{w}", f"{den}_{w}") for w in ("before", "after")})


def group_rates(df: DataFrame, num: str, den: str) -> DataFrame:
    """Per line: mean weekly totals before and after, rounded half to even, and their rates."""
    weeks = weekly(df.filter("before_after is not null"), ("tfn", "before_after"), (num, den))

    def mean(v: str, code: int) -> Column:
        return half_even(F.avg(F.when(F.col("before_after") == code, F.col(v))))

    wide = weeks.groupBy("tfn").agg(
        mean(num, 1).alias(f"before_{num}"), mean(den, 1).alias(f"before_{den}"),
        mean(num, 0).alias(num), mean(den, 0).alias(den),
    )
    # Groups missing on either side drop out, as in an inner merge of the two.
    return wide.filter(F.col(f"before_{den}").isNotNull() & F.col(den).isNotNull()).withColumns({
        "before_rate": ratio(f"before_{num}", f"before_{den}"), "rate": ratio(num, den),
    })


def diff_in_diff(rates: DataFrame, num: str, den: str) -> DataFrame:
    """Effect of the pilot against what the control line lets expect. Input has one row per line."""
    def of(group: str, col: str) -> Column:
        return F.max(F.when(F.col("tfn") == group, F.col(col)))

    base = rates.agg(
        of("pilot", "before_rate").alias("pre_p"), of("control", "before_rate").alias("pre_c"),
        of("pilot", "rate").alias("post_p"), of("control", "rate").alias("post_c"),
    )
    b = base.select(F.struct("pre_p", "pre_c", "post_p", "post_c")).scalar()
    out = rates.withColumn("_b", b).withColumns({
        "diff": F.col("_b.pre_p") - F.col("_b.pre_c"),
        "did": (F.col("_b.pre_c") - F.col("_b.post_c")) - (F.col("_b.pre_p") - F.col("_b.post_p")),
        "expected": F.col("_b.post_c") + F.col("_b.pre_p") - F.col("_b.pre_c"),
    })
    return out.withColumns({
        "effect": F.col("rate") - F.col("expected"),
        "effect_pct": F.try_divide("rate", "expected"),
        "total_effect": (F.col("rate") + F.col("did")) * F.col(den) - F.col(num),
    }).drop("_b")


def did_long(did: DataFrame) -> DataFrame:
    """Chart rows: control, pilot and expected, before and after."""
    rows = did.select(F.explode(F.when(
        F.col("tfn") == "pilot", F.array(
            F.struct(F.lit("pilot").alias("group"), F.col("before_rate").alias("pre"), F.col("rate").alias("post")),
            F.struct(F.lit("expected").alias("group"), F.col("before_rate").alias("pre"), F.col("expected").alias("post")),
        )).otherwise(F.array(
            F.struct(F.lit("control").alias("group"), F.col("before_rate").alias("pre"), F.col("rate").alias("post")),
        ))).alias("_r")).select("_r.*")
    return to_long(rows, ["group"], ["pre", "post"], "before_after", "rate")


def to_long(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def clip_std(df: DataFrame, col: str, k: float = 2.0) -> DataFrame:
    """Values cut at plus and minus ``k`` sample standard deviations of the whole column."""
    limit = df.agg(F.stddev_samp(col) * k).scalar()
    return df.withColumn("_limit", limit).withColumn(
        col, F.least(F.greatest(F.col(col), -F.col("_limit")), F.col("_limit"))
    ).drop("_limit")


def logged_q(df: DataFrame) -> DataFrame:
    """q-value of the logged action."""
    return df.withColumn("q_value", pick("q_values", "action")).filter("q_value is not null")


def q_value_rank(df: DataFrame) -> DataFrame:
    """Exact median of the clipped q-value per action, ranked from the best. One row per action."""
    medians = exact_median(clip_std(df, "q_value"), "action_nm", "q_value", "q_value")
    return medians.withColumn("rank", F.dense_rank().over(Window.orderBy(F.col("q_value").desc())))


def histogram(df: DataFrame, col: str, by: str, bins: int) -> DataFrame:
    """Counts per group in ``bins`` equal cells between the smallest and the largest value of all."""
    ends = df.agg(F.struct(F.min(col).alias("lo"), F.max(col).alias("hi"))).scalar()
    cell = F.least(
        F.floor(F.try_divide((F.col(col) - F.col("_e.lo")) * bins, F.col("_e.hi") - F.col("_e.lo"))), F.lit(bins - 1)
    )
    return df.withColumn("_e", ends).groupBy(by, F.coalesce(cell, F.lit(0)).cast("int").alias("bin")).agg(
        F.count(F.lit(1)).alias("n")
    )


def explode_series(df: DataFrame, id_col: str, *arrays: str) -> DataFrame:
    """Parallel arrays to one row per element."""
    return df.select(id_col, F.explode(F.arrays_zip(*arrays)).alias("_z")).select(id_col, "_z.*")
