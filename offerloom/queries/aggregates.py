"""D: aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.operators import dispositions as D
from offerloom.operators import report as R
from offerloom.operators import rewards as W
from offerloom.operators import sketches as H
from offerloom.operators import state as S
from offerloom.operators.blocks import exact_median
from offerloom.operators.vocabulary import build_vocabulary, vocab_size
from offerloom.queries.expressions import (
    OFFER_REPORT, disposition_rows, flags, offer_sessions,
)
from offerloom.queries.joins import features, tokens
from offerloom.queries.registry import CALLS, DECISIONS, FEATURES, FLAGS, REPORT, VOCAB, WEEK, joined, query, text
from offerloom.queries.sources import PENALTY, penalty_fact
from offerloom.session import scratch_path
from offerloom.sources import adapters as A
from offerloom.sources import tables as T


@query("d1_rollup_flags", f"WITH {FLAGS} SELECT * FROM flags")
def d1(spark, base):
    return flags(spark, base)


@query("d2_dispositions", f"WITH {FLAGS} SELECT * FROM disp")
def d2(spark, base):
    return disposition_rows(spark, base)


@query("d3_daily_state", f"""
    WITH {FEATURES}, {VOCAB}
    SELECT enterprise_id, CAST(date AS VARCHAR) AS date, CAST((pos - 1) // 10000 AS INT) AS part,
           string_agg(token_name, ',' ORDER BY date_time, token_name) AS state,
           string_agg(token, ',' ORDER BY date_time, token_name) AS state_tokenized, CAST(count(*) AS INT) AS size
    FROM (SELECT *, row_number() OVER (PARTITION BY enterprise_id, date ORDER BY date_time, token_name, token) AS pos FROM tokens)
    GROUP BY 1, 2, 3""")
def d3(spark, base):
    return S.daily_state(tokens(spark, base)).select(
        "enterprise_id", text("date"), "part", joined("state").alias("state"), joined("state_tokenized").alias("state_tokenized"), "size"
    )


@query("d4_offer_report")
def d4(spark, base):
    """Approximate member counts; the exact twin is the next query."""
    return D.offer_report(offer_sessions(spark, base)).withColumn("startdate", F.col("startdate").cast("string"))


@query("d4_offer_report_exact", f"""
    WITH {OFFER_REPORT} SELECT metric, CAST(startdate AS VARCHAR) AS startdate, tfn, members, sessions, offered, accepted, success,
        failure, offered_not_accepted FROM offer_report""")
def d4_exact(spark, base):
    return D.offer_report(offer_sessions(spark, base), exact=True).withColumn("startdate", F.col("startdate").cast("string"))


def close(estimate, exact, share):
    return (F.abs(estimate - exact) <= exact * share + 1).cast("int")


@query("d4_stored_sketches", f"""
    WITH {OFFER_REPORT}, m AS (
        SELECT metric, tfn, CAST(date_trunc('month', startdate) AS VARCHAR) AS month, count(*) AS sessions, count(DISTINCT cagm) AS exact
        FROM session GROUP BY 1, 2, 3)
    SELECT metric, tfn, substr(month, 1, 7) AS month, sessions, exact, 1 AS members_close FROM m""")
def d4_sketches(spark, base):
    """Members by month, merged from stored sketches of days, within 4 standard errors of the exact count."""
    keys = ["metric", "tfn", F.date_format("startdate", "yyyy-MM").alias("month")]
    rows, out = offer_sessions(spark, base), scratch_path(spark, "d4s")
    T.overwrite(H.daily_sketches(rows, ["metric", "tfn"], "startdate", "cagm", "offered"), out)
    by_month = H.estimates(H.merge_sketches(spark.read.parquet(out), keys), {})
    exact = rows.groupBy(*keys).agg(F.count_distinct("cagm").alias("exact"))
    share = 4 * 1.04 / 2 ** (H.LG_K / 2)
    return by_month.join(exact, ["metric", "tfn", "month"]).select(
        "metric", "tfn", "month", F.col("n").alias("sessions"), "exact", close(F.col("members"), F.col("exact"), share).alias("members_close")
    )


@query("d5_session_totals", f"""
    WITH {FLAGS}, {CALLS}
    SELECT call_guid, CAST(sum(offered) AS INT) AS offered, CAST(sum(accepted) AS INT) AS accepted, CAST(sum(success) AS INT) AS success,
           coalesce(string_agg(offer, ',' ORDER BY offer) FILTER (WHERE offered = 1), '') AS offered_list,
           coalesce(string_agg(offer, ',' ORDER BY offer) FILTER (WHERE accepted = 1), '') AS accepted_list
    FROM disp JOIN good_calls USING (call_guid) GROUP BY 1""")
def d5(spark, base):
    return W.session_totals(offer_sessions(spark, base)).select(
        "call_guid", "offered", "accepted", "success", joined("offered_list").alias("offered_list"),
        joined("accepted_list").alias("accepted_list"),
    )


@query("d6_daily_rewards", f"""
    WITH {PENALTY}
    SELECT user_id AS enterprise_id, CAST(ts::DATE AS VARCHAR) AS date, 'rx' AS source, CAST(sum(reward_value) AS BIGINT) AS rewards
    FROM penalties WHERE reward_value IS NOT NULL GROUP BY 1, 2""")
def d6(spark, base):
    return W.daily_rewards(penalty_fact(spark, base), "reward_value").select("enterprise_id", text("date"), "source", "rewards")


@query("d7_daily_volume", f"""
    WITH {DECISIONS} SELECT app, CAST(time::DATE AS VARCHAR) AS date, count(*) AS volume FROM decisions GROUP BY 1, 2""")
def d7(spark, base):
    rows = R.daily_volume(A.decisions(spark, base)).orderBy("app", F.col("date").desc())
    return rows.select("app", text("date"), "volume")


@query("d8_daily_counts", f"""
    WITH {REPORT}, d AS (SELECT DISTINCT gvpsessionid, startdate, tfn FROM report)
    SELECT CAST(startdate AS VARCHAR) AS startdate, tfn, count(*) AS n FROM d GROUP BY 1, 2""")
def d8(spark, base):
    sessions = A.report(spark, base).select("gvpsessionid", "startdate", "tfn").distinct()
    return R.daily_counts(sessions, ["startdate", "tfn"]).withColumn("startdate", F.col("startdate").cast("string"))


@query("d9_mean_of_daily", f"""
    WITH {REPORT}, d AS (SELECT startdate, before_after, tfn, sum(accepted) AS accepted FROM report
        WHERE before_after IS NOT NULL GROUP BY 1, 2, 3)
    SELECT before_after, tfn, round(avg(accepted), 4) AS avg_accepted FROM d GROUP BY 1, 2""")
def d9(spark, base):
    daily = A.report(spark, base).filter("before_after is not null").groupBy("startdate", "before_after", "tfn").agg(
        F.sum("accepted").alias("accepted")
    )
    return R.mean_of_daily(daily, ("before_after", "tfn"), "accepted", "avg_accepted", 4)


@query("d10_session_metric", f"""
    WITH {REPORT}, s AS (SELECT gvpsessionid, cagm, tfn, startdate, max(penalty) AS p FROM report
        WHERE metric = 'call' AND xferstatus = 'XFER' GROUP BY 1, 2, 3, 4)
    SELECT tfn, CAST(startdate AS VARCHAR) AS startdate, CAST(sum(p) AS BIGINT) AS repeat_calls, count(*) AS calls FROM s GROUP BY 1, 2""")
def d10(spark, base):
    rows = R.session_metric(
        A.report(spark, base), "call", "repeat_calls", ("tfn", "startdate"), F.col("xferstatus") == "XFER"
    )
    return rows.select("tfn", text("startdate"), "repeat_calls", "calls")


@query("d11_weekly", f"""
    WITH {REPORT}
    SELECT CAST({WEEK} AS VARCHAR) AS week, tfn, CAST(sum(offered) AS BIGINT) AS offered, CAST(sum(accepted) AS BIGINT) AS accepted
    FROM report WHERE metric NOT IN ('call', 'resolved') GROUP BY 1, 2""")
def d11(spark, base):
    rows = R.weekly(R.offers_only(A.report(spark, base)), ["tfn"], ["offered", "accepted"])
    return rows.withColumn("week", F.col("week").cast("string"))


@query("d12_pivot_before_after", f"""
    WITH {REPORT}
    SELECT tfn, metric, CAST(sum(offered) FILTER (WHERE before_after = 1) AS BIGINT) AS offered_before,
           CAST(sum(offered) FILTER (WHERE before_after = 0) AS BIGINT) AS offered_after,
           CAST(sum(accepted) FILTER (WHERE before_after = 1) AS BIGINT) AS accepted_before,
           CAST(sum(accepted) FILTER (WHERE before_after = 0) AS BIGINT) AS accepted_after
    FROM report WHERE metric NOT IN ('call', 'resolved') AND before_after IS NOT NULL GROUP BY 1, 2""")
def d12(spark, base):
    rows = R.offers_only(A.report(spark, base), F.col("before_after").isNotNull())
    return R.pivot_before_after(rows, ("tfn", "metric"), ("offered", "accepted"))


@query("d13_distinct", "SELECT DISTINCT o_custkey, o_orderstatus FROM orders")
def d13(spark, base):
    return A.load(spark, "orders", base).select("o_custkey", "o_orderstatus").distinct()


@query("d14_median", "SELECT event_type, round(median(value), 6) AS median FROM events GROUP BY 1")
def d14(spark, base):
    rows = exact_median(A.load(spark, "events", base), "event_type", "value", "median")
    return rows.withColumn("median", F.round("median", 6))


@query("d14_stored_sketches", """
    SELECT event_type, count(*) AS n, 1 AS median_close, 1 AS p90_close FROM events GROUP BY 1""")
def d14_sketches(spark, base):
    """Quantiles of the whole range from stored sketches of days: their true ranks are within 4 % of those asked for."""
    rows, out = A.load(spark, "events", base), scratch_path(spark, "d14s")
    T.overwrite(H.daily_sketches(rows.withColumn("day", F.to_date("ts")), ["event_type"], "day", "user_id", "value"), out)
    read = H.estimates(H.merge_sketches(spark.read.parquet(out), ["event_type"]), {"median": 0.5, "p90": 0.9})
    below = [F.avg((F.col("value") < F.col(q)).cast("int")).alias(f"{q}_below") for q in ("median", "p90")]
    ranks = rows.join(read.select("event_type", "median", "p90"), "event_type").groupBy("event_type").agg(*below)
    return read.join(ranks, "event_type").select(
        "event_type", "n", *[(F.abs(F.col(f"{q}_below") - r) <= 0.04).cast("int").alias(f"{q}_close") for q, r in (("median", 0.5), ("p90", 0.9))]
    )


@query("d15_vocab_size", f"WITH {FEATURES}, {VOCAB} SELECT CAST(max(token) + 1 AS INT) AS vocab_size FROM vocab")
def d15(spark, base):
    return vocab_size(build_vocabulary(features(spark, base)))


@query("d16_value_by_action", f"""
    WITH {DECISIONS}
    SELECT action, count(*) AS n, round(sum(rewards), 4) AS total_value, round(avg(rewards), 6) AS mean_value FROM decisions GROUP BY 1""")
def d16(spark, base):
    rows = A.decisions(spark, base).groupBy(F.get("actions", F.lit(0)).alias("action"))
    return rows.agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("rewards"), 4).alias("total_value"),
        F.round(F.avg("rewards"), 6).alias("mean_value"),
    )


@query("d17_histogram", """
    WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events)
    SELECT event_type, CAST(least(floor((value - lo) * 20 / (hi - lo)), 19) AS INT) AS bin, count(*) AS n FROM events, e GROUP BY 1, 2""")
def d17(spark, base):
    return R.histogram(A.load(spark, "events", base), "value", "event_type", 20)


