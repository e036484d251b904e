"""E: ordered work per entity."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.operators import episodes as E
from offerloom.operators import report as R
from offerloom.operators import rewards as W
from offerloom.operators import runs as U
from offerloom.operators import state as S
from offerloom.plans import state_store as N
from offerloom.queries.joins import tokens
from offerloom.queries.registry import DECISIONS, FEATURES, K, REPORT, STEPS, VOCAB, joined, query, state_sql, text
from offerloom.queries.sources import TRAINING, training_steps
from offerloom.session import scratch_path
from offerloom.sources import adapters as A

STATE_COLUMNS = """enterprise_id, CAST(date AS VARCHAR) AS date, array_to_string(names, ',') AS state,
           array_to_string(ids, ',') AS state_tokenized, CAST(size AS INT) AS size, cum_size"""


def shown(state):
    return state.select(
        "enterprise_id", text("date"), joined("state").alias("state"), joined("state_tokenized").alias("state_tokenized"),
        "size", "cum_size",
    )


@query("e1_state_history_first", f"""
    WITH {FEATURES}, {VOCAB}, {state_sql('first', 40)} SELECT {STATE_COLUMNS} FROM state""")
def e1(spark, base):
    return shown(S.state_history(tokens(spark, base), 40, keep="first"))


@query("e2_state_history_last", f"""
    WITH {FEATURES}, {VOCAB}, {state_sql('last', 40)} SELECT {STATE_COLUMNS} FROM state""")
def e2(spark, base):
    return shown(S.state_history(tokens(spark, base), 40))


@query("e2_state_by_nights", f"""
    WITH {FEATURES}, {VOCAB}, {state_sql('last', 40)} SELECT {STATE_COLUMNS} FROM state""")
def e2_nights(spark, base):
    """The same states, kept up to date: days up to one, the days after it, then late tokens of all days."""
    rows, root = tokens(spark, base), scratch_path(spark, "e2n")
    late, early = F.pmod(F.xxhash64("token_name", "date_time"), F.lit(8)) == 0, F.dayofmonth("date") <= 15
    for night in (rows.filter(~late & early), rows.filter(~late & ~early), rows.filter(late)):
        N.add_tokens(spark, night, root, 40)
    return shown(N.stored_history(spark, root))


@query("e3_session_state", f"""
    WITH s AS (SELECT user_id AS enterprise_id, ts, event_type, 'k' || {K} AS kt, length(event_type) AS t1, {K} + 100 AS t2
               FROM events WHERE event_type <> 'error' AND ts::DATE >= DATE '2024-01-31' - 180),
    a AS (SELECT enterprise_id, flatten(list([event_type, kt] ORDER BY ts)) AS e,
                 flatten(list([t1, t2] ORDER BY ts)) AS t FROM s GROUP BY 1)
    SELECT enterprise_id, array_to_string(list_slice(e, greatest(len(e) - 99, 1), len(e)), ',') AS state,
           array_to_string(list_slice(t, greatest(len(t) - 99, 1), len(t)), ',') AS state_tokenized, len(e) AS orig_size FROM a""")
def e3(spark, base):
    rows = S.session_state(S.select_sessions(A.sessions(spark, base), A.AS_OF))
    return rows.select(
        "enterprise_id", joined("state").alias("state"), joined("state_tokenized").alias("state_tokenized"), "orig_size"
    )


@query("e4_current_state", f"""
    WITH {FEATURES}, {VOCAB}, {state_sql('last', 100)} SELECT {STATE_COLUMNS} FROM state WHERE current_record = 1""")
def e4(spark, base):
    return shown(S.flag_current(S.state_history(tokens(spark, base))).filter("current_record = 1"))


@query("e5_repeat_penalty", """
    WITH calls AS (SELECT DISTINCT user_id, ts FROM events),
    p AS (SELECT user_id, ts, min(-3) OVER (PARTITION BY user_id ORDER BY ts
          RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS reward_value FROM calls)
    SELECT user_id AS enterprise_id, CAST(epoch_us(ts) AS BIGINT) AS ts_us, reward_value FROM p WHERE reward_value IS NOT NULL""")
def e5(spark, base):
    rows = W.repeat_penalty(A.event_calls(spark, base))
    return rows.select("enterprise_id", F.unix_micros("date_time").alias("ts_us"), "reward_value")


@query("e5_repeat_penalty_orders", """
    WITH calls AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders),
    p AS (SELECT o_custkey, o_orderdate, min(-3) OVER (PARTITION BY o_custkey ORDER BY o_orderdate
          RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS reward_value FROM calls)
    SELECT o_custkey AS enterprise_id, CAST(o_orderdate::DATE AS VARCHAR) AS date, reward_value FROM p WHERE reward_value IS NOT NULL""")
def e5_orders(spark, base):
    """Midnight calls: both borders of the range are met exactly."""
    calls = A.load(spark, "orders", base).select(
        F.col("o_custkey").alias("enterprise_id"), F.col("o_orderdate").cast("timestamp").alias("date_time")
    )
    return W.repeat_penalty(calls).select(
        "enterprise_id", F.to_date("date_time").cast("string").alias("date"), "reward_value"
    )


def steps(spark, base):
    return E.with_steps(A.decisions(spark, base), "enterprise_id", "time", "eps_id")


@query("e6_steps", f"WITH {STEPS} SELECT enterprise_id, CAST(event_id AS VARCHAR) AS eps_id, t FROM steps")
def e6(spark, base):
    return steps(spark, base).select("enterprise_id", "eps_id", "t")


@query("e7_next_values", f"WITH {TRAINING} SELECT eps_id, t, obs, new_obs, mask, new_mask FROM training")
def e7(spark, base):
    return training_steps(spark, base).select(
        "eps_id", "t", joined("obs", 4).alias("obs"), joined("new_obs", 4).alias("new_obs"), joined("mask").alias("mask"),
        joined("new_mask").alias("new_mask"),
    )


@query("e7_next_known_value", f"""
    WITH {STEPS}, known AS (SELECT enterprise_id, t, CASE WHEN action < 4 THEN action END AS a FROM steps)
    SELECT enterprise_id, t, coalesce(lead(a) OVER w, last_value(a IGNORE NULLS) OVER (w ROWS UNBOUNDED PRECEDING), -1) AS new_a
    FROM known WINDOW w AS (PARTITION BY enterprise_id ORDER BY t)""")
def e7_known(spark, base):
    """Most values are null: the last known one may lie many steps back. Small blocks exercise the carry."""
    action = F.get("actions", F.lit(0))
    known = steps(spark, base).withColumn("a", F.when(action < 4, action))
    rows = E.with_next(known, "enterprise_id", ["a"], size=8)
    return rows.select("enterprise_id", "t", F.coalesce("new_a", F.lit(-1)).alias("new_a"))


@query("e8_dones", f"""
    WITH {STEPS} SELECT enterprise_id, t, CAST(t = max(t) OVER (PARTITION BY enterprise_id) AS INT) AS dones FROM steps""")
def e8(spark, base):
    return E.with_dones(steps(spark, base), "enterprise_id").select("enterprise_id", "t", "dones")


@query("e9_penalty_per_offer", f"""
    WITH {REPORT}, p AS (SELECT *, max(penalty) OVER (PARTITION BY gvpsessionid) * accepted AS pen FROM report)
    SELECT tfn, metric, CAST(sum(pen) AS BIGINT) AS penalty, CAST(sum(accepted) AS BIGINT) AS accepted FROM p
    WHERE metric NOT IN ('call', 'resolved') GROUP BY 1, 2""")
def e9(spark, base):
    rows = R.offers_only(R.penalty_per_offer(A.report(spark, base)))
    return rows.groupBy("tfn", "metric").agg(F.sum("penalty").alias("penalty"), F.sum("accepted").alias("accepted"))


@query("e10_dense_rank", f"""
    WITH {DECISIONS}, s AS (SELECT 2 * stddev_samp(rewards) AS l FROM decisions),
    m AS (SELECT 'a' || action AS action_nm, median(least(greatest(rewards, -l), l)) AS q_value FROM decisions, s GROUP BY 1)
    SELECT action_nm, round(q_value, 6) AS q_value, CAST(dense_rank() OVER (ORDER BY q_value DESC) AS INT) AS rank FROM m""")
def e10(spark, base):
    rows = A.decisions(spark, base).select(
        F.concat(F.lit("a"), F.get("actions", F.lit(0))).alias("action_nm"), F.col("rewards").alias("q_value")
    )
    return R.q_value_rank(rows).withColumn("q_value", F.round("q_value", 6))


SERIES = """hist AS (
    SELECT CAST(user_id AS VARCHAR) AS runid, event_id AS step, epoch_us(ts) AS timestamp, value,
           row_number() OVER (PARTITION BY user_id ORDER BY ts) - 1 AS t,
           row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS back FROM events
), rolled AS (
    SELECT *, CASE WHEN t >= 4 THEN stddev_samp(value) OVER (PARTITION BY runid ORDER BY t ROWS 4 PRECEDING) END AS rolling_val FROM hist
), changed AS (
    SELECT *, lag(rolling_val) OVER (PARTITION BY runid ORDER BY t) AS prev_val FROM rolled
), series AS (SELECT *, abs((prev_val - rolling_val) / nullif(prev_val, 0)) AS diff_pct FROM changed)"""


@query("e11_relative_change", f"""
    WITH {SERIES} SELECT runid, t, coalesce(round(rolling_val, 4), -1) AS rolling_val, coalesce(round(diff_pct, 4), -1) AS diff_pct FROM series""")
def e11(spark, base):
    hist = A.metric_history(spark, base)
    rows = U.run_series(hist, hist.select("runid").distinct())
    return rows.select(
        "runid", "t", F.coalesce(F.round("rolling_val", 4), F.lit(-1.0)).alias("rolling_val"),
        F.coalesce(F.round("diff_pct", 4), F.lit(-1.0)).alias("diff_pct"),
    )


@query("e12_previous", f"""
    WITH {STEPS} SELECT enterprise_id, t, lag(action, 1, 0) OVER w AS prev_action, lag(rewards, 1, 0) OVER w AS prev_rewards
    FROM steps WINDOW w AS (PARTITION BY enterprise_id ORDER BY t)""")
def e12(spark, base):
    rows = steps(spark, base).withColumn("action", F.get("actions", F.lit(0)))
    return E.with_previous(rows, "enterprise_id", ["action", "rewards"]).select(
        "enterprise_id", "t", "prev_action", "prev_rewards"
    )


@query("e13_first_last", """
    SELECT CAST(user_id AS VARCHAR) AS runid, arg_min(value, ts) AS first_value, arg_max(value, ts) AS last_metric FROM events GROUP BY 1""")
def e13(spark, base):
    return U.stable_runs(A.metric_history(spark, base)).select("runid", "first_value", "last_metric")


@query("e14_n_step_return", f"""
    WITH {STEPS}
    SELECT enterprise_id, t, round(rewards + 0.9 * coalesce(lead(rewards, 1) OVER w, 0) + 0.9 * 0.9 * coalesce(lead(rewards, 2) OVER w, 0)
           + 0.9 * 0.9 * 0.9 * coalesce(lead(rewards, 3) OVER w, 0), 6) AS n_return,
           coalesce(lead(action, 4) OVER w, -1) AS n_obs, CAST(lead(t, 4) OVER w IS NULL AS INT) AS n_done
    FROM steps WINDOW w AS (PARTITION BY enterprise_id ORDER BY t)""")
def e14(spark, base):
    rows = steps(spark, base).withColumn("obs", F.get("actions", F.lit(0)))
    return E.n_step_return(rows, "enterprise_id", 4, 0.9).select(
        "enterprise_id", "t", F.round("n_return", 6).alias("n_return"), F.coalesce("n_obs", F.lit(-1)).alias("n_obs"), "n_done"
    )


