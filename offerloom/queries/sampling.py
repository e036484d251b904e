"""F and G: order, top-k, sampling and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.operators import episodes as E
from offerloom.operators import policy as P
from offerloom.operators import report as R
from offerloom.operators import rewards as W
from offerloom.operators import runs as U
from offerloom.operators import sampling as N
from offerloom.operators import state as S
from offerloom.queries.expressions import disposition_fact
from offerloom.queries.joins import tokens
from offerloom.queries.registry import DECISIONS, FEATURES, FLAGS, REPORT, VOCAB, joined, query, state_sql, text, u
from offerloom.queries.sources import PENALTY, penalty_fact
from offerloom.sources import adapters as A
from offerloom.sources.decision_log import source_dates
from offerloom.session import scratch_path


@query("f1_order_by", f"""
    WITH {DECISIONS} SELECT app, CAST(time::DATE AS VARCHAR) AS date, count(*) AS volume FROM decisions GROUP BY 1, 2 ORDER BY 1, 2 DESC""")
def f1(spark, base):
    rows = R.daily_volume(A.decisions(spark, base)).select("app", text("date"), "volume")
    return rows.orderBy("app", F.col("date").desc())


@query("f2_sample_n", f"""
    SELECT o_custkey FROM (SELECT DISTINCT o_custkey FROM orders) ORDER BY {u('o_custkey', 5)}, o_custkey LIMIT 30""")
def f2(spark, base):
    return N.sample_n(A.load(spark, "orders", base), 30, 5, "o_custkey")


@query("f3_sample_fraction", f"""
    WITH {FEATURES}, {VOCAB}, {state_sql()}
    SELECT enterprise_id, array_to_string(ids, ',') AS state FROM state WHERE current_record = 1 AND {u('enterprise_id', 11)} < 0.3""")
def f3(spark, base):
    current = S.flag_current(S.state_history(tokens(spark, base))).filter("current_record = 1")
    rows = N.sample_fraction(current, 0.3, 11, "enterprise_id")
    return rows.select("enterprise_id", joined("state_tokenized").alias("state"))


@query("f4_balance_groups", f"""
    WITH {REPORT}, n AS (SELECT count(*) FILTER (WHERE tfn = 'pilot') / CAST(count(*) FILTER (WHERE tfn = 'control') AS DOUBLE) AS share FROM report)
    SELECT tfn, metric, count(*) AS n FROM report, n
    WHERE tfn = 'pilot' OR {u("gvpsessionid, ':', metric", 42)} < share GROUP BY 1, 2""")
def f4(spark, base):
    rows = N.balance_groups(A.report(spark, base), "control_pilot", 0, 1, 42, "gvpsessionid", "metric")
    return rows.groupBy("tfn", "metric").agg(F.count(F.lit(1)).alias("n"))


@query("f5_top_ranked", """
    WITH r AS (SELECT CAST(user_id AS VARCHAR) AS runid, arg_max(value, ts) AS last_metric FROM events GROUP BY 1),
    k AS (SELECT *, dense_rank() OVER (ORDER BY last_metric DESC) AS rank FROM r)
    SELECT runid, last_metric, CAST(rank AS INT) AS rank FROM k WHERE rank <= 10""")
def f5(spark, base):
    runs = U.stable_runs(A.metric_history(spark, base)).select("runid", "last_metric")
    return N.top_ranked(runs, "last_metric", 10).select("runid", "last_metric", "rank")


@query("f6_epoch_sample", f"SELECT event_id FROM events ORDER BY {u('event_id', 3)}, event_id LIMIT 200")
def f6(spark, base):
    return N.epoch_sample(A.load(spark, "events", base).select("event_id"), 200, 3, "event_id")


@query("f7_sample_actions", f"""
    WITH v AS (SELECT vec_id AS id, label AS action, embedding::DOUBLE[] AS l FROM embeddings),
    x AS (SELECT id, action, unnest(range(64)) AS a, l FROM v),
    e AS (SELECT id, action, a, exp(CASE WHEN a = action THEN -1000 ELSE l[a + 1] END
                 - list_max(list_transform(l, lambda y, i: CASE WHEN i = action + 1 THEN -1000 ELSE y END))) AS e FROM x),
    p AS (SELECT id, action, a, e / sum(e) OVER (PARTITION BY id) AS p FROM e),
    k AS (SELECT id, action, a, -ln({u("id, ':', a", 9)}) / p AS key FROM p WHERE p > 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY key) AS rk FROM k)
    SELECT id, any_value(action) || ',' || string_agg(a, ',' ORDER BY rk) AS actions FROM r WHERE rk <= 3 GROUP BY 1""")
def f7(spark, base):
    return P.sample_actions(A.scores(spark, base), 3, 9, "id").select("id", joined("actions").alias("actions"))



@query("f8_explore", f"""
    WITH v AS (SELECT vec_id AS id, label AS action, list_filter(range(64), lambda i: (vec_id + i) % 3 > 0) AS legal FROM embeddings)
    SELECT id, CASE WHEN {u('id', '4-eps')} < 0.1 THEN legal[CAST(floor({u('id', '4-pick')} * len(legal)) AS INT) + 1] ELSE action END AS action
    FROM v""")
def f8(spark, base):
    return P.explore(A.scores(spark, base), 4, "id").select("id", F.col("action").cast("bigint"))


@query("f9_suppress_none", f"""
    WITH v AS (SELECT vec_id AS id, list_transform(range(64), lambda i: CAST((vec_id + i) % 3 > 0 AS INT)) AS mask FROM embeddings)
    SELECT id, CASE WHEN {u('id', 6)} > 0.1 THEN 0 ELSE mask[1] END AS none_legal, CAST(list_sum(mask[2:]) AS BIGINT) AS others FROM v""")
def f9(spark, base):
    rows = P.suppress_none(A.scores(spark, base), 6, "id")
    return rows.select(
        "id", F.get("mask", F.lit(0)).alias("none_legal"),
        F.aggregate(F.slice("mask", 2, 63), F.lit(0), lambda s, x: s + x).cast("bigint").alias("others"),
    )


@query("g1_union_rewards", f"""
    WITH {FLAGS}, {PENALTY}, a AS (
        SELECT o_custkey AS enterprise_id, o_orderdate::DATE AS date, sum(accepted) AS rewards
        FROM disp JOIN orders ON call_guid = CAST(o_orderkey AS VARCHAR) GROUP BY 1, 2
        UNION ALL
        SELECT user_id, ts::DATE, sum(reward_value) FROM penalties WHERE reward_value IS NOT NULL GROUP BY 1, 2)
    SELECT enterprise_id, CAST(date AS VARCHAR) AS date, CAST(sum(rewards) AS BIGINT) AS rewards FROM a GROUP BY 1, 2""")
def g1(spark, base):
    rows = W.combine_rewards(penalty_fact(spark, base), disposition_fact(spark, base))
    return rows.select("enterprise_id", text("date"), "rewards")


@query("g1_steps_with_rewards", f"""
    WITH {DECISIONS}, {PENALTY}, r AS (
        SELECT user_id AS enterprise_id, ts::DATE AS date, sum(reward_value) AS rewards FROM penalties
        WHERE reward_value IS NOT NULL GROUP BY 1, 2),
    s AS (SELECT enterprise_id, time, implementation, action, rewards FROM decisions
          UNION ALL SELECT enterprise_id, date, 'rx', 0, rewards FROM r)
    SELECT enterprise_id, implementation, count(*) AS n, CAST(sum(action) AS BIGINT) AS actions, round(sum(rewards), 4) AS rewards
    FROM s GROUP BY 1, 2""")
def g1_steps(spark, base):
    """The log holds the entity as text, the rewards as a number."""
    log = A.decisions(spark, base).withColumn("enterprise_id", F.col("enterprise_id").cast("string"))
    steps = E.steps_with_rewards(log, W.daily_rewards(penalty_fact(spark, base), "reward_value"))
    return steps.groupBy("enterprise_id", "implementation").agg(
        F.count(F.lit(1)).alias("n"), F.sum("action").alias("actions"), F.round(F.sum("rewards"), 4).alias("rewards")
    )


@query("g2_date_difference", """
    SELECT DISTINCT CAST(ts::DATE AS VARCHAR) AS date FROM events WHERE ts::DATE NOT IN (
        SELECT ts::DATE FROM events WHERE event_type = 'signup' AND ts::DATE < DATE '2024-01-10')""")
def g2(spark, base):
    from offerloom.queries.sources import write_log

    src = source_dates(spark, write_log(spark, base, scratch_path(spark, "g2")))
    loaded = A.features(spark, base).filter("feature_name = 'signup' and date < '2024-01-10'").select(
        F.col("date").alias("partition_field")
    )
    return src.join(loaded, "partition_field", "left_anti").select(F.col("partition_field").cast("string").alias("date"))
