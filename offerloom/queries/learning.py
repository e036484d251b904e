"""V, H, I, J: dictionaries, experiment reports, off-policy evaluation, run selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.operators import episodes as E
from offerloom.operators import evaluation as V
from offerloom.operators import policy as P
from offerloom.operators import report as R
from offerloom.operators import runs as U
from offerloom.operators import sampling as N
from offerloom.operators.vocabulary import build_vocabulary
from offerloom.queries.functions import WORDS, words
from offerloom.queries.joins import features
from offerloom.queries.registry import FEATURES, K, REPORT, STEPS, WEEK, query, u
from offerloom.queries.windows import SERIES, steps
from offerloom.sources import adapters as A


@query("v1_build_vocabulary", f"""
    WITH w AS (SELECT DISTINCT unnest({WORDS}) AS token_name FROM documents)
    SELECT token_name, CAST(row_number() OVER (ORDER BY token_name) AS INT) AS token FROM w""")
def v1(spark, base):
    """Every distinct word of all documents."""
    return build_vocabulary(words(spark, base).select(F.explode("words").alias("token_name")))


@query("v1_extend_vocabulary", f"""
    WITH {FEATURES}, old AS (
        SELECT token_name, row_number() OVER (ORDER BY token_name) AS token FROM (SELECT DISTINCT token_name FROM features
        WHERE token_name LIKE 'signup%' OR token_name LIKE 'view%')),
    new AS (SELECT token_name, (SELECT max(token) FROM old) + row_number() OVER (ORDER BY token_name) AS token
        FROM (SELECT DISTINCT token_name FROM features) WHERE token_name NOT IN (SELECT token_name FROM old))
    SELECT token_name, CAST(token AS INT) AS token FROM old UNION ALL SELECT token_name, CAST(token AS INT) FROM new""")
def v1_extend(spark, base):
    """Old ids stay although new names sort before them."""
    rows = features(spark, base)
    old = build_vocabulary(rows.filter("feature_name in ('signup', 'view')"))
    return build_vocabulary(rows, existing=old)


@query("v2_dense_id", """
    WITH c AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS eps_id FROM customer)
    SELECT o_orderkey, eps_id FROM orders JOIN c ON c_name = 'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')""")
def v2(spark, base):
    ids = E.with_dense_id(A.id_map(spark, base), "alternative_id").select(F.col("alternative_id").alias("cagm"), "eps_id")
    return A.calls(spark, base).join(ids, "cagm").select(F.col("call_guid").cast("bigint").alias("o_orderkey"), "eps_id")


def rates_sql(source: str, num: str, den: str) -> str:
    return f"""{REPORT}, daily AS ({source}), wk AS (
        SELECT {WEEK} AS week, tfn, before_after, sum(num) AS num, sum(den) AS den FROM daily WHERE before_after IS NOT NULL GROUP BY 1, 2, 3
    ), rates AS (
        SELECT tfn, round_even(avg(num) FILTER (WHERE before_after = 1), 0) AS before_{num},
               round_even(avg(den) FILTER (WHERE before_after = 1), 0) AS before_{den},
               round_even(avg(num) FILTER (WHERE before_after = 0), 0) AS {num},
               round_even(avg(den) FILTER (WHERE before_after = 0), 0) AS {den},
               before_{num} / nullif(before_{den}, 0) AS before_rate, {num} / nullif({den}, 0) AS rate
        FROM wk GROUP BY 1
    ), base AS (
        SELECT max(before_rate) FILTER (WHERE tfn = 'pilot') AS pre_p, max(before_rate) FILTER (WHERE tfn = 'control') AS pre_c,
               max(rate) FILTER (WHERE tfn = 'pilot') AS post_p, max(rate) FILTER (WHERE tfn = 'control') AS post_c FROM rates
    ), did AS (
        SELECT rates.*, pre_p - pre_c AS diff, (pre_c - post_c) - (pre_p - post_p) AS did, post_c + pre_p - pre_c AS expected,
               rate - (post_c + pre_p - pre_c) AS effect, rate / (post_c + pre_p - pre_c) AS effect_pct,
               (rate + ((pre_c - post_c) - (pre_p - post_p))) * {den} - {num} AS total_effect FROM rates, base
    )"""


CALL_RATES = rates_sql("""
    SELECT tfn, startdate, before_after, sum(p) AS num, count(*) AS den FROM (
        SELECT gvpsessionid, cagm, tfn, startdate, before_after, max(penalty) AS p FROM report
        WHERE metric = 'call' AND startdate >= DATE '1996-01-01' AND xferstatus = 'XFER' GROUP BY 1, 2, 3, 4, 5) GROUP BY 1, 2, 3""",
    "repeat_calls", "calls")


def call_rates(spark, base):
    daily = R.session_metric(
        A.report(spark, base), "call", "repeat_calls", ("tfn", "startdate", "before_after"),
        F.col("startdate") >= "1996-01-01", F.col("xferstatus") == "XFER",
    )
    return R.group_rates(daily, "repeat_calls", "calls")


@query("h1_group_rates", f"""
    WITH {CALL_RATES} SELECT tfn, before_repeat_calls, before_calls, repeat_calls, calls, round(before_rate, 6) AS before_rate,
    round(rate, 6) AS rate FROM rates""")
def h1(spark, base):
    rates = call_rates(spark, base)
    return rates.select(
        "tfn", "before_repeat_calls", "before_calls", "repeat_calls", "calls",
        *[F.round(c, 6).alias(c) for c in ("before_rate", "rate")],
    )


ACCEPT_RATES = rates_sql("""
    SELECT tfn, startdate, before_after, sum(accepted) AS num, sum(offered) AS den FROM report
    WHERE metric NOT IN ('call', 'resolved') AND offered = 1 GROUP BY 1, 2, 3""", "accepted", "offered")

DID_COLUMNS = ("before_rate", "rate", "diff", "did", "expected", "effect", "effect_pct", "total_effect")


def accept_did(spark, base):
    rows = R.offers_only(A.report(spark, base), F.col("offered") == 1)
    return R.diff_in_diff(R.group_rates(rows, "accepted", "offered"), "accepted", "offered")


@query("h2_diff_in_diff", f"""
    WITH {ACCEPT_RATES} SELECT tfn, {', '.join(f'round({c}, 6) AS {c}' for c in DID_COLUMNS)} FROM did""")
def h2(spark, base):
    return accept_did(spark, base).select("tfn", *[F.round(c, 6).alias(c) for c in DID_COLUMNS])


@query("h2_diff_in_diff_calls", f"""
    WITH {CALL_RATES} SELECT tfn, {', '.join(f'round({c}, 6) AS {c}' for c in DID_COLUMNS)} FROM did""")
def h2_calls(spark, base):
    did = R.diff_in_diff(call_rates(spark, base), "repeat_calls", "calls")
    return did.select("tfn", *[F.round(c, 6).alias(c) for c in DID_COLUMNS])


@query("h3_offer_before_after", f"""
    WITH {REPORT}, p AS (SELECT *, max(penalty) OVER (PARTITION BY gvpsessionid) * accepted AS pen FROM report
        WHERE startdate >= DATE '1996-01-01' AND xferstatus = 'XFER' AND before_after IS NOT NULL),
    g AS (SELECT tfn, metric, CAST(sum(pen) FILTER (WHERE before_after = 1) AS BIGINT) AS repeat_calls_before,
        CAST(sum(pen) FILTER (WHERE before_after = 0) AS BIGINT) AS repeat_calls_after,
        CAST(sum(accepted) FILTER (WHERE before_after = 1) AS BIGINT) AS accepted_before,
        CAST(sum(accepted) FILTER (WHERE before_after = 0) AS BIGINT) AS accepted_after
        FROM p WHERE metric NOT IN ('call', 'resolved') GROUP BY 1, 2)
    SELECT *, round(repeat_calls_before / nullif(accepted_before, 0)::DOUBLE, 6) AS call_rate_before,
           round(repeat_calls_after / nullif(accepted_after, 0)::DOUBLE, 6) AS call_rate_after FROM g""")
def h3(spark, base):
    rows = A.report(spark, base).filter("startdate >= '1996-01-01' and xferstatus = 'XFER' and before_after is not null")
    offers = R.offers_only(R.penalty_per_offer(rows)).withColumnRenamed("penalty", "repeat_calls")
    wide = R.offer_before_after(offers, "repeat_calls", "accepted", "call_rate")
    return wide.withColumns({c: F.round(c, 6) for c in ("call_rate_before", "call_rate_after")})


def weekly_rate_sql(cond: str) -> str:
    return f"""
    WITH {REPORT}
    SELECT CAST({WEEK} AS VARCHAR) AS week, tfn, CAST(sum(accepted) AS BIGINT) AS accepted, CAST(sum(offered) AS BIGINT) AS offered,
           round(sum(accepted) / nullif(sum(offered), 0)::DOUBLE, 6) AS accepted_rate
    FROM report WHERE metric NOT IN ('call', 'resolved') AND offered = 1 AND {cond} GROUP BY 1, 2"""


def weekly_rate(rows):
    return rows.withColumns({"week": F.col("week").cast("string"), "accepted_rate": F.round("accepted_rate", 6)})


@query("h4_accepted_rate_weekly", weekly_rate_sql("true"))
def h4(spark, base):
    return weekly_rate(R.accepted_rate_weekly(A.report(spark, base)))


@query("h4_accepted_rate_weekly_offer", weekly_rate_sql("metric = 'renewal'"))
def h4_offer(spark, base):
    return weekly_rate(R.accepted_rate_weekly(A.report(spark, base), "renewal"))


def session_rate_sql(metric: str, cond: str) -> str:
    return f"""
    WITH {REPORT}, s AS (SELECT gvpsessionid, cagm, tfn, startdate, max(penalty) AS p FROM report
        WHERE metric = '{metric}' AND {cond} GROUP BY 1, 2, 3, 4)
    SELECT CAST({WEEK} AS VARCHAR) AS week, tfn, CAST(sum(p) AS BIGINT) AS n, count(*) AS calls,
           round(sum(p) / count(*)::DOUBLE, 6) AS rate FROM s GROUP BY 1, 2"""


def session_rate(spark, base, metric, *conds):
    daily = R.session_metric(A.report(spark, base), metric, "n", ("tfn", "startdate"), *conds)
    return R.rate_weekly(daily, "n", "calls", "rate").withColumns({"week": F.col("week").cast("string"), "rate": F.round("rate", 6)})


@query("h5_repeat_call_rate_weekly", session_rate_sql("call", "xferstatus = 'XFER'"))
def h5(spark, base):
    return session_rate(spark, base, "call", F.col("xferstatus") == "XFER")


@query("h5_resolved_rate_weekly", session_rate_sql("resolved", "true"))
def h5_resolved(spark, base):
    return session_rate(spark, base, "resolved")


@query("h6_q_value_rank", """
    WITH q AS (SELECT 'a' || label AS action_nm, embedding[label + 1]::DOUBLE AS q FROM embeddings WHERE label NOT IN (8, 9)),
    s AS (SELECT 2 * stddev_samp(q) AS l FROM q),
    m AS (SELECT action_nm, median(least(greatest(q, -l), l)) AS q_value FROM q, s GROUP BY 1)
    SELECT action_nm, round(q_value, 6) AS q_value, CAST(dense_rank() OVER (ORDER BY q_value DESC) AS INT) AS rank FROM m""")
def h6(spark, base):
    rows = A.scores(spark, base).filter("action not in (8, 9)").withColumns({
        "q_values": F.col("logits"), "action_nm": F.concat(F.lit("a"), "action"),
    })
    return R.q_value_rank(R.logged_q(rows)).withColumn("q_value", F.round("q_value", 6))


@query("h7_did_long", f"""
    WITH {ACCEPT_RATES}, r AS (
        SELECT tfn AS "group", before_rate AS pre, rate AS post FROM did
        UNION ALL SELECT 'expected', before_rate, expected FROM did WHERE tfn = 'pilot')
    SELECT "group", 'pre' AS before_after, round(pre, 6) AS rate FROM r UNION ALL SELECT "group", 'post', round(post, 6) FROM r""")
def h7(spark, base):
    return R.did_long(accept_did(spark, base)).withColumn("rate", F.round("rate", 6))


@query("i1_split_by_key", f"""
    SELECT event_id, CASE WHEN {u('user_id', 42)} < 0.7 THEN 0 ELSE 1 END AS split FROM events""")
def i1(spark, base):
    return N.split_by_key(A.load(spark, "events", base).select("event_id", "user_id"), "user_id").select("event_id", "split")


def evaluable(spark, base):
    """Steps with the probability of a policy close to the logged one, and model values."""
    k = F.col("k")
    raw = A.load(spark, "events", base).withColumn("k", A.k_of()).select(
        F.col("user_id").alias("eps_id"), F.col("ts").cast("timestamp").alias("time"), "event_id", F.col("value").alias("reward"),
        ((F.pmod(k, F.lit(7)) + 2) / F.lit(10.0)).alias("p_b"),
        F.when((k == 99) & (F.col("event_type") == "error"), 0.0)
        .otherwise((F.pmod(k, F.lit(7)) + 2) / F.lit(10.0) + (F.pmod(k, F.lit(3)) - 1) * F.lit(0.01)).alias("p_t"),
        (k / F.lit(10.0)).alias("q_hat"), ((k + 5) / F.lit(10.0)).alias("v_hat"),
    )
    return V.weighted_steps(raw, "eps_id", "time", "event_id")


EVALUABLE = f"""raw AS (
    SELECT user_id AS eps_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS t, value::DOUBLE AS reward,
           ({K} % 7 + 2) / 10.0::DOUBLE AS p_b,
           CASE WHEN {K} = 99 AND event_type = 'error' THEN 0.0::DOUBLE ELSE ({K} % 7 + 2) / 10.0::DOUBLE + ({K} % 3 - 1) * 0.01::DOUBLE END AS p_t,
           {K} / 10.0::DOUBLE AS q_hat, ({K} + 5) / 10.0::DOUBLE AS v_hat FROM events
), logs AS (
    SELECT *, pow(0.99::DOUBLE, t) AS g, CASE WHEN p_t > 0 THEN ln(p_t / p_b) ELSE 0 END AS l, CAST(p_t <= 0 AS INT) AS z FROM raw
), w AS (
    SELECT *, CASE WHEN sum(z) OVER o > 0 THEN 0 ELSE exp(sum(l) OVER o) END AS w,
           CASE WHEN sum(z) OVER o - z > 0 THEN 0 ELSE exp(sum(l) OVER o - l) END AS w_prev
    FROM logs WINDOW o AS (PARTITION BY eps_id ORDER BY t ROWS UNBOUNDED PRECEDING)
), n AS (SELECT count(DISTINCT eps_id) AS n, sum(g * reward) / count(DISTINCT eps_id) AS v_behavior FROM w)"""


def estimate_sql(target: str) -> str:
    return f"""WITH {EVALUABLE}, e AS ({target})
    SELECT round(v_behavior, 4) AS v_behavior, round(v_target, 4) AS v_target, round(v_target / greatest(v_behavior, 1e-8), 6) AS v_gain FROM e, n"""


def rounded(df):
    return df.select(F.round("v_behavior", 4).alias("v_behavior"), F.round("v_target", 4).alias("v_target"),
                     F.round("v_gain", 6).alias("v_gain"))


IS = "SELECT sum(g * w * reward) / any_value(n) AS v_target FROM w, n"
WIS = """SELECT sum(s / nullif(m, 0)) / any_value(n) AS v_target
         FROM (SELECT t, sum(g * w * reward) AS s, avg(w) AS m FROM w GROUP BY 1), n"""
DR = "SELECT sum(g * (w_prev * v_hat + w * (reward - q_hat))) / any_value(n) AS v_target FROM w, n"


@query("i2_importance_sampling", estimate_sql(IS))
def i2(spark, base):
    return rounded(V.ope_is(evaluable(spark, base)))


@query("i3_weighted_importance_sampling", estimate_sql(WIS))
def i3(spark, base):
    return rounded(V.ope_wis(evaluable(spark, base)))


@query("i4_doubly_robust", estimate_sql(DR))
def i4(spark, base):
    return rounded(V.ope_dr(evaluable(spark, base)))


@query("i5_direct_method", f"WITH {EVALUABLE} SELECT round(avg(v_hat), 6) AS v_target FROM w WHERE t = 0")
def i5(spark, base):
    return V.ope_dm(evaluable(spark, base)).withColumn("v_target", F.round("v_target", 6))


@query("i6_compare_policies", """
    WITH a AS (SELECT CAST(range AS INT) AS action FROM range(64)),
    v AS (SELECT vec_id, label, list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN (vec_id + i - 1) % 3 > 0 THEN x END) AS l FROM embeddings),
    s AS (SELECT label AS orig_action, list_position(l, list_max(l)) - 1 AS action, list_max(l) AS value FROM v),
    n AS (SELECT action, count(*) AS new_dist, sum(value) AS total_value, avg(value) AS mean_value FROM s GROUP BY 1),
    o AS (SELECT orig_action AS action, count(*) AS orig_dist FROM s GROUP BY 1)
    SELECT a.action, coalesce(new_dist, 0) AS new_dist, round(total_value, 6) AS total_value, round(mean_value, 6) AS mean_value,
           coalesce(orig_dist, 0) AS orig_dist, CAST(coalesce(new_dist, 0) = 0 AS INT) AS unused
    FROM a LEFT JOIN n USING (action) LEFT JOIN o USING (action)""")
def i6(spark, base):
    scored = P.score_policy(A.scores(spark, base).withColumns({"orig_action": F.col("action"), "q_values": F.col("logits")}))
    rows = scored.withColumn("value", F.get("q_values", F.col("action")))
    ids = spark.range(64).select(F.col("id").cast("int").alias("action"))
    return V.compare_policies(rows, ids).withColumns({
        "total_value": F.round("total_value", 6), "mean_value": F.round("mean_value", 6),
    })


def q_steps(spark, base):
    rows = steps(spark, base).withColumns({
        "action": F.get("actions", F.lit(0)),
        "obs": F.array(F.col("action_prob"), F.log1p("rewards"), F.hour("time") / F.lit(24.0)),
    })
    shaped = E.n_step_return(rows, "enterprise_id", 3, 0.9)
    mask = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.when(F.pmod(F.col("t") + i, F.lit(3)) > 0, 1).otherwise(0))
    return shaped.withColumn("n_mask", mask)


@query("i7_fitted_q")
def i7(spark, base):
    """Greedy action and its value under the fitted model, by action."""
    rows = q_steps(spark, base)
    weights, _ = V.fitted_q(rows, 12, 3, iters=3, gamma=0.9, n_step=3)
    scored = rows.withColumn("q_values", V.q_of(F.col("obs"), weights)).withColumn("mask", F.col("n_mask"))
    best = P.score_policy(scored).withColumn("value", F.get("q_values", F.col("action")))
    return best.groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("value"), 4).alias("mean_value"))


def q_round(k: int) -> str:
    """Targets ``y``, penalty ``p`` and solved lines ``w`` of a round, from the lines of the round before."""
    return f"""y{k} AS (
    SELECT enterprise_id, t, any_value(action) AS action, any_value(x) AS x,
           any_value(r) + 0.9 * 0.9 * coalesce(max(CASE WHEN nx IS NOT NULL AND (t + i) % 3 > 0 THEN b + c * nx END), 0) AS y
    FROM s, w{k - 1} GROUP BY 1, 2
), p{k} AS (SELECT 0.1 / stddev_pop(y) * count(*) AS p FROM y{k}), m{k} AS (
    SELECT action, count(*) + any_value(p) AS n, sum(x) AS sx, sum(x * x) + any_value(p) AS sxx, sum(y) AS sy, sum(x * y) AS sxy FROM y{k}, p{k} GROUP BY 1
), w{k} AS (
    SELECT i, coalesce((sxx * sy - sx * sxy) / (n * sxx - sx * sx), 0) AS b, coalesce((n * sxy - sx * sy) / (n * sxx - sx * sx), 0) AS c
    FROM w0 LEFT JOIN m{k} ON action = i
)"""


@query("i7_fitted_q_line", f"""
    WITH {STEPS}, s AS (
        SELECT enterprise_id, t, action, action_prob AS x, coalesce(rewards, 0) + 0.9 * coalesce(lead(rewards) OVER o, 0) AS r, lead(action_prob, 2) OVER o AS nx
        FROM steps WINDOW o AS (PARTITION BY enterprise_id ORDER BY t)
    ), w0 AS (SELECT unnest(range(12)) AS i, 0::DOUBLE AS b, 0::DOUBLE AS c), {q_round(1)}, {q_round(2)}, {q_round(3)}
    SELECT action, count(*) AS n, round(any_value(b), 5) AS bias, round(any_value(c), 5) AS slope FROM s JOIN w3 ON i = action GROUP BY 1""")
def i7_line(spark, base):
    """Three rounds with one number observed: each action's line is solved in closed form by the SQL."""
    rows = steps(spark, base).withColumns({"action": F.get("actions", F.lit(0)), "obs": F.array("action_prob")})
    mask = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.when(F.pmod(F.col("t") + i, F.lit(3)) > 0, 1).otherwise(0))
    shaped = E.n_step_return(rows, "enterprise_id", 2, 0.9).withColumn("n_mask", mask)
    weights, _ = V.fitted_q(shaped, 12, 1, iters=3, gamma=0.9, n_step=2)
    lines = F.array(*[F.array(*[F.lit(float(x)) for x in w]) for w in weights])
    own = F.get(lines, F.col("action"))
    return rows.groupBy("action").agg(F.count(F.lit(1)).alias("n")).select(
        "action", "n", F.round(F.get(own, F.lit(0)), 5).alias("bias"), F.round(F.get(own, F.lit(1)), 5).alias("slope")
    )


@query("j1_stable_runs", f"""
    WITH {SERIES}, f AS (SELECT runid, count(*) FILTER (WHERE diff_pct < 0.2 AND back <= 8) AS flat, arg_min(value, t) AS first_value,
        arg_max(value, t) AS last_metric FROM series GROUP BY 1)
    SELECT runid, first_value, last_metric, CAST(8 - flat <= 3 AND first_value < last_metric AS INT) AS is_stable FROM f""")
def j1(spark, base):
    return U.stable_runs(A.metric_history(spark, base), n=8, threshold=0.2, tolerance=3)


@query("j2_best_runs", f"""
    WITH {SERIES}, f AS (SELECT runid, count(*) FILTER (WHERE diff_pct < 0.2 AND back <= 8) AS flat, arg_min(value, t) AS first_value,
        arg_max(value, t) AS last_metric, count(*) AS n FROM series GROUP BY 1),
    r AS (SELECT runid, last_metric, dense_rank() OVER (ORDER BY last_metric DESC) AS rank FROM f
          WHERE 8 - flat <= 3 AND first_value < last_metric AND last_metric <> 0)
    SELECT 'run-' || runid AS run_name, last_metric, CAST(rank AS INT) AS rank, 'lr' AS kept FROM r WHERE rank <= 5""")
def j2(spark, base):
    hist = A.metric_history(spark, base)
    params = hist.select("runid", "run_name").distinct().withColumn(
        "params", F.create_map(F.lit("lr"), F.lit("0.1"), F.lit("host"), F.col("run_name"))
    )
    best = U.best_runs(hist, params, topn=5, n=8, threshold=0.2, tolerance=3)
    return best.select("run_name", "last_metric", "rank", F.array_join(F.map_keys("params"), ",").alias("kept"))


@query("j3_metric_rows", f"""
    WITH {EVALUABLE}, a AS ({IS}), b AS ({WIS}), c AS ({DR}), m AS (
        SELECT 'IS' AS p, v_target FROM a UNION ALL SELECT 'WIS', v_target FROM b UNION ALL SELECT 'DR', v_target FROM c)
    SELECT p || '-v_target' AS metric, round(v_target, 4) AS value FROM m
    UNION ALL SELECT p || '-v_gain', round(v_target / greatest(v_behavior, 1e-8), 4) FROM m, n""")
def j3(spark, base):
    long = V.metric_rows(V.ope_all(evaluable(spark, base)))
    return long.withColumn("value", F.round("value", 4))


