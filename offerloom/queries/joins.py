"""C: joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.operators import dispositions as D
from offerloom.operators import episodes as E
from offerloom.operators import evaluation as V
from offerloom.operators import ids as I
from offerloom.operators import policy as P
from offerloom.operators import report as R
from offerloom.operators import rewards as W
from offerloom.operators import sampling as N
from offerloom.operators import state as S
from offerloom.operators.vocabulary import apply_vocabulary, build_vocabulary, new_tokens, token_name
from offerloom.queries.expressions import disposition_rows, good_calls
from offerloom.queries.registry import (
    CALLS, FEATURES, FLAGS, TOKEN_STATE, REPORT, STEPS, VOCAB, joined, query, text, u,
)
from offerloom.queries.sources import PENALTY, penalty_fact
from offerloom.sources import adapters as A


def features(spark, base):
    return S.select_features(A.features(spark, base), A.AS_OF).withColumn("token_name", token_name())


def tokens(spark, base):
    rows = features(spark, base)
    return apply_vocabulary(rows, build_vocabulary(rows))


@query("c1_apply_vocabulary", f"""
    WITH {FEATURES}, {VOCAB} SELECT enterprise_id, CAST(date AS VARCHAR) AS date, token_name, CAST(token AS INT) AS token FROM tokens""")
def c1(spark, base):
    return tokens(spark, base).select("enterprise_id", text("date"), "token_name", "token")


@query("c2_new_tokens", f"""
    WITH {FEATURES} SELECT DISTINCT token_name FROM features WHERE token_name NOT IN (
        SELECT token_name FROM features WHERE token_name LIKE 'view%' OR token_name LIKE 'click%')""")
def c2(spark, base):
    rows = features(spark, base)
    known = rows.filter("feature_name in ('view', 'click')").select("token_name").distinct()
    return new_tokens(rows, "token_name", known)


@query("c3_calls_without_interaction", """
    SELECT CAST(o_orderkey AS VARCHAR) AS call_guid FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def c3(spark, base):
    return I.calls_without_interaction(A.calls(spark, base), A.call_flags(spark, base)).select("call_guid")


@query("c4_resolve_id", "SELECT CAST(o_orderkey AS VARCHAR) AS call_guid, o_custkey AS enterprise_id FROM orders JOIN customer ON c_custkey = o_custkey")
def c4(spark, base):
    return I.resolve_id(A.calls(spark, base), A.id_map(spark, base)).select("call_guid", "enterprise_id")


@query("c5_resolve_id_multi", """
    SELECT CAST(o_orderkey AS VARCHAR) AS call_guid, o_custkey AS enterprise_id,
           CASE o_orderstatus WHEN 'P' THEN 'enterprise_id' ELSE 'cagm' END AS id_type
    FROM orders JOIN customer ON c_custkey = o_custkey""")
def c5(spark, base):
    """Two applications know the member number, one the entity id itself; the map holds duplicates."""
    app = F.when(F.col("xferstatus") == "XFER", "ivr").when(F.col("xferstatus") == "DONE", "spec-pat").otherwise("advocacy")
    member = F.when(app != "advocacy", F.col("cagm"))
    number = F.regexp_replace(F.substring("cagm", 10, 9), "^0+(?=.)", "")
    log = A.calls(spark, base).withColumns({"app": app, "id": number}).withColumn("cagm", member)
    plain = A.id_map(spark, base)
    own = plain.select("enterprise_id", F.lit("enterprise_id").alias("id_type"),
                       F.col("enterprise_id").cast("string").alias("alternative_id"))
    doubled = plain.unionByName(own).unionByName(plain)
    return I.resolve_id_multi(log, doubled).select("call_guid", "enterprise_id", "id_type")


@query("c6_restrict_to", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def c6(spark, base):
    clients = A.load(spark, "customer", base).filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return S.restrict_to(A.load(spark, "orders", base), clients.unionByName(clients)).select("o_orderkey")


@query("c7_attach_call", f"""
    WITH {FLAGS}, {CALLS}
    SELECT tfn, offer, count(*) AS n, CAST(sum(accepted) AS BIGINT) AS accepted FROM disp JOIN calls USING (call_guid) GROUP BY 1, 2""")
def c7(spark, base):
    rows = D.attach_call(disposition_rows(spark, base), A.calls(spark, base), "tfn")
    return rows.groupBy("tfn", "offer").agg(F.count(F.lit(1)).alias("n"), F.sum("accepted").alias("accepted"))


FUTURE = """calls AS (
    SELECT event_id, user_id, ts, event_type IN ('error', 'purchase') AS xfer FROM events
), future AS (
    SELECT a.event_id, a.user_id, count(b.event_id) AS calls FROM calls a LEFT JOIN calls b
    ON b.user_id = a.user_id AND b.xfer AND b.ts > a.ts AND b.ts <= a.ts + INTERVAL 7 DAYS GROUP BY 1, 2
)"""


def future_calls(spark, base):
    calls = A.event_calls(spark, base)
    return W.future_events(calls, calls.filter("xferstatus = 'XFER'"), "enterprise_id", "call_guid", "date_time")


@query("c8_future_events", f"""
    WITH {FUTURE} SELECT CAST(event_id AS VARCHAR) AS call_guid, user_id AS enterprise_id, calls FROM future WHERE calls > 0""")
def c8(spark, base):
    return future_calls(spark, base).filter("calls > 0").select("call_guid", "enterprise_id", "calls")


@query("c9_future_calls_filled", f"""
    WITH {CALLS}, later AS (
        SELECT a.call_guid, count(*) AS calls FROM good_calls a JOIN good_calls b ON a.cagm = b.cagm AND b.xferstatus = 'XFER'
        AND b.start_dtm > a.start_dtm AND b.start_dtm <= a.start_dtm + INTERVAL 7 DAYS GROUP BY 1)
    SELECT call_guid, coalesce(calls, 0) AS calls FROM good_calls LEFT JOIN later USING (call_guid)""")
def c9(spark, base):
    """Calls start at midnight here, so the seven-day border is met often."""
    calls = good_calls(spark, base).withColumn("starttime", F.col("start_dtm"))
    later = W.future_events(calls, calls.filter("xferstatus = 'XFER'"), "cagm", "call_guid", "starttime")
    return W.with_future_calls(calls, later.filter("calls > 0")).select("call_guid", "calls")


def token_state(spark, base):
    return S.flag_current(S.state_history(tokens(spark, base)))


def event_days(spark, base, shift):
    """Events moved in time, so that many fall on days without a state row."""
    day = F.date_add(F.to_date("time"), shift)
    return A.decisions(spark, base).select("enterprise_id", day.alias("date"), "eps_id")


@query("c10_attach_state", f"""
    WITH {TOKEN_STATE}
    SELECT CAST(e.event_id AS VARCHAR) AS eps_id, array_to_string(s.ids, ',') AS state
    FROM events e JOIN state s ON s.enterprise_id = e.user_id AND s.date = e.ts::DATE + 3""")
def c10(spark, base):
    rows = S.attach_state(event_days(spark, base, 3), token_state(spark, base))
    return rows.select("eps_id", joined("state_tokenized").alias("state"))


@query("c11_current_state", f"""
    WITH {TOKEN_STATE}
    SELECT c_custkey AS enterprise_id, coalesce(array_to_string(s.ids, ','), '0') AS state
    FROM customer LEFT JOIN state s ON s.enterprise_id = c_custkey AND s.current_record = 1""")
def c11(spark, base):
    """Customers without events have no state: [0]."""
    asked = A.load(spark, "customer", base).select(F.col("c_custkey").alias("enterprise_id"))
    rows = S.attach_current_state(asked, token_state(spark, base))
    return rows.select("enterprise_id", joined("state_tokenized").alias("state"))


@query("c12_state_asof", f"""
    WITH {TOKEN_STATE}, e AS (SELECT event_id, user_id AS enterprise_id, ts::DATE - 3 AS date FROM events)
    SELECT CAST(e.event_id AS VARCHAR) AS eps_id, coalesce(CAST(s.date AS VARCHAR), 'none') AS state_date,
           coalesce(array_to_string(s.ids, ','), 'none') AS state
    FROM e ASOF LEFT JOIN state s ON s.enterprise_id = e.enterprise_id AND e.date >= s.date""")
def c12(spark, base):
    rows = S.attach_state_asof(event_days(spark, base, -3), token_state(spark, base))
    none = F.lit("none")
    return rows.select(
        "eps_id", F.coalesce(F.col("state_date").cast("string"), none).alias("state_date"),
        F.coalesce(joined("state_tokenized"), none).alias("state"),
    )


@query("c13_next_state", f"""
    WITH {TOKEN_STATE}, {PENALTY}
    SELECT p.user_id AS enterprise_id, count(*) AS penalties, max(array_to_string(s.ids, ',')) AS next_state
    FROM penalties p JOIN state s ON s.enterprise_id = p.user_id AND s.current_record = 1
    WHERE p.reward_value IS NOT NULL GROUP BY 1""")
def c13(spark, base):
    penalties = penalty_fact(spark, base).groupBy("enterprise_id").agg(F.count(F.lit(1)).alias("penalties"))
    rows = S.attach_next_state(penalties, token_state(spark, base).filter("current_record = 1"))
    return rows.select("enterprise_id", "penalties", joined("next_state").alias("next_state"))


@query("c14_daily_series", f"""
    WITH {CALLS}, d AS (SELECT *, start_dtm::DATE AS date FROM calls),
    a AS (SELECT date, tfn, count(*) AS ivr_calls FROM d GROUP BY 1, 2),
    b AS (SELECT date, tfn, count(*) AS agent_interactions FROM d WHERE logical_app_name = 'RX' GROUP BY 1, 2),
    c AS (SELECT date, tfn, count(*) AS valid_interactions FROM d WHERE logical_app_name = 'RX' AND xferstatus = 'XFER' GROUP BY 1, 2)
    SELECT CAST(date AS VARCHAR) AS date, tfn, ivr_calls, agent_interactions, valid_interactions
    FROM a JOIN b USING (date, tfn) JOIN c USING (date, tfn)""")
def c14(spark, base):
    calls = A.calls(spark, base).withColumn("date", F.to_date("start_dtm"))
    rx = calls.filter("logical_app_name = 'RX'")
    keys = ["date", "tfn"]
    rows = R.daily_series_join(
        R.daily_counts(calls, keys, "ivr_calls"), R.daily_counts(rx, keys, "agent_interactions"),
        R.daily_counts(rx.filter("xferstatus = 'XFER'"), keys, "valid_interactions"),
    )
    return rows.select(text("date"), "tfn", "ivr_calls", "agent_interactions", "valid_interactions")


@query("c15_min_episode_length", f"""
    WITH {STEPS}
    SELECT enterprise_id, t, CAST(event_id AS VARCHAR) AS eps_id FROM steps
    WHERE enterprise_id IN (SELECT enterprise_id FROM steps WHERE t >= 64)""")
def c15(spark, base):
    steps = E.with_steps(A.decisions(spark, base), "enterprise_id", "time", "eps_id")
    return E.min_episode_length(steps, "enterprise_id", 65).select("enterprise_id", "t", "eps_id")


@query("c16_before_after_merge", f"""
    WITH {REPORT}, wk AS (
        SELECT CAST(date_trunc('week', startdate) AS DATE) AS week, tfn, before_after, sum(penalty) AS resolved, count(*) AS calls
        FROM report WHERE metric = 'resolved' AND before_after IS NOT NULL GROUP BY 1, 2, 3)
    SELECT tfn, round_even(avg(CASE WHEN before_after = 1 THEN resolved END), 0) AS before_resolved,
           round_even(avg(CASE WHEN before_after = 0 THEN resolved END), 0) AS resolved FROM wk GROUP BY 1""")
def c16(spark, base):
    rows = R.session_metric(A.report(spark, base), "resolved", "resolved", ("tfn", "startdate", "before_after"))
    return R.group_rates(rows, "resolved", "calls").select("tfn", "before_resolved", "resolved")


@query("c17_action_distribution", """
    WITH a AS (SELECT range AS action FROM range(64)),
    s AS (SELECT label AS orig_action, list_position(l, list_max(l)) - 1 AS action FROM (
        SELECT label, embedding AS l FROM embeddings))
    SELECT CAST(a.action AS INT) AS action, (SELECT count(*) FROM s WHERE s.action = a.action) AS new_dist,
           (SELECT count(*) FROM s WHERE s.orig_action = a.action) AS orig_dist FROM a""")
def c17(spark, base):
    rows = A.scores(spark, base).withColumns({
        "orig_action": F.col("action"),
        "action": F.array_position("logits", F.array_max("logits")).cast("int") - 1, "value": F.lit(1.0),
    })
    ids = spark.range(64).select(F.col("id").cast("int").alias("action"))
    return V.compare_policies(rows, ids).select("action", "new_dist", "orig_dist")


@query("c18_split_join", f"""
    WITH k AS (SELECT DISTINCT user_id FROM events WHERE {u('user_id', 42)} >= 0.8)
    SELECT event_id FROM events WHERE user_id IN (SELECT user_id FROM k)""")
def c18(spark, base):
    events = A.load(spark, "events", base).select("event_id", "user_id")
    keys = N.split3_by_key(events.select("user_id").distinct(), "user_id").filter("split = 'test'").select("user_id")
    return S.restrict_to(events, keys).select("event_id")


@query("c19_population_state", f"""
    WITH {TOKEN_STATE}
    SELECT enterprise_id, CAST(date AS VARCHAR) AS date, array_to_string(ids, ',') AS state FROM state
    WHERE current_record = 1 AND date >= DATE '2024-01-31' - 7 AND enterprise_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def c19(spark, base):
    keys = A.load(spark, "customer", base).filter("c_acctbal > 0").select(F.col("c_custkey").alias("enterprise_id"))
    rows = S.population_state(token_state(spark, base), keys, A.AS_OF, 7)
    return rows.select("enterprise_id", text("date"), joined("state_tokenized").alias("state"))


