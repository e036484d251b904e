"""B: projections, filters, predicates and expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.fixed_values import APP_ID_TYPE
from offerloom.functions import decrypt, map_codes, yearmonth
from offerloom.operators import dispositions as D
from offerloom.operators import policy as P
from offerloom.operators import report as R
from offerloom.operators import rewards as W
from offerloom.operators import state as S
from offerloom.operators.vocabulary import token_name
from offerloom.queries.registry import CALLS, FLAGS, K, LINE_OFFERS, REPORT, joined, query, text
from offerloom.sources import adapters as A


@query("b1_select_features", f"""
    SELECT event_type, CAST(ts::DATE AS VARCHAR) AS date, count(*) AS n FROM events
    WHERE event_type <> 'signup' OR ts::DATE >= DATE '2024-01-21' GROUP BY 1, 2""")
def b1(spark, base):
    """Only the demographics are limited by date."""
    rows = S.select_features(A.features(spark, base), "2025-01-20")
    return rows.groupBy(F.col("feature_name").alias("event_type"), text("date")).agg(F.count(F.lit(1)).alias("n"))


@query("b2_select_sessions", """
    SELECT event_type, count(*) AS n FROM events WHERE event_type <> 'error' AND ts::DATE >= DATE '2024-07-10' - 180
    GROUP BY 1""")
def b2(spark, base):
    return S.select_sessions(A.sessions(spark, base), "2024-07-10").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


def good_calls(spark, base):
    return W.select_calls(A.calls(spark, base), "RX", "member", "1995-02-01")


@query("b3_select_calls", f"WITH {CALLS} SELECT call_guid, cagm, tfn FROM good_calls")
def b3(spark, base):
    return good_calls(spark, base).select("call_guid", "cagm", "tfn")


@query("b4_token_name", f"""
    SELECT CASE WHEN {K} >= 90 THEN event_type ELSE event_type || '___' || CAST(({K} // 10) * 10 AS VARCHAR) END AS token_name,
           count(*) AS n FROM events GROUP BY 1""")
def b4(spark, base):
    """Values of 90 and more are set to null first."""
    rows = A.features(spark, base).withColumn("feature_value", F.nullif("feature_value", F.lit("90")))
    return rows.groupBy(token_name().alias("token_name")).agg(F.count(F.lit(1)).alias("n"))


@query("b5_conditional_flags", """
    SELECT CAST(l_orderkey AS VARCHAR) AS call_guid,
           max(CAST(l_returnflag = 'R' OR floor(l_quantity) = 7 AS INT)) AS sms_offered,
           max(CAST(l_linestatus = 'O' AS INT)) AS sms_accepted, max(CAST(l_quantity > 25 AS INT)) AS sms_success
    FROM lineitem GROUP BY 1""")
def b5(spark, base):
    return D.rollup_flags(A.call_flags(spark, base), "call_guid", {"sms": LINE_OFFERS["sms"]})


def flags(spark, base):
    return D.rollup_flags(A.call_flags(spark, base), "call_guid", LINE_OFFERS)


def chained(spark, base):
    return D.chain_flags(flags(spark, base), "call_guid", LINE_OFFERS)


def disposition_rows(spark, base):
    return D.dispositions(chained(spark, base), "call_guid")


@query("b6_chain_flags", f"""
    WITH {FLAGS}
    SELECT call_guid, refill_offered, refill_offered * CASE WHEN renewal_offered = 1 THEN refill_wanted END AS refill_accepted,
           refill_offered * CASE WHEN renewal_offered = 1 THEN refill_wanted END * refill_success AS refill_success,
           refill_failure FROM flags""")
def b6(spark, base):
    """The caller's yes is unknown without a renewal offer: null runs through the products."""
    known = flags(spark, base).withColumn("refill_wanted", F.when(F.col("renewal_offered") == 1, F.col("refill_wanted")))
    return D.chain_flags(known, "call_guid", {"refill": LINE_OFFERS["refill"]})


@query("b7_offered_not_accepted", f"""
    WITH {FLAGS}
    SELECT offer, CAST(offered = 1 AND accepted = 0 AND success = 0 AS INT) AS offered_not_accepted, count(*) AS n
    FROM disp GROUP BY 1, 2""")
def b7(spark, base):
    rows = D.with_offered_not_accepted(disposition_rows(spark, base))
    return rows.groupBy("offer", "offered_not_accepted").agg(F.count(F.lit(1)).alias("n"))


@query("b8_split_metric", f"""
    WITH {FLAGS}, long AS (UNPIVOT disp ON offered, accepted, success, failure INTO NAME disposition VALUE value)
    SELECT offer, disposition, CAST(sum(value) AS BIGINT) AS total FROM long
    WHERE NOT (offer <> 'refill' AND disposition = 'failure') GROUP BY 1, 2""")
def b8(spark, base):
    """Column names such as ``refill_offered`` taken apart again."""
    wide = chained(spark, base)
    names = [c for c in wide.columns if c != "call_guid"]
    rows = wide.unpivot("call_guid", names, "metric", "value")
    return rows.groupBy(
        F.split_part("metric", F.lit("_"), F.lit(1)).alias("offer"),
        F.split_part("metric", F.lit("_"), F.lit(2)).alias("disposition"),
    ).agg(F.sum("value").alias("total"))


@query("b9_to_fact", f"""
    WITH {FLAGS}
    SELECT o_custkey AS enterprise_id, 'org' AS organization, 'ivr' AS app, 'rx' AS source, 'call' AS category,
           CAST(o_orderdate::DATE AS VARCHAR) AS date, offer, offered, accepted, success, failure
    FROM disp JOIN orders ON call_guid = CAST(o_orderkey AS VARCHAR)""")
def b9(spark, base):
    return disposition_fact(spark, base).select(
        "enterprise_id", "organization", "app", "source", "category", text("date"), "offer", *D.DISPOSITIONS
    )


def disposition_fact(spark, base):
    from offerloom.operators.ids import resolve_id

    rows = D.attach_call(disposition_rows(spark, base), A.calls(spark, base), "cagm", "start_dtm")
    resolved = resolve_id(rows, A.id_map(spark, base))
    return D.to_fact(resolved, "start_dtm", "org", "ivr", "rx", "call", "offer", *D.DISPOSITIONS)


@query("b10_rename", "SELECT o_orderkey AS call_guid, o_custkey AS member, o_orderstatus AS status FROM orders")
def b10(spark, base):
    rows = A.load(spark, "orders", base).select("o_orderkey", "o_custkey", "o_orderstatus")
    return rows.withColumnsRenamed({"o_orderkey": "call_guid", "o_custkey": "member", "o_orderstatus": "status"})


@query("b11_null_fill", """
    SELECT c_custkey, coalesce(max(o_orderkey), 0) AS last_order, count(o_orderkey) AS orders
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def b11(spark, base):
    n = A.load(spark, "orders", base).groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderkey").alias("last_order"), F.count(F.lit(1)).alias("orders")
    )
    return A.load(spark, "customer", base).select("c_custkey").join(n, "c_custkey", "left").fillna(
        0, ["last_order", "orders"]
    )


OFFER_REPORT = f"""{FLAGS}, {CALLS}, session AS (
    SELECT d.offer AS metric, c.start_dtm::DATE AS startdate, c.tfn, c.cagm, d.offered, d.accepted, d.success, d.failure,
           CAST(offered = 1 AND accepted = 0 AND success = 0 AS INT) AS offered_not_accepted, d.call_guid
    FROM disp d JOIN good_calls c USING (call_guid)
), offer_report AS (
    SELECT metric, startdate, tfn, count(DISTINCT cagm) AS members, count(*) AS sessions,
           CAST(sum(offered) AS BIGINT) AS offered, CAST(sum(accepted) AS BIGINT) AS accepted,
           CAST(sum(success) AS BIGINT) AS success, CAST(sum(failure) AS BIGINT) AS failure,
           CAST(sum(offered_not_accepted) AS BIGINT) AS offered_not_accepted
    FROM session GROUP BY 1, 2, 3
)"""


def offer_sessions(spark, base):
    rows = D.with_offered_not_accepted(disposition_rows(spark, base)).withColumnRenamed("offer", "metric")
    calls = good_calls(spark, base).withColumns({
        "startdate": F.to_date("start_dtm"), "starttime": F.col("start_dtm"),
    })
    return D.attach_call(rows, calls, "cagm", "starttime", "startdate", "tfn")


@query("b12_rates", f"""
    WITH {OFFER_REPORT}
    SELECT metric, CAST(startdate AS VARCHAR) AS startdate, tfn, round(members / nullif(offered, 0)::DOUBLE, 6) AS member_offer_ratio,
           round(offered / sessions::DOUBLE, 6) AS offered_rate, round(accepted / nullif(offered, 0)::DOUBLE, 6) AS accepted_rate,
           round(success / nullif(offered, 0)::DOUBLE, 6) AS success_rate FROM offer_report""")
def b12(spark, base):
    rates = D.with_rates(D.offer_report(offer_sessions(spark, base), exact=True))
    cols = ("member_offer_ratio", "offered_rate", "accepted_rate", "success_rate")
    return rates.select("metric", text("startdate"), "tfn", *[F.round(c, 6).alias(c) for c in cols])


@query("b13_session_reward", f"""
    WITH {FLAGS}
    SELECT call_guid, CAST(sum(success) - 2 - sum(CAST(offered = 1 AND accepted = 0 AND success = 0 AS INT)) AS BIGINT) AS success_reward,
           CAST(sum(accepted) - 2 - sum(CAST(offered = 1 AND accepted = 0 AND success = 0 AS INT)) AS BIGINT) AS accepted_reward
    FROM disp GROUP BY 1""")
def b13(spark, base):
    sums = D.with_offered_not_accepted(disposition_rows(spark, base)).groupBy("call_guid").agg(
        F.sum("accepted").alias("accepted"), F.sum("success").alias("success"),
        F.sum("offered_not_accepted").alias("offered_not_accepted"), F.lit(2).alias("calls"),
    )
    return W.session_reward(sums).select("call_guid", "success_reward", "accepted_reward")


@query("b14_yearmonth", "SELECT year(o_orderdate) || '-' || month(o_orderdate) AS yearmonth, count(*) AS n FROM orders GROUP BY 1")
def b14(spark, base):
    return A.load(spark, "orders", base).groupBy(yearmonth("o_orderdate").alias("yearmonth")).agg(F.count(F.lit(1)).alias("n"))


@query("b15_map_codes", """
    SELECT CASE WHEN event_type IN ('view', 'click') THEN 'cagm' WHEN event_type = 'signup' THEN 'enterprise_id' END AS id_type,
           count(*) AS n FROM events GROUP BY 1""")
def b15(spark, base):
    app = F.when(F.col("event_type") == "view", "ivr").when(F.col("event_type") == "click", "spec-pat").when(
        F.col("event_type") == "signup", "advocacy").otherwise("fax")
    return A.load(spark, "events", base).groupBy(map_codes(app, APP_ID_TYPE).alias("id_type")).agg(F.count(F.lit(1)).alias("n"))


@query("b16_first_id", """
    SELECT CASE WHEN event_type <> 'error' THEN 'm' || user_id ELSE 'e' || event_id END AS id, count(*) AS n FROM events GROUP BY 1""")
def b16(spark, base):
    member = F.when(F.col("event_type") != "error", F.concat(F.lit("m"), F.col("user_id")))
    other = F.concat(F.lit("e"), F.col("event_id"))
    return A.load(spark, "events", base).groupBy(F.coalesce(member, other).alias("id")).agg(F.count(F.lit(1)).alias("n"))


@query("b17_decrypt", "SELECT c_custkey, c_name FROM customer")
def b17(spark, base):
    """Names are encrypted with a key of their segment first; the vector is kept apart from the text."""
    key, iv = F.substring(F.md5("c_mktsegment"), 1, 16), F.substring(F.md5("c_name"), 1, 16)
    whole = F.aes_encrypt("c_name", key, F.lit("CBC"), F.lit("DEFAULT"), iv.cast("binary"))
    stored = A.load(spark, "customer", base).withColumn("cipher", F.base64(F.substring(whole, F.lit(17), F.length(whole))))
    return stored.select("c_custkey", decrypt("cipher", key, iv).alias("c_name"))


REQUESTS = f"""requests AS (
    SELECT event_id, user_id, ts, {K} AS k, event_type IN ('view', 'click') AS is_ivr,
           CASE event_type WHEN 'view' THEN 'ivr' WHEN 'click' THEN 'ivr-test' WHEN 'signup' THEN 'spec-pat-test'
                WHEN 'error' THEN 'fax' ELSE 'spec-pat' END AS app,
           CASE event_type WHEN 'view' THEN 'ivr' WHEN 'click' THEN 'ivr' WHEN 'error' THEN 'fax' ELSE 'spec-pat' END AS app_name,
           list_concat(list_filter(CASE WHEN event_type IN ('view', 'click') THEN ['autorefill', 'sms', 'renewal', 'refill', 'orderstatus']
                            ELSE ['creditcard', 'osp_smf', 'osp_commpref', 'orderstatus'] END,
                       lambda x, i: (({K} >> (i - 1)) & 1) = 1),
                       CASE WHEN {K} = 99 THEN ['unknown_offer'] ELSE [] END) AS flags
    FROM events
)"""


@query("b18_parse_requests", f"""
    WITH {REQUESTS}
    SELECT event_id, app, app_name, CASE WHEN app_name = 'fax' THEN 'none' WHEN is_ivr THEN 'c' || event_id ELSE 's' || event_id END AS session_id,
           CAST(user_id AS VARCHAR) AS raw_id, CASE WHEN app_name = 'fax' THEN 'none' WHEN is_ivr THEN 'refill' ELSE 'order' END AS intent,
           array_to_string(flags, ',') AS flags, CASE WHEN app_name = 'fax' THEN 'invalid app: fax' ELSE 'none' END AS error
    FROM requests""")
def b18(spark, base):
    none = F.lit("none")
    return P.parse_requests(A.requests(spark, base)).select(
        "event_id", "app", "app_name", F.coalesce("session_id", none).alias("session_id"), "raw_id",
        F.coalesce("intent", none).alias("intent"), joined("flags").alias("flags"), F.coalesce("error", none).alias("error"),
    )


@query("b19_priority", f"""
    WITH {REQUESTS}
    SELECT event_id, CASE WHEN app LIKE '%-test%' AND k % 10 = 0 THEN flags[1] END AS override FROM requests""")
def b19(spark, base):
    return P.apply_priority(P.parse_requests(A.requests(spark, base))).select("event_id", "override")


@query("b20_date_test", f"""
    SELECT CASE WHEN {K} % 3 = 0 THEN 0 ELSE 1 END AS is_date, count(*) AS n FROM events GROUP BY 1""")
def b20(spark, base):
    """Texts that are dates, and texts that only look like them."""
    word = F.when(F.pmod(A.k_of(), F.lit(3)) == 0, F.date_format("ts", "yyyy-99-dd")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    is_date = F.when(F.try_to_timestamp(word, F.lit("yyyy-MM-dd")).isNotNull(), 1).otherwise(0)
    return A.load(spark, "events", base).groupBy(is_date.alias("is_date")).agg(F.count(F.lit(1)).alias("n"))


@query("b21_report_filters", f"""
    WITH {REPORT}
    SELECT metric, tfn, count(*) AS n FROM report
    WHERE metric NOT IN ('call', 'resolved') AND startdate BETWEEN DATE '1997-01-01' AND DATE '2000-12-31'
      AND before_after IS NOT NULL AND xferstatus = 'XFER' GROUP BY 1, 2""")
def b21(spark, base):
    rows = R.offers_only(
        A.report(spark, base), F.col("startdate").between("1997-01-01", "2000-12-31"),
        F.col("before_after").isNotNull(), F.col("xferstatus") == "XFER",
    )
    return rows.groupBy("metric", "tfn").agg(F.count(F.lit(1)).alias("n"))
