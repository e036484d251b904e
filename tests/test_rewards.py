"""Penalties, later calls, dispositions, reports."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from offerloom.operators import dispositions as D
from offerloom.operators import report as R
from offerloom.operators import rewards as W
from offerloom.operators.ids import resolve_id, resolve_id_multi

T0 = datetime(2024, 3, 1, 12)
H, DAY = timedelta(hours=1), timedelta(days=1)


def calls(spark, times, entity=1):
    return spark.createDataFrame([(entity, f"c{i}", t) for i, t in enumerate(times)],
                                 "enterprise_id bigint, call_guid string, date_time timestamp")


@pytest.mark.parametrize("gap, hit", [
    (12 * H, False), (DAY, True), (DAY - timedelta(seconds=1), False), (7 * DAY, True),
    (7 * DAY + timedelta(seconds=1), False), (4 * DAY, True),
])
def test_penalty_borders(spark, gap, hit):
    got = W.repeat_penalty(calls(spark, [T0, T0 + gap])).collect()
    assert [(r["date_time"], r["reward_value"]) for r in got] == ([(T0 + gap, -3)] if hit else [])


@pytest.mark.parametrize("lo, hi", [(7, 1), (2, 1), (3, 2), (5, 1)])
@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hours=st.lists(st.integers(0, 400), min_size=1, max_size=25))
def test_penalty_against_brute_force(spark, lo, hi, hours):
    times = sorted({T0 + h * 2 * H for h in hours})
    want = [t for t in times if any(t - lo * DAY <= s <= t - hi * DAY for s in times)]
    got = W.repeat_penalty(calls(spark, times + times), lo, hi).orderBy("date_time").collect()
    assert [r["date_time"] for r in got] == want


def test_penalty_arguments(spark):
    with pytest.raises(ValueError):
        W.repeat_penalty(calls(spark, [T0]), 1, 1)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(hours=st.lists(st.integers(0, 300), min_size=1, max_size=20), later=st.lists(st.integers(0, 300), max_size=20))
def test_future_events_against_brute_force(spark, hours, later):
    times, future = [T0 + h * H for h in hours], [T0 + h * H for h in later]
    got = W.future_events(calls(spark, times), calls(spark, future), "enterprise_id", "call_guid", "date_time")
    want = {f"c{i}": sum(t < f <= t + 7 * DAY for f in future) for i, t in enumerate(times)}
    assert {r["call_guid"]: r["calls"] for r in got.collect()} == want


def test_future_event_borders(spark):
    df = calls(spark, [T0])
    got = W.future_events(df, calls(spark, [T0, T0 + 7 * DAY, T0 + 7 * DAY + timedelta(microseconds=1)]),
                          "enterprise_id", "call_guid", "date_time")
    assert got.first()["calls"] == 1


def test_dispositions_drop_nulls_and_fill_zero(spark):
    df = spark.createDataFrame([("a", 1, None, 1, 1, None), ("b", 1, 1, 1, 0, None), ("c", 1, 0, 1, 1, None)],
                               "call_guid string, x_alert int, x_yes int, x_done int, y_alert int, z_alert int")
    offers = {"x": {"offered": "x_alert", "wanted": "x_yes", "success": "x_done"}, "y": {"offered": "y_alert"}, "z": {"offered": "z_alert"}}
    wide = D.chain_flags(D.rollup_flags(df, "call_guid", offers), "call_guid", offers)
    got = {(r["call_guid"], r["offer"]): tuple(r)[2:] for r in D.dispositions(wide, "call_guid").collect()}
    assert got[("a", "x")] == (1, 0, 0, 0)  # unknown answer: null products, dropped, then zero
    assert got[("b", "x")] == (1, 1, 1, 0)
    assert got[("a", "y")] == (1, 0, 0, 0)
    assert not any(offer == "z" for _, offer in got)


def test_call_log_offers_cover_all_flags(spark):
    flags = {r for rules in D.CALL_LOG_OFFERS.values() for r in rules.values()}
    plain = sorted(f for f in flags if f.isidentifier())
    extra = ["ob_alert_after_ss", "cc_released", "add_new_cc", "cc_release_failed", "add_new_cc_failed", "sms_enrolled", "gan_activation_sent"]
    df = spark.range(1).select(
        F.lit("g").alias("call_guid"), *[F.lit(1).alias(c) for c in [*plain, *extra]], F.lit("56070").alias("peg"),
        F.lit("-RX_OB_After_SS1-").alias("request_content"), F.lit("yes").alias("pharmacy_order_sms_offered_response"),
        F.lit("no").alias("pharmacy_care_sms_offered_response"),
    )
    wide = D.chain_flags(D.rollup_flags(df, "call_guid"), "call_guid")
    got = {r["offer"]: tuple(r)[2:] for r in D.dispositions(wide, "call_guid").collect()}
    assert len(got) == 12 and got["sms"] == (1, 1, 1, 1) and got["pasms"] == (1, 0, 0, 0)
    assert got["diabeteshold"] == (1, 0, 0, 0) and got["outstandingbalance"] == (1, 1, 1, 1)


def test_rates_without_offers_are_null(spark):
    df = spark.createDataFrame([(1, 2, 0, 0, 0)], "members long, sessions long, offered long, accepted long, success long")
    r = D.with_rates(df).first()
    assert r["offered_rate"] == 0 and r["accepted_rate"] is None and r["member_offer_ratio"] is None


def test_ids(spark):
    id_map = spark.createDataFrame([(1, "cagm", "m"), (2, "cagm", "m"), (1, "cagm", "m"), (3, "enterprise_id", "3")],
                                   "enterprise_id bigint, id_type string, alternative_id string")
    df = spark.createDataFrame([("ivr", "m", "zzz"), ("advocacy", None, "3"), ("fax", "m", "m")], "app string, cagm string, id string")
    assert sorted(r["enterprise_id"] for r in resolve_id(df, id_map).collect()) == [1, 1, 2, 2]
    assert sorted((r["app"], r["enterprise_id"]) for r in resolve_id_multi(df, id_map).collect()) == [
        ("advocacy", 3), ("ivr", 1), ("ivr", 2)]


def test_week_label_is_the_sunday(spark):
    df = spark.sql("select * from values (date'2024-01-07', 1), (date'2024-01-08', 2), (date'2024-01-14', 4) as t(startdate, v)")
    got = {str(r["week"]): r["v"] for r in R.weekly(df, [], ["v"]).collect()}
    assert got == {"2024-01-07": 1, "2024-01-14": 6}


def test_diff_in_diff_by_hand(spark):
    df = spark.createDataFrame(
        [("control", 10.0, 100.0, 20.0, 100.0, 0.10, 0.20), ("pilot", 30.0, 100.0, 25.0, 100.0, 0.30, 0.25)],
        "tfn string, before_n double, before_d double, n double, d double, before_rate double, rate double")
    p = R.diff_in_diff(df, "n", "d").filter("tfn = 'pilot'").first()
    assert p["diff"] == pytest.approx(0.2) and p["expected"] == pytest.approx(0.4)
    assert p["effect"] == pytest.approx(-0.15) and p["effect_pct"] == pytest.approx(0.625)
    assert p["did"] == pytest.approx((0.1 - 0.2) - (0.3 - 0.25)) and p["total_effect"] == pytest.approx((0.25 - 0.15) * 100 - 25)


def test_penalty_of_a_session_without_id(spark):
    df = spark.createDataFrame([(None, "a", 1, 0), (None, "call", 0, 1), (5, "a", 1, 0)],
                               "gvpsessionid bigint, metric string, accepted int, penalty int")
    got = {(r["gvpsessionid"], r["metric"]): r["penalty"] for r in R.penalty_per_offer(df).collect()}
    assert got == {(None, "a"): 1, (None, "call"): 0, (5, "a"): 0}
