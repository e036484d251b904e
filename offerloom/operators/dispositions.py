"""From flags in a call log to one disposition row per call and offer."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.functions import ratio

DISPOSITIONS = ("offered", "accepted", "success", "failure")

# Flag columns of the call log by offer and disposition. ``wanted`` is the caller's yes, which
# counts as accepted only together with ``offered``. A text with an operator is a condition.
CALL_LOG_OFFERS = {
    "refill": {
        "offered": "refill_alert", "wanted": "want_refill_yes",
        "success": "rx_refilled", "failure": "rx_refill_failed",
    },
    "schedulerefill": {
        "offered": "refill_schedule_alert", "accepted": "refill_schedule_alert_yes",
        "success": "refill_scheduled", "failure": "refill_schedule_failed",
    },
    "renewal": {
        "offered": "renewal_alert", "accepted": "renewal_alert_yes",
        "success": "rx_renewed", "failure": "rx_renew_failed",
    },
    "autorefill": {
        "offered": "auto_refill_alert", "accepted": "auto_refill_alert_enroll_now",
        "success": "auto_refill_enrolled", "failure": "auto_refill_failed",
    },
    "outstandingbalance": {
        "offered": "ob_alert_after_ss = 1 OR (peg = '56070' AND request_content LIKE '%RX_OB_After_SS1%')",
        "wanted": "ob_pay_now_alert_yes", "success": "balance_paid", "failure": "ob_failed",
    },
    "address": {
        "offered": "address_alert", "wanted": "want_fix_address_yes",
        "success": "address_released", "failure": "address_release_failed",
    },
    "creditcard": {
        "offered": "cc_alert", "wanted": "want_fix_cc_yes",
        "success": "cc_released = 1 OR add_new_cc = 1", "failure": "cc_release_failed = 1 OR add_new_cc_failed = 1",
    },
    "sms": {
        "offered": "pharmacy_order_sms_offered", "accepted": "pharmacy_order_sms_offered_response = 'yes'",
        "success": "sms_enrolled = 1 OR gan_activation_sent = 1", "failure": "sms_add_failure",
    },
    "pasms": {
        "offered": "pharmacy_care_sms_offered", "accepted": "pharmacy_care_sms_offered_response = 'yes'",
        "success": "sms_enrolled = 1 OR gan_activation_sent = 1",
    },
    "clinicalopportunity": {"offered": "clinical_oppty_alert", "accepted": "clinical_oppty_alert_yes"},
    "diabeteshold": {"offered": "diabetes_hold_alert"},
    "orderstatus": {"offered": "order_status_alert", "accepted": "order_status_alert_yes"},
}


def rollup_flags(df: DataFrame, key: str, offers: Mapping[str, Mapping[str, str]] = CALL_LOG_OFFERS) -> DataFrame:
    """Largest flag per key: one column ``offer_disposition`` per entry, combined map-side first."""
    def flag(rule: str):
        if rule.isidentifier():
            return F.col(rule)
        return F.when(F.expr(rule), 1).otherwise(0)

    return df.groupBy(key).agg(*[
        F.max(flag(rule)).alias(f"{offer}_{disposition}")
        for offer, rules in offers.items() for disposition, rule in rules.items()
    ])


def chain_flags(df: DataFrame, key: str, offers: Mapping[str, Mapping[str, str]] = CALL_LOG_OFFERS) -> DataFrame:
    """``accepted = offered * wanted`` and ``success = accepted * success``; a null factor gives null."""
    out = []
    for offer, rules in offers.items():
        def raw(d: str, offer: str = offer):
            return F.col(f"{offer}_{d}")

        accepted = raw("offered") * raw("wanted") if "wanted" in rules else raw("accepted") if "accepted" in rules else None
        out.append(raw("offered").alias(f"{offer}_offered"))
        if accepted is not None:
            out.append(accepted.alias(f"{offer}_accepted"))
        if "success" in rules:
            success = raw("success") if accepted is None else accepted * raw("success")
            out.append(success.alias(f"{offer}_success"))
        if "failure" in rules:
            out.append(raw("failure").alias(f"{offer}_failure"))
    return df.select(key, *out)


def dispositions(flags: DataFrame, key: str) -> DataFrame:
    """One row per key and offer with the four dispositions, zero where the log says nothing.

    ``flags`` has one row per key (see :func:`rollup_flags`) and columns named ``offer_disposition``, so that the
    turn from wide to long needs no shuffle. An offer with nothing but nulls gives no row.
    """
    offers: dict[str, dict[str, str]] = {}
    for name in flags.columns:
        offer, _, disposition = name.partition("_")
        if name != key and disposition in DISPOSITIONS:
            offers.setdefault(offer, {})[disposition] = name
    rows = []
    for offer, cols in offers.items():
        values = {d: F.col(cols[d]).cast("int") if d in cols else F.lit(None).cast("int") for d in DISPOSITIONS}
        rows.append(F.when(
            F.coalesce(*values.values()).isNotNull(),
            F.struct(F.lit(offer).alias("offer"),
                     *[F.coalesce(v, F.lit(0)).alias(d) for d, v in values.items()]),
        ))
    return flags.select(key, F.explode(F.array_compact(F.array(*rows))).alias("_r")).select(
        key, "_r.offer", *[f"_r.{d}" for d in DISPOSITIONS]
    )


def with_offered_not_accepted(df: DataFrame) -> DataFrame:
    ignored = (F.col("offered") == 1) & (F.col("accepted") == 0) & (F.col("success") == 0)
    return df.withColumn("offered_not_accepted", F.when(ignored, 1).otherwise(0))


def attach_call(df: DataFrame, calls: DataFrame, *cols: str) -> DataFrame:
    """Call attributes by call id."""
    return df.join(calls.select("call_guid", *cols), on="call_guid")


def to_fact(df: DataFrame, time: str, organization: str, app: str, source: str, category: str, *values: str) -> DataFrame:
    """The common seven columns of a fact table, then the values."""
    return df.select(
        F.col("enterprise_id").cast("bigint"),
        F.lit(organization).alias("organization"), F.lit(app).alias("app"),
        F.lit(source).alias("source"), F.lit(category).alias("category"),
        F.to_date(time).alias("date"), F.col(time).alias("date_time"), *values,
    )


def with_rates(df: DataFrame) -> DataFrame:
    """Rates of an offer report; NULL where nothing was offered."""
    return df.withColumns({
        "member_offer_ratio": ratio("members", "offered"),
        "offered_rate": ratio("offered", "sessions"),
        "accepted_rate": ratio("accepted", "offered"),
        "success_rate": ratio("success", "offered"),
    })


def offer_report(df: DataFrame, exact: bool = False) -> DataFrame:
    """Members, sessions and disposition sums by offer, day and line."""
    members = F.count_distinct("cagm") if exact else F.approx_count_distinct("cagm")
    sums = ("offered", "accepted", "success", "failure", "offered_not_accepted")
    return df.groupBy("metric", "startdate", "tfn").agg(
        members.alias("members"), F.count(F.lit(1)).alias("sessions"), *[F.sum(c).alias(c) for c in sums]
    )
