"""Views of the star-schema tables in the shape the operators expect.

Times are cast from ``timestamp_ntz`` once, here. No adapter aggregates, except where noted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.session import configure

AS_OF = "2024-01-31"


def load(spark: SparkSession, name: str, base: str | None = None) -> DataFrame:
    """A table by catalog name, or a parquet folder below ``base``."""
    configure(spark)
    return spark.table(name) if base is None else spark.read.parquet(f"{base}/{name}.parquet")


def k_of(c: str = "props") -> Column:
    return F.get_json_object(c, "$.k").cast("int")


def features(spark: SparkSession, base: str) -> DataFrame:
    is_profile = F.col("event_type") == "signup"
    return load(spark, "events", base).select(
        F.col("user_id").alias("enterprise_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("ts").cast("timestamp").alias("date_time"),
        F.when(is_profile, "profile").otherwise("session_event").alias("feature_type"),
        F.when(is_profile, "demographics").otherwise("behavior").alias("category"),
        F.col("event_type").alias("feature_name"),
        (F.floor(k_of() / 10) * 10).cast("string").alias("feature_value"),
    )


def sessions(spark: SparkSession, base: str) -> DataFrame:
    """Every event is a short session of two tokens."""
    k = k_of()
    return load(spark, "events", base).select(
        F.col("user_id").alias("enterprise_id"),
        F.col("ts").cast("date").alias("date"),
        F.col("ts").cast("timestamp").alias("date_time"),
        F.when(F.col("event_type") == "error", "text").otherwise(F.col("event_type")).alias("event_type"),
        F.array(F.col("event_type"), F.concat(F.lit("k"), k.cast("string"))).alias("events"),
        F.array(F.length("event_type"), k + 100).alias("event_tokens"),
    )


def member_id(c: str) -> Column:
    return F.concat(F.lit("Customer#"), F.lpad(F.col(c).cast("string"), 9, "0"))


def calls(spark: SparkSession, base: str) -> DataFrame:
    """Orders as calls of a member."""
    return load(spark, "orders", base).select(
        F.col("o_orderkey").cast("string").alias("call_guid"),
        member_id("o_custkey").alias("cagm"),
        F.col("o_orderdate").cast("timestamp").alias("start_dtm"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "MED").otherwise("RX").alias("logical_app_name"),
        F.when(F.col("o_orderpriority") == "5-LOW", "provider").otherwise("member").alias("caller_type"),
        tfn("o_custkey").alias("tfn"),
        xferstatus("o_orderstatus").alias("xferstatus"),
        F.when(F.col("o_totalprice") >= 20000, 1).otherwise(0).alias("authenticated"),
    )


def tfn(key: str) -> Column:
    return F.when(F.substring(F.md5(F.col(key).cast("string")), 1, 1) < "8", "pilot").otherwise("control")


def xferstatus(status: str) -> Column:
    return F.when(F.col(status) == "F", "XFER").when(F.col(status) == "O", "DONE").otherwise("HANG")


def event_calls(spark: SparkSession, base: str) -> DataFrame:
    """Events as closely spaced calls."""
    return load(spark, "events", base).select(
        F.col("event_id").cast("string").alias("call_guid"),
        F.col("user_id").alias("enterprise_id"),
        F.col("ts").cast("timestamp").alias("date_time"),
        F.when(F.col("event_type").isin("error", "purchase"), "XFER").otherwise("DONE").alias("xferstatus"),
    )


def id_map(spark: SparkSession, base: str) -> DataFrame:
    return load(spark, "customer", base).select(
        F.col("c_custkey").alias("enterprise_id"),
        F.lit("cagm").alias("id_type"),
        F.col("c_name").alias("alternative_id"),
    )


def call_flags(spark: SparkSession, base: str) -> DataFrame:
    """Order lines as log rows with 0/1 flags; many rows per call."""
    def flag(cond: str) -> Column:
        return F.when(F.expr(cond), 1).otherwise(0)

    return load(spark, "lineitem", base).select(
        F.col("l_orderkey").cast("string").alias("call_guid"),
        flag("l_returnflag = 'A'").alias("refill_alert"),
        flag("l_linestatus = 'F'").alias("want_refill_yes"),
        flag("l_discount >= 0.05").alias("rx_refilled"),
        flag("l_discount < 0.02").alias("rx_refill_failed"),
        flag("l_returnflag = 'N'").alias("renewal_alert"),
        flag("l_tax >= 0.04").alias("renewal_alert_yes"),
        flag("l_discount >= 0.03").alias("rx_renewed"),
        flag("l_returnflag = 'R'").alias("sms_offered"),
        F.when(F.col("l_linestatus") == "O", "yes").otherwise("no").alias("sms_offered_response"),
        flag("l_quantity > 25").alias("sms_enrolled"),
        flag("l_quantity > 40").alias("gan_activation_sent"),
        F.concat(F.lit("q"), F.col("l_quantity").cast("int").cast("string")).alias("request_content"),
    )


REPORT_SPLIT = "1998-05-01"


def report(spark: SparkSession, base: str) -> DataFrame:
    """Offer lines plus one ``call`` and one ``resolved`` row per session."""
    orders = load(spark, "orders", base)
    date = F.col("o_orderdate").cast("date")
    session = [
        F.col("o_orderkey").alias("gvpsessionid"),
        member_id("o_custkey").alias("cagm"),
        date.alias("startdate"),
        tfn("o_custkey").alias("tfn"),
        xferstatus("o_orderstatus").alias("xferstatus"),
        F.when(date < "1998-04-01", 1).when(date >= REPORT_SPLIT, 0).alias("before_after"),
        F.when(tfn("o_custkey") == "pilot", 0).otherwise(1).alias("control_pilot"),
    ]
    zero = F.lit(0)
    offer = (
        F.when(F.col("l_returnflag") == "A", "refill").when(F.col("l_returnflag") == "N", "renewal").otherwise("sms")
    )
    lines = load(spark, "lineitem", base).select(
        F.col("l_orderkey").alias("o_orderkey"),
        offer.alias("metric"),
        F.when(F.col("l_discount") >= 0.02, 1).otherwise(0).alias("offered"),
        F.when((F.col("l_discount") >= 0.02) & (F.col("l_linestatus") == "O"), 1).otherwise(0).alias("accepted"),
    )
    offers = orders.join(lines, "o_orderkey").select(*session, "metric", "offered", "accepted", zero.alias("penalty"))
    whole = orders.withColumn(
        "m", F.explode(F.array(
            F.struct(F.lit("call").alias("metric"),
                     F.when(F.col("o_totalprice") > 250000, 1).otherwise(0).alias("penalty")),
            F.struct(F.lit("resolved").alias("metric"),
                     F.when(F.col("o_orderpriority") < "3", 1).otherwise(0).alias("penalty")),
        ))
    ).select(*session, "m.metric", zero.alias("offered"), zero.alias("accepted"), "m.penalty")
    return offers.unionByName(whole)


def decisions(spark: SparkSession, base: str) -> DataFrame:
    """Events as logged decisions of one step."""
    k = F.col("k")
    prob = (F.pmod(k, F.lit(7)) + 2) / F.lit(10.0)
    return load(spark, "events", base).withColumn("k", k_of()).select(
        F.when(F.col("event_type").isin("view", "click"), "ivr").otherwise("spec-pat").alias("app"),
        F.concat(F.lit("impl-"), F.col("event_type")).alias("implementation"),
        F.col("user_id").alias("enterprise_id"),
        F.col("ts").cast("timestamp").alias("time"),
        F.col("event_id").cast("string").alias("eps_id"),
        F.array(F.pmod(k, F.lit(12))).alias("actions"),
        prob.alias("action_prob"),
        F.ln(prob).alias("action_logp"),
        F.col("value").alias("rewards"),
    )


def scores(spark: SparkSession, base: str) -> DataFrame:
    """Vectors as logits of an action space of their length (64), with a logged action."""
    return load(spark, "embeddings", base).select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("logits"),
        F.col("embedding").cast("array<double>").alias("obs"),
        F.col("label").alias("action"),
        F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.when(F.pmod(F.col("vec_id") + i, F.lit(3)) > 0, 1)
                    .otherwise(0)).alias("mask"),
    )


def metric_history(spark: SparkSession, base: str) -> DataFrame:
    """Events of a user as the metric series of a training run."""
    return load(spark, "events", base).select(
        F.lit("train").alias("experiment"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("run_name"),
        F.col("user_id").cast("string").alias("runid"),
        F.col("event_id").alias("step"),
        F.unix_micros(F.col("ts").cast("timestamp")).alias("timestamp"),
        F.col("value"),
    )


def requests(spark: SparkSession, base: str) -> DataFrame:
    """Events as request messages: JSON text per event."""
    k = F.col("k")
    ivr = F.array(F.lit("autorefill"), F.lit("sms"), F.lit("renewal"), F.lit("refill"), F.lit("orderstatus"))
    web = F.array(F.lit("creditcard"), F.lit("osp_smf"), F.lit("osp_commpref"), F.lit("orderstatus"))
    is_ivr = F.col("event_type").isin("view", "click")
    flags = F.filter(
        F.when(is_ivr, ivr).otherwise(web), lambda x, i: F.getbit(k, i) == 1
    )
    unknown = F.when(k == 99, F.array(F.lit("unknown_offer"))).otherwise(F.array().cast("array<string>"))
    app = (
        F.when(F.col("event_type") == "view", "IVR")
        .when(F.col("event_type") == "click", "ivr-test")
        .when(F.col("event_type") == "signup", "SPEC-PAT-TEST")
        .when(F.col("event_type") == "error", "fax")
        .otherwise("spec-pat")
    )
    body = F.struct(
        F.col("user_id").cast("string").alias("cagm"),
        F.when(is_ivr, F.concat(F.lit("c"), F.col("event_id"))).alias("ivrcallid"),
        F.when(~is_ivr, F.concat(F.lit("s"), F.col("event_id"))).alias("sessionid"),
        F.when(is_ivr, F.lit("refill")).alias("callintent"),
        F.when(~is_ivr, F.lit("order")).alias("digitalintent"),
        F.concat(flags, unknown).alias("eligibilityflags"),
        F.when(F.pmod(k, F.lit(10)) == 0, F.lit(0)).alias("priorityaction"),
    )
    message = F.struct(app.alias("app"), body.alias("app_data"))
    return load(spark, "events", base).withColumn("k", k_of()).select(
        "event_id", F.col("ts").cast("timestamp").alias("time"), F.to_json(message).alias("message")
    )
