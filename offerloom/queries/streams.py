"""T: stream jobs, run over all there is and read back from their sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom.operators import episodes as E
from offerloom.operators import rewards as W
from offerloom.operators.state import newest_state
from offerloom.queries.functions import MASKS
from offerloom.queries.joins import tokens
from offerloom.queries.registry import DECISIONS, K, TOKEN_STATE, joined, query, text, u
from offerloom.queries.sources import PENALTY, penalty_fact, write_log
from offerloom.session import scratch_path, shuffle_width
from offerloom.sources import adapters as A
from offerloom.sources import decision_log as L
from offerloom.sources import tables as S
from offerloom.sources.lookup import publish_lookup
from offerloom.streaming import streams as Z


def events(spark, base):
    schema = A.load(spark, "events", base).schema
    return Z.event_stream(spark, base, schema, pathGlobFilter="events.parquet")


def decisions(rows):
    return rows.select(
        F.when(F.col("event_type").isin("view", "click"), "ivr").otherwise("spec-pat").alias("app"),
        F.col("user_id").alias("enterprise_id"), F.col("ts").cast("timestamp").alias("time"),
    )


def drained(spark, name, df):
    """Run a stream to its end and read its sink."""
    out = scratch_path(spark, name)
    Z.write_stream(df, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data")


def closed(spark, name, df, group, reach):
    """Run a stream to its end with a marker behind its last row, and read its sink: all rows come from the stream."""
    out = scratch_path(spark, name)
    Z.run_and_close(df, group, f"{out}/data", f"{out}/checkpoint", f"{out}/markers", reach=reach)
    return spark.read.parquet(f"{out}/data")


@query("t1_event_stream", "SELECT event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def t1(spark, base):
    rows = drained(spark, "t1", events(spark, base))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


BUS = "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, headers array<struct<key:string, value:binary>>"


def bus_records(rows):
    """Events as records of a bus; every third one was sent twice."""
    sends = F.when(F.pmod("event_id", F.lit(3)) == 0, F.sequence(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    payload = F.to_json(F.struct("event_id", "event_type", "value"))
    return rows.withColumn("_send", F.explode(sends)).select(
        F.col("user_id").cast("string").cast("binary").alias("key"), payload.cast("binary").alias("value"), F.lit("events").alias("topic"),
        F.pmod("user_id", F.lit(4)).cast("int").alias("partition"), (F.col("event_id") * 2 + F.col("_send")).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.array(F.struct(F.lit("message-id").alias("key"), F.col("event_id").cast("string").cast("binary").alias("value"))).alias("headers"),
    )


@query("t1_bus_messages", "SELECT event_id, CAST(user_id AS BIGINT) AS user_id, event_type, round(value, 4) AS value FROM events")
def t1_bus(spark, base):
    """Binary records of an at-least-once bus: decoded, each message once."""
    out = scratch_path(spark, "t1b")
    S.overwrite(bus_records(A.load(spark, "events", base)), f"{out}/bus")
    rows = drained(spark, "t1m", Z.bus_messages(Z.event_stream(spark, f"{out}/bus", BUS)))
    body = F.from_json("message", "event_id bigint, event_type string, value double")
    return rows.withColumn("_m", body).select(
        "_m.event_id", F.col("key").cast("bigint").alias("user_id"), "_m.event_type", F.round("_m.value", 4).alias("value")
    )


@query("t2_stream_sink", "SELECT event_id, user_id, value FROM events")
def t2(spark, base):
    """The stream is started twice on one checkpoint: the second start finds nothing new."""
    out = scratch_path(spark, "t2")
    for _ in range(2):
        rows = events(spark, base).select("event_id", "user_id", "value")
        Z.write_stream(rows, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data")


def size_scores(tokens):
    """Scores by the length of the state: a stand-in for a model that SQL can repeat."""
    n = F.size(tokens)
    return F.transform(F.sequence(F.lit(0), F.lit(18)), lambda i: F.pmod(n * 7 + i * 13, F.lit(17)) / F.lit(10.0))


DECIDED = f"""{TOKEN_STATE}, {MASKS}, ids AS (
    SELECT app AS app_name, list(action_id ORDER BY position) AS action_ids FROM actions GROUP BY 1
), asked AS (
    SELECT m.*, i.action_ids, CASE WHEN is_ivr THEN 'c' || event_id WHEN app_name = 'spec-pat' THEN 's' || event_id END AS session_id,
           coalesce(len(s.ids), 1) AS n,
           CASE WHEN m.app LIKE '%-test%' AND k % 10 = 0 THEN flags[1] END AS override
    FROM masks m LEFT JOIN ids i USING (app_name) LEFT JOIN state s ON s.enterprise_id = m.user_id AND s.current_record = 1
), suppressed AS (
    SELECT *, CASE WHEN list_sum(mask) > 1 AND {u('session_id', '7-none')} > 0.1 THEN list_concat([0], mask[2:]) ELSE mask END AS legal FROM asked
), scored AS (
    SELECT *, list_transform(legal, lambda m, i: CASE WHEN m = 1 THEN ((n * 7 + (i - 1) * 13) % 17) / 10::DOUBLE END) AS q,
           list_filter(range(len(legal)), lambda i: legal[i + 1] = 1) AS positions FROM suppressed
), chosen AS (
    SELECT *, CASE WHEN {u('session_id', '7-eps')} < 0.1 THEN positions[CAST(floor({u('session_id', '7-pick')} * len(positions)) AS INT) + 1]
                   ELSE list_position(q, list_max(q)) - 1 END AS a FROM scored
), decided AS (
    SELECT *, override IS NULL AND (app_name = 'fax' OR k = 99) AS failed,
           exp(q[a + 1] - list_max(q)) / list_sum(list_transform(q, lambda x: coalesce(exp(x - list_max(q)), 0))) AS p FROM chosen
)"""


@query("t3_decide_stream", f"""
    WITH {DECIDED}
    SELECT event_id, app, CASE WHEN failed THEN 0 ELSE action_ids[CASE WHEN override IS NULL THEN a + 1 ELSE list_position(names, override) END] END AS action_id,
           CASE WHEN failed THEN 'none' ELSE coalesce(override, names[a + 1]) END AS action_name,
           CASE WHEN failed OR override IS NOT NULL THEN -1 ELSE round(p, 6) END AS action_prob, CAST(failed AS INT) AS failed,
           CAST(NOT failed AND override IS NULL AS INT) AS logged
    FROM decided""")
def t3(spark, base):
    out = scratch_path(spark, "t3")
    decide_all(spark, base, out)
    rows = spark.read.parquet(f"{out}/decisions")
    return rows.select(
        "event_id", "app", "action_id", "action_name", F.coalesce(F.round("action_prob", 6), F.lit(-1.0)).alias("action_prob"),
        F.when(F.col("error").isNotNull(), 1).otherwise(0).alias("failed"), "logged",
    )


def decide_all(spark, base, out, by_bucket=False):
    """Requests arrive as a stream of message files; the state is a stored table, or one in buckets."""
    S.overwrite(A.requests(spark, base), f"{out}/requests", n=max(8, shuffle_width(spark)))
    requests = Z.event_stream(spark, f"{out}/requests", "event_id bigint, time timestamp, message string")
    state = newest_state(tokens(spark, base)).select(
        F.col("enterprise_id").cast("string").alias("raw_id"), "enterprise_id", "state_tokenized", "state"
    )
    if by_bucket:
        publish_lookup(state, f"{out}/state", buckets=16)
    else:
        S.overwrite(state, f"{out}/state")
    Z.decide_stream(
        requests, f"{out}/state", size_scores, f"{out}/decisions", f"{out}/errors", f"{out}/checkpoint", f"{out}/log", by_bucket=by_bucket,
    ).awaitTermination()


@query("t3_decide_by_bucket", f"""
    WITH {DECIDED} SELECT event_id, CAST(CASE WHEN failed THEN 1 ELSE 0 END AS INT) AS failed, array_to_string(legal, ',') AS mask FROM decided""")
def t3_bucket(spark, base):
    """The state is looked up in hash buckets of its current version."""
    out = scratch_path(spark, "t3k")
    decide_all(spark, base, out, by_bucket=True)
    rows = spark.read.parquet(f"{out}/decisions")
    return rows.select("event_id", F.when(F.col("error").isNotNull(), 1).otherwise(0).alias("failed"), joined("mask").alias("mask"))


@query("t3_decision_log", f"""
    WITH {DECIDED}, l AS (SELECT * FROM decided WHERE NOT failed AND override IS NULL)
    SELECT session_id AS eps_id, app, CAST(user_id AS VARCHAR) AS enterprise_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, CAST(a AS INT) AS action,
           names[a + 1] AS action_name, round(p, 6) AS action_prob, array_to_string(legal, ',') AS mask, CAST(least(list_sum(legal), 4) AS INT) AS listed,
           'cagm' AS id_type FROM l""")
def t3_log(spark, base):
    """What the stream logs, read back by the log reader."""
    out = scratch_path(spark, "t3l")
    decide_all(spark, base, out)
    good, _ = L.split_valid(L.read_decisions(spark, f"{out}/log"))
    return good.select(
        "eps_id", "app", "enterprise_id", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), F.get("actions", F.lit(0)).alias("action"),
        F.get("raw_action_str", F.lit(0)).alias("action_name"), F.round("action_prob", 6).alias("action_prob"), joined("mask").alias("mask"),
        F.size("raw_action_str").alias("listed"), "id_type",
    )


@query("t3_log_to_steps", f"""
    WITH {DECIDED}, {PENALTY}, l AS (SELECT user_id AS enterprise_id, 'offerloom' AS implementation, a AS action, NULL AS rewards FROM decided
        WHERE NOT failed AND override IS NULL),
    r AS (SELECT user_id, ts::DATE AS date, sum(reward_value) AS rewards FROM penalties WHERE reward_value IS NOT NULL GROUP BY 1, 2),
    s AS (SELECT * FROM l UNION ALL SELECT user_id, 'rx', 0, rewards FROM r)
    SELECT enterprise_id, implementation, count(*) AS n, CAST(sum(action) AS BIGINT) AS actions, round(coalesce(sum(rewards), 0)::DOUBLE, 4) AS rewards
    FROM s GROUP BY 1, 2""")
def t3_steps(spark, base):
    """Stream, log, ingest, episodes: the decisions become steps beside the rewards."""
    out = scratch_path(spark, "t3s")
    decide_all(spark, base, out)
    L.ingest_new_dates(spark, f"{out}/log/batch_id=*", f"{out}/loaded", f"{out}/bad")
    steps = E.steps_with_rewards(spark.read.parquet(f"{out}/loaded"), W.daily_rewards(penalty_fact(spark, base), "reward_value"))
    return steps.groupBy("enterprise_id", "implementation").agg(
        F.count(F.lit(1)).alias("n"), F.sum("action").alias("actions"), F.round(F.coalesce(F.sum("rewards"), F.lit(0.0)), 4).alias("rewards")
    )


@query("t3_decision_errors", f"""
    SELECT CASE event_type WHEN 'error' THEN 'invalid app: fax' ELSE 'eligible action not in the action space' END AS error, count(*) AS n
    FROM events WHERE event_type = 'error' OR {K} = 99 GROUP BY 1""")
def t3_errors(spark, base):
    out = scratch_path(spark, "t3e")
    decide_all(spark, base, out)
    return spark.read.parquet(f"{out}/errors").groupBy("error").agg(F.count(F.lit(1)).alias("n"))


@query("t4_assemble_episodes", f"""
    WITH m AS (SELECT user_id, ts, {K} % 12 AS action, value AS reward, CAST(event_type = 'signup' AND {K} >= 80 AS INT) AS done FROM events),
    s AS (SELECT *, sum(done) OVER (PARTITION BY user_id ORDER BY ts) - done AS ep FROM m)
    SELECT CAST(user_id AS VARCHAR) AS session, CAST(epoch_us(ts) AS BIGINT) AS ts_us, row_number() OVER w - 1 AS t, action, reward,
           lag(action, 1, 0) OVER w AS prev_action, lag(reward, 1, 0) OVER w AS prev_reward, done AS dones
    FROM s WINDOW w AS (PARTITION BY user_id, ep ORDER BY ts)""")
def t4(spark, base):
    k = A.k_of()
    messages = events(spark, base).select(
        F.col("user_id").cast("string").alias("session"), F.col("ts").cast("timestamp").alias("time"),
        F.pmod(k, F.lit(12)).alias("action"), F.col("value").alias("reward"),
        F.when((F.col("event_type") == "signup") & (k >= 80), 1).otherwise(0).alias("done"),
    ).withWatermark("time", "1 hour")
    rows = drained(spark, "t4", Z.assemble_episodes_stream(messages, idle="2 days"))
    return rows.select(
        "session", F.unix_micros("time").alias("ts_us"), "t", "action", "reward", "prev_action", "prev_reward", "dones"
    )


@query("t4_idle_ends", f"""
    WITH m AS (SELECT user_id, ts, {K} % 12 AS action, value AS reward, CAST(event_type = 'signup' AND {K} >= 80 AS INT) AS done FROM events),
    s AS (SELECT *, sum(done) OVER (PARTITION BY user_id ORDER BY ts) - done AS ep,
          row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS back FROM m),
    n AS (SELECT *, count(*) OVER (PARTITION BY user_id, ep) AS t FROM s)
    SELECT CAST(user_id AS VARCHAR) AS session, CAST(epoch_us(ts + INTERVAL 2 DAYS) AS BIGINT) AS ts_us, t, action AS prev_action, reward AS prev_reward,
           1 AS dones FROM n WHERE back = 1 AND done = 0""")
def t4_ends(spark, base):
    """Every session that did not say its end, ended by its timer."""
    k = A.k_of()
    messages = events(spark, base).select(
        F.col("user_id").cast("string").alias("session"), F.col("ts").cast("timestamp").alias("time"),
        F.pmod(k, F.lit(12)).alias("action"), F.col("value").alias("reward"),
        F.when((F.col("event_type") == "signup") & (k >= 80), 1).otherwise(0).alias("done"),
    )
    rows = closed(spark, "t4e", messages, lambda df: Z.assemble_episodes_stream(df, "2 days", ends=True), "2 days")
    return rows.filter("kind = 'end'").select("session", F.unix_micros("time").alias("ts_us"), "t", "prev_action", "prev_reward", "dones")


@query("t5_sessionize_stream", """
    WITH g AS (SELECT user_id, ts, CAST(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 6 HOURS AS INT) AS same FROM events),
    s AS (SELECT user_id, ts, sum(1 - coalesce(same, 0)) OVER (PARTITION BY user_id ORDER BY ts) AS sid FROM g),
    a AS (SELECT user_id, min(ts) AS lo, max(ts) + INTERVAL 6 HOURS AS hi, count(*) AS events FROM s GROUP BY user_id, sid)
    SELECT user_id AS enterprise_id, CAST(epoch_us(lo) AS BIGINT) AS start_us, CAST(epoch_us(hi) AS BIGINT) AS end_us, events
    FROM a""")
def t5(spark, base):
    rows = closed(spark, "t5", decisions(events(spark, base)), lambda df: Z.sessionize_stream(df, "6 hours", None), "6 hours")
    return rows.select(
        "enterprise_id", F.unix_micros("start").alias("start_us"), F.unix_micros("end").alias("end_us"), "events"
    )


@query("t6_ingest_stream", f"""
    SELECT 'good' AS part, CAST(ts::DATE AS VARCHAR) AS date, count(*) AS n FROM events WHERE {K} <> 99 GROUP BY 2
    UNION ALL SELECT 'bad', CAST(ts::DATE AS VARCHAR), count(*) FROM events WHERE {K} = 99 GROUP BY 2""")
def t6(spark, base):
    src, out = write_log(spark, base, scratch_path(spark, "t6")), scratch_path(spark, "t6")
    Z.ingest_stream(spark, src, f"{out}/log", f"{out}/bad", f"{out}/checkpoint").awaitTermination()
    good = spark.read.parquet(f"{out}/log").select(F.lit("good").alias("part"), F.col("partition_field").alias("date"))
    bad = spark.read.parquet(f"{out}/bad").select(F.lit("bad").alias("part"), F.col("file_date").alias("date"))
    return good.unionByName(bad).groupBy("part", text("date")).agg(F.count(F.lit(1)).alias("n"))


@query("t7_volume_stream", f"""
    WITH {DECISIONS}
    SELECT app, CAST(time::DATE AS VARCHAR) AS date, count(*) AS volume FROM decisions GROUP BY 1, 2""")
def t7(spark, base):
    return closed(spark, "t7", decisions(events(spark, base)), lambda df: Z.volume_stream(df, None), "1 day").select("app", text("date"), "volume")
