"""A: scans, sources and sinks."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from offerloom.operators import episodes as E
from offerloom.operators import policy as P
from offerloom.operators import rewards as R
from offerloom.operators.dispositions import to_fact
from offerloom.queries.registry import K, STEPS, joined, query, text
from offerloom.schemas import REWARD_FACT
from offerloom.session import cut_lineage, scratch_path
from offerloom.sources import adapters as A
from offerloom.sources import decision_log as L
from offerloom.sources import tables as S


def write_log(spark, base, path, cond="true", broken=True):
    """Events as JSON log records in folders by date; a few records are cut short."""
    k = A.k_of()
    day = F.date_format("ts", "yyyy-MM-dd")
    record = F.to_json(F.struct(
        F.when(F.col("event_type").isin("view", "click"), "ivr").otherwise("spec-pat").alias("app"),
        F.col("user_id").cast("string").alias("enterprise_id"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"),
        F.col("event_id").cast("string").alias("eps_id"),
        F.array(F.pmod(k, F.lit(12))).alias("actions"),
        F.col("value").alias("rewards"),
        F.struct(k.alias("k"), F.col("event_type").alias("callintent")).alias("infos"),
    ))
    value = F.when(k == 99, F.substring(record, 1, 40)).otherwise(record) if broken else record
    rows = A.load(spark, "events", base).filter(cond).select(value.alias("value"), day.alias("log_date"))
    rows.write.mode("overwrite").partitionBy("log_date").text(path)
    return path


@query("a1_scan", """
    SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def a1(spark, base):
    rows = A.load(spark, "orders", base)
    return rows.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query("a2_log_scan", f"""
    SELECT CASE WHEN event_type IN ('view', 'click') THEN 'ivr' ELSE 'spec-pat' END AS app,
           CAST(user_id AS VARCHAR) AS enterprise_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS time,
           CAST(event_id AS VARCHAR) AS eps_id, {K} % 12 AS action, value AS rewards,
           '{{"k":' || {K} || ',"callintent":"' || event_type || '"}}' AS infos
    FROM events""")
def a2(spark, base):
    log = L.read_decisions(spark, write_log(spark, base, scratch_path(spark, "a2"), broken=False))
    return log.select(
        "app", "enterprise_id", F.date_format("time", "yyyy-MM-dd HH:mm:ss").alias("time"), "eps_id",
        F.get("actions", F.lit(0)).alias("action"), "rewards", "infos",
    )


@query("a3_file_date", f"""
    SELECT CAST(ts::DATE AS VARCHAR) AS file_date, count(*) AS n FROM events WHERE {K} <> 0 GROUP BY 1
    UNION ALL SELECT 'rejected', count(*) FROM events WHERE {K} = 0""")
def a3(spark, base):
    good = F.concat(F.lit("s"), F.col("event_id"), F.lit("_"), F.date_format("ts", "yyyy-MM-dd HHmmss"), F.lit(".json"))
    name = F.when(A.k_of() == 0, F.concat(F.lit("notes_"), F.col("event_type"), F.lit(".json"))).otherwise(good)
    found = L.file_date(F.replace(name, F.lit(" "), F.lit("%20"))).cast("string")
    rows = A.load(spark, "events", base).select(F.coalesce(found, F.lit("rejected")).alias("file_date"))
    return rows.groupBy("file_date").agg(F.count(F.lit(1)).alias("n"))


def _per_day(spark, path):
    return spark.read.parquet(path).groupBy(text("partition_field")).agg(F.count(F.lit(1)).alias("n"))


@query("a4_ingest_new_dates", f"""
    SELECT CAST(ts::DATE AS VARCHAR) AS partition_field, count(*) AS n FROM events
    WHERE ({K} <> 99) AND (ts::DATE >= DATE '2024-01-15' OR event_type <> 'error') GROUP BY 1""")
def a4(spark, base):
    """Days loaded before keep their rows although the source has more by now."""
    dst = scratch_path(spark, "a4")
    old = write_log(spark, base, scratch_path(spark, "a4"), "ts < '2024-01-15' and event_type <> 'error'")
    L.ingest_new_dates(spark, old, dst)
    L.ingest_new_dates(spark, write_log(spark, base, scratch_path(spark, "a4")), dst)
    return _per_day(spark, dst)


@query("a5_reingest_recent", f"""
    SELECT CAST(ts::DATE AS VARCHAR) AS partition_field, count(*) AS n FROM events
    WHERE ({K} <> 99) AND (ts::DATE >= DATE '2024-01-28' OR event_type <> 'error') GROUP BY 1""")
def a5(spark, base):
    dst = scratch_path(spark, "a5")
    L.ingest_new_dates(spark, write_log(spark, base, scratch_path(spark, "a5"), "event_type <> 'error'"), dst)
    L.reingest_recent(spark, write_log(spark, base, scratch_path(spark, "a5")), dst, date(2024, 1, 30))
    return _per_day(spark, dst)


@query("a6_append_partitioned", """
    SELECT CAST(ts::DATE AS VARCHAR) AS partition_field, count(*) AS n FROM events GROUP BY 1""")
def a6(spark, base):
    dst = scratch_path(spark, "a6")
    rows = A.decisions(spark, base)
    S.append_partitioned(rows.filter("app = 'ivr'"), dst)
    S.append_partitioned(rows.filter("app <> 'ivr'"), dst)
    return _per_day(spark, dst)


def penalty_fact(spark, base):
    calls = R.repeat_penalty(A.event_calls(spark, base))
    named = calls.withColumns({"reward_name": F.lit("repeat_call"), "reward_desc": F.lit("repeat call within 7 days")})
    return to_fact(named, "date_time", "org", "ivr", "rx", "call", "reward_name", "reward_desc", "reward_value")


PENALTY = """calls AS (
    SELECT DISTINCT user_id, ts FROM events
), penalties AS (
    SELECT user_id, ts, min(-3) OVER (PARTITION BY user_id ORDER BY ts
        RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 1 DAYS PRECEDING) AS reward_value FROM calls
)"""


@query("a7_write_fact", f"""
    WITH {PENALTY}
    SELECT CAST(ts::DATE AS VARCHAR) AS date, count(*) AS n, CAST(sum(reward_value) AS BIGINT) AS total FROM penalties
    WHERE reward_value IS NOT NULL GROUP BY 1""")
def a7(spark, base):
    """Two writes: the second replaces the later dates only."""
    dst = scratch_path(spark, "a7")
    fact = penalty_fact(spark, base)
    late = F.col("date") >= "2024-01-20"
    S.write_fact(fact.withColumn("reward_value", F.when(late, 0).otherwise(F.col("reward_value"))), dst)
    S.write_fact(fact.filter(late), dst)
    return spark.read.parquet(dst).groupBy(text("date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("reward_value").alias("total")
    )


@query("a8_ensure_table", f"""
    WITH {PENALTY} SELECT count(*) AS n, count(DISTINCT user_id) AS entities FROM penalties WHERE reward_value IS NOT NULL""")
def a8(spark, base):
    """Creating the table again leaves the stored rows alone."""
    dst = scratch_path(spark, "a8")
    S.ensure_table(spark, dst, REWARD_FACT, ["date"])
    S.write_fact(penalty_fact(spark, base), dst)
    S.ensure_table(spark, dst, REWARD_FACT, ["date"])
    return S.read_table(spark, dst, REWARD_FACT).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("enterprise_id").alias("entities")
    )


@query("a9_overwrite", "SELECT c_custkey, c_name, round(c_acctbal, 2) AS balance FROM customer")
def a9(spark, base):
    """The second write brings another schema."""
    dst = scratch_path(spark, "a9")
    rows = A.load(spark, "customer", base)
    S.overwrite(rows.select("c_custkey"), dst, n=4)
    S.overwrite(rows.select("c_custkey", "c_name", F.round("c_acctbal", 2).alias("balance")), dst, n=4)
    return spark.read.parquet(dst)


@query("a10_export", "SELECT n_nationkey, n_name, count(*) AS customers FROM nation JOIN customer ON c_nationkey = n_nationkey GROUP BY 1, 2")
def a10(spark, base):
    dst = scratch_path(spark, "a10")
    rows = A.load(spark, "customer", base).join(
        A.load(spark, "nation", base), F.col("c_nationkey") == F.col("n_nationkey")
    ).groupBy("n_nationkey", "n_name").agg(F.count(F.lit(1)).alias("customers"))
    S.export_files(rows, dst, k=1)
    return spark.read.parquet(dst)


@query("a11_quarantine", f"""
    SELECT CASE WHEN {K} = 99 THEN 'bad' ELSE 'good' END AS part, count(*) AS n FROM events GROUP BY 1""")
def a11(spark, base):
    good, bad = L.split_valid(L.read_decisions(spark, write_log(spark, base, scratch_path(spark, "a11"))))
    parts = good.select(F.lit("good").alias("part")).unionByName(bad.select(F.lit("bad").alias("part")))
    return parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))


@query("a12_table_extent", """
    SELECT CAST(max(o_orderdate)::DATE AS VARCHAR) AS "end", CAST(min(o_orderdate)::DATE AS VARCHAR) AS start, count(*) AS n
    FROM orders""")
def a12(spark, base):
    extent = S.table_extent(A.load(spark, "orders", base).select(F.to_date("o_orderdate").alias("d")), "d")
    return extent.select(text("end"), text("start"), "n")


@query("a13_cluster_by", "SELECT c_custkey, c_nationkey FROM customer")
def a13(spark, base):
    return S.cluster_by(A.load(spark, "customer", base).select("c_custkey", "c_nationkey"), "c_nationkey", 8)


def training_steps(spark, base):
    obs = F.array(F.col("rewards"), F.col("action_prob"))
    mask = F.array(F.lit(1), F.when(F.get("actions", F.lit(0)) > 5, 1).otherwise(0))
    shaped = A.decisions(spark, base).withColumns({"obs": obs, "mask": mask, "agent_index": F.lit(0)})
    moved = E.with_transitions(shaped, "enterprise_id", "time", ["eps_id"], ["obs", "mask"])
    return moved.withColumn("eps_id", F.col("enterprise_id"))


TRAINING = f"""{STEPS}, shaped AS (
    SELECT *, round(rewards, 4) || ',' || round(action_prob, 4) AS obs, '1,' || CAST(action > 5 AS INT) AS mask FROM steps
), training AS (
    SELECT enterprise_id AS eps_id, t, action, rewards, obs, mask,
           coalesce(lead(obs) OVER w, obs) AS new_obs, coalesce(lead(mask) OVER w, mask) AS new_mask,
           CAST(lead(t) OVER w IS NULL AS INT) AS dones
    FROM shaped WINDOW w AS (PARTITION BY enterprise_id ORDER BY t)
)"""


@query("a14_export_episodes", f"""
    WITH {STEPS}
    SELECT enterprise_id AS eps_id, t, action, rewards, 1 AS mask_0, CAST(action > 5 AS INT) AS mask_1,
           round(rewards, 4) AS obs_0, round(action_prob, 4) AS obs_1 FROM steps""")
def a14(spark, base):
    """Written as JSON records, read back and flattened again."""
    dst = scratch_path(spark, "a14")
    S.export_json(E.episode_records(training_steps(spark, base), chunk=16), dst)
    schema = "eps_id bigint, part int, steps array<struct<t: bigint, actions: array<int>, obs: array<double>, rewards: double>>"
    steps = spark.read.schema(schema).json(dst).select("eps_id", F.explode("steps").alias("s"))
    return steps.select(
        "eps_id", "s.t", F.get("s.actions", F.lit(0)).alias("action"), "s.rewards",
        F.get("s.obs", F.lit(0)).cast("int").alias("mask_0"), F.get("s.obs", F.lit(1)).cast("int").alias("mask_1"),
        F.round(F.get("s.obs", F.lit(2)), 4).alias("obs_0"), F.round(F.get("s.obs", F.lit(3)), 4).alias("obs_1"),
    )


@query("a15_training_columns", f"""
    WITH {TRAINING}
    SELECT eps_id, t, action, rewards, dones, mask, new_mask FROM training""")
def a15(spark, base):
    rows = E.training_columns(training_steps(spark, base).withColumn("source", F.col("app")))
    return rows.select(
        "eps_id", "t", F.get("actions", F.lit(0)).alias("action"), "rewards", "dones", joined("mask").alias("mask"),
        joined("new_mask").alias("new_mask"),
    )


@query("a16_cut_lineage", "SELECT l_returnflag, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS quantity FROM lineitem GROUP BY 1")
def a16(spark, base):
    rows = cut_lineage(A.load(spark, "lineitem", base).select("l_returnflag", "l_quantity"))
    return rows.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("quantity")
    )


def _actions_sql() -> str:
    rows = [
        f"('{app}', {position}, {id}, '{name}')"
        for app, actions in P.app_actions().items() for position, (id, name) in enumerate(actions.items())
    ]
    return f"actions(app, position, action_id, name) AS (VALUES {', '.join(rows)})"


ACTIONS = _actions_sql()


@query("a17_action_space", f"""
    WITH {ACTIONS}, n AS (
        SELECT CASE WHEN event_type IN ('view', 'click') THEN 'ivr' ELSE 'spec-pat' END AS app, {K} % 12 AS position,
               count(*) AS n FROM events GROUP BY 1, 2)
    SELECT a.app, a.position, a.action_id, a.name, coalesce(n.n, 0) AS logged FROM actions a LEFT JOIN n USING (app, position)""")
def a17(spark, base):
    """How often each action of the space was logged."""
    n = A.decisions(spark, base).groupBy("app", F.get("actions", F.lit(0)).alias("position")).agg(
        F.count(F.lit(1)).alias("logged")
    )
    return P.action_space(spark).join(n, ["app", "position"], "left").fillna(0, ["logged"]).select(
        "app", "position", "action_id", "name", "logged"
    )
