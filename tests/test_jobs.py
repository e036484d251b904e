"""Log ingest, table writes, streams, run selection and the nightly jobs."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from offerloom.operators import runs as U
from offerloom.plans import nightly
from offerloom.schemas import REWARD_FACT, require
from offerloom.sources import decision_log as L
from offerloom.sources import tables as T
from offerloom.streaming import streams as Z


def log_file(folder, session, stamp, day=None, text=None):
    """A file as the scoring service names it."""
    body = text or (
        '{"app":"ivr","enterprise_id":"7","time":"%s 10:00:00","eps_id":"%s","actions":[3],"infos":{"callintent":"x"},'
        '"rewards":null}' % (day or stamp[:10], session)
    )
    folder.mkdir(exist_ok=True)
    (folder / f"{session}_{stamp}.json").write_text(body)


def counts(spark, path):
    return {str(r["partition_field"]): r["count"] for r in spark.read.parquet(path).groupBy("partition_field").count().collect()}


def test_ingest_and_reingest(spark, tmp_path):
    src, dst, bad = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "bad")
    log_file(src, "s1", "2024-01-01 100000")
    log_file(src, "s2", "2024-01-02 100000")
    (src / "notes.json").write_text("{}")
    assert L.ingest_new_dates(spark, str(src), dst, bad) == [date(2024, 1, 1), date(2024, 1, 2)]
    log_file(src, "s3", "2024-01-01 110000")  # late, of a loaded day
    log_file(src, "s4", "2024-01-03 100000")
    log_file(src, "s5", "2024-01-03 110000", text='{"app":"ivr","time":"2024-01-03')  # cut short
    log_file(src, "s6", "2024-01-03 120000", day="2024-01-01")  # of another day than its file
    assert L.ingest_new_dates(spark, str(src), dst, bad) == [date(2024, 1, 3)]
    assert counts(spark, dst) == {"2024-01-01": 1, "2024-01-02": 1, "2024-01-03": 1}
    assert spark.read.parquet(bad).count() == 2
    L.reingest_recent(spark, str(src), dst, date(2024, 1, 3), days=2)
    assert counts(spark, dst) == {"2024-01-01": 2, "2024-01-02": 1, "2024-01-03": 1}
    assert (src / "notes.json").exists() and L.ingest_new_dates(spark, str(src), dst) == []
    row = spark.read.parquet(dst).first()
    assert row["infos"] == '{"callintent":"x"}' and row["actions"] == [3]


@pytest.mark.parametrize("path, want", [
    ("file:/a/s1_2024-01-01%20100000.json", "2024-01-01"), ("/a/2024-01-01/part-0.json", "2024-01-01"),
    ("/a/log_date=2024-01-01/x.txt", "2024-01-01"), ("/a/notes.json", None), ("/a/s_2024-13-01 1.json", None),
])
def test_file_date(spark, path, want):
    got = spark.range(1).select(L.file_date(F.lit(path))).first()[0]
    assert (str(got) if got else None) == want


def test_fact_write_replaces_days_only(spark, tmp_path):
    path = str(tmp_path / "fact")
    T.ensure_table(spark, path, REWARD_FACT, ["date"])
    assert T.read_table(spark, path, REWARD_FACT).count() == 0
    fact = spark.sql("""select 1L enterprise_id, 'o' organization, 'a' app, 's' source, 'c' category, date'2024-01-01' date,
        timestamp'2024-01-01' date_time, 'n' reward_name, 'd' reward_desc, 1 reward_value""")
    T.write_fact(fact, path)
    T.write_fact(fact.withColumn("date", F.date_add("date", 1)), path)
    T.write_fact(fact.withColumn("reward_value", F.lit(9)), path)
    got = T.read_table(spark, path, REWARD_FACT).groupBy("date").agg(F.sum("reward_value").alias("v")).orderBy("date")
    assert [r["v"] for r in got.collect()] == [9, 1]


def test_days_without_rows_are_cleared(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact = spark.sql("""select 1L enterprise_id, date_add(date'2024-01-01', cast(id as int)) date, id reward_value from range(4)""")
    T.write_fact(fact, path)
    T.write_fact(fact.filter("date = '2024-01-04'"), path, date(2024, 1, 3))
    assert {str(r["date"]) for r in spark.read.parquet(path).collect()} == {"2024-01-01", "2024-01-02", "2024-01-04"}
    assert T.partition_days(spark, path, "date") == {date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 4)}
    assert T.partition_days(spark, str(tmp_path / "none"), "date") == set() and not T.exists(spark, str(tmp_path / "none"))


def test_day_of_bad_records_is_loaded_once_and_cleared_day_goes(spark, tmp_path):
    src, dst, bad = tmp_path / "src", str(tmp_path / "dst"), str(tmp_path / "bad")
    log_file(src, "s1", "2024-01-01 100000")
    log_file(src, "s2", "2024-01-02 100000", text='{"app":"ivr","time":"2024-01-02')
    assert L.ingest_new_dates(spark, str(src), dst, bad) == [date(2024, 1, 1), date(2024, 1, 2)]
    for _ in range(2):
        assert L.ingest_new_dates(spark, str(src), dst, bad) == []
    assert spark.read.parquet(bad).count() == 1
    log_file(src, "s1", "2024-01-01 100000", text='{"app":"ivr","time":"2024-01-01')  # the good record is gone
    L.reingest_recent(spark, str(src), dst, date(2024, 1, 2), errors=bad)
    assert T.partition_days(spark, dst, "partition_field") == set() and spark.read.parquet(bad).count() == 2


def test_rewards_look_back_beyond_the_start(spark, tmp_path):
    calls = spark.sql("""select concat('g', id) as call_guid, 'm1' as cagm, timestampadd(DAY, cast(2 * id as int), timestamp'2024-01-01 09:00:00')
        as start_dtm, 'RX' as logical_app_name, 'member' as caller_type from range(8)""")
    id_map = spark.sql("select 1L as enterprise_id, 'cagm' as id_type, 'm1' as alternative_id")
    days = lambda root: {str(r["date"]) for r in spark.read.parquet(f"{root}/rewards").collect()}
    nightly.reward_job(spark, calls, id_map, str(tmp_path / "all"), "2023-01-01")
    nightly.reward_job(spark, calls, id_map, str(tmp_path / "late"), "2024-01-09 12:00:00")
    assert days(tmp_path / "late") == {d for d in days(tmp_path / "all") if d >= "2024-01-09"} and "2024-01-11" in days(tmp_path / "late")
    # A correction that takes the last calls away clears their days; earlier days stay.
    nightly.reward_job(spark, calls.filter("start_dtm < '2024-01-12'"), id_map, str(tmp_path / "all"), "2024-01-09 12:00:00")
    assert max(days(tmp_path / "all")) == "2024-01-11" and "2024-01-03" in days(tmp_path / "all")


def test_dispositions_from_a_start(spark, tmp_path):
    calls = spark.sql("""select concat('g', id) as call_guid, 'm1' as cagm, timestampadd(DAY, cast(id as int), timestamp'2024-01-01') as start_dtm,
        if(id % 2 = 0, 'RX', 'MED') as logical_app_name from range(8)""")
    id_map = spark.sql("select 1L as enterprise_id, 'cagm' as id_type, 'm1' as alternative_id")
    flags = calls.select("call_guid", F.lit(1).alias("x_alert"), F.lit(1).alias("x_yes"))
    offers = {"x": {"offered": "x_alert", "accepted": "x_yes"}}
    nightly.disposition_job(spark, flags, calls, id_map, str(tmp_path), offers)
    nightly.disposition_job(spark, flags, calls.filter("start_dtm < '2024-01-06'"), id_map, str(tmp_path), offers, "2024-01-04", "RX")
    got = {str(r["date"]) for r in spark.read.parquet(f"{tmp_path}/dispositions").collect()}
    assert got == {"2024-01-01", "2024-01-02", "2024-01-03", "2024-01-05"}


def test_required_columns(spark):
    with pytest.raises(ValueError, match="b"):
        require(spark.range(1).toDF("a"), "a", "b")


MESSAGE = "session string, time timestamp, action int, reward double, done int"


def test_episodes_across_batches(spark, tmp_path):
    """Three messages and a done over two micro-batches; another session stays open."""
    t0 = datetime(2024, 1, 1)
    batches = [
        [("a", t0, 5, 1.0, 0), ("b", t0, 1, 0.5, 0)],
        [("a", t0 + timedelta(minutes=2), 7, 3.0, 1), ("a", t0 + timedelta(minutes=1), 6, 2.0, 0), ("a", t0 + timedelta(minutes=3), 8, 4.0, 0)],
    ]
    src, out = str(tmp_path / "m"), tmp_path
    for rows in batches:
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(src)
        stream = Z.event_stream(spark, src, MESSAGE, maxFilesPerTrigger=1).withWatermark("time", "1 hour")
        Z.write_stream(Z.assemble_episodes_stream(stream), str(out / "o"), str(out / "c")).awaitTermination()
    got = spark.read.parquet(str(out / "o")).orderBy("session", "time").collect()
    assert [(r["session"], r["t"], r["action"], r["prev_action"], r["prev_reward"], r["dones"]) for r in got] == [
        ("a", 0, 5, 0, 0.0, 0), ("a", 1, 6, 5, 1.0, 0), ("a", 2, 7, 6, 2.0, 1), ("a", 0, 8, 0, 0.0, 0), ("b", 0, 1, 0, 0.0, 0),
    ]


def test_idle_sessions_end_and_late_messages_are_set_aside(spark, tmp_path):
    t0 = datetime(2024, 1, 1)
    minute = lambda n: t0 + timedelta(minutes=n)
    batches = [
        [("a", minute(10), 5, 1.0, 0), ("b", minute(0), 1, 0.5, 0), ("d", minute(5), 2, 1.5, 1)],
        [("a", minute(9), 9, 9.0, 0), ("a", minute(11), 6, 2.0, 0)],
        [("a", minute(8), 9, 9.0, 0)],
        [("c", minute(600), 3, 0.0, 0)],
    ]
    src = str(tmp_path / "m")
    for rows in batches:
        spark.createDataFrame(rows, MESSAGE).coalesce(1).write.mode("append").parquet(src)
        stream = Z.event_stream(spark, src, MESSAGE, maxFilesPerTrigger=1).withWatermark("time", "1 hour")
        Z.write_stream(Z.assemble_episodes_stream(stream, ends=True), str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o")).collect()
    assert sorted((r["session"], r["t"], r["action"], r["prev_action"], r["dones"]) for r in got if r["kind"] == "step") == [
        ("a", 0, 5, 0, 0), ("a", 1, 6, 5, 0), ("b", 0, 1, 0, 0), ("c", 0, 3, 0, 0), ("d", 0, 2, 0, 1),
    ]
    assert sorted((r["time"], r["action"]) for r in got if r["kind"] == "late" and r["t"] is None) == [(minute(8), 9), (minute(9), 9)]
    ended = sorted((r["session"], r["t"], r["time"], r["action"], r["prev_action"], r["prev_reward"], r["dones"]) for r in got if r["kind"] == "end")
    assert ended == [("a", 2, minute(71), None, 6, 2.0, 1), ("b", 1, minute(60), None, 1, 0.5, 1)]


def history(spark, series):
    rows = [(run, i, 1000 + i, float(v)) for run, vs in series.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "runid string, step bigint, timestamp bigint, value double")


def test_stability(spark):
    wave = [1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 2, 1, 3]
    series = {
        "flat": [5.0] * 16, "rising": [float(i) for i in range(16)], "falling": [float(-i) for i in range(16)],
        "short": [1.0, 2.0, 3.0], "wild": wave[:-1] + [50],
    }
    got = {r["runid"]: r["is_stable"] for r in U.stable_runs(history(spark, series), tolerance=0).collect()}
    assert got == {"flat": 0, "rising": 1, "falling": 0, "short": 0, "wild": 0}


def test_best_runs_and_series(spark):
    hist = history(spark, {"a": range(20), "b": range(1, 21), "c": range(2, 22), "z": range(20, 0, -1)})
    params = spark.createDataFrame([(r, f"run-{r}", {"lr": "1", "host": "h"}) for r in "abcz"], "runid string, run_name string, params map<string,string>")
    best = U.best_runs(hist, params, topn=2)
    assert [(r["runid"], r["rank"], r["params"]) for r in best.orderBy("rank").collect()] == [("c", 1, {"lr": "1"}), ("b", 2, {"lr": "1"})]
    series = U.run_series(hist, best, size=8)
    assert series.count() == 40 and series.filter("t >= 5 and diff_pct > 1e-9").count() == 0
    assert series.filter("diff_pct is null").count() == 10


def test_nightly_jobs(spark, tmp_path):
    root = str(tmp_path)
    features = spark.sql("""
        select id % 3 + 1 as enterprise_id, date_add(date'2024-01-01', cast(id % 5 as int)) as date,
               timestampadd(HOUR, cast(id as int), timestamp'2024-01-01') as date_time, 'session_event' as feature_type,
               'behavior' as category, concat('f', id % 4) as feature_name, cast(id % 2 as string) as feature_value from range(60)""")
    id_map = spark.sql("select id + 1 as enterprise_id, 'cagm' as id_type, concat('m', id + 1) as alternative_id from range(2)")
    clients = spark.sql("select 3L as enterprise_id")
    nightly.state_job(spark, features, id_map, clients, root, "2024-01-31", max_len=7)
    first = {r["token_name"]: r["token"] for r in spark.read.parquet(f"{root}/tokens").collect()}
    assert sorted(first.values()) == [1, 2, 3, 4]
    more = features.withColumn("feature_name", F.concat(F.lit("a"), "feature_name"))
    nightly.state_job(spark, features.unionByName(more), id_map, clients, root, "2024-01-31", max_len=7)
    second = {r["token_name"]: r["token"] for r in spark.read.parquet(f"{root}/tokens").collect()}
    assert first.items() <= second.items() and sorted(second.values()) == list(range(1, 9))
    state = spark.read.parquet(f"{root}/state")
    assert state.filter(F.size("state_tokenized") > 7).count() == 0 and state.filter("current_record = 1").count() == 3
    assert spark.read.parquet(f"{root}/state_members").count() == 2 and spark.read.parquet(f"{root}/state_clients").count() == 1

    calls = spark.sql("""select concat('g', id) as call_guid, concat('m', id % 2 + 1) as cagm, timestampadd(DAY, cast(id as int), timestamp'2024-01-01')
        as start_dtm, 'RX' as logical_app_name, 'member' as caller_type from range(6)""")
    nightly.reward_job(spark, calls, id_map, root, "2023-01-01")
    assert spark.read.parquet(f"{root}/rewards").agg(F.sum("reward_value")).first()[0] == -12
    flags = calls.select("call_guid", F.lit(1).alias("x_alert"), F.lit(1).alias("x_yes"))
    nightly.disposition_job(spark, flags, calls, id_map, root, {"x": {"offered": "x_alert", "accepted": "x_yes"}})
    assert spark.read.parquet(f"{root}/dispositions").count() == 6

    for i in range(4):
        log_file(tmp_path / "log", f"s{i}", f"2024-01-0{i + 1} 100000", text='{"app":"ivr","enterprise_id":"%d","time":"2024-01-0%d 10:00:00","actions":[%d]}' % (i % 2 + 1, i + 1, i))
    nightly.log_job(spark, str(tmp_path / "log"), root, date(2024, 1, 4))
    nightly.episode_job(spark, root, lambda c: F.array(F.size(c).cast("double")), min_len=2)
    episodes = spark.read.parquet(f"{root}/episodes")
    ends = episodes.groupBy("eps_id").agg(F.sum("dones").alias("d"), F.max("t").alias("t"), F.count(F.lit(1)).alias("n")).collect()
    assert {r["eps_id"] for r in ends} == {0, 1} and all(r["d"] == 1 and r["n"] == r["t"] + 1 for r in ends)
    assert episodes.filter("dones = 1 and new_obs <> obs").count() == 0
