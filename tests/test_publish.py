"""Days published in one step: failures between the steps lose nothing, and each job runs once."""

import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from offerloom.sources import decision_log as L
from offerloom.sources import publish as P
from offerloom.sources import tables as T
from offerloom.streaming import streams as Z


def log_file(folder, session, day, n, broken=0):
    lines = [json.dumps({"app": "ivr", "time": f"{day} 10:00:{i:02}", "eps_id": f"{session}-{i}"}) for i in range(n)]
    (folder / f"{session}_{day} 100000.json").write_text("\n".join([*lines, *["{broken"] * broken]) + "\n")


def stored(spark, *paths):
    return [
        sorted((str(r["partition_field"]), r["count"]) for r in spark.read.parquet(str(p)).groupBy("partition_field").count().collect())
        if T.partition_days(spark, str(p), "partition_field") else [] for p in paths
    ]


@pytest.fixture
def log(tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    log_file(src, "a", "2024-01-01", 3, broken=1)
    log_file(src, "b", "2024-01-02", 2, broken=2)
    return src, str(tmp_path / "log"), str(tmp_path / "bad")


def test_failure_before_the_decision_changes_nothing(spark, log, monkeypatch):
    src, dst, bad = log
    with monkeypatch.context() as m:
        m.setattr(P.Publication, "decide", lambda self: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            L.ingest_new_dates(spark, str(src), dst, bad)
    assert stored(spark, dst, bad) == [[], []]
    assert L.ingest_new_dates(spark, str(src), dst, bad) == [date(2024, 1, 1), date(2024, 1, 2)]
    assert stored(spark, dst, bad) == [[("2024-01-01", 3), ("2024-01-02", 2)], [("2024-01-01", 1), ("2024-01-02", 2)]]
    assert not [n for n in P._children(spark, dst) if n.startswith("_publish")]


@pytest.mark.parametrize("moves", [0, 1, 2, 3])
def test_failure_between_moves_is_finished(spark, log, monkeypatch, moves):
    src, dst, bad = log
    done, move = [], P._move

    def failing(*args):
        if len(done) == moves:
            raise OSError("lost")
        done.append(args)
        move(*args)

    with monkeypatch.context() as m:
        m.setattr(P, "_move", failing)
        with pytest.raises(OSError):
            L.ingest_new_dates(spark, str(src), dst, bad)
    # The days were decided, so the next run finds them loaded, good and bad records alike.
    assert L.ingest_new_dates(spark, str(src), dst, bad) == []
    assert stored(spark, dst, bad) == [[("2024-01-01", 3), ("2024-01-02", 2)], [("2024-01-01", 1), ("2024-01-02", 2)]]


def test_old_days_stay_until_new_ones_are_whole(spark, tmp_path):
    path = str(tmp_path / "fact")
    row = lambda day, n: spark.range(n).withColumn("date", F.lit(day).cast("date"))
    T.replace_days(row("2024-01-01", 4).union(row("2024-01-02", 2)), path)
    failing = row("2024-01-01", 5).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        T.replace_days(failing, path, days=[date(2024, 1, 1), date(2024, 1, 2)])
    assert spark.read.parquet(path).count() == 6
    T.replace_days(row("2024-01-01", 5), path, days=[date(2024, 1, 1), date(2024, 1, 2)])
    assert {(str(r["date"]), r["count"]) for r in spark.read.parquet(path).groupBy("date").count().collect()} == {("2024-01-01", 5)}


def test_the_job_runs_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(10).mapInArrow(count, "id long").withColumn("date", F.lit("2024-01-01").cast("date"))
    T.replace_days(df, str(tmp_path / "once"), days=[date(2024, 1, 1)])
    assert seen.value == 10


def test_stream_keeps_the_table_of_the_nightly_jobs(spark, log, tmp_path):
    src, dst, bad = log
    run = lambda: Z.ingest_stream(spark, str(src), dst, bad, str(tmp_path / "checkpoint")).awaitTermination()
    run()
    assert stored(spark, dst, bad) == [[("2024-01-01", 3), ("2024-01-02", 2)], [("2024-01-01", 1), ("2024-01-02", 2)]]
    log_file(src, "late", "2024-01-01", 4)
    (src / "undated.json").write_text('{"app": "ivr"}\n')
    run()
    assert stored(spark, dst, bad) == [[("2024-01-01", 7), ("2024-01-02", 2)], [("2024-01-01", 1), ("2024-01-02", 2)]]
    assert spark.read.parquet(f"{bad}_undated").count() == 1
    assert L.ingest_new_dates(spark, str(src), dst, bad) == []
    assert L.reingest_recent(spark, str(src), dst, date(2024, 1, 2), errors=bad) and stored(spark, dst)[0][0] == ("2024-01-01", 7)


def test_stream_closes_its_own_groups(spark, tmp_path):
    """Two runs over one checkpoint: the first closes what it has seen, and an empty one emits nothing."""
    rows = [("a", 1, "2024-01-01 10:00:00"), ("a", 2, "2024-01-01 23:00:00"), ("b", 1, "2024-01-02 10:10:00"), ("a", 1, "2024-01-02 10:20:00")]
    schema = "app string, enterprise_id long, time timestamp"
    src = str(tmp_path / "events")

    def put(part):
        spark.createDataFrame(part, "app string, enterprise_id long, time string").selectExpr("app", "enterprise_id", "cast(time AS timestamp) AS time").write.mode("append").parquet(src)

    def run(name, group, reach):
        out = str(tmp_path / name)
        Z.run_and_close(spark.readStream.schema(schema).parquet(src), group, f"{out}/data", f"{out}/checkpoint", f"{out}/markers", reach=reach)
        return sorted(map(tuple, spark.read.schema("app string, date date, volume long" if name == "volume" else "enterprise_id long, start timestamp, end timestamp, events long").parquet(f"{out}/data").collect()))

    put([])
    assert run("volume", lambda df: Z.volume_stream(df, None), "1 day") == []
    put(rows)
    day = lambda d: date(2024, 1, d)
    assert run("volume", lambda df: Z.volume_stream(df, None), "1 day") == [("a", day(1), 2), ("a", day(2), 1), ("b", day(2), 1)]
    got = run("sessions", lambda df: Z.sessionize_stream(df, "30 minutes", None), "30 minutes")
    assert [(e, n) for e, _, _, n in got] == [(1, 1), (1, 2), (2, 1)]
    put([("b", 3, "2024-01-09 00:00:00")])
    assert run("volume", lambda df: Z.volume_stream(df, None), "1 day")[-1] == ("b", day(9), 1)
