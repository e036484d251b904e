"""Bus payloads, stored sketches, packed moments and bounded decoding on small tables with planted cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.operators import embedding as M
from offerloom.operators import evaluation as V
from offerloom.operators import sketches as H
from offerloom.queries.streams import BUS, size_scores
from offerloom.session import scratch_path
from offerloom.sources import adapters as A
from offerloom.streaming import streams as Z


def bus_folder(spark, batches):
    out = scratch_path(spark, "bus")
    for i, rows in enumerate(batches):
        full = [(k, v, "t", 0, i * 100 + j, t, h) for j, (k, v, t, h) in enumerate(rows)]
        df = spark.createDataFrame([], BUS) if not full else spark.createDataFrame(full, BUS.replace("timestamp timestamp", "timestamp string"))
        df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).coalesce(1).write.mode("append").parquet(out)
    return out


def received(spark, path, **options):
    out = scratch_path(spark, "bus-out")
    rows = Z.bus_messages(Z.event_stream(spark, path, BUS, **options))
    Z.write_stream(rows, f"{out}/data", f"{out}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{out}/data")


def head(id):
    return [("other", b"x"), ("message-id", id)]


def test_bus_gives_each_message_once(spark):
    at = "2024-01-01 00:00:0"
    first = [(b"u1", b"one", at + "1", head(b"a")), (b"u1", b"one", at + "2", head(b"a")), (None, b"two", at + "3", None), (b"u2", None, at + "4", [])]
    second = [(b"u1", b"one", at + "5", head(b"a")), (b"u3", b"ok \xff", at + "6", head(b"b")), (None, b"two", at + "7", [("message-id", None)])]
    got = received(spark, bus_folder(spark, [first, second]), maxFilesPerTrigger=1).orderBy("time").collect()
    # Without an id the place in the topic counts, so equal payloads stay messages of their own.
    assert [r["message"] for r in got] == ["one", "two", None, "ok \ufffd", "two"]
    assert [r["key"] for r in got] == ["u1", None, "u2", "u3", None] and got[1]["message_id"] == "t:0:2"
    assert received(spark, bus_folder(spark, [[]])).count() == 0


def test_bus_messages_are_decided(spark, base):
    asked = A.requests(spark, base).limit(20).collect()
    rows = [(str(r["event_id"]).encode(), r["message"].encode(), str(r["time"]), head(str(r["event_id"]).encode())) for r in asked] * 2
    out = scratch_path(spark, "bus-decided")
    messages = Z.bus_messages(Z.event_stream(spark, bus_folder(spark, [rows]), BUS)).withColumn("event_id", F.col("key").cast("bigint"))
    state = spark.createDataFrame([], "raw_id string, enterprise_id bigint, state_tokenized array<int>, state array<string>")
    Z.decide_stream(messages.select("event_id", "time", "message"), state, size_scores, f"{out}/d", f"{out}/e", f"{out}/c").awaitTermination()
    assert sorted(r["event_id"] for r in spark.read.parquet(f"{out}/d").select("event_id").collect()) == sorted(r["event_id"] for r in asked)


def test_sketches_merge_to_any_range(spark):
    days = spark.range(30_000).select(
        F.pmod("id", F.lit(2)).alias("g"), F.pmod("id", F.lit(30)).alias("day"), F.pmod("id", F.lit(7001)).alias("member"), F.col("id").cast("double").alias("value")
    )
    daily = H.daily_sketches(days, ["g"], "day", "member", "value")
    whole = H.estimates(H.merge_sketches(daily, []), {"median": 0.5, "p90": 0.9}).first()
    assert whole["n"] == 30_000 and abs(whole["members"] - 7001) <= 4 * 1.04 / 64 * 7001
    assert abs(whole["median"] - 15_000) <= 0.04 * 30_000 and abs(whole["p90"] - 27_000) <= 0.04 * 30_000
    some = H.merge_sketches(daily.filter("day < 10"), ["g"])
    again = H.estimates(H.merge_sketches(some, []), {}).first()
    assert again["n"] == 10_000 and abs(again["members"] - days.filter("day < 10").select("member").distinct().count()) <= 4 * 1.04 / 64 * 7001


def test_sketches_of_nulls_and_of_nothing(spark):
    df = spark.createDataFrame([("a", 1, None, None), ("b", 1, "x", float("nan")), ("b", 2, "x", 3.0)], "g string, day int, member string, value double")
    got = {r["g"]: r for r in H.estimates(H.merge_sketches(H.daily_sketches(df, ["g"], "day", "member", "value"), ["g"]), {"m": 0.5}).collect()}
    assert (got["a"]["n"], got["a"]["members"], got["a"]["m"]) == (1, 0, None) and (got["b"]["n"], got["b"]["members"], got["b"]["m"]) == (2, 1, 3.0)
    assert H.merge_sketches(H.daily_sketches(df.limit(0), ["g"], "day", "member", "value"), ["g"]).count() == 0


def q_rows(spark, n, actions, dim):
    rng = np.random.default_rng(4)
    rows = [(rng.normal(size=dim).tolist(), int(rng.integers(actions)), float(rng.normal()), rng.normal(size=dim).tolist(), int(i % 3 == 0), [1] * actions) for i in range(n)]
    return spark.createDataFrame(rows, "obs array<double>, action int, n_return double, n_obs array<double>, n_done int, n_mask array<int>")


def test_blocks_of_moments_change_nothing(spark, monkeypatch):
    df = q_rows(spark, 120, 3, 4)
    want = V.fitted_q(df, 3, 4, 2)[0]
    monkeypatch.setattr(V, "MOMENT_BLOCK", 4)
    monkeypatch.setattr(V, "MOMENT_TASKS", 2)
    assert np.allclose(V.fitted_q(df.repartition(5), 3, 4, 2)[0], want)


def test_fitted_q_of_the_second_configuration(spark):
    """288 actions and 100 numbers observed."""
    weights, errors = V.fitted_q(q_rows(spark, 600, 288, 100), 288, 100, iters=2, track_error=True)
    assert np.shape(weights) == (288, 101) and np.isfinite(weights).all() and np.isfinite(errors).all() and np.any(weights)


@pytest.mark.parametrize("k", [3, 60])
def test_short_vectors_are_not_compared(spark, monkeypatch, k):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(400, 4)) * (1 / np.arange(1, 401))[:, None]  # lengths fall fast
    x[7] = x[8] = x[3]  # ties
    q = np.vstack([rng.normal(size=(30, 4)), np.zeros((1, 4))])
    vectors = spark.createDataFrame([(f"t{i:03d}", v.tolist()) for i, v in enumerate(x)], "token_name string, vector array<double>")
    states = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(q)], "id bigint, vector array<double>")
    compared, real = [], M._best_of_slices
    monkeypatch.setattr(M, "_best_of_slices", lambda asked, *rest: (compared.append(asked.count()), real(asked, *rest))[1])
    got = {r["id"]: r["tokens"] for r in M.decode_tokens(states, vectors, k, "id", slice_bytes=640).collect()}
    for i, v in enumerate(q):
        order = sorted(range(400), key=lambda j: (-float(x[j] @ v), j))[:k]
        assert np.allclose([float(x[int(t[1:])] @ v) for t in got[i]], [float(x[j] @ v) for j in order])
    if k == 3:
        assert got[30] == ["t000", "t001", "t002"] and len(compared) == 2
        assert sum(compared) < 0.5 * len(q) * 400 * 32 / 640


def test_vectors_of_one_length_and_empty_tables(spark):
    vectors = spark.createDataFrame([(f"t{i}", [1.0, 0.0]) for i in range(50)], "token_name string, vector array<double>")
    states = spark.createDataFrame([(1, [2.0, 0.0])], "id bigint, vector array<double>")
    assert M.decode_tokens(states, vectors, 2, "id", slice_bytes=64).first()["tokens"] == ["t0", "t1"]
    assert M.decode_tokens(states.limit(0), vectors, 2, "id", slice_bytes=64).count() == 0
    assert M.decode_tokens(states, vectors.limit(0), 2, "id").count() == 0
