"""Vocabulary and token state."""

import itertools

import pytest
from pyspark.sql import functions as F

from offerloom.operators import state as S
from offerloom.operators.vocabulary import build_vocabulary, max_token, token_name, vocab_size

TOKENS = "enterprise_id bigint, date date, date_time timestamp, token_name string, token int"


def token_df(spark, counts):
    """``counts``: entity -> tokens per day."""
    rows, n = [], itertools.count()
    for entity, days in counts.items():
        for d, size in enumerate(days, 1):
            for i in range(size):
                t = next(n)
                rows.append((entity, f"2024-01-{d:02d}", f"2024-01-{d:02d} {i % 24:02d}:{i // 24:02d}:00", f"f___{t % 7}", t % 7 + 1))
    df = spark.createDataFrame(rows, "enterprise_id bigint, date string, date_time string, token_name string, token int")
    return df.withColumns({"date": F.col("date").cast("date"), "date_time": F.col("date_time").cast("timestamp")})


def brute(df, n, keep):
    """Collect, flatten, cut: per entity and day."""
    pdf = df.toPandas().sort_values(["enterprise_id", "date_time", "token_name"])
    out = {}
    for e, g in pdf.groupby("enterprise_id"):
        for d in sorted(g["date"].unique()):
            seq = g[g["date"] <= d]["token"].tolist()
            out[(e, d)] = seq[-n:] if keep == "last" else seq[:n]
    return out


@pytest.mark.parametrize("keep", ["first", "last"])
@pytest.mark.parametrize("parts", [1, 9])
def test_history_against_brute_force(spark, keep, parts):
    n = 10
    df = token_df(spark, {1: [9], 2: [10], 3: [11], 4: [3, 1, 40, 2, 5], 5: [200, 1]}).repartition(parts)
    got = S.state_history(df, n, keep)
    want = brute(df, n, keep)
    assert {(r["enterprise_id"], r["date"]): r["state_tokenized"] for r in got.collect()} == want
    sizes = {r["enterprise_id"]: (len(r["state"]), r["size"], r["cum_size"]) for r in got.filter("date = '2024-01-01'").collect()}
    assert sizes[1] == (9, 9, 9) and sizes[2] == (10, 10, 10) and sizes[3] == (10, 11, 11)


def test_first_states_are_prefixes(spark):
    df = token_df(spark, {1: [3, 4, 5, 6]})
    states = [r["state_tokenized"] for r in S.state_history(df, 12, "first").orderBy("date").collect()]
    assert all(b[:len(a)] == a for a, b in itertools.pairwise(states))


def test_unknown_keep(spark):
    with pytest.raises(ValueError):
        S.state_history(token_df(spark, {1: [1]}), 5, "middle")


def test_daily_state_continues_long_days(spark):
    df = token_df(spark, {1: [25], 2: [4]})
    rows = S.daily_state(df, part_len=10).orderBy("enterprise_id", "part").collect()
    assert [(r["enterprise_id"], r["part"], r["size"]) for r in rows] == [(1, 0, 10), (1, 1, 10), (1, 2, 5), (2, 0, 4)]
    whole = [t for r in rows if r["enterprise_id"] == 1 for t in r["state_tokenized"]]
    assert whole == brute(df, 1000, "last")[(1, rows[0]["date"])]


def test_one_current_record_per_entity(spark):
    flagged = S.flag_current(S.state_history(token_df(spark, {1: [1, 2], 2: [3]}), 5))
    assert flagged.groupBy("enterprise_id").agg(F.sum("current_record").alias("n")).filter("n <> 1").count() == 0


def test_session_state(spark):
    rows = [(1, f"2024-01-{i // 5 + 1:02d} {i % 5:02d}:00:00", [f"a{i}", f"b{i}"], [i, i + 100]) for i in range(30)]
    rows += [(2, "2024-01-01 00:00:00", [], []), (2, "2024-01-02 00:00:00", ["x"], [7])]
    df = spark.createDataFrame(rows, "enterprise_id bigint, t string, events array<string>, event_tokens array<int>").select(
        "enterprise_id", F.col("t").cast("timestamp").alias("date_time"), F.to_date("t").alias("date"), "events", "event_tokens"
    )
    got = {r["enterprise_id"]: r for r in S.session_state(df, 11).collect()}
    flat = [x for i in range(30) for x in (i, i + 100)]
    assert got[1]["state_tokenized"] == flat[-11:] and got[1]["orig_size"] == 60
    assert got[2]["state"] == ["x"] and got[2]["orig_size"] == 1


def test_state_joins(spark):
    state = S.flag_current(S.state_history(token_df(spark, {1: [1, 0, 2]}), 5))
    asked = spark.createDataFrame([(1,), (9,)], "enterprise_id bigint")
    got = {r["enterprise_id"]: r["state_tokenized"] for r in S.attach_current_state(asked, state).collect()}
    assert len(got[1]) == 3 and got[9] == [0]
    days = spark.createDataFrame([(1, "2023-12-31"), (1, "2024-01-02"), (1, "2024-01-09")], "enterprise_id bigint, d string").select(
        "enterprise_id", F.col("d").cast("date").alias("date")
    )
    asof = [r["state_tokenized"] for r in S.attach_state_asof(days, state).orderBy("date").collect()]
    assert asof[0] is None and len(asof[1]) == 1 and len(asof[2]) == 3
    assert S.attach_state(days, state).count() == 0


def test_lookup_has_one_row_per_id(spark):
    state = S.flag_current(S.state_history(token_df(spark, {1: [1, 2], 2: [3], 3: [1]}), 5))
    ids = spark.createDataFrame([(2, "cagm", "m"), (1, "cagm", "m"), (1, "cagm", "m"), (3, "other", "x")],
                                "enterprise_id bigint, id_type string, alternative_id string")
    rows = S.state_lookup(state, ids).collect()
    assert [(r["raw_id"], r["enterprise_id"], len(r["state_tokenized"])) for r in rows] == [("m", 1, 3)]


def names(spark, *words):
    return spark.createDataFrame([(w,) for w in words], "token_name string")


def ids(df):
    return {r["token_name"]: r["token"] for r in df.collect()}


def test_vocabulary_extension_keeps_ids(spark):
    old = build_vocabulary(names(spark, "b", "c", "b"))
    assert ids(old) == {"b": 1, "c": 2}
    assert ids(build_vocabulary(names(spark, "a", "c"), existing=old)) == {"b": 1, "c": 2, "a": 3}


def test_empty_dictionary_starts_at_one(spark):
    empty = spark.createDataFrame([], "token_name string, token int")
    assert max_token(empty) == 0 and vocab_size(empty).first()[0] == 1
    assert ids(build_vocabulary(names(spark, "z", "y"), existing=empty)) == {"y": 1, "z": 2}


def test_null_value_leaves_the_name(spark):
    df = spark.createDataFrame([("f", None), ("f", "1")], "feature_name string, feature_value string")
    assert {r[0] for r in df.select(token_name()).collect()} == {"f", "f___1"}


def test_demographics_alone_are_limited_by_date(spark):
    df = spark.createDataFrame(
        [("session_event", "x", "2001-01-01"), ("other", "demographics", "2001-01-01"), ("other", "demographics", "2024-01-01")],
        "feature_type string, category string, d string",
    ).withColumn("date", F.col("d").cast("date"))
    assert {(r["feature_type"], r["d"]) for r in S.select_features(df, "2024-01-31").collect()} == {
        ("session_event", "2001-01-01"), ("other", "2024-01-01"),
    }


def test_newest_state_is_the_flagged_row_of_the_history(spark):
    rows = [(e, d, None if i == 2 else f"{d} 00:00:{i % 4:02d}", f"t{i % 5}", i % 5) for e in (1, 2) for d in ("2024-01-01", "2024-01-02", "2024-01-05")
            for i in range(e * 3)]
    rows += [rows[0], (None, "2024-01-01", "2024-01-01 00:00:00", "a", 1), (1, None, None, "b", 2), (3, "2024-01-03", None, "c", None)]
    df = spark.createDataFrame(rows, "enterprise_id int, date string, date_time string, token_name string, token int").withColumn("date", F.to_date("date"))
    cols = ["enterprise_id", "date", "state", "state_tokenized", "current_record"]
    for most in (1, 2, 4, 7, 100):
        want = S.flag_current(S.state_history(df, most)).filter("current_record = 1").select(*cols).collect()
        newest = S.newest_state(df, most)
        assert sorted(map(str, newest.select(*cols).collect())) == sorted(map(str, want)) and len(want) == 3
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(enterprise_id") == 1
