"""Block-wise ordered work equals the plain window, also when one key holds most rows."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from offerloom.operators import blocks as B
from offerloom.operators import episodes as E


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 holds two thirds of the rows."""
    return (
        spark.range(3000)
        .select(
            F.when(F.col("id") % 3 < 2, 0).otherwise(F.col("id") % 17).alias("k"),
            F.timestamp_seconds(1_700_000_000 + (F.col("id") * 7919) % 900_000).alias("time"),
            "id", ((F.col("id") * 31) % 11).alias("v"),
        )
        .withColumn("maybe", F.when(F.col("v") < 3, F.col("v")))
        .repartition(7)
        .cache()
    )


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_running_sums(skewed):
    order = [F.col("time"), F.col("id")]
    got = B.running_sums(skewed, ["k"], B.hour_block("time"), order, {"s": F.col("v"), "n": F.lit(1)})
    w = Window.partitionBy("k").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.withColumns({"s": F.sum("v").over(w), "n": F.count(F.lit(1)).over(w)})
    assert rows(got.select("k", "id", "s", "n")) == rows(want.select("k", "id", "s", "n"))


@pytest.fixture(scope="module")
def stepped(skewed):
    return E.with_steps(skewed, "k", "time", "id").cache()


@pytest.mark.parametrize("size", [7, 64, 1 << 20])
def test_next_previous_done_in_small_blocks(stepped, size):
    w = Window.partitionBy("k").orderBy("t")
    known = F.last("maybe", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    want = stepped.select(
        "k", "t", F.coalesce(F.lead("maybe").over(w), known).alias("new_maybe"), F.coalesce(F.lead("v").over(w), "v").alias("new_v"),
        F.when(F.lead("t").over(w).isNull(), 1).otherwise(0).alias("dones"),
    )
    got = E.with_next(stepped, "k", ["maybe", "v"], size=size).select("k", "t", "new_maybe", "new_v", "dones")
    assert rows(got) == rows(want)
    assert rows(E.with_dones(stepped, "k", size=size).select("k", "t", "dones")) == rows(want.select("k", "t", "dones"))
    prev = E.with_previous(stepped, "k", ["v"], size=size).select("k", "t", "prev_v")
    assert rows(prev) == rows(stepped.select("k", "t", F.lag("v", 1, 0).over(w)))


def test_steps_by_range_equal_steps_by_hour(spark, skewed, stepped):
    same_time = skewed.withColumn("time", F.date_trunc("day", "time"))
    assert rows(E.with_steps(skewed, "k", "time", "id", by_range=True).select("id", "t")) == rows(stepped.select("id", "t"))
    by_hour, by_range = (E.with_steps(same_time, "k", "time", "id", by_range=r).select("id", "t") for r in (False, True))
    assert rows(by_hour) == rows(by_range)


def test_transitions_equal_steps_and_next(skewed, stepped):
    want = E.with_next(stepped, "k", ["maybe", "v"])
    got = E.with_transitions(skewed, "k", "time", ["id"], ["maybe", "v"])
    cols = ["k", "id", "t", "new_maybe", "new_v", "dones"]
    assert rows(got.select(*cols)) == rows(want.select(*cols))


@pytest.mark.parametrize("size", [8, 50])
def test_n_step_return_in_small_blocks(stepped, size):
    n, g = 6, 0.5
    df = stepped.withColumns({"rewards": F.col("v").cast("double"), "obs": F.col("id")})
    w = Window.partitionBy("k").orderBy("t")
    total = sum((F.coalesce(F.lead("rewards", i).over(w), F.lit(0.0)) * g**i for i in range(1, n)), F.col("rewards"))
    want = df.select("k", "t", F.round(total, 6), F.lead("obs", n).over(w), F.when(F.lead("t", n).over(w).isNull(), 1).otherwise(0))
    got = E.n_step_return(df, "k", n, g, size=size).select("k", "t", F.round("n_return", 6), "n_obs", "n_done")
    assert rows(got) == rows(want)


def test_long_reach_takes_larger_blocks(stepped):
    df = stepped.withColumns({"rewards": F.col("v").cast("double"), "obs": F.col("id")})
    same = lambda size: rows(E.n_step_return(df, "k", 20, 0.5, size=size).select("k", "t", F.round("n_return", 6), "n_obs", "n_done"))
    assert same(8) == same(1 << 20)


@pytest.mark.parametrize("k", [1, 2, 50, 1 << 22])
def test_episodes_of_any_least_length(stepped, k):
    n = stepped.groupBy("k").count().filter(F.col("count") >= k)
    assert rows(E.min_episode_length(stepped, "k", k).select("k", "t")) == rows(stepped.join(n, "k").select("k", "t"))


@pytest.mark.parametrize("parts", [1, 3, 11])
def test_dense_index_equals_global_row_number(skewed, parts):
    got = B.dense_index(skewed.select("id"), "id", "n", start=5, parts=parts)
    assert {r["id"]: r["n"] for r in got.collect()} == {i: i + 6 for i in range(3000)}


@pytest.mark.parametrize("parts", [1, 5])
def test_range_prefix(skewed, parts):
    got = B.range_prefix(skewed.select("k", "id", "v"), ["k"], ["id"], F.col("v"), "cum", parts=parts)
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    assert rows(got) == rows(skewed.select("k", "id", "v", F.sum("v").over(w)))


def test_exact_median(skewed):
    df = skewed.withColumn("x", F.when(F.col("id") % 5 > 0, (F.col("id") * 37 % 101).cast("double")))
    want = df.where("x is not null").toPandas().groupby("k")["x"].median()
    got = {r["k"]: r["m"] for r in B.exact_median(df, "k", "x", "m").collect()}
    assert got == {k: v for k, v in want.items()}
    assert np.isfinite(list(got.values())).all()


@pytest.fixture(scope="module")
def one_hour(spark):
    """Key 0 has 2,000 rows in one hour; some rows have no key or no time."""
    key = F.when(F.col("id") % 50 == 7, None).when(F.col("id") < 2000, 0).otherwise(F.col("id") % 5)
    time = F.when(F.col("id") % 50 == 9, None).when(F.col("id") < 2000, F.timestamp_seconds(1_700_000_000 + F.col("id") % 60)).otherwise(
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 400)
    )
    df = spark.range(2600).select("id", key.alias("k"), time.alias("time"), ((F.col("id") * 31) % 11).alias("v"))
    return df.withColumn("maybe", F.when(F.col("v") < 3, F.col("v"))).repartition(5).cache()


@pytest.mark.parametrize("most", [100, 1 << 20])
def test_scan_equals_window_and_sets_rows_aside(one_hour, most):
    got = B.segmented_scan(
        one_hour, ["k"], "time", ["id"], sums={"s": F.col("v"), "n": F.lit(1)}, lasts={"known": "maybe"}, nexts={"ahead": "maybe"}, end="last", most=most
    )
    w = Window.partitionBy("k").orderBy("time", "id")
    so_far = w.rowsBetween(Window.unboundedPreceding, 0)
    good = one_hour.filter("k IS NOT NULL AND time IS NOT NULL")
    want = good.withColumns({
        "s": F.sum("v").over(so_far), "n": F.count(F.lit(1)).over(so_far), "known": F.last("maybe", ignorenulls=True).over(so_far),
        "ahead": F.lead("maybe").over(w), "last": F.when(F.lead("id").over(w).isNull(), 1).otherwise(0),
    })
    cols = ["id", "s", "n", "known", "ahead", "last"]
    aside = got.filter("k IS NULL OR time IS NULL")
    assert rows(got.filter("k IS NOT NULL AND time IS NOT NULL").select(*cols)) == rows(want.select(*cols))
    assert aside.count() == one_hour.count() - good.count() > 0
    assert aside.filter("s IS NOT NULL OR n IS NOT NULL OR known IS NOT NULL OR ahead IS NOT NULL OR last IS NOT NULL").count() == 0


def test_one_hour_is_spread_over_all_tasks(one_hour):
    cut = B.order_blocks(one_hour, ["k"], "time", ["id"], most=100)
    sizes = [r["count"] for r in cut.filter("k = 0 AND _hour IS NOT NULL").groupBy("_hour", "_part").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 400 and sum(sizes) == cut.filter("k = 0 AND time IS NOT NULL").count()
    loose = cut.filter("_hour IS NULL").select("_part").distinct().count()
    assert loose > 50  # rows without a place are not one block


def test_operators_on_one_hour_equal_their_plain_form(one_hour):
    """Every operator that is cut by hours, with hours cut further and without."""
    from offerloom.operators import evaluation as V
    from offerloom.operators import rewards as W
    from offerloom.operators import state as S

    for by in (
        lambda most: E.with_steps(one_hour, "k", "time", "id", most=most),
        lambda most: E.with_transitions(one_hour, "k", "time", ["id"], ["maybe", "v"], most=most),
        lambda most: V.weighted_steps(one_hour.withColumns({"p_t": F.col("v") / 11, "p_b": F.lit(0.5)}), "k", "time", "id", most=most).selectExpr("id", "t", "round(ln(w), 6)", "round(ln(w_prev), 6)"),
        lambda most: W.future_events(one_hour, one_hour.filter("v < 5"), "k", "id", "time", 1, most=most),
        lambda most: S.daily_state(
            one_hour.selectExpr("k AS enterprise_id", "to_date(time) AS date", "time AS date_time", "cast(v AS string) AS token_name", "id AS token"), 300, most=most
        ),
    ):
        small, large = by(100), by(1 << 20)
        assert rows(small) == rows(large) and small.columns == large.columns
    kept = E.with_transitions(one_hour, "k", "time", ["id"], ["v"])
    assert kept.count() == one_hour.count() and kept.filter("t IS NULL").count() == one_hour.filter("k IS NULL OR time IS NULL").count()
    assert rows(E.with_steps(one_hour, "k", "time", "id", by_range=True).select("id", "t")) == rows(E.with_steps(one_hour, "k", "time", "id").select("id", "t"))


def test_state_is_limited_before_the_shuffle(one_hour):
    """A day and all sessions of an entity: the plan keeps what a state can hold in each task, below the exchange."""
    from offerloom.operators import state as S

    tokens = one_hour.selectExpr("k AS enterprise_id", "to_date(time) AS date", "time AS date_time", "cast(v AS string) AS token_name", "id AS token")
    sessions = one_hour.selectExpr("k AS enterprise_id", "to_date(time) AS date", "time AS date_time", "array(cast(v AS string)) AS events", "array(id) AS event_tokens")
    for df in (S.bounded_days(tokens, 100), S.session_state(sessions, 100)):
        df.collect()
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        physical = df._jdf.queryExecution().sparkPlan().toString()
        assert "WindowGroupLimit" in plan and physical.count("WindowGroupLimit") >= 2 and "Partial" in physical
