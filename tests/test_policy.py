"""Array functions, legality, sampling, evaluation, embedding."""

import dataclasses
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom import functions as X
from offerloom.operators import embedding as M
from offerloom.operators import episodes as E
from offerloom.operators import evaluation as V
from offerloom.operators import policy as P
from offerloom.operators import sampling as N


def one(spark, expr, **cols):
    return spark.range(1).withColumns({k: F.lit(v) if not isinstance(v, list) else F.lit(v) for k, v in cols.items()}).select(expr).first()[0]


@pytest.mark.parametrize("n, want", [(0, []), (1, [3]), (2, [2, 3]), (3, [1, 2, 3]), (4, [1, 2, 3])])
def test_tail(spark, n, want):
    df = spark.sql("select array(1, 2, 3) as a")
    assert df.select(X.tail("a", n) if n else F.slice("a", 1, 0)).first()[0] == want


def test_pad(spark):
    df = spark.sql("select array(1, 2) as a")
    row = df.select(X.pad("a", 4), X.pad("a", 4, 9, "left"), X.pad("a", 1), X.pad_mask(X.pad("a", 3))).first()
    assert list(row) == [[1, 2, 0, 0], [9, 9, 1, 2], [1, 2], [1, 1, 0]]
    with pytest.raises(ValueError):
        X.pad("a", 3, side="middle")


def test_softmax(spark):
    df = spark.sql("select array(1D, 1D, -1000D) as l")
    row = df.select(X.softmax("l"), X.log_softmax("l"), X.softmax_without("l", F.lit(0))).first()
    assert row[0] == pytest.approx([1 / 3] * 3) and row[1] == pytest.approx([np.log(1 / 3)] * 3)
    assert row[2] == [0.0, 1.0, 0.0]


def test_half_even_ratio_pick(spark):
    row = spark.sql("select array(10, 20) as a").select(
        X.half_even(F.lit(2.5)), X.half_even(F.lit(3.5)), X.ratio(F.lit(1), F.lit(0)), X.pick("a", F.lit(2)), X.pick("a", F.lit(1))
    ).first()
    assert list(row) == [2.0, 4.0, None, None, 20]


def mask_df(spark, *masks):
    return spark.createDataFrame([(i, list(m)) for i, m in enumerate(masks)], "id bigint, mask array<int>")


def test_none_stays_when_it_is_alone(spark):
    got = [r["mask"] for r in P.suppress_none(mask_df(spark, (1, 0, 0), (1, 1, 0)), 1, "id", chance=0.0).orderBy("id").collect()]
    assert got == [[1, 0, 0], [0, 1, 0]]


def test_explore_draws_legal_actions_only(spark):
    df = spark.range(500).select("id", F.lit([0, 1, 0, 1]).alias("mask"), F.lit(3).alias("action"))
    always = {r["action"] for r in P.explore(df, 1, "id", epsilon=1.0).collect()}
    never = {r["action"] for r in P.explore(df, 1, "id", epsilon=0.0).collect()}
    assert always == {1, 3} and never == {3}


def test_sampled_actions_are_distinct_and_follow_shares(spark):
    df = spark.range(4000).select("id", F.lit(0).alias("action"), F.lit([5.0, 2.0, 1.0, 0.0, -1000.0]).alias("logits"))
    rows = [r["actions"] for r in P.sample_actions(df, 3, 2, "id").collect()]
    assert all(a[0] == 0 and len(a) == 4 and sorted(a) == [0, 1, 2, 3] for a in rows)
    p = np.exp([2.0, 1.0, 0.0])
    first = np.bincount([a[1] for a in rows], minlength=4)[1:] / len(rows)
    assert first == pytest.approx(p / p.sum(), abs=0.03)


def test_all_illegal_gives_no_action(spark):
    df = mask_df(spark, (0, 0), (0, 1)).withColumn("q_values", F.lit([5.0, 1.0]))
    got = [(r["action"], r["action_prob"]) for r in P.score_policy(df).orderBy("id").collect()]
    assert got == [(None, None), (1, 1.0)]


def requests(spark, *messages):
    return spark.createDataFrame([(i, m) for i, m in enumerate(messages)], "id bigint, message string")


def test_requests(spark):
    df = requests(
        spark,
        '{"app":"SPEC-PAT-TEST","app_data":{"digitalintent":"x","eligibilityflags":["creditcard","osp_smf"],"cagm":"1","sessionid":"s"}}',
        '{"app":"ivr","app_data":{"callintent":"y","eligibilityflags":["sms","nonsense"],"cagm":"2","ivrcallid":"c"}}',
        '{"app":"ivr-test","app_data":{"eligibilityflags":["sms","refill"],"priorityaction":1}}',
        'not json',
    )
    rows = P.apply_priority(P.with_action_mask(P.parse_requests(df))).orderBy("id").collect()
    assert rows[0]["app"] == "spec-pat-test" and rows[0]["session_id"] == "s" and rows[0]["error"] is None
    legal = [i for i, m in zip(rows[0]["action_ids"], rows[0]["mask"]) if m]
    assert legal == [0, 9, 19] and len(rows[0]["mask"]) == 19
    assert rows[1]["error"] is not None and rows[2]["override"] == "refill" and rows[3]["error"] is not None


def test_override_is_answered_as_asked_and_kept_out_of_training(spark):
    message = lambda flags, ask: '{"app":"ivr-test","app_data":{"cagm":"m","ivrcallid":"c","eligibilityflags":%s,"priorityaction":%s}}' % (flags, ask)
    df = spark.createDataFrame([(1, message('["sms","refill"]', 0)), (2, message('["sms","unknown"]', 0)), (3, message('["unknown"]', 0)), (4, message('["sms","unknown"]', "null")), (5, message('["sms"]', 5))], "id int, message string")
    state = spark.createDataFrame([], "raw_id string, enterprise_id bigint, state_tokenized array<int>, state array<string>")
    rows = P.decide(df, state, lambda c: F.transform(F.sequence(F.lit(0), F.lit(18)), lambda i: i.cast("double")), epsilon=0.0, chance=0.0)
    got = {r["id"]: (r["action_name"], r["action_id"], r["action_prob"], r["error"] is None, r["logged"]) for r in rows.collect()}
    assert got[1] == ("sms", 2, None, True, 0) and got[2] == ("sms", 2, None, True, 0) and got[3] == ("unknown", None, None, True, 0)
    assert got[4] == ("none", 0, None, False, 0) and got[5] == ("sms", 2, 1.0, True, 1)


def test_network_equals_numpy(spark):
    rng = np.random.default_rng(1)
    layers = [(rng.normal(size=(5, 3)), rng.normal(size=5)), (rng.normal(size=(4, 5)), rng.normal(size=4))]
    actions, x = rng.normal(size=(6, 4)), rng.normal(size=(20, 3))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, obs array<double>")
    got = df.select("id", P.network_q(F.col("obs"), layers, actions).alias("q")).orderBy("id").collect()
    want = (np.tanh(x @ layers[0][0].T + layers[0][1]) @ layers[1][0].T + layers[1][1]) @ actions.T
    assert np.allclose([r["q"] for r in got], want)


def test_splits_keep_keys_together(spark):
    df = spark.range(5000).select((F.col("id") % 500).alias("k"))
    for split in (N.split_by_key(df, "k"), N.split3_by_key(df, "k")):
        assert split.groupBy("k").agg(F.count_distinct("split").alias("n")).filter("n > 1").count() == 0
    sizes = {r["split"]: r["keys"] / 500 for r in N.split_sizes(N.split3_by_key(df, "k"), "k").collect()}
    assert sizes["train"] == pytest.approx(0.64, abs=0.08) and sizes["test"] == pytest.approx(0.2, abs=0.06)


def test_sampling_does_not_depend_on_layout(spark):
    df = spark.range(1000)
    a = {r["id"] for r in N.sample_n(df.repartition(7), 20, 3, "id").collect()}
    assert a == {r["id"] for r in N.sample_n(df.coalesce(1), 20, 3, "id").collect()} and len(a) == 20


def step_df(spark, episodes, seed=0, same=False):
    rng = np.random.default_rng(seed)
    rows = []
    for e in range(episodes):
        for t in range(int(rng.integers(1, 8))):
            b = float(rng.uniform(0.2, 0.9))
            rows.append((e, t, float(rng.normal()), b, b if same else float(rng.uniform(0, 1)), float(rng.normal()), float(rng.normal())))
    return rows, spark.createDataFrame(rows, "eps_id bigint, t bigint, reward double, p_b double, p_t double, q_hat double, v_hat double")


def test_same_policy_gains_nothing(spark):
    _, df = step_df(spark, 30, same=True)
    for method in (V.ope_is, V.ope_wis):
        r = method(df).first()
        assert r["v_target"] == pytest.approx(r["v_behavior"])


def test_doubly_robust_equals_backward_recursion(spark):
    rows, df = step_df(spark, 25)
    total, g = 0.0, 0.9
    for e in {r[0] for r in rows}:
        v = 0.0
        for _, _, rew, b, p, q, vh in reversed([r for r in rows if r[0] == e]):
            v = vh + p / b * (rew + g * v - q)
        total += v
    assert V.ope_dr(df, g).first()["v_target"] == pytest.approx(total / 25)


def test_importance_sampling_by_hand(spark):
    rows, df = step_df(spark, 25)
    g, target, weights, returns = 0.9, 0.0, {}, {}
    for e in {r[0] for r in rows}:
        w = 1.0
        for _, t, rew, b, p, _, _ in [r for r in rows if r[0] == e]:
            w *= p / b
            target += g**t * w * rew
            weights.setdefault(t, []).append(w)
            returns.setdefault(t, []).append(g**t * w * rew)
    wis = sum(sum(returns[t]) / np.mean(weights[t]) for t in weights)
    assert V.ope_is(df, g).first()["v_target"] == pytest.approx(target / 25)
    assert V.ope_wis(df, g).first()["v_target"] == pytest.approx(wis / 25)


def test_zero_ratio_ends_the_weight_and_blocks_do_not_matter(spark):
    df = spark.createDataFrame([(0, t, 1.0, 0.5, 0.0 if t == 2 else 0.6) for t in range(5)], "eps_id bigint, t bigint, reward double, p_b double, p_t double")
    for size in (2, 100):
        rows = V.importance_weights(df, size).orderBy("t").collect()
        assert [r["w"] for r in rows] == pytest.approx([1.2, 1.44, 0, 0, 0])
        assert [r["w_prev"] for r in rows] == pytest.approx([1, 1.2, 1.44, 0, 0])


def test_weights_of_raw_rows_equal_those_of_numbered_steps(spark):
    rng = np.random.default_rng(2)
    rows = [(int(e), int(m), i, float(rng.uniform(0.2, 0.9)), float(rng.choice([0.0, 0.3, 0.6], p=[0.05, 0.5, 0.45]))) for i, (e, m) in enumerate(zip(rng.integers(0, 4, 300), rng.integers(0, 400, 300)))]
    raw = spark.createDataFrame(rows, "eps_id bigint, m int, id int, p_b double, p_t double").withColumn("time", F.timestamp_seconds(F.col("m") * 1800))
    want = V.importance_weights(E.with_steps(raw, "eps_id", "time", "id"))
    shown = ["id", "t", F.round("w", 9), F.round("w_prev", 9)]
    assert sorted(map(tuple, V.weighted_steps(raw, "eps_id", "time", "id").select(*shown).collect())) == sorted(map(tuple, want.select(*shown).collect()))


@pytest.mark.parametrize("name", ["i2_importance_sampling", "i3_weighted_importance_sampling", "i4_doubly_robust", "j3_metric_rows"])
def test_estimates_scan_the_log_twice_at_most(spark, base, name):
    from offerloom.queries import QUERIES

    plan = QUERIES[name](spark, base)._jdf.queryExecution().executedPlan().toString()
    assert 1 <= plan.count("FileScan") <= 2


def test_unusable_probabilities_are_set_aside(spark):
    df = spark.createDataFrame([(0.5,), (0.0,), (None,)], "p_b double")
    good, bad = V.split_evaluable(df)
    assert good.count() == 1 and bad.count() == 2


def test_fitted_q_equals_ridge_in_numpy(spark):
    rng = np.random.default_rng(3)
    n, actions, dim, g, reg, iters = 200, 3, 2, 0.9, 0.1, 3
    obs, nobs = rng.normal(size=(n, dim)), rng.normal(size=(n, dim))
    act, ret, done = rng.integers(0, actions, n), rng.normal(size=n), rng.integers(0, 2, n)
    mask = rng.integers(0, 2, (n, actions))
    rows = [(obs[i].tolist(), int(act[i]), float(ret[i]), nobs[i].tolist(), int(done[i]), mask[i].tolist()) for i in range(n)]
    df = spark.createDataFrame(rows, "obs array<double>, action int, n_return double, n_obs array<double>, n_done int, n_mask array<int>")
    weights, errors = V.fitted_q(df, actions, dim, iters, g, 1, reg, track_error=True)
    w = np.zeros((actions, dim + 1))
    x, nx = np.column_stack([np.ones(n), obs]), np.column_stack([np.ones(n), nobs])
    for _ in range(iters):
        q = np.where(mask == 1, nx @ w.T, -np.inf).max(axis=1)
        y = ret + g * np.where((done == 1) | ~np.isfinite(q), 0, q)
        for a in range(actions):
            sel = act == a
            penalty = reg / y.std() * n * np.eye(dim + 1)  # Spark states regParam for a label of unit spread
            w[a] = np.linalg.solve(x[sel].T @ x[sel] + penalty, x[sel].T @ y[sel])
    assert np.allclose(weights, w, atol=1e-6) and len(errors) == iters and np.isfinite(errors).all()


def weights(rng, vocab=9, dim=6, length=5, out=3):
    return M.EncoderWeights(rng.normal(size=(vocab, dim)), rng.normal(size=(dim, dim)), rng.normal(size=(dim, 2 * dim)),
                            rng.normal(size=length), 0.3, rng.normal(size=(out, dim)), rng.normal(size=out))


def test_encoder_against_loops(spark):
    w = weights(np.random.default_rng(5))
    states = [[1, 2, 3], None, [4, 5, 6, 7, 8, 1, 2], [3, 3, 3, 3, 3]]
    df = spark.createDataFrame(list(enumerate(states)), "id bigint, s array<int>")
    got = [r["v"] for r in df.select("id", M.encode_states(w, F.col("s"), batch=2).alias("v")).orderBy("id").collect()]
    for s, v in zip(states, got):
        ids = ([0] if s is None else s)[-5:]
        e = w.embeddings[ids + [0] * (5 - len(ids))]
        pooled = np.full(6, w.position_bias)
        for i in range(5):
            q = w.attn_in @ e[i]
            a = np.exp([q @ c for c in e])
            mix = (a / a.sum()) @ e
            pooled = pooled + w.positions[i] * np.tanh(w.attn_out @ np.concatenate([mix, q]))
        assert np.allclose(v, w.out @ pooled + w.out_bias)


def test_attention_over_a_joined_table_equals_the_shipped_one(spark):
    w = weights(np.random.default_rng(3))
    states = [[1, 2, 3], None, [], [4] * 9, [2, 1]]
    df = spark.createDataFrame(list(enumerate(states)), "id bigint, s array<int>")
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(w.embeddings)], "token int, vector array<double>")
    want = {r["id"]: r["v"] for r in df.select("id", M.encode_states(w, F.col("s")).alias("v")).collect()}
    got = {r["id"]: r["vector"] for r in M.encode_states_attention(df, table, w, ["id"], "s").collect()}
    assert got.keys() == want.keys() and all(np.allclose(got[i], want[i]) for i in want)


def test_attention_unpacks_few_states_at_a_time(spark):
    import tracemalloc

    import pyarrow as pa

    n, length = 3000, 100
    w = weights(np.random.default_rng(4), length=length)
    held = pa.array(np.arange(n * length * 6) % 97 / 97.0)
    places = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * length), pa.array(np.tile(np.arange(length, dtype=np.int32), n)))
    numbers = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * length * 6), held)
    tracemalloc.start()
    got = M._attended(w, np.zeros(6), places, numbers)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = M._attend(w, held.to_numpy()[-length * 6:].reshape(1, length, 6))[0]
    assert len(got) == n and np.allclose(got[n - 1].as_py(), want) and peak < 50e6
    assert M._attended(w, np.zeros(6), places.slice(0, 0), numbers.slice(0, 0)).to_pylist() == []
    # A vector of another length than the encoder's is an error, not spread over it.
    df = spark.createDataFrame([(1, [1])], "id bigint, s array<int>")
    table = spark.createDataFrame([(1, [0.5])], "token int, vector array<double>")
    with pytest.raises(Exception, match="has not the 6 numbers"):
        M.encode_states_attention(df, table, w, ["id"], "s").collect()


def test_k2_joins_the_token_table(spark, base):
    from offerloom.operators import state as S
    from offerloom.queries import QUERIES, inference

    token_vectors = {r["token"]: r["vector"] for r in inference.vectors(spark, base).collect()}
    table = np.zeros((max(token_vectors) + 1, inference.DIM))
    for token, v in token_vectors.items():
        table[token] = v
    w = dataclasses.replace(inference.encoder(), embeddings=table)
    assert len(inference.encoder().embeddings) == 1  # no table of the dictionary travels
    current = S.flag_current(S.state_history(inference.tokens(spark, base))).filter("current_record = 1")
    want = {r["enterprise_id"]: r["v"] for r in current.select("enterprise_id", M.encode_states(w, F.col("state_tokenized")).alias("v")).collect()}
    rows = QUERIES["k2_encode_states"](spark, base).collect()
    got = {r["enterprise_id"]: [r[f"v{i}"] for i in range(4)] for r in rows}
    assert len(rows) == current.count() and got.keys() == want.keys() and all(np.allclose(got[i], want[i], atol=2e-6) for i in want)


def test_joined_encoding_and_decoding_slices(spark):
    vec = spark.createDataFrame([(i, f"t{i}", [float(np.cos(i)), float(np.sin(i))]) for i in range(1, 30)], "token int, token_name string, vector array<double>")
    df = spark.createDataFrame([(1, [1, 2, 2]), (2, [7])], "id bigint, state_tokenized array<int>")
    means = M.encode_states_joined(df, vec.select("token", "vector"), ["id"])
    got = {r["id"]: r["vector"] for r in means.collect()}
    assert got[1] == pytest.approx([(np.cos(1) + 2 * np.cos(2)) / 3, (np.sin(1) + 2 * np.sin(2)) / 3])
    whole = {r["id"]: r["tokens"] for r in M.decode_tokens(means, vec, 3, "id").collect()}
    sliced = {r["id"]: r["tokens"] for r in M.decode_tokens(means, vec, 3, "id", slice_bytes=100).collect()}
    assert whole == sliced and whole[2][0] == "t7"


def test_embedding_fit_and_growth(spark):
    rows = [(i, (["a", "b"] if i % 2 else ["c", "d"]) * 6) for i in range(20)] + [(50, ["lonely"]), (51, [])]
    df = spark.createDataFrame(rows, "id bigint, state array<string>")
    vectors, states = M.fit_state_embedding(df, 16, ["id"])
    got = {r["token_name"]: np.array(r["vector"]) for r in vectors.collect()}
    assert got.keys() == {"a", "b", "c", "d", "lonely"} and not got["lonely"].any()
    cos = lambda x, y: got[x] @ got[y] / np.linalg.norm(got[x]) / np.linalg.norm(got[y])
    assert cos("a", "b") > cos("a", "c") and cos("c", "d") > cos("b", "d")
    again = {r["token_name"]: r["vector"] for r in M.fit_state_embedding(df.repartition(3), 16, ["id"])[0].collect()}
    assert all(np.allclose(got[k], again[k]) for k in got)
    means = {r["id"]: r["vector"] for r in states.collect()}
    assert means.keys() == {*range(20), 50} and np.allclose(means[1], (got["a"] + got["b"]) / 2)
    vocab = spark.createDataFrame([("a", 1), ("new", 4)], "token_name string, token int")
    grown = {r["token_name"]: r["vector"] for r in M.extend_embedding(vectors, vocab, 16).collect()}
    assert grown["new"] == [0.0] * 16 and any(grown["a"])


def test_rectangles(spark):
    df = spark.sql("select * from values (array(1)), (array(1, 2, 3)) as t(a)")
    assert M.is_rectangular(df, "a").first()["rectangular"] == 0
    assert sorted(r["a"] for r in M.pad_to_longest(df, "a").collect()) == [[1, 0, 0], [1, 2, 3]]


def test_log_softmax_is_finite_where_the_share_underflows(spark):
    row = spark.sql("select array(0D, -800D, 1D) as l").select(X.log_softmax("l").alias("p")).first()["p"]
    top = 1 + math.log(1 + math.exp(-1))
    assert row == pytest.approx([-top, -800 - top, 1 - top])


@pytest.mark.parametrize("n", [0, 1, 7, 500, 999, 1000, 5000])
def test_samples_are_the_least_random_numbers(spark, n):
    df = spark.range(1000).withColumnRenamed("id", "k")
    want = [r["k"] for r in df.orderBy(X.uniform("k", seed=5), "k").limit(n).collect()]
    assert sorted(r["k"] for r in N.epoch_sample(df, n, 5, "k").collect()) == sorted(want)
    assert sorted(r["k"] for r in N.sample_n(df.union(df), n, 5, "k").collect()) == sorted(want)


DECIDED_STATE = "raw_id string, enterprise_id bigint, state_tokenized array<int>, state array<string>"


def decided_requests(spark, n, names):
    body = '{"app": "IVR", "app_data": {"cagm": "%d", "ivrcallid": "c%d", "callintent": "refill", "eligibilityflags": ["sms", "refill"]}}'
    df = spark.createDataFrame([(i, body % (i % 3, i)) for i in range(n)], "event_id bigint, message string").withColumn("time", F.lit("2024-01-05 10:00:00").cast("timestamp"))
    state = spark.createDataFrame([(str(i), i, list(range(len(names))), names) for i in range(2)], DECIDED_STATE)
    return P.decide(df, state, lambda c: F.transform(F.sequence(F.lit(0), F.lit(18)), lambda i: i.cast("double")))


def test_a_decision_shuffles_requests_before_lists_are_made_of_them(spark):
    plan = decided_requests(spark, 3, ["a___0"])._jdf.queryExecution().optimizedPlan().toString()
    above, below = plan.split("Join LeftOuter")
    assert " AS mask#" in above and " AS names#" not in below and " AS mask#" not in below and "action_ids" not in below


def test_the_decision_log_is_compressed_and_read_back_whole(spark, tmp_path):
    from offerloom.sources.decision_log import read_decisions, split_valid

    names = [f"session_event___{i}" for i in range(100)]
    record = P.decision_record(decided_requests(spark, 400, names)).coalesce(1)
    P.write_decisions(record, f"{tmp_path}/log")
    files = list(tmp_path.glob("log/log_date=2024-01-05/part-*"))
    text = sum(len(r["v"]) for r in record.select(F.to_json(F.struct("*")).alias("v")).collect())
    good, bad = split_valid(read_decisions(spark, f"{tmp_path}/log"))
    cols = ["eps_id", "enterprise_id", "actions", "mask", "raw_state", "raw_state_str", "obs", "action_prob"]
    key = lambda df: sorted(map(str, df.select(*cols).collect()))
    assert bad.count() == 0 and good.count() == 400 and key(good) == key(record)
    assert sum(f.stat().st_size for f in files) < text / 4
