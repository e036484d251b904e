"""K: policy scoring and state vectors."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from offerloom.operators import embedding as M
from offerloom.operators import policy as P
from offerloom.operators import sampling as N
from offerloom.operators import state as S
from offerloom.operators.vocabulary import build_vocabulary
from offerloom.queries.expressions import REQUESTS
from offerloom.queries.joins import features, tokens
from offerloom.queries.registry import FEATURES, VOCAB, joined, query, state_sql, u
from offerloom.queries.sources import ACTIONS
from offerloom.sources import adapters as A

DIM = 8


def policy(obs: int = 64, hidden: int = 4, actions: int = 64) -> P.LinearPolicy:
    h, j, a = np.arange(hidden), np.arange(obs), np.arange(actions)
    return P.LinearPolicy(
        weights=((h[:, None] * 5 + j[None, :] * 3) % 7 - 3) / 10.0,
        bias=h / 10.0,
        actions=((a[:, None] * 4 + h[None, :]) % 5 - 2) / 5.0,
    )


SCORED = """v AS (
    SELECT vec_id AS id, embedding::DOUBLE[] AS obs, list_transform(range(64), lambda i: CAST((vec_id + i) % 3 > 0 AS INT)) AS mask FROM embeddings
), hid AS (
    SELECT id, mask, list_transform(range(4), lambda h: list_sum(list_transform(range(64), lambda j: ((h * 5 + j * 3) % 7 - 3) / 10::DOUBLE * obs[j + 1])) + h / 10::DOUBLE) AS z FROM v
), qs AS (
    SELECT id, mask, list_transform(range(64), lambda a: list_sum(list_transform(range(4), lambda h: ((a * 4 + h) % 5 - 2) / 5::DOUBLE * z[h + 1]))) AS q FROM hid
), legal AS (
    SELECT id, list_transform(q, lambda x, i: CASE WHEN mask[i] = 1 THEN x END) AS q FROM qs
), scored AS (
    SELECT id, list_position(q, list_max(q)) - 1 AS action,
           1 / list_sum(list_transform(q, lambda x: coalesce(exp(x - list_max(q)), 0))) AS p FROM legal
)"""


@query("k1_score_policy", f"""
    WITH {SCORED} SELECT id, CAST(action AS INT) AS action, round(p, 6) AS action_prob, round(ln(p), 6) AS action_logp FROM scored""")
def k1(spark, base):
    rows = A.scores(spark, base).withColumn("q_values", P.linear_q(F.col("obs"), policy()))
    return shown_scores(rows)


def shown_scores(rows):
    return P.score_policy(rows).select(
        "id", "action", F.round("action_prob", 6).alias("action_prob"), F.round("action_logp", 6).alias("action_logp")
    )


@query("k1_score_policy_network", f"""
    WITH {SCORED} SELECT id, CAST(action AS INT) AS action, round(p, 6) AS action_prob, round(ln(p), 6) AS action_logp FROM scored""")
def k1_network(spark, base):
    """The general form in Arrow batches, here with the one linear layer of the query before."""
    p = policy()
    rows = A.scores(spark, base).withColumn("q_values", P.network_q(F.col("obs"), [(p.weights, p.bias)], p.actions))
    return shown_scores(rows)


def encoder(length: int = 100, dim: int = DIM, out: int = 4) -> M.EncoderWeights:
    """The small matrices, of a fixed seed, and the padding; token vectors are a table of their own."""
    rng = np.random.default_rng(dim)
    return M.EncoderWeights(
        np.zeros((1, dim)), rng.normal(size=(dim, dim)) / dim, rng.normal(size=(dim, 2 * dim)) / dim, rng.normal(size=length) / length, 0.1,
        rng.normal(size=(out, dim)), rng.normal(size=out),
    )


@query("k2_encode_states")
def k2(spark, base):
    """Attention encoding of every current state, with token vectors joined for a dictionary of any size."""
    current = S.flag_current(S.state_history(tokens(spark, base))).filter("current_record = 1")
    rows = M.encode_states_attention(current, vectors(spark, base), encoder(), ["enterprise_id"])
    return rows.select("enterprise_id", *[F.round(F.get("vector", F.lit(i)), 6).alias(f"v{i}") for i in range(4)])


# A small encoder, spelled out in the SQL below.
SMALL_ENCODER = M.EncoderWeights(
    np.zeros((1, 2)), np.array([[0.5, -0.25], [0.75, 1.0]]), np.array([[1.0, 0.5, -0.5, 0.25], [0.25, -1.0, 0.5, 0.75]]),
    np.array([0.1, 0.2, 0.3, 0.4]), 0.05, np.array([[1.0, 2.0], [-0.5, 0.25]]), np.array([0.1, -0.2]),
)


@query("k2_encode_states_small", f"""
    WITH {FEATURES}, {VOCAB}, {state_sql()}, cur AS (
        SELECT enterprise_id, list_slice(ids, greatest(len(ids) - 3, 1), len(ids)) AS ids FROM state WHERE current_record = 1
    ), x AS (
        SELECT enterprise_id, i, CASE WHEN i < len(ids) THEN sin(ids[i + 1]::DOUBLE) ELSE 0 END AS a,
               CASE WHEN i < len(ids) THEN sin(2 * ids[i + 1]::DOUBLE) ELSE 0 END AS b FROM cur, (SELECT unnest(range(4)) AS i)
    ), q AS (SELECT *, 0.5 * a - 0.25 * b AS qa, 0.75 * a + b AS qb FROM x), att AS (
        SELECT q.enterprise_id, q.i, any_value(qa) AS qa, any_value(qb) AS qb,
               sum(exp(qa * x.a + qb * x.b) * x.a) / sum(exp(qa * x.a + qb * x.b)) AS ma,
               sum(exp(qa * x.a + qb * x.b) * x.b) / sum(exp(qa * x.a + qb * x.b)) AS mb
        FROM q JOIN x ON q.enterprise_id = x.enterprise_id GROUP BY 1, 2
    ), pooled AS (
        SELECT enterprise_id, sum((i + 1) / 10.0 * tanh(ma + 0.5 * mb - 0.5 * qa + 0.25 * qb)) + 0.05 AS pa,
               sum((i + 1) / 10.0 * tanh(0.25 * ma - mb + 0.5 * qa + 0.75 * qb)) + 0.05 AS pb FROM att GROUP BY 1
    ) SELECT enterprise_id, round(pa + 2 * pb + 0.1, 6) AS v0, round(-0.5 * pa + 0.25 * pb - 0.2, 6) AS v1 FROM pooled""")
def k2_small(spark, base):
    """The attention form with length 4 and dimension 2."""
    current = S.flag_current(S.state_history(tokens(spark, base))).filter("current_record = 1")
    held = vectors(spark, base).withColumn("vector", F.slice("vector", 1, 2))
    rows = M.encode_states_attention(current, held, SMALL_ENCODER, ["enterprise_id"])
    return rows.select("enterprise_id", *[F.round(F.get("vector", F.lit(i)), 6).alias(f"v{i}") for i in range(2)])


def vectors(spark, base):
    """Token vectors by a formula of the id."""
    vocab = build_vocabulary(features(spark, base))
    return vocab.withColumn(
        "vector", F.transform(F.sequence(F.lit(1), F.lit(DIM)), lambda j: F.sin(F.col("token") * j))
    )


MEANS = f"""{FEATURES}, {VOCAB}, {state_sql()}, long AS (
    SELECT enterprise_id, unnest(ids) AS token FROM state WHERE current_record = 1
), means AS (
    SELECT enterprise_id, j, avg(sin((token * j)::DOUBLE)) AS m FROM long, (SELECT unnest(range(1, 9)) AS j) GROUP BY 1, 2
)"""


@query("k2_encode_states_joined", f"""
    WITH {MEANS} SELECT enterprise_id, j - 1 AS i, round(m, 6) AS m FROM means""")
def k2_joined(spark, base):
    """Mean token vector by joins, for a dictionary of any size."""
    rows = mean_states(spark, base).select("enterprise_id", F.posexplode("vector").alias("i", "m"))
    return rows.select("enterprise_id", F.col("i").cast("bigint").alias("i"), F.round("m", 6).alias("m"))


def mean_states(spark, base):
    current = S.flag_current(S.state_history(tokens(spark, base))).filter("current_record = 1")
    return M.encode_states_joined(current, vectors(spark, base).select("token", "vector"), ["enterprise_id"])


@query("k3_split3_by_key", f"""
    WITH s AS (SELECT user_id, CASE WHEN {u('user_id', 42)} >= 0.8 THEN 'test' WHEN {u('user_id', '42-val')} >= 0.8 THEN 'val' ELSE 'train' END AS split FROM events)
    SELECT split, count(DISTINCT user_id) AS keys, count(*) AS rows FROM s GROUP BY 1""")
def k3(spark, base):
    return N.split_sizes(N.split3_by_key(A.load(spark, "events", base).select("user_id"), "user_id"), "user_id")


@query("k4_fit_embedding", f"""
    WITH {FEATURES}, {VOCAB}, {state_sql()}, seq AS (SELECT enterprise_id, names FROM state WHERE current_record = 1
    ), near AS (
        SELECT names[i] AS a, unnest(names[i + 1 : i + 5]) AS b FROM (SELECT names, unnest(range(1, len(names) + 1)) AS i FROM seq)
    ), met AS (
        SELECT a, b, count(*) AS n FROM (SELECT a, b FROM near UNION ALL SELECT b, a FROM near) GROUP BY 1, 2
    ), one AS (SELECT a, sum(n) AS n FROM met GROUP BY 1
    ), w AS (
        SELECT met.a, met.b, ln(met.n * (SELECT sum(n) FROM met)::DOUBLE / (x.n::DOUBLE * y.n)) AS w
        FROM met JOIN one x ON x.a = met.a JOIN one y ON y.a = met.b
    ), v AS (
        SELECT a AS token_name, j, sum(w * CASE WHEN substr(md5(b || ':' || j), 1, 1) < '8' THEN 1 ELSE -1 END) / sqrt({DIM}::DOUBLE) AS x
        FROM w, (SELECT unnest(range({DIM})) AS j) WHERE w > 0 GROUP BY 1, 2
    ), names AS (SELECT DISTINCT unnest(names) AS token_name FROM seq)
    SELECT token_name, j AS i, round(coalesce(x, 0), 5) AS x FROM names CROSS JOIN (SELECT unnest(range({DIM})) AS j) LEFT JOIN v USING (token_name, j)""")
def k4(spark, base):
    """Fitted vector of every token of the current states."""
    states = S.flag_current(S.state_history(tokens(spark, base))).filter("current_record = 1").select("enterprise_id", "state")
    fitted, _ = M.fit_state_embedding(states, DIM, ["enterprise_id"])
    rows = fitted.select("token_name", F.posexplode("vector").alias("i", "x"))
    return rows.select("token_name", F.col("i").cast("bigint").alias("i"), F.round("x", 5).alias("x"))


@query("k5_extend_embedding", f"""
    WITH {FEATURES}, {VOCAB}
    SELECT token_name, token, CASE WHEN token_name LIKE 'view%' OR token_name LIKE 'click%' THEN round(sin(token::DOUBLE), 6) ELSE 0 END AS first
    FROM (SELECT token_name, CAST(token AS INT) AS token FROM vocab)""")
def k5(spark, base):
    """Tokens of views and clicks have vectors, the others start at zero."""
    vocab = build_vocabulary(features(spark, base))
    old = vectors(spark, base).filter("token_name like 'view%' or token_name like 'click%'").select("token_name", "vector")
    rows = M.extend_embedding(old, vocab, DIM)
    return rows.select("token_name", "token", F.round(F.get("vector", F.lit(0)), 6).alias("first"))


@query("k6_decode_tokens", f"""
    WITH {MEANS}, d AS (
        SELECT enterprise_id, v.token_name, sum(m * sin((v.token * j)::DOUBLE)) AS score FROM means, vocab v GROUP BY 1, 2
    ), r AS (SELECT *, row_number() OVER (PARTITION BY enterprise_id ORDER BY score DESC) AS rk FROM d)
    SELECT enterprise_id, string_agg(token_name, ',' ORDER BY rk) AS tokens, round(max(score), 5) AS best FROM r WHERE rk <= 3 GROUP BY 1""")
def k6(spark, base):
    rows = M.decode_tokens(mean_states(spark, base), vectors(spark, base), 3, "enterprise_id")
    return rows.select("enterprise_id", joined("tokens").alias("tokens"), F.round(F.get("scores", F.lit(0)), 5).alias("best"))


@query("k7_cold_start", f"""
    WITH {REQUESTS}, {ACTIONS}, whole AS (SELECT list(name ORDER BY action_id) AS names FROM (SELECT DISTINCT action_id, name FROM actions)),
    m AS (SELECT event_id, app_name, k, names, list_transform(names, lambda n: CAST(n = 'none' OR list_contains(flags, n) AS INT)) AS mask
          FROM requests, whole),
    l AS (SELECT *, list_filter(range(27), lambda i: mask[i + 1] = 1) AS legal FROM m)
    SELECT event_id, CASE WHEN app_name = 'fax' THEN '-' ELSE array_to_string(mask, ',') END AS mask,
           CASE WHEN app_name = 'fax' THEN '-' ELSE names[legal[CAST(floor({u('event_id', '3-pick')} * len(legal)) AS INT) + 1] + 1] END AS name,
           CAST(k = 99 OR app_name = 'fax' AS INT) AS failed FROM l""")
def k7(spark, base):
    rows = P.cold_start(P.parse_requests(A.requests(spark, base)), 3, "event_id")
    return rows.select(
        "event_id", F.coalesce(joined("mask"), F.lit("-")).alias("mask"),
        F.coalesce(F.get("names", F.col("action")), F.lit("-")).alias("name"),
        F.when(F.col("error").isNotNull(), 1).otherwise(0).alias("failed"),
    )


