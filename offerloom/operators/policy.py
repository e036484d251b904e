"""From a request to an action: parsing, legality, scoring, exploration."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.fixed_values import (
    ACTION_SPACE, APP_ID_TYPE, CHANCE_OF_NO_ACTION, EPSILON, NO_ACTION, SENTINEL_LOGIT, STATE_MAX_LEN,
)
from offerloom.functions import (
    action_mask, dot, legal_argmax, masked_scores, number_matrix, pick, softmax_without, tail, uniform, with_top, with_value,
)
from offerloom.schemas import DECISION_LOG

REQUEST_SCHEMA = """
    app string,
    app_data struct<cagm: string, ivrcallid: string, sessionid: string, patientid: string, callintent: string,
                    digitalintent: string, eligibilityflags: array<string>, priorityaction: int>
"""


def app_actions(spec: Mapping[str, Mapping[int, str]] = ACTION_SPACE) -> dict[str, dict[int, str]]:
    """Actions of each application, the common ones included, by id."""
    apps = [a for a in spec if a != "common"]
    return {a: dict(sorted({**spec.get("common", {}), **spec[a]}.items())) for a in apps}


def action_space(spark: SparkSession, spec: Mapping[str, Mapping[int, str]] = ACTION_SPACE) -> DataFrame:
    """``(app, position, action_id, name)`` as a table."""
    rows = [(app, pos, i, n) for app, acts in app_actions(spec).items() for pos, (i, n) in enumerate(acts.items())]
    return spark.createDataFrame(rows, "app string, position int, action_id int, name string")


def _by_app(values: Mapping[str, list], kind: str) -> Column:
    """Constant per application, NULL for an unknown one. Part of the plan, so no join is needed."""
    return F.element_at(F.from_json(F.lit(json.dumps(values)), f"map<string, array<{kind}>>"), F.col("app_name"))


def parse_requests(df: DataFrame, message: str = "message") -> DataFrame:
    """JSON messages to columns. A message that is not JSON or not of a known application gets an ``error``."""
    r = F.from_json(message, REQUEST_SCHEMA)
    parsed = df.withColumn("_r", r).withColumn("app", F.lower("_r.app"))
    parsed = parsed.withColumn("app_name", F.regexp_replace("app", "-test$", ""))
    data = F.col("_r.app_data")
    is_ivr, is_web = F.col("app_name") == "ivr", F.col("app_name") == "spec-pat"
    known = F.coalesce(is_ivr | is_web, F.lit(False))
    return parsed.select(
        *[c for c in df.columns if c != message], F.col(message).alias("input"), "app", "app_name",
        F.when(is_ivr, data["ivrcallid"]).when(is_web, data["sessionid"]).alias("session_id"),
        data["cagm"].alias("raw_id"),
        F.when(is_ivr, data["callintent"]).when(is_web, data["digitalintent"]).alias("intent"),
        F.coalesce(data["eligibilityflags"], F.array().cast("array<string>")).alias("flags"),
        data["priorityaction"].alias("priority"), data["patientid"].alias("patient_id"),
        F.when(~known, F.concat(F.lit("invalid app: "), F.coalesce("app_name", F.lit("?")))).alias("error"),
    )


def apply_priority(df: DataFrame) -> DataFrame:
    """``override``: the flag that a test message asks for by index, NULL for all other messages."""
    asked = F.col("app").contains("-test") & F.col("priority").isNotNull()
    return df.withColumn("override", F.when(asked, F.get("flags", F.col("priority"))))


def with_action_mask(
    df: DataFrame, spec: Mapping[str, Mapping[int, str]] = ACTION_SPACE, cold_start: bool = False
) -> DataFrame:
    """``action_ids, names, mask`` of each request; 'none' is always eligible, an unknown name is an ``error``.

    With ``cold_start`` the mask covers the whole action space, still allowing the application's own actions only.
    """
    own = app_actions(spec)
    whole = dict(sorted(pair for acts in own.values() for pair in acts.items()))
    shown = {app: whole for app in own} if cold_start else own
    eligible = F.array_union(F.array(F.lit(NO_ACTION)), F.col("flags"))
    known = _by_app({app: list(acts.values()) for app, acts in own.items()}, "string")
    unknown = F.size(F.array_except(eligible, known)) > 0
    listed = df.withColumns({
        "action_ids": _by_app({app: list(acts) for app, acts in shown.items()}, "int"),
        "names": _by_app({app: list(acts.values()) for app, acts in shown.items()}, "string"),
    })
    return listed.withColumn("mask", action_mask(F.col("names"), eligible)).withColumn(
        "error", F.coalesce("error", F.when(unknown, F.lit("eligible action not in the action space")))
    )


def suppress_none(df: DataFrame, seed: int | str, *keys: str, chance: float = CHANCE_OF_NO_ACTION) -> DataFrame:
    """With more than one legal action, 'none' stays legal only with the given chance."""
    several = F.aggregate("mask", F.lit(0), lambda s, m: s + m) > 1
    drop = several & (uniform(*keys, seed=seed) > chance)
    return df.withColumn(
        "mask", F.when(drop, F.transform("mask", lambda m, i: F.when(i == 0, 0).otherwise(m))).otherwise(F.col("mask"))
    )


@dataclass(frozen=True)
class LinearPolicy:
    """``q = actions . (weights . obs + bias)``: one hidden linear layer against action vectors.

    All three are parameters of a model, of a size fixed by state and action dimension.
    """

    weights: np.ndarray  # (hidden, obs)
    bias: np.ndarray  # (hidden,)
    actions: np.ndarray  # (actions, hidden)

    def folded(self) -> tuple[np.ndarray, np.ndarray]:
        return self.actions @ self.weights, self.actions @ self.bias


def linear_q(obs: Column, policy: LinearPolicy) -> Column:
    """q-values of all actions as one array expression."""
    matrix, offset = policy.folded()
    rows = number_matrix(np.column_stack([offset, matrix]))
    return with_value(F.concat(F.array(F.lit(1.0)), obs), lambda o: F.transform(rows, lambda w: dot(w, o)))


def network_q(obs: Column, layers: list[tuple[np.ndarray, np.ndarray]], actions: np.ndarray) -> Column:
    """q-values of a tanh network, by Arrow batches. Layers are ``(weights (out, in), bias)``."""
    @F.pandas_udf("array<double>")
    def forward(batch: pd.Series) -> pd.Series:
        if batch.empty:
            return pd.Series([], dtype=object)
        x = np.stack(batch.to_numpy())
        for i, (w, b) in enumerate(layers):
            x = x @ w.T + b
            if i + 1 < len(layers):
                x = np.tanh(x)
        return pd.Series(list(x @ actions.T))

    return forward(obs)


def score_policy(df: DataFrame) -> DataFrame:
    """Best legal action of ``q_values`` under ``mask``, with its probability and log probability.

    Probabilities are a softmax over the legal actions; a tie goes to the first action.
    """
    shares = with_top(
        masked_scores(F.col("q_values"), F.col("mask")),
        lambda v: F.transform(v["s"], lambda q: F.when(q.isNull(), 0.0).otherwise(F.exp(q - v["top"]))),
    )
    probs = with_value(shares, lambda e: with_value(
        F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda s, x: s + x).alias("total")),
        lambda v: F.transform(v["e"], lambda x: F.try_divide(x, v["total"])),
    ))
    scored = df.withColumn("probs", probs).withColumn("action", legal_argmax(F.col("q_values"), F.col("mask")))
    prob = pick("probs", "action")
    return scored.withColumn("action_prob", prob).withColumn("action_logp", F.ln(F.col("action_prob")))


def explore(df: DataFrame, seed: int | str, *keys: str, epsilon: float = EPSILON) -> DataFrame:
    """With chance ``epsilon`` replace the action by a uniform draw among the legal ones."""
    legal = F.filter(
        F.transform("mask", lambda m, i: F.when(m == 1, i)), lambda i: i.isNotNull()
    )
    drawn = with_value(
        F.struct(legal.alias("l"), uniform(*keys, seed=f"{seed}-pick").alias("u")),
        lambda v: F.get(v["l"], F.floor(v["u"] * F.size(v["l"])).cast("int")),
    )
    return df.withColumn(
        "action", F.when(uniform(*keys, seed=f"{seed}-eps") < epsilon, drawn).otherwise(F.col("action"))
    )


def sample_actions(df: DataFrame, n: int, seed: int | str, *keys: str, logits: str = "logits") -> DataFrame:
    """``actions``: the chosen action, then up to ``n`` others drawn without replacement by softmax share.

    Exponential keys -ln(u) / p taken in ascending order give that draw; a share of zero is never drawn.
    """
    p = softmax_without(logits, F.col("action"))
    text = F.concat_ws(":", *[F.col(k).cast("string") for k in keys])
    keyed = with_value(
        F.struct(p.alias("p"), text.alias("k")),
        lambda v: F.transform(
            v["p"], lambda x, i: F.when(
                x > 0, F.struct((-F.ln(uniform(v["k"], i, seed=seed)) / x).alias("key"), i.alias("a"))
            )
        ),
    )
    ranked = F.slice(F.sort_array(F.array_compact(keyed)), 1, n)
    return df.withColumn("actions", F.concat(F.array("action"), F.transform(ranked, lambda s: s["a"])))


def cold_start(
    df: DataFrame, seed: int | str, *keys: str, spec: Mapping[str, Mapping[int, str]] = ACTION_SPACE
) -> DataFrame:
    """No model yet: whole action space, own legal actions, a uniform draw among them."""
    masked = with_action_mask(df, spec, cold_start=True)
    return explore(masked.withColumn("action", F.lit(None).cast("int")), seed, *keys, epsilon=1.0)


def legal_logits(q: Column, mask: Column) -> Column:
    """Scores with impossible actions at the sentinel."""
    return F.zip_with(q, mask, lambda x, m: F.when(m == 1, x).otherwise(F.lit(float(SENTINEL_LOGIT))))


def decide(
    requests: DataFrame, state: DataFrame, q_values, spec: Mapping[str, Mapping[int, str]] = ACTION_SPACE,
    seed: int = 7, epsilon: float = EPSILON, chance: float = CHANCE_OF_NO_ACTION, implementation: str = "offerloom",
) -> DataFrame:
    """Requests to decisions. ``q_values`` maps the token array column to the scores of the widest action space.

    ``state`` has ``raw_id, enterprise_id, state_tokenized, state``, one row per id (``state_lookup``). A request with
    an error gets action 'none' and keeps its message; the others carry all that the decision log needs.

    A test message that asks for a flag (``override``) is answered with that flag before anything else is looked at: no error of another
    flag changes it, its id is that of the flag (NULL if the space has no such action), and it has no probability. Such rows have
    ``logged`` = 0, as those with an error: they don't belong in training data.
    """
    # The join comes first: only what a request says is shuffled, not the lists of names and masks that are made of it.
    asked = apply_priority(parse_requests(requests)).join(state, "raw_id", "left")
    masked = suppress_none(with_action_mask(asked, spec), f"{seed}-none", "session_id", chance=chance)
    known = masked.withColumns({
        "raw_state": tail(F.coalesce("state_tokenized", F.array(F.lit(0))), STATE_MAX_LEN),
        "raw_state_str": F.concat(
            F.coalesce("state", F.array().cast("array<string>")), F.array(F.coalesce("intent", F.lit("")))
        ),
    })
    scored = known.withColumn("q_values", F.slice(q_values(F.col("raw_state")), F.lit(1), F.size("names")))
    picked = explore(score_policy(scored), seed, "session_id", epsilon=epsilon)
    prob = pick("probs", "action")
    asked_for = F.col("override").isNotNull()
    ok = F.col("error").isNull() & ~asked_for
    position = F.array_position("names", F.col("override")).cast("int")
    return picked.withColumns({
        "action_id": F.when(asked_for, F.when(position > 0, F.get("action_ids", position - 1))).when(ok, pick("action_ids", "action")).otherwise(0),
        "action_name": F.when(asked_for, F.col("override")).when(ok, pick("names", "action")).otherwise(NO_ACTION),
        "action_prob": F.when(ok, prob),
        "action_logp": F.when(ok, F.ln(prob)),
        "implementation": F.lit(implementation),
        "logged": F.when(ok, 1).otherwise(0),
        "error": F.when(~asked_for, F.col("error")),
    })


def decision_record(
    decided: DataFrame, n_actions: int = 3, seed: int | str = 7, encode: Callable[[Column], Column] | None = None
) -> DataFrame:
    """The log columns of decisions that belong in training data (``logged`` = 1), and the day ``log_date``.

    ``actions`` holds positions: the chosen one, then up to ``n_actions`` others drawn by their share; ``raw_action_str`` has their
    names. ``obs`` is the mask, followed by ``encode`` of the state tokens if given. What only later steps can tell is null.
    """
    rows = decided.filter("logged = 1").withColumn("_logits", legal_logits(F.col("q_values"), F.col("mask")))
    rows = sample_actions(rows, n_actions, f"{seed}-log", "session_id", logits="_logits")
    # Where the chosen action is the only legal one, no other has a share of its own.
    rows = rows.withColumn("actions", F.array_distinct(F.filter("actions", lambda a: F.get("mask", a) == 1)))
    mask = F.col("mask").cast("array<double>")
    known = {
        "id": F.col("raw_id"), "id_type": F.element_at(F.create_map(*[F.lit(x) for kv in APP_ID_TYPE.items() for x in kv]), F.col("app_name")),
        "enterprise_id": F.col("enterprise_id").cast("string"), "eps_id": F.col("session_id"), "agent_index": F.lit(0),
        "obs": mask if encode is None else F.concat(mask, encode(F.col("raw_state"))), "logits": F.col("_logits"),
        "infos": F.to_json(F.struct(F.col("intent").alias("callintent"), F.col("patient_id").alias("patientid"), F.col("raw_id").alias("cagm"))),
        "raw_state": F.col("raw_state").cast("array<string>"), "raw_action_str": F.transform("actions", lambda a: F.get("names", a)),
    }
    later = ("t", "rewards", "prev_actions", "prev_rewards", "dones", "new_obs")
    types = dict(c.strip().split(" ", 1) for c in DECISION_LOG.split(", "))
    columns = [
        (F.lit(None) if c in later else known.get(c, F.col(c))).cast(kind).alias(c) for c, kind in types.items()
    ]
    return rows.select(*columns, F.date_format("time", "yyyy-MM-dd").alias("log_date"))


def write_decisions(record: DataFrame, path: str) -> None:
    """Dated JSON files that ``read_decisions`` reads, compressed: a record repeats all names of its state. A file is that of one task."""
    fields = [c for c in record.columns if c != "log_date"]
    text = record.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm:ss")).select(
        F.to_json(F.struct(*fields)).alias("value"), "log_date"
    )
    text.write.mode("overwrite").options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}).partitionBy("log_date").text(path)
