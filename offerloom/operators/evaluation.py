"""Off-policy evaluation, policy comparison and fitted Q on step tables.

Steps have ``eps_id, t, reward, p_b`` (logged probability) and ``p_t`` (probability under the new policy);
the doubly robust estimate also reads ``q_hat`` and ``v_hat``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.fixed_values import GAMMA
from offerloom.functions import dot, number_matrix, ratio, with_value
from offerloom.operators.blocks import HOT_ROWS, STEP_BLOCK, running_sums, segmented_scan
from offerloom.session import cut_lineage

# Numbers in a block of moments, and groups of tasks whose blocks are added first.
MOMENT_BLOCK, MOMENT_TASKS = 4096, 32
MOMENTS = "action int, block int, v array<double>"


def split_evaluable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with a usable logged probability, and the others for quarantine."""
    usable = F.coalesce(F.col("p_b") > 0, F.lit(False))
    return df.filter(usable), df.filter(~usable)


def importance_weights(df: DataFrame, size: int = STEP_BLOCK) -> DataFrame:
    """``w``: product of p_t / p_b up to the step; ``w_prev``: the same up to the step before.

    Sums of logs in step blocks; a ratio of zero makes all later weights zero.
    """
    rho = F.col("p_t") / F.col("p_b")
    rows = df.withColumn("_ln", F.when(rho > 0, F.ln(rho)).otherwise(0.0)).withColumn(
        "_zero", F.when(rho > 0, 0).otherwise(1)
    )
    block = F.floor(F.col("t") / F.lit(size)).cast("bigint")
    summed = running_sums(rows, ["eps_id"], block, [F.col("t")], {"_log": F.col("_ln"), "_zeros": F.col("_zero")})
    return summed.withColumns({
        "w": F.when(F.col("_zeros") > 0, 0.0).otherwise(F.exp("_log")),
        "w_prev": F.when(F.col("_zeros") - F.col("_zero") > 0, 0.0).otherwise(F.exp(F.col("_log") - F.col("_ln"))),
    }).drop("_ln", "_zero", "_log", "_zeros")


def weighted_steps(df: DataFrame, key: str, time: str, *ties: str, most: int = HOT_ROWS) -> DataFrame:
    """``t``, ``w`` and ``w_prev`` of raw log rows in one go, as ``with_steps`` and :func:`importance_weights` give them.

    One scan carries the number of rows, the sum of logs and the number of zeros. Rows without key or time are set aside: they stay, with
    null in these columns, and :func:`ope_all` leaves them out.
    """
    rho = F.col("p_t") / F.col("p_b")
    rows = df.withColumns({"_ln": F.when(rho > 0, F.ln(rho)).otherwise(0.0), "_zero": F.when(rho > 0, 0).otherwise(1)})
    scanned = segmented_scan(rows, [key], time, ties, sums={"_n": F.lit(1), "_log": F.col("_ln"), "_zeros": F.col("_zero")}, most=most)
    known = lambda value: F.when(F.col("_n").isNotNull(), value)
    return scanned.select(
        *df.columns, (F.col("_n") - 1).cast("bigint").alias("t"),
        known(F.when(F.col("_zeros") > 0, 0.0).otherwise(F.exp("_log"))).alias("w"),
        known(F.when(F.col("_zeros") - F.col("_zero") > 0, 0.0).otherwise(F.exp(F.col("_log") - F.col("_ln")))).alias("w_prev"),
    )


def ope_all(df: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """One row with ``v_behavior`` and the estimates ``is``, ``wis`` and, if the rows have model values, ``dr``.

    * ``is``: per-decision importance sampling.
    * ``wis``: the weights divided by their mean at the step. The mean divides a whole step number, so it is applied to sums per step.
    * ``dr``: the doubly robust estimate, unrolled into one sum over steps.

    Rows that carry ``w`` and ``w_prev`` already are read once: all sums are made by step number in one grouping.
    """
    rows = df if {"w", "w_prev"} <= set(df.columns) else importance_weights(df)
    rows = rows.filter("t IS NOT NULL")
    g = F.pow(F.lit(gamma), F.col("t"))
    value = F.col("w_prev") * F.col("v_hat") + F.col("w") * (F.col("reward") - F.col("q_hat")) if "q_hat" in df.columns else F.lit(0.0)
    steps = rows.groupBy("t").agg(
        F.sum(g * F.col("reward")).alias("_b"), F.sum(g * F.col("w") * F.col("reward")).alias("_t"), F.avg("w").alias("_w"),
        F.sum(g * value).alias("_d"), F.count(F.when(F.col("t") == 0, 1)).alias("episodes"),
    )
    sums = steps.agg(
        F.sum("_b").alias("_b"), F.sum("_t").alias("is"), F.sum(F.coalesce(F.try_divide("_t", "_w"), F.lit(0.0))).alias("wis"),
        F.sum("_d").alias("dr"), F.sum("episodes").alias("episodes"),
    )
    methods = ["is", "wis", "dr"] if "q_hat" in df.columns else ["is", "wis"]
    return sums.select(ratio("_b", "episodes").alias("v_behavior"), *[ratio(m, "episodes").alias(m) for m in methods])


def gain(target: Column) -> Column:
    return target / F.greatest("v_behavior", F.lit(1e-8))


def _estimate(df: DataFrame, method: str, gamma: float) -> DataFrame:
    return ope_all(df, gamma).select("v_behavior", F.col(method).alias("v_target"), gain(F.col(method)).alias("v_gain"))


def ope_is(df: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """Per-decision importance sampling."""
    return _estimate(df, "is", gamma)


def ope_wis(df: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """Weighted importance sampling."""
    return _estimate(df, "wis", gamma)


def ope_dr(df: DataFrame, gamma: float = GAMMA) -> DataFrame:
    """Doubly robust estimate."""
    return _estimate(df, "dr", gamma)


def ope_dm(df: DataFrame) -> DataFrame:
    """Direct method: mean model value of the first steps."""
    return df.filter("t = 0").agg(F.avg("v_hat").alias("v_target"))


def metric_rows(estimates: DataFrame) -> DataFrame:
    """The row of :func:`ope_all` in long form, names prefixed by the method; gain and target only."""
    methods = [c for c in estimates.columns if c != "v_behavior"]
    long = F.array(*[
        F.struct(F.lit(f"{m.upper()}-{name}").alias("metric"), value.alias("value"))
        for m in methods for name, value in (("v_gain", gain(F.col(m))), ("v_target", F.col(m)))
    ])
    return estimates.select(F.inline(long))


def compare_policies(df: DataFrame, actions: DataFrame) -> DataFrame:
    """Per action: how often the new policy takes it, its value there, and how often the log took it.

    ``df`` has ``action, orig_action, value``. ``unused`` marks actions the new policy never takes.
    """
    new = df.groupBy("action").agg(
        F.count(F.lit(1)).alias("new_dist"), F.sum("value").alias("total_value"), F.avg("value").alias("mean_value")
    )
    old = df.groupBy(F.col("orig_action").alias("action")).agg(F.count(F.lit(1)).alias("orig_dist"))
    joined = actions.select("action").join(new, "action", "left").join(old, "action", "left")
    return joined.fillna(0, ["new_dist", "orig_dist"]).withColumn(
        "unused", F.when(F.col("new_dist") == 0, 1).otherwise(0)
    )


def q_of(obs: Column, weights: Sequence[Sequence[float]]) -> Column:
    """q-values of all actions for linear weights ``(bias, w...)`` per action."""
    rows = number_matrix(weights)
    return with_value(F.concat(F.array(F.lit(1.0)), obs), lambda o: F.transform(rows, lambda w: dot(w, o)))


def fitted_q(
    df: DataFrame, n_actions: int, obs_dim: int, iters: int = 5, gamma: float = GAMMA, n_step: int = 1,
    reg: float = 0.1, track_error: bool = False,
) -> tuple[list[list[float]], list[float]]:
    """Fitted-Q iteration with a linear model per action. Returns the weights and, if asked for, the training
    error per round.

    ``df`` has ``obs, action, n_return, n_obs, n_done, n_mask``. The target is the n-step return plus the
    discounted best legal value ``n`` steps on. The model of an action is separate from the others, so its second moments are summed
    once; each round sums only the products with the target, and solves one small system per action. Sums are made per task, the upper
    triangle of a matrix as blocks of :data:`MOMENT_BLOCK` numbers, and added block by block; nothing but the sums comes back to the driver. ``reg`` is a ridge
    penalty in the terms of Spark's regression, that is, for a label of unit spread.
    """
    width = obs_dim + 1
    steps = cut_lineage(df.select("obs", "action", "n_return", "n_obs", "n_done", "n_mask"))

    def with_one(column: pd.Series) -> np.ndarray:
        return np.column_stack([np.ones(len(column)), np.stack(column.to_numpy())]) if len(column) else np.zeros((0, width))

    def packed(total: dict[int, np.ndarray]) -> pd.DataFrame:
        """Vectors by action, in blocks of bounded length."""
        rows = [(int(a), b, v[at:at + MOMENT_BLOCK]) for a, v in total.items() for b, at in enumerate(range(0, len(v), MOMENT_BLOCK))]
        return pd.DataFrame({"action": [r[0] for r in rows], "block": [r[1] for r in rows], "v": [r[2] for r in rows]})

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"action": part["action"].iloc[:1], "block": part["block"].iloc[:1], "v": [np.sum(np.stack(part["v"].to_numpy()), axis=0)]})

    def summed(parts: DataFrame) -> dict[int, np.ndarray]:
        """Sums by action of the tasks' blocks ``v``, added as vectors: those of some tasks first, then their sums."""
        some = parts.withColumn("_some", F.pmod(F.spark_partition_id(), F.lit(MOMENT_TASKS)))
        sums = some.groupBy("action", "block", "_some").applyInPandas(add, MOMENTS).groupBy("action", "block").applyInPandas(add, MOMENTS)
        rows = sums.toPandas().sort_values(["action", "block"])
        return {int(a): np.concatenate(own["v"].to_list()) for a, own in rows.groupby("action")}

    def unpacked(v: np.ndarray) -> np.ndarray:
        out = np.zeros((width, width))
        out[upper] = v
        return out + np.triu(out, 1).T

    upper = np.triu_indices(width)

    def second(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            x, action = with_one(batch["obs"]), batch["action"].to_numpy()
            for a in np.unique(action):
                own = x[action == a]
                total[a] = total.get(a, 0) + own.T @ own
        yield packed({a: m[upper] for a, m in total.items()})

    squares = {a: unpacked(v) for a, v in summed(steps.select("action", "obs").mapInPandas(second, MOMENTS)).items()}
    weights = np.zeros((n_actions, width))
    errors: list[float] = []
    for _ in range(iters):
        w = weights.copy()

        def products(batches: Iterator[pd.DataFrame], w: np.ndarray = w) -> Iterator[pd.DataFrame]:
            """Per action: sum of x * y, then number of rows, sum of y, sum of y * y."""
            total: dict[int, np.ndarray] = {}
            for batch in batches:
                if not len(batch):
                    continue
                open_ = (batch["n_done"].to_numpy() != 1) & batch["n_obs"].notna().to_numpy()
                best = np.zeros(len(batch))
                if open_.any():
                    legal = np.stack(batch.loc[open_, "n_mask"].to_numpy()) == 1
                    q = np.where(legal, with_one(batch.loc[open_, "n_obs"]) @ w.T, -np.inf).max(axis=1)
                    best[open_] = np.where(np.isfinite(q), q, 0.0)
                y = batch["n_return"].to_numpy() + gamma ** n_step * best
                x, action = with_one(batch["obs"]), batch["action"].to_numpy()
                for a in np.unique(action):
                    own, label = x[action == a], y[action == a]
                    total[a] = total.get(a, 0) + np.concatenate([own.T @ label, [len(label), label.sum(), label @ label]])
            yield packed(total)

        found = summed(steps.mapInPandas(products, MOMENTS))
        n, sum_y, sum_yy = (sum(v[width + i] for v in found.values()) for i in range(3))
        spread = float(np.sqrt(max(sum_yy / n - (sum_y / n) ** 2, 0.0))) if n else 0.0
        penalty = (reg / spread * n if spread > 0 else reg) * np.eye(width)
        weights = np.zeros((n_actions, width))
        for a, v in found.items():
            weights[a] = np.linalg.solve(squares[a] + penalty, v[:width])
        if track_error and n:
            gap = sum_yy + sum(weights[a] @ squares[a] @ weights[a] - 2 * weights[a] @ v[:width] for a, v in found.items())
            errors.append(float(np.sqrt(max(gap, 0.0) / n)))
    return weights.tolist(), errors
