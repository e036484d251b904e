"""Episodes: ordered steps of an entity with what comes next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.functions import concat_obs, log_softmax, pick, softmax
from offerloom.operators.blocks import (
    HOT_ROWS, STEP_BLOCK, dense_index, drop_step_blocks, range_prefix, segmented_scan, with_step_blocks,
)

TRAINING_COLUMNS = (
    "agent_index", "eps_id", "t", "actions", "obs", "rewards", "dones", "new_obs", "action_prob", "action_logp",
    "mask", "new_mask",
)


def steps_with_rewards(log: DataFrame, rewards: DataFrame) -> DataFrame:
    """Logged steps plus one step per daily reward total, in one column layout.

    Entity ids are text in the log and numbers in the rewards; ids that are not numbers belong to no entity.
    """
    entity = F.expr("try_cast(enterprise_id AS bigint)").alias("enterprise_id")
    steps = log.select(
        "implementation", entity, F.to_date("time").alias("date"), "time", F.get("actions", F.lit(0)).alias("action"),
        "actions", "action_prob", "action_logp", "rewards",
    )
    totals = rewards.select(
        F.col("source").alias("implementation"), entity, "date", F.to_timestamp("date").alias("time"),
        F.lit(0).alias("action"), F.array(F.lit(0)).alias("actions"),
        F.lit(None).cast("double").alias("action_prob"), F.lit(None).cast("double").alias("action_logp"),
        F.col("rewards").cast("double").alias("rewards"),
    )
    return steps.unionByName(totals).filter("enterprise_id is not null")


def with_steps(df: DataFrame, key: str, time: str, *ties: str, by_range: bool = False, most: int = HOT_ROWS) -> DataFrame:
    """Step number ``t`` = 0, 1, ... by time, then the tie columns; null for rows without key or time.

    Entities are cut by the hour, and hours of more than ``most`` rows further. With ``by_range`` all rows are cut by sorted range instead.
    """
    if by_range:
        # Rows without key or time count for none.
        known = F.col(key).isNotNull() & F.col(time).isNotNull()
        counted = range_prefix(df, [key], [time, *ties], F.when(known, 1).otherwise(0), "_n")
        return counted.withColumn("t", F.when(known, F.col("_n") - 1).cast("bigint")).drop("_n")
    counted = segmented_scan(df, [key], time, ties, sums={"_n": F.lit(1)}, most=most)
    return counted.withColumn("t", (F.col("_n") - 1).cast("bigint")).drop("_n")


def with_next(df: DataFrame, key: str, cols: Sequence[str], size: int = STEP_BLOCK) -> DataFrame:
    """``new_<col>``: value of the next step, else the last known value up to this step. Adds ``dones`` too."""
    blocks = with_step_blocks(df, "t", after=1, size=size)
    within = Window.partitionBy(key, "_block").orderBy("t")
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    local = blocks.withColumns({
        **{f"_next_{c}": F.lead(c).over(within) for c in cols},
        **{f"_last_{c}": F.last(c, ignorenulls=True).over(so_far) for c in cols},
        "dones": F.when(F.lead("t").over(within).isNull(), 1).otherwise(0),
    })
    # Last known value of the blocks before, one row per entity and block.
    before = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    home = F.floor(F.col("t") / F.lit(size)).cast("bigint")
    carry = df.groupBy(key, home.alias("_block")).agg(
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("t"))).alias(c) for c in cols]
    ).select(key, "_block", *[F.last(c, ignorenulls=True).over(before).alias(f"_carry_{c}") for c in cols])
    joined = drop_home(local).join(carry, [key, "_block"], "left")
    return joined.select(
        *df.columns,
        *[F.coalesce(f"_next_{c}", f"_last_{c}", f"_carry_{c}").alias(f"new_{c}") for c in cols],
        "dones",
    )


def with_transitions(df: DataFrame, key: str, time: str, ties: Sequence[str], cols: Sequence[str], most: int = HOT_ROWS) -> DataFrame:
    """``t``, ``new_<col>`` and ``dones`` in one go, as :func:`with_steps` and :func:`with_next` give them.

    Rows without key or time are set aside: they stay, with null in these columns.
    """
    scanned = segmented_scan(
        df, [key], time, ties, sums={"_n": F.lit(1)}, lasts={f"_known_{c}": c for c in cols}, nexts={f"_ahead_{c}": c for c in cols},
        end="dones", most=most,
    )
    return scanned.select(
        *df.columns, (F.col("_n") - 1).cast("bigint").alias("t"),
        *[F.coalesce(f"_ahead_{c}", f"_known_{c}").alias(f"new_{c}") for c in cols], "dones",
    )


def drop_home(df: DataFrame) -> DataFrame:
    return df.filter("_home = 1").drop("_home")


def with_dones(df: DataFrame, key: str, size: int = STEP_BLOCK) -> DataFrame:
    """1 on the last step of each episode, else 0."""
    blocks = with_step_blocks(df, "t", after=1, size=size)
    following = F.lead("t").over(Window.partitionBy(key, "_block").orderBy("t"))
    return drop_step_blocks(blocks.withColumn("dones", F.when(following.isNull(), 1).otherwise(0)))


def with_previous(df: DataFrame, key: str, cols: Sequence[str], size: int = STEP_BLOCK) -> DataFrame:
    """``prev_<col>``: value one step before, 0 at the start."""
    blocks = with_step_blocks(df, "t", before=1, size=size)
    within = Window.partitionBy(key, "_block").orderBy("t")
    return drop_step_blocks(blocks.withColumns({f"prev_{c}": F.lag(c, 1, 0).over(within) for c in cols}))


def n_step_return(df: DataFrame, key: str, n: int, gamma: float, obs: str = "obs", size: int = STEP_BLOCK) -> DataFrame:
    """Discounted reward of the next ``n`` steps, the observation ``n`` steps on, and whether it is beyond the end."""
    blocks = with_step_blocks(df, "t", after=n, size=size)
    within = Window.partitionBy(key, "_block").orderBy("t")
    total: Column = F.coalesce("rewards", F.lit(0.0))
    for k in range(1, n):
        total = total + F.coalesce(F.lead("rewards", k).over(within), F.lit(0.0)) * (gamma ** k)
    return drop_step_blocks(blocks.withColumns({
        "n_return": total,
        f"n_{obs}": F.lead(obs, n).over(within),
        "n_done": F.when(F.lead("t", n).over(within).isNull(), 1).otherwise(0),
    }))


def min_episode_length(df: DataFrame, key: str, k: int) -> DataFrame:
    """Episodes with at least ``k`` steps, for any ``k``: last step numbers are grouped (combined before the shuffle) and joined back."""
    long = df.groupBy(key).agg(F.max("t").alias("_last")).filter(F.col("_last") >= k - 1).select(key)
    return df.join(long, key, "left_semi").select(*df.columns)


def with_dense_id(df: DataFrame, key: str, out: str = "eps_id") -> DataFrame:
    """Whole-number episode ids 0, 1, ... by key order."""
    ids = dense_index(df.select(key).where(F.col(key).isNotNull()).distinct(), key, "_id")
    return df.join(ids, key).withColumn(out, F.col("_id") - 1).drop("_id")


def with_action_values(df: DataFrame) -> DataFrame:
    """Probability, log probability and q-value of the logged action."""
    return df.withColumns({
        "action_prob": pick(softmax("logits"), "action"),
        "action_logp": pick(log_softmax("logits"), "action"),
        "q_value": pick("q_values", "action"),
    })


def training_columns(df: DataFrame) -> DataFrame:
    """The twelve columns that training reads; the scan is pruned to them."""
    return df.select(*[c for c in TRAINING_COLUMNS if c in df.columns])


def episode_records(df: DataFrame, chunk: int = 1000) -> DataFrame:
    """Episodes as records with ordered steps; the observation is mask plus state vector.

    An episode longer than ``chunk`` steps goes on in further records, so no record grows without bound.
    """
    steps = df.select(
        "eps_id", F.floor(F.col("t") / chunk).cast("int").alias("part"),
        F.struct(
            "t", "agent_index", "actions", concat_obs(F.col("mask"), F.col("obs")).alias("obs"), "rewards", "dones",
            concat_obs(F.col("new_mask"), F.col("new_obs")).alias("new_obs"), "action_prob", "action_logp",
        ).alias("step"),
    )
    return steps.groupBy("eps_id", "part").agg(F.sort_array(F.collect_list("step")).alias("steps"))
