"""Ordered work on keys that may hold a large share of all rows.

A window partitioned by the entity alone puts all rows of one entity in one task. The helpers
here cut each entity into blocks first (by time, by step number or by sorted range), do the
ordered work per block, and carry a summary of one row per block across the block borders.
Results equal those of the plain window.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.session import cut_lineage, shuffle_width

STEP_BLOCK = 1 << 20
# Rows of one key and hour up to which the hour is one block; a fuller hour is cut further.
HOT_ROWS = 1 << 20
# Number of blocks that rows without a place in the order are dealt to.
LOOSE_BLOCKS = 1 << 20


def hour_block(c: Column | str) -> Column:
    """Number of the hour of a timestamp: the usual time block of an entity."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(F.unix_micros(c.cast("timestamp")) / F.lit(3_600_000_000)).cast("bigint")


def order_blocks(df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = (), most: int = HOT_ROWS) -> DataFrame:
    """Add ``_hour`` and ``_part``: blocks of rows of one key that follow each other in the order of time and ties.

    A block is an hour of a key. Hours of more than ``most`` rows are found by a count that is combined before its shuffle; their rows, and
    no others, are cut further by sorted range, so an entity with all its rows in one hour is spread over many tasks. Rows that are equal in
    time and ties stay together. Rows with a null key or time have no place: their ``_hour`` is null, and they are dealt out by a hash.
    """
    keys, ties = list(keys), list(ties)
    known = F.lit(True)
    for c in (*keys, time):
        known &= F.col(c).isNotNull()
    rows = df.withColumn("_hour", F.when(known, hour_block(time)))
    hashed = [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and f.dataType.simpleString() != "variant"]
    loose = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(LOOSE_BLOCKS)).cast("int")
    alone = F.when(F.col("_hour").isNull(), loose).otherwise(F.lit(0))
    full = (
        rows.filter("_hour IS NOT NULL").groupBy(*keys, "_hour").agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > most)
    )
    if not full.limit(1).count():
        return rows.withColumn("_part", alone)
    full = cut_lineage(full)
    hours, total = full.agg(F.count(F.lit(1)), F.sum("_rows")).first()
    full = full.select(*keys, "_hour", F.lit(True).alias("_full"))
    # At most one row per ``most`` rows of input; beyond what is safe to send, Spark chooses the join.
    marked = rows.join(F.broadcast(full) if hours <= 10_000 else full, [*keys, "_hour"], "left")
    cols = [*df.columns, "_hour"]
    parts = max(shuffle_width(df.sparkSession), -(-total // most))
    cut = (
        marked.filter("_full").select(*cols).repartitionByRange(parts, *keys, time, *ties)
        .withColumn("_part", F.spark_partition_id())
    )
    return marked.filter("_full IS NULL").select(*cols).withColumn("_part", alone).unionByName(cut_lineage(cut))


def segmented_scan(
    df: DataFrame, keys: Sequence[str], time: str, ties: Sequence[str] = (), sums: Mapping[str, Column] | None = None,
    lasts: Mapping[str, str] | None = None, nexts: Mapping[str, str] | None = None, end: str | None = None, most: int = HOT_ROWS,
) -> DataFrame:
    """What a window over each key in the order of time and ties would give, worked out per block of :func:`order_blocks`.

    * ``sums``: inclusive running sums, which serve counts, sums of logs and numbers of zeros alike;
    * ``lasts``: the last known value of a column up to the row;
    * ``nexts``: the value of a column in the next row;
    * ``end``: 1 in the last row of the key, else 0.

    Rows are shuffled once, by key and block. A block's summary (totals, last known values, first row) is one row, combined before
    its shuffle; summaries are combined along the blocks of a key and joined back. Rows with a null key or time are set aside: they stay, with
    null in all added columns, and count for no other row.
    """
    keys, ties = list(keys), list(ties)
    sums, lasts, nexts = dict(sums or {}), dict(lasts or {}), dict(nexts or {})
    block = [*keys, "_hour", "_part"]
    rows = order_blocks(df, keys, time, ties, most)
    order = [F.col(c) for c in (time, *ties)]
    within = Window.partitionBy(*block).orderBy(*order)
    so_far = within.rowsBetween(Window.unboundedPreceding, 0)
    ahead = bool(nexts or end)
    local = rows.withColumns({
        **{f"_sum_{o}": F.sum(w).over(so_far) for o, w in sums.items()},
        **{f"_last_{o}": F.last(c, ignorenulls=True).over(so_far) for o, c in lasts.items()},
        **{f"_next_{o}": F.lead(c).over(within) for o, c in nexts.items()},
        **({"_more": F.lead(F.lit(1)).over(within)} if ahead else {}),
    })
    place = F.struct(*order)
    first = F.min_by(F.struct(F.lit(1).alias("_there"), *[F.col(c).alias(o) for o, c in nexts.items()]), place).alias("_first")
    summary = rows.filter("_hour IS NOT NULL").groupBy(*block).agg(
        *[F.sum(w).alias(f"_total_{o}") for o, w in sums.items()],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), place)).alias(f"_known_{o}") for o, c in lasts.items()],
        *([first] if ahead else []),
    )
    along = Window.partitionBy(*keys).orderBy("_hour", "_part")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    carry = summary.select(
        *block, *[F.sum(f"_total_{o}").over(before).alias(f"_before_{o}") for o in sums],
        *[F.last(f"_known_{o}", ignorenulls=True).over(before).alias(f"_carry_{o}") for o in lasts],
        *([F.lead("_first").over(along).alias("_first")] if ahead else []),
    )
    joined = local.join(carry, block, "left")
    placed = lambda value: F.when(F.col("_hour").isNotNull(), value)
    added = {o: placed(F.col(f"_sum_{o}") + F.coalesce(F.col(f"_before_{o}"), F.lit(0))) for o in sums}
    added |= {o: placed(F.coalesce(f"_last_{o}", f"_carry_{o}")) for o in lasts}
    added |= {o: placed(F.when(F.col("_more") == 1, F.col(f"_next_{o}")).otherwise(F.col("_first")[o])) for o in nexts}
    if end:
        added[end] = placed(F.when(F.col("_more").isNull() & F.col("_first").isNull(), 1).otherwise(0))
    return joined.select(*df.columns, *[value.alias(name) for name, value in added.items()])


def running_sums(
    df: DataFrame, keys: Sequence[str], block: Column, order: Sequence[Column], sums: Mapping[str, Column]
) -> DataFrame:
    """Inclusive running sums per key in the given order.

    ``block`` must not decrease along the order. Keys are not null. The row side is shuffled once,
    by key and block; the carry side has one row per key and block.
    """
    keys = list(keys)
    rows = df.withColumn("_block", block)
    inner = Window.partitionBy(*keys, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    carry = rows.groupBy(*keys, "_block").agg(*[F.sum(w).alias(f"_sum_{out}") for out, w in sums.items()])
    carry = carry.select(
        *keys, "_block", *[F.sum(f"_sum_{out}").over(before).alias(f"_carry_{out}") for out in sums]
    )
    local = rows.withColumns({f"_local_{out}": F.sum(w).over(inner) for out, w in sums.items()})
    joined = local.join(carry, on=[*keys, "_block"], how="left")
    total = {out: F.col(f"_local_{out}") + F.coalesce(F.col(f"_carry_{out}"), F.lit(0)) for out in sums}
    return joined.withColumns(total).select(*df.columns, *sums)


def with_step_blocks(df: DataFrame, step: str, before: int = 0, after: int = 0, size: int = STEP_BLOCK) -> DataFrame:
    """Cut dense step numbers 0, 1, 2, ... into blocks of ``size`` for frames of fixed reach.

    Rows within ``before`` or ``after`` steps of a border are copied into the neighbour block, so that
    any ``lag`` up to ``before`` and ``lead`` up to ``after`` finds its row. ``_home`` is 1 for the row itself
    and 0 for a copy: filter on it after the window.
    """
    # A longer reach takes larger blocks, with the same results.
    while size <= max(before, after):
        size *= 2
    home = F.floor(F.col(step) / F.lit(size)).cast("bigint")
    inside = F.pmod(F.col(step), F.lit(size))
    blocks = [home]
    if after:
        blocks.append(F.when((inside < after) & (home > 0), home - 1))
    if before:
        blocks.append(F.when(inside >= size - before, home + 1))
    copies = F.array_compact(F.array(*blocks)) if len(blocks) > 1 else F.array(home)
    return df.withColumn("_block", F.explode(copies)).withColumn(
        "_home", F.when(F.col("_block") == home, 1).otherwise(0)
    )


def drop_step_blocks(df: DataFrame) -> DataFrame:
    """Remove the copies made by :func:`with_step_blocks`."""
    return df.filter("_home = 1").drop("_block", "_home")


def range_prefix(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: Column, out: str, parts: int | None = None
) -> DataFrame:
    """Inclusive running sum of ``weight`` per key, rows cut by sorted range instead of by key.

    A range partition holds a slice of the global order, so a large key is spread over many tasks.
    The partition number is fixed by a checkpoint. At most one key per partition continues
    from an earlier one, so the carry has no more rows than there are partitions and is broadcast.
    """
    keys, order = list(keys), list(order)
    parts = parts or shuffle_width(df.sparkSession)
    cut = cut_lineage(
        df.withColumn("_weight", weight)
        .repartitionByRange(parts, *keys, *order)
        .withColumn("_part", F.spark_partition_id())
    )
    inner = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        cut.groupBy(*keys, "_part")
        .agg(F.sum("_weight").alias("_sum"))
        .withColumn("_carry", F.sum("_sum").over(before))
        .filter("_carry is not null")
        .select(*keys, "_part", "_carry")
    )
    local = cut.withColumn("_local", F.sum("_weight").over(inner))
    joined = local.join(F.broadcast(carry), on=[*keys, "_part"], how="left")
    return joined.withColumn(out, F.col("_local") + F.coalesce("_carry", F.lit(0))).select(*df.columns, out)


def dense_index(
    df: DataFrame, key: str, out: str, start: int = 0, parts: int | None = None, dtype: str = "bigint"
) -> DataFrame:
    """Numbers ``start + 1, start + 2, ...`` by order of a unique key, without a single-task window.

    Each range partition numbers its own sorted rows; the offsets have one row per partition.
    """
    parts = parts or shuffle_width(df.sparkSession)
    numbered = cut_lineage(
        df.repartitionByRange(parts, key)
        .sortWithinPartitions(key)
        .withColumn("_mono", F.monotonically_increasing_id())
    )
    # The upper bits of the id are the partition number, the lower 33 bits the row number within it.
    split = numbered.select(
        *df.columns,
        F.shiftright("_mono", 33).alias("_part"),
        F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1)).alias("_row"),
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        split.groupBy("_part")
        .agg((F.max("_row") + 1).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        split.join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_offset") + F.col("_row") + 1 + F.lit(start)).cast(dtype))
        .select(*df.columns, out)
    )


def exact_median(df: DataFrame, by: str, value: str, out: str) -> DataFrame:
    """Exact median per group: counts of distinct values, then a range-cut running count."""
    counts = df.filter(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = range_prefix(counts, [by], [value], F.col("_n"), "_cum")
    totals = ranked.groupBy(by).agg(F.sum("_n").alias("_total"))
    low = F.floor((F.col("_total") + 1) / 2)
    high = F.floor(F.col("_total") / 2) + 1
    return (
        ranked.join(totals, by)
        .groupBy(by)
        .agg(
            F.min(F.when(F.col("_cum") >= low, F.col(value))).alias("_low"),
            F.min(F.when(F.col("_cum") >= high, F.col(value))).alias("_high"),
        )
        .select(by, ((F.col("_low") + F.col("_high")) / 2).alias(out))
    )
