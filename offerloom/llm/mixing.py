"""Mixing sources to target weights by systematic sampling.

Every source gets a target in words. A document's expected copies are target / source size, the same for all documents
of the source. The expected copies are summed along the source in order of size and id, one random offset is added, and a
document is emitted once for each integer that the sum crosses. So each document gets the expected number rounded down or up,
and since the order goes by size, the words taken stay close to the target.

The prefix sum is cut by sorted range (``prefix_sums``), so a source with a third of all rows is spread over many tasks.
Targets are solved by water filling over the table of sources: one row per source.

Defined results: a null text has size 0; a null source is a source of its own, last in order; a source without words
has target 0 and gives nothing; of a long text only the words are counted, it is never held or cut; rows repeat as they come, each is a document; an empty table gives an empty result. Input columns with names of this
operator's output are not read except id, text and source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import NOT_BLANKS, materialize, prefix_sums

WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
SEED = 17


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(NOT_BLANKS)).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Target words per source: ``sources`` has ``source`` and ``source_size``.

    Shares go by weight; where a share exceeds ``cap`` times the size it stops there, and the excess is shared by weight
    among the others until none is above. That is water filling: in order of cap / weight, the sources up to some place are full and
    the rest share what is left by weight. One row per source, so the plain window is small.
    """
    every = Window.partitionBy()
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (F.pmod(F.col("_place"), len(weights)) + 1).cast("int"))
    full = Window.orderBy(F.col("_limit") / F.col("weight"), "_place").rowsBetween(Window.unboundedPreceding, -1)
    rows = (
        sources.withColumn("_place", F.row_number().over(order) - 1)
        .withColumn("weight", weight)
        .withColumn("_limit", F.col("source_size") * cap)
        .withColumn("_goal", F.sum("source_size").over(every) * F.lit(share))
        .withColumn("_all", F.sum("weight").over(every))
        .withColumn("_left", F.col("_goal") - F.coalesce(F.sum("_limit").over(full), F.lit(0)))
        .withColumn("_open", F.col("_all") - F.coalesce(F.sum("weight").over(full), F.lit(0)))
        .withColumn("_level", F.col("_left") / F.col("_open"))
        # The first source that is not full sets the level for itself and all after it.
        .withColumn("_free", F.min(F.when(F.col("_level") * F.col("weight") <= F.col("_limit"), F.col("_limit") / F.col("weight"))).over(every))
        .withColumn(
            "_at",
            F.min(F.when(F.col("_limit") / F.col("weight") == F.col("_free"), F.col("_level"))).over(every),
        )
        .withColumn(
            "target",
            F.when(F.col("_free").isNull() | (F.col("_limit") / F.col("weight") < F.col("_free")), F.col("_limit").cast("double"))
            .otherwise(F.least(F.col("_limit").cast("double"), F.col("_at") * F.col("weight"))),
        )
    )
    return rows.select("source", "source_size", "weight", "target")


def offset(seed: int, source: Column) -> Column:
    """One repeatable number in (0, 1) per source."""
    named = F.concat_ws(":", F.coalesce(F.concat(F.lit("s"), source), F.lit("null")), F.lit(str(seed)))
    return (F.conv(F.substring(F.md5(named), 1, 8), 16, 10).cast("long") + F.lit(0.5)) / F.lit(4294967296.0)


def mix(
    df: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, cap: int = CAP, seed: int = SEED,
    id: str = "doc_id", text: str = "text", source: str = "source", keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per document: ``id``, ``size``, ``source_size``, ``target``, ``copies``, ``taken``, and the columns ``keep``."""
    base = materialize(
        df.select(
            F.col(id).alias("_id"), F.col(source).cast("string").alias("source"), word_count(F.col(text)).alias("size"),
            F.struct(*[F.col(c) for c in keep]).alias("_keep") if keep else F.lit(None).cast("boolean").alias("_keep"),
        ),
        "mix",
    )
    goals = targets(base.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    # A key without nulls for the cut by range.
    keyed = base.withColumn("_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n")))
    ranked = prefix_sums(keyed, ["_key"], ["size", "_id"], F.lit(1).cast("long"), "_rank")
    goals = goals.withColumn("_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("n"))).drop("source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    crossed = lambda rank: F.floor(F.col("_rate") * rank + F.col("_u"))
    return (
        ranked.join(goals, "_key")
        .withColumn("_rate", rate)
        .withColumn("_u", offset(seed, F.col("source")))
        .withColumn("copies", (crossed(F.col("_rank")) - crossed(F.col("_rank") - 1)).cast("long"))
        .select(
            F.col("_id").alias(id), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
            *[F.col(f"_keep.{c}").alias(c) for c in keep],
        )
    )


def repeat_by_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Emit every document as often as its ``copies`` say."""
    return mixed.select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("_copy")).drop("_copy")


MIX_SQL = rf"""
WITH d AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents
), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
    FROM d GROUP BY source
), w AS (
    SELECT *, [{", ".join(map(str, WEIGHTS))}][1 + place % {len(WEIGHTS)}] AS weight, source_size * {CAP} AS lim FROM s
), f AS (
    SELECT *, (sum(source_size) OVER () * {SHARE}::DOUBLE - coalesce(sum(lim) OVER b, 0))
              / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0)) AS level
    FROM w WINDOW b AS (ORDER BY lim / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), e AS (
    SELECT *, min(CASE WHEN level * weight <= lim THEN lim / weight END) OVER () AS free FROM f
), g AS (
    SELECT *, min(CASE WHEN lim / weight = free THEN level END) OVER () AS lev FROM e
), t AS (
    SELECT source, source_size,
           CASE WHEN free IS NULL OR lim / weight < free THEN CAST(lim AS DOUBLE) ELSE least(CAST(lim AS DOUBLE), lev * weight) END AS target,
           (('0x' || substr(md5(coalesce('s' || source, 'null') || ':{SEED}'), 1, 8))::BIGINT + 0.5) / 4294967296.0 AS u
    FROM g
), r AS (
    SELECT d.doc_id, d.size, t.source_size, t.target, t.u,
           CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
           row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS rank
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       CAST((floor(rate * rank + u) - floor(rate * (rank - 1) + u)) * size AS BIGINT) AS taken
FROM r"""
