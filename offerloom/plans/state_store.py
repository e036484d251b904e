"""States kept up to date: a night reads its own tokens and what it stored of the entities they belong to.

Three tables below a root, published together:

* ``state_days``, by date: the bounded summary of an entity's day (its newest tokens and the token count). Summaries merge: tokens are
  joined, sorted and cut, counts are added.
* ``state``, by date: the state at the end of each day, as :func:`offerloom.operators.state.state_history` gives it.
* ``state_current``, by a hash of the entity: its newest tokens, their count and the last day, one row per entity.

An entity whose new days all lie after its last one goes on from its current row, and no older day of it is read. One with late tokens is built
anew from its day summaries, and the dates whose rows change are rewritten. A date that is stored already keeps the rows of other entities.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.fixed_values import STATE_MAX_LEN
from offerloom.functions import tail
from offerloom.operators.state import bounded_days, history_of_days
from offerloom.session import scratch_path
from offerloom.sources.publish import Publication, recover
from offerloom.sources.tables import exists, partition_days, read_table

# Buckets of the current states: a night rewrites those that its entities fall into.
BUCKETS = 64
KEY = ["enterprise_id", "date"]


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _bucket() -> Column:
    return F.pmod(F.xxhash64("enterprise_id"), F.lit(BUCKETS)).cast("int")


def _table(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """A table of the store; empty, with the columns of ``like``, before the first night."""
    return spark.read.schema(like.schema).parquet(path) if exists(spark, path) else like.limit(0)


def _of_days(spark: SparkSession, path: str, rows: DataFrame, dates: list[date]) -> DataFrame | None:
    """Rows stored under these dates; no other folder is opened."""
    found = sorted(set(dates) & partition_days(spark, path, "date"))
    if not found:
        return None
    table = spark.read.schema(rows.schema).option("basePath", path).parquet(*[f"{path}/date={d}" for d in found])
    return table.select(*rows.columns)


def _dates(df: DataFrame) -> list[date]:
    return [r["date"] for r in df.select("date").distinct().collect()]  # bounded by the calendar


def add_tokens(spark: SparkSession, tokens: DataFrame, root: str, max_len: int = STATE_MAX_LEN) -> None:
    """Take in tokens that the store has not seen, of new days or late ones."""
    recover(spark, root)
    days_path, state_path, current_path = f"{root}/state_days", f"{root}/state", f"{root}/state_current"
    known = tokens.filter("enterprise_id IS NOT NULL AND date IS NOT NULL")
    fresh = _stored(bounded_days(known, max_len).select(*KEY, "_day", F.col("size").cast("bigint").alias("size")), "state-fresh")
    touched = fresh.groupBy("enterprise_id").agg(F.min("date").alias("_first"))

    like = fresh.select("enterprise_id", "date", F.col("_day").alias("_tail"), F.col("size").alias("cum_size"), F.lit(0).alias("bucket"))
    current = _table(spark, current_path, like)
    found = touched.withColumn("bucket", _bucket()).join(current, ["enterprise_id", "bucket"], "left")
    found = _stored(found.withColumn("_late", F.coalesce(F.col("_first") <= F.col("date"), F.lit(False))), "state-touched")

    # Entities that go on from their current row, which stands for all days before.
    base = found.filter("NOT _late AND date IS NOT NULL").select(*KEY, F.col("_tail").alias("_day"), F.col("cum_size").alias("size"))
    going = found.filter("NOT _late").select("enterprise_id", F.col("date").alias("_last"))
    own = fresh.join(going.select("enterprise_id"), "enterprise_id", "left_semi")
    rows = _history(own.unionByName(base), max_len).join(going, "enterprise_id").filter("_last IS NULL OR date > _last").drop("_last")
    summaries = own

    if found.filter("_late").limit(1).count():
        late = found.filter("_late").select("enterprise_id", "_first")
        old = spark.read.schema(fresh.schema).parquet(days_path).select(*fresh.columns)
        every = fresh.unionByName(old).join(late.select("enterprise_id"), "enterprise_id", "left_semi")
        merged = every.groupBy(*KEY).agg(
            tail(F.sort_array(F.flatten(F.collect_list("_day"))), max_len).alias("_day"), F.sum("size").alias("size")
        )
        merged = _stored(merged, "state-merged")
        rows = rows.unionByName(_history(merged, max_len).join(late, "enterprise_id").filter(F.col("date") >= F.col("_first")).drop("_first"))
        changed = fresh.select(*KEY).join(late.select("enterprise_id"), "enterprise_id", "left_semi")
        summaries = summaries.unionByName(merged.join(changed, KEY, "left_semi"))

    rows = _stored(rows, "state-rows")
    state = rows.drop("_tail")
    publication = Publication(spark, root)
    for new, path in ((state, state_path), (summaries.select(*fresh.columns), days_path)):
        beside = _of_days(spark, path, new, _dates(new))
        out = new if beside is None else beside.join(new.select(*KEY), KEY, "left_anti").unionByName(new)
        publication.stage(out, path, "date", order=["enterprise_id"])
    newest = rows.groupBy("enterprise_id").agg(F.max_by(F.struct("date", "_tail", "cum_size"), "date").alias("_c"))
    newest = newest.select("enterprise_id", "_c.*", _bucket().alias("bucket"))
    buckets = [r["bucket"] for r in newest.select("bucket").distinct().collect()]  # at most BUCKETS
    others = current.filter(F.col("bucket").isin(buckets)).join(touched, "enterprise_id", "left_anti")
    publication.stage(others.select(*newest.columns).unionByName(newest), current_path, "bucket", order=["enterprise_id"])
    publication.publish()


def _history(days: DataFrame, max_len: int) -> DataFrame:
    return history_of_days(days, max_len, tail_as="_tail")


def stored_history(spark: SparkSession, root: str) -> DataFrame:
    """All states of the store, as ``state_history`` has them."""
    return read_table(spark, f"{root}/state")


def current_states(spark: SparkSession, root: str) -> DataFrame:
    """The state of every entity at the end of its last day."""
    rows = read_table(spark, f"{root}/state_current")
    return rows.select(
        "enterprise_id", "date", F.col("_tail.token_name").alias("state"), F.col("_tail.token").alias("state_tokenized"), "cum_size",
        F.lit(1).alias("current_record"),
    )
