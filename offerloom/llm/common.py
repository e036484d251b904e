"""Helpers shared by the text operators: scratch tables, table reads, connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerloom.session import scratch_path, shuffle_width

# Code points that separate words and that exact comparison leaves out (fixed values of the contract).
BLANKS = r"[\x20\x09-\x0D]"
NOT_BLANKS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{base}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new table below the shared checkpoint folder and read it back.

    Cuts the lineage, survives the loss of executors, and unlike a checkpoint it lets later scans prune columns and
    lets the planner see the size.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hashed(df: DataFrame) -> DataFrame:
    """A table of narrow rows for a join with texts: texts are shuffled once and not sorted, in one way at every size."""
    return df.hint("shuffle_hash")


def release() -> None:
    """Give memory that a task no longer uses back to the system; its worker waits for the next task beside a large JVM."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # GNU systems have it
    if trim is not None:
        trim(0)


def slices(batch: pa.RecordBatch, size: int, text: int = 1) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of about ``size`` bytes in column number ``text``; one text is never cut."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(batch):
        before = int(ends[start - 1]) if start else 0
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield batch.slice(start, end - start)
        start = end


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(c, UPPER, LOWER)


def prefix_sums(df: DataFrame, keys: list[str], order: list[str], weight: Column, out: str) -> DataFrame:
    """Running sum of ``weight`` per key in the given order, the row itself included; rows are cut by sorted range, not by key.

    A large key is spread over many ranges. The range of a row is fixed by a written table; what a range adds to those after it is one row per
    range and key, of which only keys that go on into a later range matter.
    """
    part, total, carry = unused(df, "_part"), unused(df, "_total"), unused(df, "_carry")
    parts = shuffle_width(df.sparkSession)
    cut = df.withColumn(total, weight).repartitionByRange(parts, *keys, *order).withColumn(part, F.spark_partition_id())
    cut = materialize(cut, "ranges")
    inner = Window.partitionBy(*keys, part).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*keys, part).agg(F.sum(total).alias(total))
    carried = sums.select(*keys, part, F.sum(total).over(earlier).alias(carry)).filter(F.col(carry).isNotNull())
    joined = cut.withColumn(total, F.sum(total).over(inner)).join(carried, [*keys, part], "left")
    return joined.withColumn(out, F.col(total) + F.coalesce(F.col(carry), F.lit(0))).select(*df.columns, out)


def numbered(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """Number 0, 1, 2, ... per key in the given order."""
    return prefix_sums(df, keys, order, F.lit(1).cast("bigint"), out).withColumn(out, F.col(out) - 1)


def _edge_state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable node of every node that has a link: columns ``node``, ``component``.

    ``links`` has two columns of ids, in either direction and with repeats. Alternates large-star and small-star steps
    (Kiveris et al., "Connected Components in MapReduce and Beyond"): each step is one grouped minimum and one join, so
    no neighbourhood is ever collected. The number of rounds grows with the logarithm of the longest path. Each round
    is written to the shared folder; only a count and a checksum reach the driver.
    """
    a, b = links.columns
    edges = (
        links.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct()
    )
    edges = materialize(edges, name)
    state = _edge_state(edges)
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        )
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = (
            joined.filter("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = materialize(small, name)
        now = _edge_state(edges)
        if now == state:
            break
        state = now
    # Every edge now leads to the smallest node of its component, which is added itself.
    return edges.union(edges.select("v", "v")).groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component"))
