"""Table scans, writes and layouts on plain parquet folders."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _file_system(spark: SparkSession, path: str):
    """The path and its file system, whatever the path names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    """Is there something at the path? Asks the file system; no table is listed."""
    at, system = _file_system(spark, path)
    return bool(system.exists(at))


def partition_days(spark: SparkSession, path: str, col: str) -> set[date]:
    """Days that a table partitioned by ``col`` has folders for: one listing, no file is opened."""
    at, system = _file_system(spark, path)
    if not system.exists(at):
        return set()
    names = [s.getPath().getName() for s in system.listStatus(at) if s.isDirectory()]
    return {date.fromisoformat(n[len(col) + 1:]) for n in names if re.fullmatch(rf"{col}=\d{{4}}-\d{{2}}-\d{{2}}", n)}


def replace_days(df: DataFrame, path: str, col: str = "date", days: Iterable[date] | None = None, order: Sequence[str] = ()) -> None:
    """Overwrite the days present in ``df``. With ``days`` these are replaced whole: days without rows any more are cleared.

    The new days are staged and then put in place, so a failed write loses none, and the job runs once.
    """
    from offerloom.sources.publish import Publication

    publication = Publication(df.sparkSession, path)
    publication.stage(df, path, col, days or (), order)
    publication.publish()


def ensure_table(spark: SparkSession, path: str, schema: str, parts: Sequence[str] = ()) -> None:
    """Create an empty table unless the path exists. A partitioned one starts as an empty folder with its schema."""
    if not exists(spark, path):
        overwrite(spark.createDataFrame([], schema), path, parts=parts)


def read_table(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A stored table; with a schema, also one that has no rows yet."""
    return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)


def overwrite(df: DataFrame, path: str, n: int | None = None, parts: Sequence[str] = ()) -> None:
    """Replace a table with its schema, in ``n`` files if given."""
    out = df.repartition(n) if n else df
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "static")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)


def append_partitioned(df: DataFrame, path: str, time: str = "time") -> None:
    """Append by ``partition_field``, the day of the time column.

    Rebalancing puts a day in few files, and a day of many rows in several.
    """
    dated = df.withColumn("partition_field", F.to_date(time))
    dated.hint("rebalance", "partition_field").write.mode("append").partitionBy("partition_field").parquet(path)


def write_fact(df: DataFrame, path: str, start: date | None = None) -> None:
    """Replace the dates present in ``df``, sorted by entity inside each date.

    With ``start`` all stored dates from it on are replaced: those that have no rows any more are cleared.
    """
    days = None if start is None else {d for d in partition_days(df.sparkSession, path, "date") if d >= start}
    replace_days(df, path, "date", days, ["enterprise_id"])


def export_files(df: DataFrame, path: str, k: int | None = None) -> None:
    """Training export; ``k`` files when a small consumer asks for it, else the files of the plan."""
    (df.repartition(k) if k else df).write.mode("overwrite").parquet(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def cluster_by(df: DataFrame, col: str, n: int) -> DataFrame:
    """Range clustering by one column, so that a point lookup opens few files.

    Ties are broken by a hash of the row: a value of many rows gets several files instead of one huge one.
    """
    hashable = [f.name for f in df.schema if f.dataType.typeName() not in ("map", "variant")]
    return df.repartitionByRange(n, F.col(col), F.xxhash64(*hashable)).sortWithinPartitions(col)


def table_extent(df: DataFrame, col: str) -> DataFrame:
    """Last and first partition and the row count."""
    return df.agg(F.max(col).alias("end"), F.min(col).alias("start"), F.count(F.lit(1)).alias("n"))
