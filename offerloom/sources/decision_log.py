"""Decision log: JSON files named ``<session>_<yyyy-MM-dd HHmmss>.json``, or in folders by date, ingested by date."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.fixed_values import REPROCESS_DAYS
from offerloom.schemas import DECISION_LOG
from offerloom.sources.publish import Publication, recover
from offerloom.sources.tables import partition_days

CORRUPT = "_corrupt_record"
LOG_WITH_ERRORS = f"{DECISION_LOG}, {CORRUPT} string"


def file_date(path: Column) -> Column:
    """Date in the name of a log file, or of its folder; NULL if there is none. Names may come URL-encoded."""
    text = F.regexp_extract(path, r"(?:_|/|=)(\d{4}-\d{2}-\d{2})[^/]*(?:/[^/]*)?$", 1)
    return F.try_to_timestamp(F.nullif(text, F.lit("")), F.lit("yyyy-MM-dd")).cast("date")


def read_decisions(spark: SparkSession, *paths: str) -> DataFrame:
    """The 26 log columns, the text of malformed records, and the date of the file."""
    raw = spark.read.schema(LOG_WITH_ERRORS).option("columnNameOfCorruptRecord", CORRUPT).json(list(paths))
    return raw.select(*raw.columns[:27], file_date(F.col("_metadata.file_path")).alias("file_date"))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records, and those that are malformed, undated or of another day than their file.

    The second part belongs in an error table: files stay where they are, and nothing is lost.
    """
    good = F.col(CORRUPT).isNull() & F.coalesce(F.to_date("time") == F.col("file_date"), F.lit(False))
    return df.filter(good).drop(CORRUPT, "file_date"), df.filter(~good)


def source_dates(spark: SparkSession, src: str) -> DataFrame:
    """Distinct dates of the log files: names only, the contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src)
    return files.select(file_date(F.col("path")).alias("partition_field")).where("partition_field is not null").distinct()


def loaded_dates(spark: SparkSession, *tables: str | None) -> set[date]:
    """Days that the target or the error table holds, from the names of their folders."""
    return set().union(*(partition_days(spark, t, "partition_field") for t in tables if t))


def _day_globs(src: str, days: list[date]) -> list[str]:
    return [f"{src}/{{*_{d}*,*={d}/*,{d}/*}}" for d in days]


def _read_days(spark: SparkSession, src: str, days: list[date]) -> tuple[DataFrame, DataFrame]:
    return split_valid(read_decisions(spark, *_day_globs(src, days)))


def publish_days(spark: SparkSession, src: str, dst: str, days: list[date], errors: str | None = None) -> None:
    """Read the log files of whole days and replace these days: good records in the target, the others in the error table, in one step.

    Records of another day than their file go to the error table, so no other day is touched; a day that has no records left is
    cleared. A repeated run leaves one copy.
    """
    good, bad = _read_days(spark, src, days)
    publication = Publication(spark, dst)
    publication.stage(good.withColumn("partition_field", F.to_date("time")), dst, "partition_field", days)
    if errors:
        publication.stage(bad.withColumn("partition_field", F.col("file_date")), errors, "partition_field", days)
    publication.publish()


def ingest_new_dates(spark: SparkSession, src: str, dst: str, errors: str | None = None) -> list[date]:
    """Take in the dates of the source that the target does not have. Returns them.

    Only days come to the driver, and only files of new days are opened. A day counts as loaded if the target or the error table
    has it, so a day of nothing but bad records is read once; both appear together, or neither does.
    """
    recover(spark, dst)
    found = {r["partition_field"] for r in source_dates(spark, src).collect()}
    days = sorted(found - loaded_dates(spark, dst, errors))
    if days:
        publish_days(spark, src, dst, days, errors)
    return days


def reingest_recent(
    spark: SparkSession, src: str, dst: str, as_of: date, days: int = REPROCESS_DAYS, errors: str | None = None
) -> list[date]:
    """Replace whole days from ``as_of - days`` on, to catch records that came late."""
    start = as_of - timedelta(days=days)
    recent = source_dates(spark, src).filter(F.col("partition_field") >= F.lit(start))
    found = sorted(r["partition_field"] for r in recent.collect())
    if found:
        publish_days(spark, src, dst, found, errors)
    return found
