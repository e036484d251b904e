"""A lookup table in hash buckets, for readers that ask for few keys at a time.

A version is a folder of buckets, written whole before a pointer names it; a pointer is a small file of its own name, so readers see the
old version or the new one. One writer at a time. A reader that has started on a version can finish: the one before the current stays.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from offerloom.sources.publish import _children, _delete, _read_text, _write_text
from offerloom.sources.tables import _file_system

BUCKETS = 256
_BUCKET = "_bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _versions(spark: SparkSession, root: str) -> list[int]:
    at, system = _file_system(spark, f"{root}/current")
    names = [s.getPath().getName() for s in system.listStatus(at)] if system.exists(at) else []
    return sorted(int(n) for n in names if n.isdigit())


def publish_lookup(df: DataFrame, root: str, key: str = "raw_id", buckets: int = BUCKETS) -> int:
    """Store ``df`` as the next version and return its number. Rows without a key are never found, and go."""
    spark = df.sparkSession
    known = _versions(spark, root)
    # A version that was written but never named is overwritten by the next.
    version = (known[-1] if known else 0) + 1
    rows = df.filter(F.col(key).isNotNull()).withColumn(_BUCKET, bucket_of(F.col(key), buckets))
    rows.hint("rebalance", _BUCKET).write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{root}/versions/{version}")
    _write_text(spark, f"{root}/current/{version}", json.dumps({"key": key, "buckets": buckets, "schema": df.schema.json()}))
    for old in _children(spark, f"{root}/versions"):
        if int(old) < version - 1:
            _delete(spark, f"{root}/versions/{old}")
    return version


def read_lookup(spark: SparkSession, root: str, keys: DataFrame) -> DataFrame:
    """Rows of the current version in the buckets that ``keys`` (one column) falls in; other buckets are not opened.

    Only numbers of buckets come to the driver.
    """
    versions = _versions(spark, root)
    if not versions:
        raise FileNotFoundError(f"no lookup table at {root}")
    about = json.loads(_read_text(spark, f"{root}/current/{versions[-1]}"))
    of = bucket_of(F.col(keys.columns[0]), about["buckets"])
    wanted = [r[0] for r in keys.filter(F.col(keys.columns[0]).isNotNull()).select(of.alias(_BUCKET)).distinct().collect()]
    schema = StructType.fromJson(json.loads(about["schema"])).add(_BUCKET, IntegerType())
    rows = spark.read.schema(schema).parquet(f"{root}/versions/{versions[-1]}")
    return rows.filter(F.col(_BUCKET).isin(wanted)).drop(_BUCKET)
