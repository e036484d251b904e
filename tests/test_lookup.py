"""Lookup tables in buckets."""

import pytest
from pyspark.sql import functions as F

from offerloom.queries.streams import size_scores
from offerloom.session import scratch_path
from offerloom.sources import adapters as A
from offerloom.sources import lookup as K
from offerloom.streaming import streams as Z


def rows(spark, n, tag):
    return spark.range(n).select(F.col("id").cast("string").alias("raw_id"), F.lit(tag).alias("tag")).union(spark.sql("select cast(null as string), 'x'"))


def test_only_wanted_buckets_are_opened(spark):
    root = scratch_path(spark, "lookup")
    with pytest.raises(FileNotFoundError):
        K.read_lookup(spark, root, spark.sql("select '1' as id"))
    assert K.publish_lookup(rows(spark, 500, "old"), root, buckets=32) == 1
    asked = spark.sql("select * from values ('7'), ('7'), (null), ('nobody') as t(id)")
    got = K.read_lookup(spark, root, asked)
    opened = {f.rsplit("/", 2)[1] for f in got.inputFiles()}
    scanned = {r[0] for r in got.select(F.input_file_name()).distinct().collect()}
    assert got.filter("raw_id = '7'").first()["tag"] == "old" and 1 <= len(scanned) <= 2 < len(opened)
    assert "PartitionFilters: [" in got._jdf.queryExecution().toString() and got.columns == ["raw_id", "tag"]
    assert K.read_lookup(spark, root, asked.limit(0)).count() == 0


def test_a_new_version_is_seen_and_old_ones_go(spark):
    root = scratch_path(spark, "lookup-versions")
    K.publish_lookup(rows(spark, 50, "a"), root, buckets=4)
    asked = spark.sql("select '7' as id")
    started = K.read_lookup(spark, root, asked)
    K.publish_lookup(rows(spark, 50, "b"), root, buckets=8)
    assert K.read_lookup(spark, root, asked).filter("raw_id = '7'").first()["tag"] == "b"
    assert started.filter("raw_id = '7'").first()["tag"] == "a"
    # A version that is written but not named is not seen.
    rows(spark, 9, "c").write.parquet(f"{root}/versions/3")
    assert K.read_lookup(spark, root, asked).filter("raw_id = '7'").first()["tag"] == "b"
    assert K.publish_lookup(rows(spark, 50, "d"), root, buckets=4) == 3
    assert K.read_lookup(spark, root, asked).filter("raw_id = '7'").first()["tag"] == "d"
    assert sorted(K._children(spark, f"{root}/versions")) == ["2", "3"]


def test_stream_sees_the_version_of_its_batch(spark, base):
    out = scratch_path(spark, "lookup-stream")
    asked = A.requests(spark, base).limit(40)
    ids = [r["raw_id"] for r in Z.parse_requests(asked).select("raw_id").filter("raw_id is not null").distinct().collect()]
    for n in (1, 2):
        state = spark.createDataFrame([(i, 5, [3] * n, ["s"] * n) for i in ids], "raw_id string, enterprise_id bigint, state_tokenized array<int>, state array<string>")
        K.publish_lookup(state, f"{out}/state", buckets=8)
        asked.coalesce(1).write.mode("append").parquet(f"{out}/requests")
        requests = Z.event_stream(spark, f"{out}/requests", asked.schema)
        Z.decide_stream(requests, f"{out}/state", size_scores, f"{out}/d", f"{out}/e", f"{out}/c", by_bucket=True).awaitTermination()
        done = spark.read.parquet(f"{out}/d/batch_id={n - 1}")
        assert done.count() == asked.count() and {r[0] for r in done.filter("enterprise_id = 5").select(F.size("raw_state")).distinct().collect()} == {n}
