"""Sources, sinks and stream jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from offerloom.operators.policy import decide, decision_record, parse_requests, write_decisions
from offerloom.sources.decision_log import CORRUPT, LOG_WITH_ERRORS, file_date, publish_days
from offerloom.sources.lookup import read_lookup


def event_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet", **options) -> DataFrame:
    """Stream of a folder from its start. ``fmt`` and options may name any installed source.

    ``maxFilesPerTrigger`` (or the like of another source) bounds what one micro-batch holds.
    """
    reader = spark.readStream.format(fmt).options(**options)
    return reader.load() if fmt == "kafka" else reader.schema(schema).load(path)


def bus_messages(df: DataFrame, lateness: str = "1 hour", id_header: str = "message-id") -> DataFrame:
    """Records of a message bus (``key``, ``value``, ``topic``, ``partition``, ``offset``, ``timestamp`` and, if asked for, ``headers``) as messages, each once.

    A bus delivers at least once, and a producer that tries again writes a message twice: messages of one id (the header ``id_header``, else the
    place in the topic) that arrive within ``lateness`` of each other are one. It must cover the longest such delay; rows behind the watermark
    are dropped by Spark. Result: ``message_id``, ``time``, ``key``, ``message`` (text; bytes that are no UTF-8 are replaced), ``topic``, ``partition``,
    ``offset``. A null payload (a tombstone) stays a message without text.
    """
    def decoded(c: Column) -> Column:
        return F.make_valid_utf8(c.cast("string"))

    own = F.concat_ws(":", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    if "headers" in df.columns:
        named = F.filter("headers", lambda h: (h["key"] == id_header) & h["value"].isNotNull())
        own = F.coalesce(decoded(F.get(named, F.lit(0))["value"]), own)
    rows = df.select(
        own.alias("message_id"), F.col("timestamp").alias("time"), decoded(F.col("key")).alias("key"), decoded(F.col("value")).alias("message"),
        "topic", "partition", "offset",
    )
    return rows.withWatermark("time", lateness).dropDuplicatesWithinWatermark(["message_id"])


def write_stream(df: DataFrame, path: str, checkpoint: str, fmt: str = "parquet", mode: str = "append") -> StreamingQuery:
    """Process all that is there, then stop; progress is kept in the checkpoint."""
    return (
        df.writeStream.format(fmt).outputMode(mode).option("path", path)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def write_batches(df: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """As :func:`write_stream`, with a function per micro-batch."""
    return (
        df.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def volume_stream(df: DataFrame, lateness: str | None = "1 hour") -> DataFrame:
    """Decisions per application and day; a day is final once the watermark has passed it. Without ``lateness`` the rows have a watermark already."""
    return (
        (df.withWatermark("time", lateness) if lateness else df)
        .groupBy("app", F.window("time", "1 day"))
        .agg(F.count(F.lit(1)).alias("volume"))
        .select("app", F.col("window.start").cast("date").alias("date"), "volume")
    )


def sessionize_stream(df: DataFrame, gap: str = "30 minutes", lateness: str | None = "1 hour") -> DataFrame:
    """Sessions of an entity, cut where nothing happens for ``gap``. Without ``lateness`` the rows have a watermark already."""
    return (
        (df.withWatermark("time", lateness) if lateness else df)
        .groupBy("enterprise_id", F.session_window("time", gap))
        .agg(F.count(F.lit(1)).alias("events"))
        .select("enterprise_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "events")
    )


def run_and_close(
    df: DataFrame, group: Callable[[DataFrame], DataFrame], path: str, checkpoint: str, markers: str, time: str = "time",
    lateness: str = "1 hour", reach: str = "1 day",
) -> None:
    """Run ``group`` over all of the stream ``df``, then close what is open at its end: the run emits every group itself.

    The stream is joined by a second one, the folder ``markers``. When the input has been read, a marker, a row with nothing but a time, is
    put there, so far ahead that the watermark passes every group: its time is the watermark so far, plus twice the ``lateness`` of the
    watermark, plus the ``reach`` of a group beyond its last row (the length of a window, or the gap of a session). Markers move the watermark and
    are dropped behind it; ``group`` gets the other rows, with the watermark set. Input that comes to the same checkpoint afterwards with
    earlier times is late, as it would be behind any later row.
    """
    spark = df.sparkSession
    marked = df.withColumn("_marker", F.lit(False))
    spark.createDataFrame([], marked.schema).write.mode("append").parquet(markers)

    def run() -> StreamingQuery:
        both = marked.unionByName(spark.readStream.schema(marked.schema).parquet(markers)).withWatermark(time, lateness)
        # The condition names the time, so it is not pushed below the watermark.
        real = both.filter(~F.col("_marker") | F.col(time).isNull()).drop("_marker")
        return write_stream(group(real), path, checkpoint)

    first = run()
    first.awaitTermination()
    reached = [pd.Timestamp(p["eventTime"]["watermark"]) for p in first.recentProgress if "watermark" in (p["eventTime"] or {})]
    if not reached or max(reached).value <= 0:  # nothing has been read
        return
    ahead = 2 * pd.Timedelta(lateness) + pd.Timedelta(reach) + pd.Timedelta("1 second")
    at = F.lit(str(max(reached).tz_convert("UTC").tz_localize(None) + ahead)).cast("timestamp")
    row = [at.alias(f.name) if f.name == time else F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    spark.range(1).select(*row, F.lit(True).alias("_marker")).write.mode("append").parquet(markers)
    run().awaitTermination()


STEP_SCHEMA = "session string, t bigint, time timestamp, action int, reward double, prev_action int, prev_reward double, dones int"
STEP_STATE = "t bigint, prev_action int, prev_reward double"
ENDED_SCHEMA, ENDED_STATE = f"{STEP_SCHEMA}, kind string", f"{STEP_STATE}, latest bigint"


def assemble_episodes_stream(messages: DataFrame, idle: str = "1 hour", ends: bool = False) -> DataFrame:
    """Steps of each session in order of arrival batch and time, with the action and reward before.

    ``messages`` has ``session, time, action, reward, done``. Only a counter and the last action and reward are
    kept per session; a session ends with ``done`` or when it stays idle past the watermark. The messages of a
    session within one micro-batch are ordered in memory: bound the batch at the source.

    With ``ends`` a column ``kind`` tells rows apart. ``end``: a session that went idle, with ``dones`` = 1, the number and the values that its next
    step would have had, and the time at which it counted as idle. ``late``: a message older than one of its session that was
    numbered in an earlier batch; it gets no number, changes none, and belongs in an error table. ``step``: all others.
    """
    idle_ms = int(pd.Timedelta(idle).total_seconds() * 1000)

    whole = {"t": "Int64", "action": "Int32", "prev_action": "Int32", "dones": "Int32", "reward": "Float64", "prev_reward": "Float64"}

    def shown(rows: pd.DataFrame) -> pd.DataFrame:
        out = rows[["session", "t", "time", "action", "reward", "prev_action", "prev_reward", "dones", *(["kind"] if ends else [])]]
        return out.astype(whole)

    def advance(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        t, action, reward, *before = state.get if state.exists else (0, 0, 0.0)
        if state.hasTimedOut:
            state.remove()
            if ends:
                at = pd.Timestamp(before[0], unit="us") + pd.Timedelta(idle)
                yield shown(pd.DataFrame({
                    "session": [key[0]], "t": [t], "time": [at], "action": [None], "reward": [None], "prev_action": [action], "prev_reward": [reward],
                    "dones": [1], "kind": ["end"],
                }))
            return
        latest, done = None, False
        frames = [b for b in batches if len(b)]
        if not frames:
            return
        rows = pd.concat(frames).sort_values("time", kind="stable").reset_index(drop=True)
        if ends and before:
            late = rows["time"] < pd.Timestamp(before[0], unit="us")
            if late.any():
                yield shown(rows[late].assign(t=None, prev_action=None, prev_reward=None, dones=rows["done"], kind="late"))
                rows = rows[~late].reset_index(drop=True)
        if len(rows):
            # A message with done = 1 closes an episode; the next one of the session opens another.
            episode = rows["done"].shift(fill_value=0).cumsum()
            steps = rows.groupby(episode)
            first = episode == 0
            out = rows[["session", "time", "action", "reward"]].copy()
            out["t"] = steps.cumcount() + first * t
            out["prev_action"] = steps["action"].shift()
            out["prev_reward"] = steps["reward"].shift()
            opening = out["prev_action"].isna()
            out.loc[opening, "prev_action"] = first[opening] * action
            out.loc[opening, "prev_reward"] = first[opening] * reward
            out["prev_action"] = out["prev_action"].astype(int)
            out["dones"] = rows["done"]
            last = out.iloc[-1]
            t, action, reward = int(last["t"]) + 1, int(last["action"]), float(last["reward"])
            latest, done = last["time"], bool(last["dones"])
            yield shown(out.assign(kind="step"))
        if done:
            state.remove()
        else:
            newest = [before[0] if latest is None else latest.value // 1000] if ends else []
            state.update((t, action, reward, *newest))
            if latest is None and ends:
                latest = pd.Timestamp(before[0], unit="us")
            if latest is not None:
                floor = state.getCurrentWatermarkMs()
                state.setTimeoutTimestamp(max(int(latest.timestamp() * 1000) + idle_ms, floor + 1))

    return messages.groupBy("session").applyInPandasWithState(
        advance, ENDED_SCHEMA if ends else STEP_SCHEMA, ENDED_STATE if ends else STEP_STATE, "append", GroupStateTimeout.EventTimeTimeout
    )


def decide_stream(
    requests: DataFrame, state: DataFrame | str, q_values, decisions: str, errors: str, checkpoint: str, log: str | None = None,
    encode: Callable | None = None, by_bucket: bool = False, **kw
) -> StreamingQuery:
    """Decide each request; all decisions go to one folder, failed ones also to the error folder.

    With ``log`` those for training go there as decision records, in dated JSON files for the log reader. ``state`` may be the path of the
    stored lookup: it is then read anew for each batch, so the stream sees what the nightly job has written. ``by_bucket``: the path is that of
    :func:`offerloom.sources.lookup.publish_lookup`, and a batch opens the buckets of its own ids alone.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        # A batch writes folders of its own, so a repeated batch replaces itself.
        out, spark = f"{decisions}/batch_id={batch_id}", batch.sparkSession
        if by_bucket:
            known = read_lookup(spark, state, parse_requests(batch).select("raw_id"))
        else:
            known = spark.read.parquet(state) if isinstance(state, str) else state
        decide(batch, known, q_values, **kw).write.mode("overwrite").parquet(out)
        done = spark.read.parquet(out)
        failed = done.filter("error is not null").select("error", "input", "time")
        failed.write.mode("overwrite").parquet(f"{errors}/batch_id={batch_id}")
        if log is not None:
            write_decisions(decision_record(done, encode=encode), f"{log}/batch_id={batch_id}")

    return write_batches(requests, sink, checkpoint)


def ingest_stream(spark: SparkSession, src: str, dst: str, errors: str, checkpoint: str) -> StreamingQuery:
    """Incremental log ingest into the table that the nightly jobs keep: days of new files are read whole and published in one step.

    A late file replaces its day, with all files that the source has of it, and a repeated batch replaces itself. Records of files
    without a date go to a folder of their batch beside the error table.
    """
    raw = (
        spark.readStream.schema(LOG_WITH_ERRORS).option("columnNameOfCorruptRecord", CORRUPT)
        .option("recursiveFileLookup", "true").json(src)
        .withColumn("file_date", file_date(F.col("_metadata.file_path")))
    )

    def sink(batch: DataFrame, batch_id: int) -> None:
        days = sorted((r["file_date"] for r in batch.select("file_date").distinct().collect()), key=str)
        if None in days:
            batch.filter("file_date IS NULL").write.mode("overwrite").parquet(f"{errors}_undated/batch_id={batch_id}")
        dated = [d for d in days if d is not None]
        if dated:
            publish_days(batch.sparkSession, src, dst, dated, errors)

    return write_batches(raw, sink, checkpoint)
