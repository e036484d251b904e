"""The nightly jobs. Each reads tables and writes tables, so each can be run and repeated alone."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.fixed_values import FEATURE_DAYS, REPEAT_CALL_DAYS, STATE_MAX_LEN, STATE_SAMPLE
from offerloom.operators import dispositions as D
from offerloom.operators import episodes as E
from offerloom.operators import rewards as W
from offerloom.operators import sampling as N
from offerloom.operators import state as S
from offerloom.operators.ids import resolve_id
from offerloom.operators.vocabulary import added_tokens, apply_vocabulary, token_name
from offerloom.schemas import DISPOSITION_FACT, REWARD_FACT, VOCABULARY, require
from offerloom.session import shuffle_width
from offerloom.sources import decision_log as L
from offerloom.sources import tables as T


def state_job(
    spark: SparkSession, features: DataFrame, id_map: DataFrame, clients: DataFrame, root: str, as_of: str,
    max_len: int = STATE_MAX_LEN,
) -> None:
    """Dictionary, state of every entity and day, and the extracts of current states.

    New tokens are appended to the dictionary; known ids never change. Everything between the scan and the
    stored state is one plan.
    """
    require(features, "enterprise_id", "date", "date_time", "feature_type", "category", "feature_name", "feature_value")
    rows = S.select_features(features, as_of).withColumn("token_name", token_name())
    tokens_path = f"{root}/tokens"
    T.ensure_table(spark, tokens_path, VOCABULARY)
    known = T.read_table(spark, tokens_path, VOCABULARY)
    added_tokens(rows, "token_name", known).write.mode("append").parquet(tokens_path)
    vocab = T.read_table(spark, tokens_path, VOCABULARY)

    state = S.flag_current(S.state_history(apply_vocabulary(rows, vocab), max_len))
    T.overwrite(T.cluster_by(state, "enterprise_id", shuffle_width(spark)), f"{root}/state")

    stored = T.read_table(spark, f"{root}/state")
    members = id_map.filter("id_type = 'cagm'").select("enterprise_id", F.col("alternative_id").alias("cagm")).distinct()
    current = S.population_state(stored, members.select("enterprise_id"), as_of, FEATURE_DAYS)
    T.overwrite(current.join(members, "enterprise_id").filter("cagm is not null"), f"{root}/state_members")
    lookup = S.state_lookup(stored, id_map)
    T.overwrite(T.cluster_by(lookup, "raw_id", shuffle_width(spark)), f"{root}/state_lookup")
    T.overwrite(S.population_state(stored, clients.select("enterprise_id")), f"{root}/state_clients")
    sample = N.sample_fraction(stored.filter("current_record = 1"), STATE_SAMPLE, 42, "enterprise_id")
    T.export_files(sample, f"{root}/state_train")


def reward_job(spark: SparkSession, calls: DataFrame, id_map: DataFrame, root: str, start: str) -> None:
    """Repeat-call penalties of the days from that of ``start`` on, which are replaced whole.

    The calls of the days before that a penalty can look back to are read too.
    """
    T.ensure_table(spark, f"{root}/rewards", REWARD_FACT, ["date"])
    first = _day(start)
    chosen = calls.filter(
        (F.col("logical_app_name") == "RX") & (F.col("caller_type") == "member")
        & (F.col("start_dtm") >= F.lit(first - timedelta(days=REPEAT_CALL_DAYS)).cast("timestamp"))
    )
    known = resolve_id(chosen, id_map).withColumnRenamed("start_dtm", "date_time")
    recent = W.repeat_penalty(known).filter(F.col("date_time") >= F.lit(first).cast("timestamp"))
    penalties = recent.withColumns({
        "reward_name": F.lit("repeat_call"), "reward_desc": F.lit(f"repeat call within {REPEAT_CALL_DAYS} days"),
    })
    fact = D.to_fact(penalties, "date_time", "org", "ivr", "rx", "call", "reward_name", "reward_desc", "reward_value")
    T.write_fact(fact, f"{root}/rewards", first)


def _day(start: str) -> date:
    return datetime.fromisoformat(start).date()


def disposition_job(
    spark: SparkSession, flags: DataFrame, calls: DataFrame, id_map: DataFrame, root: str, offers=D.CALL_LOG_OFFERS,
    start: str | None = None, app: str | None = None,
) -> None:
    """Offer dispositions by date. With ``start`` only calls of the days from that of ``start`` on are read, and these days are replaced
    whole; with ``app`` only calls of that application."""
    T.ensure_table(spark, f"{root}/dispositions", DISPOSITION_FACT, ["date"])
    first = None if start is None else _day(start)
    if app is not None:
        calls = calls.filter(F.col("logical_app_name") == app)
    if first is not None:
        calls = calls.filter(F.col("start_dtm") >= F.lit(first).cast("timestamp"))
    if app is not None or first is not None:
        flags = flags.join(calls.select("call_guid").distinct(), "call_guid", "left_semi")
    wide = D.chain_flags(D.rollup_flags(flags, "call_guid", offers), "call_guid", offers)
    rows = D.attach_call(D.dispositions(wide, "call_guid"), calls, "cagm", "start_dtm")
    fact = D.to_fact(resolve_id(rows, id_map), "start_dtm", "org", "ivr", "rx", "call", "offer", *D.DISPOSITIONS)
    T.write_fact(fact, f"{root}/dispositions", first)


def log_job(spark: SparkSession, src: str, root: str, as_of: date) -> None:
    """New days of the decision log, then the last days once more."""
    fresh = L.ingest_new_dates(spark, src, f"{root}/decisions", f"{root}/decision_errors")
    if fresh or T.exists(spark, f"{root}/decisions"):
        L.reingest_recent(spark, src, f"{root}/decisions", as_of, errors=f"{root}/decision_errors")


def episode_job(spark: SparkSession, root: str, encode, min_len: int = 1) -> None:
    """Training episodes from the log, the rewards and the states. ``encode`` maps the token column to a vector."""
    rewards = W.combine_rewards(
        T.read_table(spark, f"{root}/rewards", REWARD_FACT), T.read_table(spark, f"{root}/dispositions", DISPOSITION_FACT)
    )
    log = spark.read.parquet(f"{root}/decisions").filter("enterprise_id is not null")
    steps = E.steps_with_rewards(log, rewards)
    known = S.attach_state_asof(steps, T.read_table(spark, f"{root}/state")).filter("state_tokenized is not null")
    # Stored once: what follows reads the encoded steps more than once.
    encoded = known.withColumn("obs", encode(F.col("state_tokenized"))).drop("state_tokenized").fillna(0, ["rewards"])
    T.overwrite(encoded, f"{root}/episode_steps")
    stored = T.read_table(spark, f"{root}/episode_steps")
    moved = E.with_transitions(stored, "enterprise_id", "time", ["implementation", "action"], ["obs"])
    T.overwrite(E.with_dense_id(E.min_episode_length(moved, "enterprise_id", min_len), "enterprise_id"), f"{root}/episodes")
