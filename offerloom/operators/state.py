"""Token-sequence state of each entity, per day and current."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerloom.fixed_values import FEATURE_DAYS, SESSION_DAYS, STATE_MAX_LEN
from offerloom.functions import tail
from offerloom.operators.blocks import HOT_ROWS, segmented_scan


def select_features(df: DataFrame, as_of: str, days: int = FEATURE_DAYS) -> DataFrame:
    """Session events of any age, plus demographics of the last ``days`` days.

    The date limit belongs to the demographics alone, as the original condition binds.
    """
    recent = F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days)
    return df.filter((F.col("feature_type") == "session_event") | ((F.col("category") == "demographics") & recent))


def select_sessions(df: DataFrame, as_of: str, days: int = SESSION_DAYS) -> DataFrame:
    """Sessions other than text messages in the look-back window."""
    recent = F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days)
    return df.filter((F.col("event_type") != "text") & recent)


def daily_state(tokens: DataFrame, part_len: int = 10_000, most: int = HOT_ROWS) -> DataFrame:
    """Ordered token names and ids, one row per entity, day and part: that is the key of the table.

    A part holds up to ``part_len`` tokens, so no group grows without bound; an ordinary day is part 0 alone. ``size`` counts the
    tokens of the row. Tokens without entity, day or time have no place and are left out.
    """
    ranked = segmented_scan(
        tokens.select("enterprise_id", "date", "date_time", "token_name", "token"), ["enterprise_id", "date"], "date_time",
        ["token_name", "token"], sums={"_pos": F.lit(1)}, most=most,
    ).filter("_pos IS NOT NULL")
    grouped = (
        ranked.withColumn("part", F.floor((F.col("_pos") - 1) / part_len).cast("int"))
        .groupBy("enterprise_id", "date", "part")
        .agg(F.sort_array(F.collect_list(F.struct("date_time", "token_name", "token"))).alias("_day"))
    )
    return grouped.select(
        "enterprise_id", "date", "part",
        F.col("_day.token_name").alias("state"), F.col("_day.token").alias("state_tokenized"),
        F.size("_day").alias("size"),
    )


def bounded_days(tokens: DataFrame, max_len: int, newest: bool = True) -> DataFrame:
    """Per entity and day: token count ``size``, and in ``_day`` at most ``max_len`` tokens from the wanted end, in order.

    The rank is alone in its window and filtered at once, so Spark keeps ``max_len`` tokens of a day in each task before the
    shuffle, and the count is combined before its own: no entity, day or hour makes a task large.
    """
    cols = ["date_time", "token_name", "token"]
    day = ["enterprise_id", "date"]
    order = [F.col(c).desc() if newest else F.col(c).asc() for c in cols]
    rows = tokens.select(*day, *cols)
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy(*day).orderBy(*order))).filter(F.col("_rank") <= max_len)
    kept = ranked.groupBy(*day).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("_day"))
    sizes = rows.groupBy(*day).agg(F.count(F.lit(1)).alias("size"))
    return kept.join(sizes, day)


def state_history(tokens: DataFrame, max_len: int = STATE_MAX_LEN, keep: str = "last") -> DataFrame:
    """State of each entity at the end of each of its days, cumulated over all earlier days.

    ``keep='last'`` holds the newest ``max_len`` tokens, which is what scoring and training read;
    ``keep='first'`` holds the oldest. ``size`` is the day's own token count, ``cum_size`` the count so far.
    Windows run over days: an entity has no more rows there than the calendar has days.
    """
    if keep not in ("first", "last"):
        raise ValueError("keep must be 'first' or 'last'")
    return history_of_days(bounded_days(tokens, max_len, newest=keep == "last"), max_len, keep)


def history_of_days(days: DataFrame, max_len: int, keep: str = "last", tail_as: str | None = None) -> DataFrame:
    """:func:`state_history` from what :func:`bounded_days` gives; with ``tail_as`` also the tokens with their times."""
    by_day = Window.partitionBy("enterprise_id").orderBy("date")
    cum = F.sum("size").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    days = days.withColumn("cum_size", cum)
    if keep == "last":
        # Exactly the days whose last token is among the newest max_len: the frame runs over token counts,
        # which grow with the date, so it never gathers more than two states' worth of tokens.
        by_count = Window.partitionBy("enterprise_id").orderBy("cum_size").rangeBetween(-(max_len - 1), 0)
        days = days.withColumn("_all", tail(F.flatten(F.collect_list("_day").over(by_count)), max_len))
    else:
        # The state of a day is a prefix of the entity's first max_len tokens.
        whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        useful = F.when(F.col("cum_size") - F.col("size") < max_len, F.col("_day"))
        prefix = F.slice(F.flatten(F.collect_list(useful).over(whole)), 1, max_len)
        days = days.withColumn("_prefix", prefix).withColumn(
            "_all", F.slice("_prefix", 1, F.least(F.col("cum_size"), F.lit(max_len)).cast("int"))
        )
    return days.select(
        "enterprise_id", "date",
        F.col("_all.token_name").alias("state"), F.col("_all.token").alias("state_tokenized"),
        F.col("size").cast("int").alias("size"), F.col("cum_size").cast("bigint").alias("cum_size"),
        *([F.col("_all").alias(tail_as)] if tail_as else []),
    )


def flag_current(state: DataFrame) -> DataFrame:
    """``current_record`` = 1 on the newest day of each entity. Input has one row per entity and day."""
    newest_first = Window.partitionBy("enterprise_id").orderBy(F.col("date").desc())
    return state.withColumn("current_record", F.when(F.row_number().over(newest_first) == 1, 1).otherwise(0))


def newest_state(tokens: DataFrame, max_len: int = STATE_MAX_LEN) -> DataFrame:
    """The rows that :func:`flag_current` marks in :func:`state_history`, without counts, and without the states of earlier days.

    Those are as many arrays as an entity has days. Here Spark keeps an entity's newest ``max_len`` tokens in each task before the one shuffle.
    """
    cols = ["date", "date_time", "token_name", "token"]
    rows = tokens.select("enterprise_id", *cols).filter("enterprise_id IS NOT NULL AND date IS NOT NULL")
    newest = Window.partitionBy("enterprise_id").orderBy(*[F.col(c).desc() for c in cols])
    kept = rows.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= max_len)
    lists = kept.groupBy("enterprise_id").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("_all"))
    return lists.select(
        "enterprise_id", F.array_max("_all.date").alias("date"), F.col("_all.token_name").alias("state"),
        F.col("_all.token").alias("state_tokenized"), F.lit(1).alias("current_record"),
    )


def session_state(sessions: DataFrame, max_len: int = STATE_MAX_LEN) -> DataFrame:
    """All sessions of an entity in one sequence: its newest ``max_len`` tokens and the original length.

    A session has a token at least, so the newest ``max_len`` sessions fill the state; Spark keeps no more of an entity in each task before
    the shuffle. The original length is a sum of its own, combined before its shuffle.
    """
    cols = ["date", "date_time", "_events", "_tokens"]
    filled = sessions.filter(F.size("events") > 0).select(
        "enterprise_id", "date", "date_time",
        tail("events", max_len).alias("_events"), tail("event_tokens", max_len).alias("_tokens"),
        F.size("events").cast("bigint").alias("_n"),
    )
    newest = Window.partitionBy("enterprise_id").orderBy(*[F.col(c).desc() for c in cols])
    ranked = filled.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") <= max_len)
    newer = Window.partitionBy("enterprise_id").orderBy("_rank").rowsBetween(Window.unboundedPreceding, -1)
    joined = (
        ranked.withColumn("_seen", F.coalesce(F.sum("_n").over(newer), F.lit(0)))
        .filter(F.col("_seen") < max_len)
        .groupBy("enterprise_id").agg(F.sort_array(F.collect_list(F.struct(*cols))).alias("_list"))
        .join(filled.groupBy("enterprise_id").agg(F.sum("_n").alias("orig_size")), "enterprise_id")
    )
    return joined.select(
        "enterprise_id",
        tail(F.flatten("_list._events"), max_len).alias("state"),
        tail(F.flatten("_list._tokens"), max_len).alias("state_tokenized"),
        "orig_size",
    )


def population_state(state: DataFrame, keys: DataFrame, as_of: str | None = None, days: int | None = None) -> DataFrame:
    """Current states of the entities in ``keys``; with ``days``, only those at most that old."""
    current = state.filter("current_record = 1")
    if days is not None:
        current = current.filter(F.col("date") >= F.date_sub(F.lit(as_of).cast("date"), days))
    return restrict_to(current, keys)


def restrict_to(df: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose entity is in ``keys``; duplicates in ``keys`` do not multiply rows."""
    return df.join(keys, on=keys.columns, how="left_semi")


def attach_state(events: DataFrame, state: DataFrame) -> DataFrame:
    """Events with the state of exactly their day; events on days without a state row drop out."""
    return events.join(state.select("enterprise_id", "date", "state_tokenized"), on=["enterprise_id", "date"])


def attach_state_asof(events: DataFrame, state: DataFrame) -> DataFrame:
    """Events with the newest state of their day or before; NULL if there is none yet.

    The look-back runs over state rows and distinct event days of an entity, both bounded by the calendar;
    events meet the result in one equi-join. ``state`` is read once.
    """
    known = F.struct(F.col("date").alias("state_date"), "state_tokenized")
    states = state.select("enterprise_id", "date", F.lit(0).alias("_asked"), known.alias("_s"))
    asked = events.select("enterprise_id", "date").distinct().select(
        "enterprise_id", "date", F.lit(1).alias("_asked"), F.lit(None).cast(states.schema["_s"].dataType).alias("_s")
    )
    back = Window.partitionBy("enterprise_id").orderBy("date", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    asof = (
        states.unionByName(asked)
        .withColumn("_s", F.last("_s", ignorenulls=True).over(back))
        .filter("_asked = 1")
        .select("enterprise_id", "date", "_s.state_date", "_s.state_tokenized")
    )
    return events.join(asof, ["enterprise_id", "date"], "left")


def attach_current_state(requests: DataFrame, state: DataFrame, key: str = "enterprise_id") -> DataFrame:
    """Requests with the current state of their entity; a missing state becomes ``[0]``."""
    current = state.filter("current_record = 1").select(key, "state_tokenized", "state")
    joined = requests.join(current, on=key, how="left")
    return joined.withColumns({
        "state_tokenized": F.coalesce("state_tokenized", F.array(F.lit(0))),
        "state": F.coalesce("state", F.array().cast("array<string>")),
    })


def state_lookup(state: DataFrame, id_map: DataFrame, id_type: str = "cagm") -> DataFrame:
    """Current state by alternative id, ``raw_id``, for serving: one row per id, the lowest entity where it has several."""
    ids = id_map.filter(F.col("id_type") == id_type).select("enterprise_id", F.col("alternative_id").alias("raw_id"))
    rows = state.filter("current_record = 1").join(ids.filter("raw_id is not null"), "enterprise_id")
    found = F.min_by(F.struct("enterprise_id", "state_tokenized", "state"), "enterprise_id").alias("_s")
    return rows.groupBy("raw_id").agg(found).select("raw_id", "_s.*")


def attach_next_state(rows: DataFrame, state: DataFrame, key: str = "enterprise_id") -> DataFrame:
    """Session rewards with the state that follows them."""
    return rows.join(state.select(key, F.col("state_tokenized").alias("next_state")), on=key)


__all__ = [
    "bounded_days", "history_of_days", "attach_current_state", "attach_next_state", "attach_state", "attach_state_asof", "daily_state",
    "flag_current", "newest_state", "population_state", "restrict_to", "select_features", "select_sessions", "session_state",
    "state_history", "state_lookup",
]
