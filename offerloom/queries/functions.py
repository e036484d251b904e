"""S: scalar and array functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from offerloom import functions as X
from offerloom.operators import embedding as M
from offerloom.operators import policy as P
from offerloom.operators import report as R
from offerloom.queries.expressions import REQUESTS
from offerloom.queries.registry import K, REPORT, joined, query
from offerloom.queries.sources import ACTIONS
from offerloom.sources import adapters as A

WORDS = "list_filter(string_split_regex(text, '[ \\n\\t]+'), lambda w: w <> '')"


def words(spark, base, col="words"):
    return A.load(spark, "documents", base).select(
        "doc_id", "source", F.filter(F.split("text", "[ \\n\\t]+"), lambda w: w != "").alias(col)
    )


@query("s1_array_basics", f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents)
    SELECT doc_id, len(w) AS size, array_to_string(w, ',') AS rejoined, len(w[6:]) AS rest FROM d""")
def s1(spark, base):
    """Each text is cut after five words and put together again."""
    head, rest = F.slice("words", 1, 5), F.slice("words", F.lit(6), F.size("words"))
    return words(spark, base).select(
        "doc_id", F.size("words").cast("bigint").alias("size"), joined(F.flatten(F.array(head, rest))).alias("rejoined"),
        F.size(rest).cast("bigint").alias("rest"),
    )


@query("s2_tail", f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents)
    SELECT doc_id, array_to_string(list_slice(w, greatest(len(w) - 99, 1), len(w)), ',') AS tail FROM d""")
def s2(spark, base):
    return words(spark, base).select("doc_id", joined(X.tail("words", 100)).alias("tail"))


LENGTHS = f"WITH s AS (SELECT doc_id, list_transform({WORDS}, lambda w: length(w)) AS t FROM documents)"


def lengths(spark, base):
    return words(spark, base).select(
        "doc_id", F.transform("words", lambda w: F.length(w)).alias("t")
    )


@query("s3_pad", f"""
    {LENGTHS} SELECT doc_id, array_to_string(list_concat(t, list_transform(range(64 - len(t)), lambda i: 0)), ',') AS padded_right,
           array_to_string(list_concat(list_transform(range(64 - len(t)), lambda i: 0), t), ',') AS padded_left FROM s""")
def s3(spark, base):
    return lengths(spark, base).select(
        "doc_id", joined(X.pad("t", 64)).alias("padded_right"), joined(X.pad("t", 64, side="left")).alias("padded_left")
    )


@query("s4_pad_mask", f"{LENGTHS} SELECT doc_id, len(t) AS ones, CAST(greatest(len(t), 64) AS BIGINT) AS size FROM s")
def s4(spark, base):
    mask = X.pad_mask(X.pad("t", 64))
    return lengths(spark, base).select(
        "doc_id", F.aggregate(mask, F.lit(0), lambda s, x: s + x).cast("bigint").alias("ones"),
        F.size(mask).cast("bigint").alias("size"),
    )


LOGITS = "v AS (SELECT vec_id AS id, label AS action, embedding::DOUBLE[] AS l FROM embeddings)"


@query("s5_softmax", f"""
    WITH {LOGITS}, w AS (SELECT id, list_transform(l, lambda x, i: CASE WHEN i = action + 1 THEN -1000.0 ELSE x END) AS l FROM v),
    m AS (SELECT id, list_transform(l, lambda x: CASE WHEN x = -1000 THEN list_max(l) ELSE x END) AS l FROM w),
    e AS (SELECT id, list_transform(l, lambda x: exp(x - list_max(l))) AS e FROM m)
    SELECT id, unnest(range(64)) AS i, round(unnest(list_transform(e, lambda x: x / list_sum(e))), 6) AS p,
           round(unnest(list_transform(e, lambda x: ln(x / list_sum(e)))), 6) AS logp FROM e""")
def s5(spark, base):
    """The logged action is set to the sentinel first."""
    marked = A.scores(spark, base).withColumn(
        "logits", F.transform("logits", lambda x, i: F.when(i == F.col("action"), -1000.0).otherwise(x))
    )
    rows = marked.select("id", F.posexplode(F.arrays_zip(X.softmax("logits").alias("p"), X.log_softmax("logits").alias("lp"))))
    return rows.select("id", F.col("pos").cast("bigint").alias("i"), F.round("col.p", 6).alias("p"), F.round("col.lp", 6).alias("logp"))


@query("s6_softmax_without", f"""
    WITH {LOGITS}, m AS (SELECT id, list_transform(l, lambda x, i: CASE WHEN i = action + 1 THEN -1000.0 ELSE x END) AS l FROM v),
    e AS (SELECT id, list_transform(l, lambda x: exp(x - list_max(l))) AS e FROM m)
    SELECT id, unnest(range(64)) AS i, round(unnest(list_transform(e, lambda x: x / list_sum(e))), 6) AS p FROM e""")
def s6(spark, base):
    rows = A.scores(spark, base).select("id", F.posexplode(X.softmax_without("logits", F.col("action"))))
    return rows.select("id", F.col("pos").cast("bigint").alias("i"), F.round("col", 6).alias("p"))


@query("s7_pick", f"WITH {LOGITS} SELECT id, action, round(l[action + 1], 6) AS q_value, round(l[action + 61], 6) AS beyond FROM v")
def s7(spark, base):
    return A.scores(spark, base).select(
        "id", "action", F.round(X.pick("logits", "action"), 6).alias("q_value"),
        F.round(X.pick("logits", F.col("action") + 60), 6).alias("beyond"),
    )


MASKS = f"""{REQUESTS}, {ACTIONS}, names AS (
    SELECT app AS app_name, list(name ORDER BY position) AS names FROM actions GROUP BY 1
), masks AS (
    SELECT r.*, n.names, list_transform(n.names, lambda n: CAST(n = 'none' OR list_contains(flags, n) AS INT)) AS mask
    FROM requests r LEFT JOIN names n USING (app_name)
)"""


@query("s8_action_mask", f"""
    WITH {MASKS}
    SELECT event_id, coalesce(array_to_string(mask, ','), '-') AS mask,
           CASE WHEN app_name = 'fax' THEN 'invalid app: fax' WHEN k = 99 THEN 'eligible action not in the action space' ELSE '-' END AS error
    FROM masks""")
def s8(spark, base):
    rows = P.with_action_mask(P.parse_requests(A.requests(spark, base)))
    return rows.select(
        "event_id", F.coalesce(joined("mask"), F.lit("-")).alias("mask"), F.coalesce("error", F.lit("-")).alias("error")
    )


@query("s9_clip_std", """
    WITH s AS (SELECT 2 * stddev_samp(value) AS l FROM events)
    SELECT event_id, round(least(greatest(value, -l), l), 4) AS value FROM events, s""")
def s9(spark, base):
    rows = R.clip_std(A.load(spark, "events", base).select("event_id", "value"), "value")
    return rows.select("event_id", F.round("value", 4).alias("value"))


@query("s10_half_even", "SELECT l_orderkey, l_linenumber, round_even(l_quantity / 2, 0) AS half FROM lineitem")
def s10(spark, base):
    return A.load(spark, "lineitem", base).select(
        "l_orderkey", "l_linenumber", X.half_even(F.col("l_quantity") / 2).alias("half")
    )


@query("s11_dates", """
    SELECT o_orderkey, CAST(o_orderdate::DATE AS VARCHAR) AS date, CAST(o_orderdate::DATE - 180 AS VARCHAR) AS start,
           CAST(epoch_us(o_orderdate) AS BIGINT) AS us FROM orders""")
def s11(spark, base):
    date = F.to_date("o_orderdate")
    return A.load(spark, "orders", base).select(
        "o_orderkey", date.cast("string").alias("date"), F.date_sub(date, 180).cast("string").alias("start"),
        F.unix_micros(F.to_timestamp(date)).alias("us"),
    )


@query("s12_rectangular", f"""
    WITH d AS (SELECT CAST(len({WORDS}) AS INT) AS n FROM documents)
    SELECT 'raw' AS form, min(n) AS shortest, max(n) AS longest, CAST(min(n) = max(n) AS INT) AS rectangular FROM d
    UNION ALL SELECT 'padded', max(n), max(n), 1 FROM d""")
def s12(spark, base):
    rows = words(spark, base).select(F.transform("words", lambda w: F.length(w)).alias("t"))
    raw, padded = M.is_rectangular(rows, "t"), M.is_rectangular(M.pad_to_longest(rows, "t"), "t")
    return raw.select(F.lit("raw").alias("form"), "*").unionByName(padded.select(F.lit("padded").alias("form"), "*"))


@query("s13_explode_series", f"WITH {LOGITS} SELECT id, unnest(range(64)) AS step, round(unnest(l), 6) AS value FROM v")
def s13(spark, base):
    rows = A.scores(spark, base).select(
        "id", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: i.cast("bigint")).alias("step"), F.col("logits").alias("value")
    )
    return R.explode_series(rows, "id", "step", "value").select("id", "step", F.round("value", 6).alias("value"))


@query("s14_melt", f"""
    WITH {REPORT}, s AS (SELECT tfn, CAST(sum(offered) AS BIGINT) AS offered, CAST(sum(accepted) AS BIGINT) AS accepted FROM report GROUP BY 1)
    SELECT tfn, 'offered' AS name, offered AS value FROM s UNION ALL SELECT tfn, 'accepted', accepted FROM s""")
def s14(spark, base):
    rows = A.report(spark, base).groupBy("tfn").agg(F.sum("offered").alias("offered"), F.sum("accepted").alias("accepted"))
    return R.to_long(rows, ["tfn"], ["offered", "accepted"], "name", "value")


@query("s15_normalize_state", f"""
    SELECT event_id, ({K} % 12) || ',' || {K} AS from_text, ({K} % 12) || ',' || {K} AS from_array FROM events""")
def s15(spark, base):
    k = A.k_of()
    pair = F.array(F.pmod(k, F.lit(12)).cast("double"), k.cast("double"))
    stored = F.concat(F.lit("["), F.pmod(k, F.lit(12)), F.lit(", "), k, F.lit("]"))
    return A.load(spark, "events", base).select(
        "event_id", joined(X.normalize_state(stored, True)).alias("from_text"),
        joined(X.normalize_state(pair, False)).alias("from_array"),
    )


