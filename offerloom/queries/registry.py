"""Registry of queries, and the SQL of the shared views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under its inventory id and name."""
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


def joined(c: Column | str, digits: int | None = None) -> Column:
    """Array as text."""
    c = F.col(c) if isinstance(c, str) else c
    if digits is not None:
        c = F.transform(c, lambda x: F.round(x, digits))
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",")


def text(c: str) -> Column:
    return F.col(c).cast("string").alias(c)


K = "CAST(json_extract_string(props, '$.k') AS INT)"


def u(key: str, seed: int | str) -> str:
    """SQL of the repeatable uniform number."""
    return f"((('0x' || substr(md5(concat({key}, ':{seed}')), 1, 8))::BIGINT + 0.5) / 4294967296.0)"


TFN = "CASE WHEN substr(md5(CAST(o_custkey AS VARCHAR)), 1, 1) < '8' THEN 'pilot' ELSE 'control' END"
XFER = "CASE o_orderstatus WHEN 'F' THEN 'XFER' WHEN 'O' THEN 'DONE' ELSE 'HANG' END"
MEMBER = "'Customer#' || lpad(CAST(o_custkey AS VARCHAR), 9, '0')"

FEATURES = f"""features AS (
    SELECT user_id AS enterprise_id, ts::DATE AS date, ts AS date_time,
           event_type || '___' || CAST(({K} // 10) * 10 AS VARCHAR) AS token_name
    FROM events
    WHERE event_type <> 'signup' OR ts::DATE >= DATE '2024-01-31' - 365
)"""

VOCAB = """vocab AS (
    SELECT token_name, row_number() OVER (ORDER BY token_name) AS token FROM (SELECT DISTINCT token_name FROM features)
), tokens AS (SELECT f.*, v.token FROM features f JOIN vocab v USING (token_name))"""

CALLS = f"""calls AS (
    SELECT CAST(o_orderkey AS VARCHAR) AS call_guid, {MEMBER} AS cagm, o_orderdate AS start_dtm,
           CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'MED' ELSE 'RX' END AS logical_app_name,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'provider' ELSE 'member' END AS caller_type,
           {TFN} AS tfn, {XFER} AS xferstatus, CASE WHEN o_totalprice >= 20000 THEN 1 ELSE 0 END AS authenticated
    FROM orders
), good_calls AS (
    SELECT * FROM calls WHERE logical_app_name = 'RX' AND caller_type = 'member' AND start_dtm > TIMESTAMP '1995-02-01'
    AND authenticated = 1
)"""

FLAGS = """flags AS (
    SELECT CAST(l_orderkey AS VARCHAR) AS call_guid,
           max(CAST(l_returnflag = 'A' AS INT)) AS refill_offered, max(CAST(l_linestatus = 'F' AS INT)) AS refill_wanted,
           max(CAST(l_discount >= 0.05 AS INT)) AS refill_success, max(CAST(l_discount < 0.02 AS INT)) AS refill_failure,
           max(CAST(l_returnflag = 'N' AS INT)) AS renewal_offered, max(CAST(l_tax >= 0.04 AS INT)) AS renewal_accepted,
           max(CAST(l_discount >= 0.03 AS INT)) AS renewal_success,
           max(CAST(l_returnflag = 'R' OR CAST(floor(l_quantity) AS INT) = 7 AS INT)) AS sms_offered,
           max(CAST(l_linestatus = 'O' AS INT)) AS sms_accepted,
           max(CAST(l_quantity > 25 OR l_quantity > 40 AS INT)) AS sms_success
    FROM lineitem GROUP BY 1
), disp AS (
    SELECT call_guid, 'refill' AS offer, refill_offered AS offered, refill_offered * refill_wanted AS accepted,
           refill_offered * refill_wanted * refill_success AS success, refill_failure AS failure FROM flags
    UNION ALL
    SELECT call_guid, 'renewal', renewal_offered, renewal_accepted, renewal_accepted * renewal_success, 0 FROM flags
    UNION ALL
    SELECT call_guid, 'sms', sms_offered, sms_accepted, sms_accepted * sms_success, 0 FROM flags
)"""

REPORT = f"""report AS (
    SELECT o_orderkey AS gvpsessionid, {MEMBER} AS cagm, o_orderdate::DATE AS startdate, {TFN} AS tfn, {XFER} AS xferstatus,
           CASE WHEN o_orderdate::DATE < DATE '1998-04-01' THEN 1 WHEN o_orderdate::DATE >= DATE '1998-05-01' THEN 0 END
               AS before_after,
           CASE l_returnflag WHEN 'A' THEN 'refill' WHEN 'N' THEN 'renewal' ELSE 'sms' END AS metric,
           CAST(l_discount >= 0.02 AS INT) AS offered, CAST(l_discount >= 0.02 AND l_linestatus = 'O' AS INT) AS accepted,
           0 AS penalty
    FROM orders JOIN lineitem ON l_orderkey = o_orderkey
    UNION ALL
    SELECT o_orderkey, {MEMBER}, o_orderdate::DATE, {TFN}, {XFER},
           CASE WHEN o_orderdate::DATE < DATE '1998-04-01' THEN 1 WHEN o_orderdate::DATE >= DATE '1998-05-01' THEN 0 END,
           'call', 0, 0, CAST(o_totalprice > 250000 AS INT) FROM orders
    UNION ALL
    SELECT o_orderkey, {MEMBER}, o_orderdate::DATE, {TFN}, {XFER},
           CASE WHEN o_orderdate::DATE < DATE '1998-04-01' THEN 1 WHEN o_orderdate::DATE >= DATE '1998-05-01' THEN 0 END,
           'resolved', 0, 0, CAST(o_orderpriority < '3' AS INT) FROM orders
)"""

DECISIONS = f"""decisions AS (
    SELECT event_id, CASE WHEN event_type IN ('view', 'click') THEN 'ivr' ELSE 'spec-pat' END AS app,
           'impl-' || event_type AS implementation, user_id AS enterprise_id, ts AS time, {K} % 12 AS action,
           (({K} % 7) + 2) / 10.0 AS action_prob, value AS rewards
    FROM events
)"""

STEPS = f"""{DECISIONS}, steps AS (
    SELECT *, row_number() OVER (PARTITION BY enterprise_id ORDER BY time, event_id) - 1 AS t FROM decisions
)"""

WEEK = "CAST(date_trunc('week', startdate) AS DATE) + 6"

# Flags of the order lines, in the form of an offer table.
LINE_OFFERS = {
    "refill": {
        "offered": "refill_alert", "wanted": "want_refill_yes",
        "success": "rx_refilled", "failure": "rx_refill_failed",
    },
    "renewal": {"offered": "renewal_alert", "accepted": "renewal_alert_yes", "success": "rx_renewed"},
    "sms": {
        "offered": "sms_offered = 1 OR request_content LIKE '%q7'", "accepted": "sms_offered_response = 'yes'",
        "success": "sms_enrolled = 1 OR gan_activation_sent = 1",
    },
}


def state_sql(keep: str = "last", n: int = 100, source: str = "tokens") -> str:
    """CTE ``state`` over a token CTE."""
    cut = f"list_slice(arr, greatest(len(arr) - {n - 1}, 1), len(arr))" if keep == "last" else f"list_slice(arr, 1, {n})"
    return f"""daily AS (
    SELECT enterprise_id, date, list(token ORDER BY date_time, token_name) AS ids,
           list(token_name ORDER BY date_time, token_name) AS names, count(*) AS size FROM {source} GROUP BY 1, 2
), cumulated AS (
    SELECT enterprise_id, date, size, CAST(sum(size) OVER w AS BIGINT) AS cum_size,
           flatten(list(ids) OVER w) AS ids, flatten(list(names) OVER w) AS names,
           row_number() OVER (PARTITION BY enterprise_id ORDER BY date DESC) AS back
    FROM daily WINDOW w AS (PARTITION BY enterprise_id ORDER BY date ROWS UNBOUNDED PRECEDING)
), state AS (
    SELECT enterprise_id, date, size, cum_size, CAST(back = 1 AS INT) AS current_record,
           {cut.replace('arr', 'ids')} AS ids, {cut.replace('arr', 'names')} AS names
    FROM cumulated
)"""


TOKEN_STATE = f"{FEATURES}, {VOCAB}, {state_sql()}"
