"""Exact duplicates by deterministic block naming.

A text without blanks is cut into blocks of fixed size. The distinct blocks are sorted and numbered: equal blocks, and
only those, get the same integer name. Then adjacent names of a text are paired, the distinct pairs are sorted and
numbered, and so on, until one name is left per text: its identity. No hash decides equality, so there are no collisions.

Plan. Level 0 shuffles the text twice: once (pre-aggregated) to number the distinct blocks, once to look the names up.
A block with more than 1 in :data:`HOT_SHARE` of all blocks is hot; there are at most :data:`HOT_SHARE` of those, each of bounded size, so their
names are broadcast, and the shuffled look-up has no hot key. Higher levels move a few integers per block, from tables in the
shared folder; AQE splits their hot keys. The number of levels is the logarithm of the longest text.

Defined results: a null text counts as empty; a long text is named block by block, whatever its length; empty texts are equal to each other and to blank ones; a row that repeats
an id is a row of its own; of equal texts the one with the most code points, then the smallest id stays (a null id comes last), and rows that
tie in both stay together; other columns are ignored, or kept as they are where rows are dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import hashed, materialize, text_or_empty

BLOCK = 1024
HOT_SHARE = 1000
BLANK_CHARS = " \t\n\x0b\f\r"


def without_blanks(text: Column) -> Column:
    # One search for each character: much cheaper than a translation or a pattern.
    for blank in BLANK_CHARS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def _numbered(distinct: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Integer names of distinct keys: sorted within hash partitions, numbered by partition and place."""
    return distinct.sortWithinPartitions(*keys).withColumn(name, F.monotonically_increasing_id())


def identities(df: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: ``id``, ``text_sha256`` (hex, of the text without blanks), ``n_points`` and
    ``level``, ``identity`` (equal for equal texts, and only for those)."""
    base = df.select(F.col(id).alias("_id"), text_or_empty(text).alias("_text"))
    # Bounds from one cheap pass: blocks of all texts together, blocks of the longest.
    size = F.ceil(F.greatest(F.length("_text"), F.lit(1)) / F.lit(block))
    total, most = base.agg(F.sum(size), F.max(size)).first()
    clean = base.select("_id", F.length("_text").alias("n_points"), without_blanks(F.col("_text")).alias("_clean"))
    cut = F.when(F.col("_clean") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("_clean", F.lit(f"(?s).{{1,{block}}}"), 0)
    )
    pieces = clean.withColumn("_cut", cut)

    # A cold block is looked up as 'c' + block; a hot one is named already and only spreads its rows.
    # (The outer forms of explode: the others would work each text out twice, once to see that it isn't empty.)
    words = pieces.select(F.explode_outer("_cut").alias("_block")).select(F.concat(F.lit("c"), "_block").alias("_key"))
    counted = words.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    named = _numbered(counted, ["_key"], "_name")
    limit = (total or 0) // HOT_SHARE
    hot = named.filter(F.col("_n") > limit).select(F.col("_key").alias("_hot_key"), (-F.col("_name") - 1).alias("_hot"))
    rows = pieces.select(
        "_id", "n_points", F.sha2("_clean", 256).alias("text_sha256"), F.size("_cut").alias("_blocks"), F.posexplode_outer("_cut").alias("_pos", "_block")
    ).withColumn("_block", F.concat(F.lit("c"), "_block"))
    rows = rows.join(F.broadcast(hot), F.col("_block") == F.col("_hot_key"), "left")
    spread = F.concat(F.lit("h"), F.pmod(F.xxhash64("_id", "_pos"), F.lit(HOT_SHARE)).cast("string"))
    rows = rows.withColumn("_key", F.when(F.col("_hot").isNull(), F.col("_block")).otherwise(spread)).drop("_block", "_hot_key")
    # Both look-ups filter on the count, so they read one and the same shuffle of the distinct blocks.
    cold = named.filter(F.col("_n") <= limit).select("_key", "_name")
    level_rows = materialize(
        rows.join(cold, "_key", "left").select(
            "_id", "text_sha256", "n_points", "_blocks", "_pos", F.coalesce("_hot", "_name").alias("_name"), F.lit(1).cast("long").alias("_rows")
        ),
        "block-names",
    )

    whole = ["_id", "text_sha256", "n_points", "_blocks"]
    done = level_rows.filter("_blocks = 1").select(*whole, F.lit(0).alias("level"), F.col("_name").alias("identity"), "_rows")
    rest = level_rows.filter("_blocks > 1")
    level, width = 0, 1
    while width < (most or 0):
        level, width = level + 1, width * 2
        side = lambda k: F.max(F.when(F.pmod("_pos", F.lit(2)) == k, F.col("_name")))
        half = F.floor(F.col("_pos") / 2).cast("int").alias("_pos")
        # A missing right side is null: names are never null, so an odd end cannot meet a pair.
        # Rows that are equal in all of ``whole`` go on as one, with their number.
        rows_of = F.sum(F.when(F.pmod("_pos", F.lit(2)) == 0, F.col("_rows"))).alias("_rows")
        pairs = rest.groupBy(*whole, half).agg(side(0).alias("_a"), side(1).alias("_b"), rows_of)
        pairs = materialize(pairs, "block-pairs")
        names = materialize(_numbered(pairs.select("_a", "_b").distinct(), ["_a", "_b"], "_new"), "pair-names")
        names = names.withColumnsRenamed({"_a": "_x", "_b": "_y"})
        joined = pairs.join(names, (F.col("_a") == F.col("_x")) & F.col("_b").eqNullSafe(F.col("_y"))).select(
            *whole, "_pos", F.col("_new").alias("_name"), "_rows"
        )
        last = F.col("_blocks") <= width
        level_rows = materialize(joined, "block-names")
        done = done.union(level_rows.filter(last).select(*whole, F.lit(level).alias("level"), F.col("_name").alias("identity"), "_rows"))
        rest = level_rows.filter(~last)
    again = F.explode(F.array_repeat(F.lit(0), F.col("_rows").cast("int"))).alias("_again")
    return done.select(F.col("_id").alias(id), "text_sha256", "n_points", "level", "identity", again).drop("_again")


def duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """One row per row of ``df``: ``id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``, ``n_points``."""
    rows = materialize(identities(df, id, text, block), "identities")
    best = F.max(F.struct("n_points", (-F.col(id)).alias("_minus"))).alias("_best")
    groups = materialize(rows.groupBy("level", "identity").agg(F.count(F.lit(1)).alias("group_size"), best), "groups")
    keep_id = -F.col("_best._minus")
    return rows.join(groups, ["level", "identity"]).select(
        F.col(id), keep_id.alias("keep_id"), "group_size",
        (F.col(id).eqNullSafe(keep_id) & (F.col("n_points") == F.col("_best.n_points"))).alias("kept"), "text_sha256", "n_points",
    )


def drop_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text", block: int = BLOCK) -> DataFrame:
    """The rows of ``df`` that stay, with all its columns. Dropped rows are found by id, text without blanks and length."""
    gone = duplicates(df, id, text, block).filter(~F.col("kept")).select(
        F.col(id).alias("_gone"), F.unhex("text_sha256").alias("_sha"), F.col("n_points").alias("_n")
    )
    gone = materialize(gone.distinct(), "exact-gone")
    own = text_or_empty(text)
    same = F.col(id).eqNullSafe(F.col("_gone")) & (F.unhex(F.sha2(without_blanks(own), 256)) == F.col("_sha")) & (F.length(own) == F.col("_n"))
    return df.join(hashed(gone), same, "left_anti")


DEDUP_SQL = r"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS clean FROM documents
), g AS (
    SELECT clean, count(*) AS group_size, arg_min(doc_id, (-length(text), doc_id)) AS keep_id FROM d GROUP BY clean
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, sha256(d.clean) AS text_sha256
FROM d JOIN g USING (clean)"""
