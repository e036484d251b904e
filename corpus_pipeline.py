"""From raw documents to token ids: five stages, each one operator over all that the stage before kept.

Each stage takes (spark, docs, sf_dir) and returns a table, which is written as Parquet and read again as the next one's
documents. All but the last return the columns of documents, whatever they are; ``doc_id``, ``text``, ``lang`` and ``source`` are read.

1. Language: documents without a letter go, and those of whose character runs fewer than :data:`LEAST_SHARE` belong to the language found. The
   share decides only where it can: texts of fewer than :data:`LEAST_LETTERS` letters stay, and so do those without a label, or with one whose own
   texts are not found by what was learned (too few of them, say).
2. Exact duplicates: of texts that are equal up to blanks, one stays.
3. Near duplicates: of each group of linked documents, the one of smallest id stays; documents without id stay.
4. Mixing: each document comes as often as the mix takes it.
5. Byte-level BPE: token ids, and whether decoding gives the text back.

Rows that repeat an id are judged together in stages 3 and 4 (in stage 4 each comes as often as the one taken most). A null text counts as
empty and goes in stage 1. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import bpe, exact_dedup, language_id, mixing, ngram_join
from offerloom.llm.common import hashed, materialize, table, unused

LEAST_SHARE = 0.2
LEAST_LETTERS = 40
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def _columns(df: DataFrame, like: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in like.columns])


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    learned_from = docs.filter(~language_id.held_out(F.col("doc_id")))
    model = language_id.fit(learned_from)
    lang, score = unused(docs, "lang"), unused(docs, "score")
    judged = language_id.predict(docs, model, lang=lang, score=score)
    # Where nothing could be learned nothing can be rejected but what has no letters.
    if not model.names:
        return _columns(judged.filter(F.col("text").rlike(r"\p{L}")), docs)
    long = F.length(F.regexp_replace("text", r"\P{L}", "")) >= LEAST_LETTERS
    # A language is learned if most of the texts it was learned from, a bounded sample, are found by it; one row per label comes back.
    _, sample = language_id.labelled(learned_from, "doc_id", "text", "lang")
    own = language_id.predict(sample, model, lang="_found", score="_share").filter(long)
    right = F.avg(((F.col("_found") == F.col("lang")) & (F.col("_share") >= LEAST_SHARE)).cast("int"))
    learned = [r["lang"] for r in own.groupBy("lang").agg(right.alias("right")).collect() if r["right"] > 0.5]
    rejected = (F.col(score) < LEAST_SHARE) & long & F.coalesce(F.col("lang").isin(learned), F.lit(False))
    return _columns(judged.filter((F.col(lang) != language_id.UNKNOWN) & ~rejected), docs)


def drop_exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_duplicates(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(docs).filter("component_id < doc_id").select("doc_id").distinct()
    return _columns(docs.join(hashed(materialize(found, "near-gone")), "doc_id", "left_anti"), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    id, copies, copy = unused(docs, "id"), unused(docs, "copies"), unused(docs, "copy")
    taken = mixing.mix(docs).filter("copies > 0").groupBy(F.col("doc_id").alias(id)).agg(F.max("copies").cast("int").alias(copies))
    joined = docs.join(hashed(materialize(taken, "mix-taken")), F.col("doc_id").eqNullSafe(F.col(id)))
    return _columns(joined.withColumn(copy, F.explode(F.array_repeat(F.lit(0), F.col(copies)))), docs)


def encode_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``n_tokens``, ``ids``, and ``round_trip``: whether the ids decode to the text."""
    rows = docs.select("doc_id", "text")
    both = bpe.encode_decode(rows, RANKS, public_tokenizers.PATTERN)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", (F.col("bytes") == text).alias("round_trip"))


STAGES = [
    ("language", keep_known_languages),
    ("exact duplicates", drop_exact_duplicates),
    ("near duplicates", drop_near_duplicates),
    ("mix", mix_sources),
    ("byte BPE", encode_bytes),
]

# Languages are learned and tokens merged: SQL can't say that.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
