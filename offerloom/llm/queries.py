"""One query per text operator over the given tables, with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerloom.llm import (
    ann, bpe, chat_format, decontamination, exact_dedup, hard_negatives, language_id, license_scan, merkle, mixing, ngram_join, pii,
    token_output,
)
from offerloom.llm.common import table
from offerloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

WORD_TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text")
    return bpe.encode_decode(docs, BYTE_RANKS, public_tokenizers.PATTERN).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query("op2_personal_data")
def op2_personal_data(spark: SparkSession, base: str) -> DataFrame:
    docs = pii.with_spans(table(spark, base, "documents").select("doc_id", "text"))
    of = lambda kind: F.size(F.filter("spans", lambda s: (s["kind"] == kind) & s["base"])).cast("long").alias(f"n_{kind}")
    return docs.select(
        "doc_id", *[of(kind) for kind in pii.KINDS[:4]],
        F.sha2(pii.joined(F.filter("spans", lambda s: s["base"])), 256).alias("base_sha256"),
        pii.joined(F.col("spans")).alias("spans"),
        F.size("spans").cast("long").alias("n_spans"),
    )


@query("op3_nearest_vectors")
def op3_nearest_vectors(spark: SparkSession, base: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, base, "embeddings"), F.pmod("vec_id", F.lit(50)) == 0)


@query("op4_exact_dedup", exact_dedup.DEDUP_SQL)
def op4_exact_dedup(spark: SparkSession, base: str) -> DataFrame:
    return exact_dedup.duplicates(table(spark, base, "documents")).drop("n_points")


@query("op5_jaccard_join", ngram_join.NEAR_SQL)
def op5_jaccard_join(spark: SparkSession, base: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, base, "documents"))


@query("op6_license_scan", license_scan.LICENSE_SQL)
def op6_license_scan(spark: SparkSession, base: str) -> DataFrame:
    found = license_scan.scan(table(spark, base, "documents").select("doc_id", "text"))
    own = F.array_distinct(F.transform("places", lambda p: p["label"]))
    starts = F.transform("places", lambda p: p["start"])
    return found.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), F.array_join(F.array_sort(own), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(own, F.col("labels"))), ",").alias("labels"), "score",
    )


@query("op7_chat_format", chat_format.CHAT_SQL)
def op7_chat_format(spark: SparkSession, base: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    rows = table(spark, base, "conversations").select("conv_id", "turn", "role", "text").unionByName(more)
    out = chat_format.format_chats(rows)
    turns, loss = chat_format.read_turns(F.col("formatted")), chat_format.read_loss(F.col("formatted"), F.col("loss_mask"))
    back = out.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query("op8_language_id")
def op8_language_id(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.filter(~language_id.held_out(F.col("doc_id"))))
    return language_id.predict(docs.drop("lang"), model).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@query("op9_token_records")
def op9_token_records(spark: SparkSession, base: str) -> DataFrame:
    path = scratch_path(spark, "token-records")
    token_output.write_records(table(spark, base, "documents"), path, WORD_TOKENIZER)
    return token_output.read_records(spark, path).select(
        F.col("id").alias("doc_id"), "start", (F.length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


@query("op10_mixing", mixing.MIX_SQL)
def op10_mixing(spark: SparkSession, base: str) -> DataFrame:
    return mixing.mix(table(spark, base, "documents")).drop("copies")


@query("op11_decontamination", decontamination.DECONTAMINATION_SQL)
def op11_decontamination(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select("doc_id", "text")
    found = decontamination.find(docs, table(spark, base, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op12_merkle_manifest", merkle.MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, base: str) -> DataFrame:
    docs = table(spark, base, "documents").select(*merkle.COLUMNS)
    columns = {c: F.col(c) for c in merkle.COLUMNS}
    tampered = merkle.leaf(*(columns | {"text": F.replace("text", F.lit("\n"), F.lit(""))}).values())
    chosen = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    manifest = merkle.build(docs, merkle.leaf(*columns.values()), keep={"candidate": F.when(chosen, tampered)})
    return merkle.verify(manifest, "candidate").withColumnRenamed("id", "doc_id")


@query("op13_hard_negatives", hard_negatives.NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "embeddings").select(
        "vec_id", "embedding", F.when(F.pmod("vec_id", F.lit(7)) == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).alias("label")
    )
    return hard_negatives.mine(rows, F.pmod("vec_id", F.lit(100)) == 0)
