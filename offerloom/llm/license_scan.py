"""Licence statements in texts: exact phrases, and an exact set-similarity join of text blocks with templates.

Base: the places where the words of a phrase stand one after the other.

Method: a text is cut into blocks of :data:`BLOCK` words, each starting half a block after the one before, so every run of half
a block lies whole in some block. A block meets a template if it holds at least :data:`THRESHOLD` of the template's
distinct words. All such pairs are found, by these steps:

* the words of the templates are ordered by the number of documents that hold them, over all documents, rarest first;
* prefix filter: with ``o`` words needed, block and template can meet only if one of the first ``size - o + 1`` words of each is common;
* length filter: a block with fewer than ``o`` template words is out;
* positional filter: with the common word at places ``i`` and ``j``, at most ``min(|B| - i, |T| - j)`` words can be common;
* what is left is compared in full.

Words outside the templates can't be common, so a block is reduced to its template words first. Templates and phrases are arguments. A
template may be a whole licence text: what is longer than half a block is cut into even pieces of at most that, each a template of its
own, so that no template is longer than a run that some block holds whole. They are constants of the plan, and so are the bounds of everything that is broadcast or sent to the driver: one row per template word.

Defined results: a null or empty text has no words, no labels and score 0; a long text is scanned whole, as one array of words; rows that repeat stay rows of their own; other columns
of the input are ignored unless named in ``keep``; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import LOWER, UPPER, ascii_lower, text_or_empty

NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BLOCK = 32
THRESHOLD = 0.8

# Base phrases and their labels.
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
# Statements of common licences, at most half a block long.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("gpl", "licensed under the gnu general public license version"),
    ("lgpl", "licensed under the gnu lesser general public license version"),
    ("mpl-2", "subject to the terms of the mozilla public license version 2 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
)


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), NOT_WORD), "")


def _needed(size: int) -> int:
    return math.ceil(round(THRESHOLD * size, 9))


def plain_words(text: str) -> list[str]:
    """The words of a Python string, by the rule of :func:`words`."""
    return [w for w in re.split(NOT_WORD, text.translate(str.maketrans(UPPER, LOWER))) if w]


def pieces(templates: Iterable[tuple[str, str]]) -> list[tuple[str, list[str]]]:
    """Label and words of the templates, none longer than half a block; longer ones are cut evenly."""
    out = []
    for label, text in templates:
        found = plain_words(text)
        n = -(-len(found) // (BLOCK // 2))
        out += [(label, found[len(found) * i // n : len(found) * (i + 1) // n]) for i in range(n)]
    return out


def vocabulary(templates: Iterable[tuple[str, str]] = TEMPLATES) -> list[str]:
    return sorted({w for _, t in templates for w in plain_words(t)})


def _strings(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.array().cast("array<string>")


def word_order(df: DataFrame, text: str = "text", templates: Iterable[tuple[str, str]] = TEMPLATES) -> list[str]:
    """Template words, rarest first, by the number of rows that hold them. At most one row per template word comes back."""
    names = vocabulary(templates)
    # The outer form: the plain one would split each text twice, once to see whether anything is found.
    found = df.select(F.explode_outer(F.array_intersect(_strings(names), words(text_or_empty(text)))).alias("word")).filter("word is not null")
    counts = {r["word"]: r["n"] for r in found.groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    return sorted(names, key=lambda w: (counts.get(w, 0), w))


def phrase_places(found: Column, phrases: Mapping[str, str] = PHRASES) -> Column:
    """Starts and labels of all base phrases in the words ``found``."""
    def places(parts: list[str], label: str) -> Column:
        def start(w: Column, i: Column) -> Column:
            hit = w == parts[-1]
            for back, part in enumerate(reversed(parts[:-1]), 1):
                hit = hit & (F.get(found, i - back) == part)
            return F.when(hit, F.struct((i - len(parts) + 1).cast("long").alias("start"), F.lit(label).alias("label")))

        return F.when(F.array_contains(found, parts[-1]), F.array_compact(F.transform(found, start)))

    each = [places(plain_words(phrase), label) for phrase, label in phrases.items()]
    none = F.array().cast("array<struct<start:bigint,label:string>>")
    return F.flatten(F.array_compact(F.array(*each))) if each else none


def scan(
    df: DataFrame, id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (),
    templates: Iterable[tuple[str, str]] = TEMPLATES, phrases: Mapping[str, str] = PHRASES,
) -> DataFrame:
    """One row per row of ``df``: ``id``, ``n_words``, ``places`` (array of start, label), ``labels`` found by the join (array), and ``score``,
    the largest part of a template that some block holds (1 for a base phrase, 0 if nothing is found)."""
    templates = list(templates)
    order = word_order(df, text, templates)
    rank = {w: i for i, w in enumerate(order)}
    parts = pieces(templates)
    sets = [sorted(set(t), key=rank.__getitem__) for _, t in parts]
    prefixes = sorted({w for t in sets for w in t[: len(t) - _needed(len(t)) + 1]}, key=rank.__getitem__)

    rows = df.select(
        F.monotonically_increasing_id().alias("_row"), F.col(id).alias("_id"), *[F.col(k).alias(f"_keep_{k}") for k in keep],
        words(text_or_empty(text)).alias("_words"),
    )
    carried = ["_row", "_id", *[f"_keep_{k}" for k in keep], "n_words", "places"]
    n = F.size("_words")
    cut = F.transform(F.sequence(F.lit(0), F.floor((n - 1) / (BLOCK // 2)).cast("int")), lambda b: F.slice("_words", b * (BLOCK // 2) + 1, BLOCK))
    blocks = F.filter(cut, lambda b: F.arrays_overlap(b, _strings(prefixes)))
    rows = rows.withColumns({
        "n_words": n.cast("long"), "places": phrase_places(F.col("_words"), phrases),
        # In the order of the first array: rarest first.
        "_blocks": F.when(F.arrays_overlap("_words", _strings(prefixes)), F.transform(blocks, lambda b: F.array_intersect(_strings(order), b))),
    })
    blocks_rows = rows.select(*carried, F.explode_outer("_blocks").alias("_block"))

    # Prefix entries of the templates: a constant relation.
    entries = [
        F.struct(F.lit(w).alias("_word"), F.lit(j).alias("_j"), F.lit(label).alias("_label"), F.lit(len(t)).alias("_size"), F.lit(_needed(len(t))).alias("_need"), _strings(t).alias("_template"))
        for (label, _), t in zip(parts, sets, strict=True) for j, w in enumerate(t[: len(t) - _needed(len(t)) + 1])
    ]
    index = df.sparkSession.range(1).select(F.inline(F.array(*entries)))
    probes = blocks_rows.select(*carried, "_block", F.posexplode_outer("_block").alias("_i", "_word"))
    size = F.size("_block")
    possible = (
        (size >= F.col("_need")) & (F.col("_i") <= size - F.col("_need"))
        & (F.least(size - F.col("_i"), F.col("_size") - F.col("_j")) >= F.col("_need"))
    )
    held = F.when(possible, F.size(F.array_intersect("_block", "_template")))
    met = probes.join(F.broadcast(index), "_word", "left").withColumn("_held", held)
    hit = F.col("_held") >= F.col("_need")
    grouped = met.groupBy(*carried).agg(
        F.collect_set(F.when(hit, F.col("_label"))).alias("labels"),
        F.coalesce(F.max(F.when(hit, F.col("_held") / F.col("_size"))), F.lit(0.0)).alias("_score"),
    )
    return grouped.select(
        F.col("_id").alias(id), *[F.col(f"_keep_{k}").alias(k) for k in keep], "n_words", "places", "labels",
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.col("_score")).alias("score"),
    )


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


LICENSE_SQL = rf"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS w
    FROM documents
), phrases AS (
    SELECT unnest({_sql_list(PHRASES)}) AS phrase, unnest({_sql_list(PHRASES.values())}) AS label
), places AS (
    SELECT r, i - 1 AS start, label FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), phrases
    WHERE w[i] = string_split(phrase, ' ')[1] AND w[i : i + len(string_split(phrase, ' ')) - 1] = string_split(phrase, ' ')
), templates AS (
    SELECT label, list_distinct(string_split(t, ' ')) AS t
    FROM (SELECT unnest({_sql_list(x for x, _ in TEMPLATES)}) AS label, unnest({_sql_list(x for _, x in TEMPLATES)}) AS t)
), blocks AS (
    SELECT r, w[b + 1 : b + {BLOCK}] AS b FROM (SELECT r, w, unnest(range(0, len(w), {BLOCK // 2})) AS b FROM d)
), met AS (
    SELECT r, label, len(list_intersect(t, b)) / len(t)::DOUBLE AS part FROM blocks, templates
    WHERE len(list_intersect(t, b)) >= ceil(round({THRESHOLD} * len(t), 9))
), p AS (
    SELECT r, count(*) AS n, min(start) AS a, max(start) AS z, list(DISTINCT label) AS labels FROM places GROUP BY r
), m AS (SELECT r, list(DISTINCT label) AS labels, max(part) AS part FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, z AS last_word,
       coalesce(array_to_string(list_sort(p.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(p.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score
FROM d LEFT JOIN p USING (r) LEFT JOIN m USING (r)"""
