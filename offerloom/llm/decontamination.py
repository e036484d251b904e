"""Documents that hold passages of a benchmark: a broadcast hash set of word n-grams, scanned over all windows of all texts.

Texts are lower-cased (A-Z) and cut into words. A window is :data:`WORDS` consecutive words of a benchmark item, or the whole item if it has
fewer. The words of the benchmark are numbered, so a document becomes an array of numbers with a gap at every word that the benchmark does
not know; only stretches without a gap can hold a window. Their hashes are looked up in the set, a bitmap first, and each hit is verified number by
number, so no hash decides. A document word inside any occurrence of a window is hit.

The set is broadcast behind a check of its size: :data:`SET_BYTES` of benchmark text at a time. A larger benchmark is cut into blocks of whole items, the
documents are scanned once per block, and the hits of a document are united.

Defined results: a null text has no words; items without words have no window; an item without id hits words and is not listed; rows of
one item id are one item; items with the same text are all listed; rows of documents repeat as they come; a text of any length is scanned whole, in memory
of some 20 times its bytes; other columns pass through, existing columns of the output's names are replaced; an empty benchmark hits nothing, an
empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from offerloom.llm.common import LOWER, UPPER, materialize, release, unused

WORDS = 10
# Bytes of benchmark text in one broadcast set.
SET_BYTES = 16_000_000
# Bytes of document text that are scanned together.
RUN_BYTES = 2_000_000
# Words of the contract: ASCII other than letters and digits separates them (fixed values).
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_APART = bytes(i for i in range(128) if not chr(i).isalnum())
_FOLD = bytes.maketrans(_APART + UPPER.encode(), b" " * len(_APART) + LOWER.encode())
_IN_TEXT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_FACTOR = 0x9E3779B97F4A7C15
FOUND = "struct<n_words:bigint,items:array<string>,spans:array<struct<start:bigint,end:bigint>>>"


def words(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def _hashes(rows: np.ndarray) -> np.ndarray:
    h = np.full(len(rows), rows.shape[1], dtype=np.uint64)
    for column in rows.T:
        h = (h ^ column.astype(np.uint64)) * np.uint64(_FACTOR)
        h ^= h >> np.uint64(29)
    return h


class Windows:
    """All distinct windows of one length: hash set, the windows themselves, and the items of each."""

    def __init__(self, rows: np.ndarray, items: np.ndarray):
        distinct, of = np.unique(rows, axis=0, return_inverse=True)
        hashes = _hashes(distinct)
        order = np.argsort(hashes, kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.rows, self.hashes = distinct[order], hashes[order]
        pairs = np.unique(np.stack([place[of.ravel()], items], axis=1), axis=0)
        self.item = pairs[:, 1]
        self.first = np.searchsorted(pairs[:, 0], np.arange(len(distinct) + 1))
        self.bits = max(10, (16 * len(distinct)).bit_length())
        self.map = np.zeros(1 << self.bits, dtype=bool)
        self.map[self._slot(self.hashes)] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, codes: np.ndarray, unknown_before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places where a window stands, and which; ``unknown_before``: unknown words before each place."""
        size = self.rows.shape[1]
        none = np.zeros(0, dtype=np.int64)
        if len(codes) < size:
            return none, none
        at = np.flatnonzero(unknown_before[size:] == unknown_before[:-size])
        found_at, found = [none], [none]
        for start in range(0, len(at), 200_000):
            part = at[start : start + 200_000]
            hashes = _hashes(codes[part[:, None] + np.arange(size)])
            maybe = self.map[self._slot(hashes)]
            part, hashes = part[maybe], hashes[maybe]
            place = np.searchsorted(self.hashes, hashes, "left")
            while len(part):  # again only where different windows share a hash
                inside = place < len(self.hashes)
                inside[inside] = self.hashes[place[inside]] == hashes[inside]
                part, hashes, place = part[inside], hashes[inside], place[inside]
                equal = (codes[part[:, None] + np.arange(size)] == self.rows[place]).all(axis=1)
                found_at.append(part[equal])
                found.append(place[equal])
                part, hashes, place = part[~equal], hashes[~equal], place[~equal] + 1
        return np.concatenate(found_at), np.concatenate(found)


class GramSet:
    """Windows of a benchmark by length; ``items``: rows of (id or None, text)."""

    def __init__(self, items: Sequence[tuple[str | None, str | None]], size: int = WORDS):
        self.names = sorted({name for name, _ in items if name is not None})
        number = {name: i for i, name in enumerate(self.names)} | {None: -1}
        self.code: dict[bytes, int] = {}
        rows: dict[int, list[np.ndarray]] = {}
        owner: dict[int, list[np.ndarray]] = {}
        for name, text in items:
            codes = np.array([self.code.setdefault(w, len(self.code)) for w in words(text)], dtype=np.int32)
            if len(codes):
                n = min(size, len(codes))
                found = np.lib.stride_tricks.sliding_window_view(codes, n)
                rows.setdefault(n, []).append(found)
                owner.setdefault(n, []).append(np.full(len(found), number[name], dtype=np.int64))
        self.windows = [Windows(np.concatenate(rows[n]), np.concatenate(owner[n])) for n in sorted(rows)]

    def scan(self, texts: list[str | None]) -> list[dict]:
        """Per text: number of words, names of the items found, and stretches of hit words."""
        cut = [words(text) for text in texts]
        sizes = np.fromiter(map(len, cut), dtype=np.int64, count=len(cut))
        ends = np.cumsum(sizes + 1)
        begins = ends - sizes - 1
        # One array for all texts, with an unknown word between, so that no window reaches from one into the next.
        codes = np.full(int(ends[-1]) if len(ends) else 0, -1, dtype=np.int32)
        for begin, ws in zip(begins.tolist(), cut, strict=True):
            codes[begin : begin + len(ws)] = np.fromiter(map(self.code.get, ws, repeat(-1)), dtype=np.int32, count=len(ws))
        unknown = np.concatenate([[0], np.cumsum(codes < 0)])
        change = np.zeros(len(codes) + 1, dtype=np.int64)
        texts_of, items_of = [], []
        for group in self.windows:
            at, which = group.find(codes, unknown)
            np.add.at(change, at, 1)
            np.add.at(change, at + group.rows.shape[1], -1)
            pairs = np.unique(np.stack([np.searchsorted(ends, at, "right"), which], axis=1), axis=0)
            n = group.first[pairs[:, 1] + 1] - group.first[pairs[:, 1]]
            upto = np.cumsum(n)
            texts_of.append(np.repeat(pairs[:, 0], n))
            items_of.append(group.item[np.repeat(group.first[pairs[:, 1]] - upto + n, n) + np.arange(len(texts_of[-1]))])
        out = [{"n_words": n, "items": [], "spans": []} for n in sizes.tolist()]
        if self.windows:
            for text, item in np.unique(np.stack([np.concatenate(texts_of), np.concatenate(items_of)], axis=1), axis=0).tolist():
                if item >= 0:
                    out[text]["items"].append(self.names[item])
        # A stretch ends at the latest at the gap behind its text.
        edge = np.flatnonzero(np.diff(np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)))
        starts, stops = edge[::2], edge[1::2]
        for text, start, stop in zip(np.searchsorted(ends, starts, "right").tolist(), starts.tolist(), stops.tolist(), strict=True):
            out[text]["spans"].append({"start": start - int(begins[text]), "end": stop - int(begins[text])})
        return out


_FOUND_TYPE = pa.struct([
    ("n_words", pa.int64()), ("items", pa.list_(pa.string())), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
])


def _text_groups(texts: pa.Array) -> Iterator[list[str | None]]:
    group, size = [], 0
    for value in texts:
        group.append(value.as_py())
        size += len(group[-1] or "")
        if size >= RUN_BYTES:
            yield group
            group, size = [], 0
    if group:
        yield group


def _scan(df: DataFrame, items: Sequence[tuple[str | None, str | None]], size: int, text: Column) -> Column:
    shared = df.sparkSession.sparkContext.broadcast(GramSet(items, size))

    def scan(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = [pa.array(shared.value.scan(group), _FOUND_TYPE) for group in _text_groups(texts)]
            yield pa.concat_arrays(parts) if parts else pa.array([], _FOUND_TYPE)
        release()

    return arrow_udf(scan, FOUND)(text)


def _united(lists: pa.Array) -> pa.Array:
    """Stretches united where they meet or overlap, as those of one block are."""
    out = []
    for spans in lists.to_pylist():
        kept: list[dict] = []
        for span in sorted(spans or [], key=lambda s: (s["start"], s["end"])):
            if kept and span["start"] <= kept[-1]["end"]:
                kept[-1]["end"] = max(kept[-1]["end"], span["end"])
            else:
                kept.append(dict(span))
        out.append(kept)
    return pa.array(out, _FOUND_TYPE.field("spans").type)


def find(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    size: int = WORDS, set_bytes: int = SET_BYTES,
) -> DataFrame:
    """Add ``n_words``, ``n_hit``, ``items`` (names of the items found, sorted as strings) and ``spans`` (hit words, as stretches from 0, end exclusive)."""
    items = benchmark.select(F.col(item_id).cast("string").alias("id"), F.col(item_text).cast("string").alias("text")).filter("text IS NOT NULL")
    bytes_of = F.octet_length("text") + F.coalesce(F.octet_length("id"), F.lit(0)) + 16
    total = items.agg(F.sum(bytes_of.cast("long"))).first()[0] or 0
    blocks = 1 if total <= set_bytes else -(-2 * total // set_bytes)
    found = unused(df, "_found")
    if blocks == 1:
        rows = [(r["id"], r["text"]) for r in items.collect()]  # at most set_bytes
        out = df.withColumn(found, _scan(df, rows, size, F.col(text).cast("string")))
    else:
        out = _find_in_blocks(df, items, blocks, size, text, found)
    out = out.withColumns({
        "n_words": F.col(found)["n_words"],
        "n_hit": F.aggregate(F.col(found)["spans"], F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]),
        "items": F.array_sort(F.col(found)["items"]), "spans": F.col(found)["spans"],
    })
    return out.drop(found)


def _find_in_blocks(df: DataFrame, items: DataFrame, blocks: int, size: int, text: str, found: str) -> DataFrame:
    """As one set would find them: a scan per block of items, the hits of each row united by its number in a written copy."""
    row = unused(df, "_row")
    rows = materialize(df.withColumn(row, F.monotonically_increasing_id()), "benchmark-rows")
    dealt = materialize(items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks))), "benchmark-items")
    hits = []
    for block in range(blocks):
        part = [(r["id"], r["text"]) for r in dealt.filter(F.col("block") == block).collect()]  # about half of set_bytes
        scanned = rows.select(row, _scan(df, part, size, F.col(text).cast("string")).alias("_f"))
        # The first block also counts the words of all rows.
        kept = scanned if block == 0 else scanned.filter("size(_f.spans) > 0")
        hits.append(materialize(kept, "benchmark-hits"))
    every = hits[0]
    for more in hits[1:]:
        every = every.union(more)
    united = every.groupBy(F.col(row).alias("_r")).agg(
        F.max("_f.n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_list("_f.items"))).alias("items"),
        F.flatten(F.collect_list("_f.spans")).alias("spans"),
    ).select("_r", F.struct("n_words", "items", arrow_udf(_united, "array<struct<start:bigint,end:bigint>>")("spans").alias("spans")).alias(found))
    return rows.join(united, rows[row] == united["_r"]).drop(row, "_r")


def _without(texts: pa.Array, spans: pa.Array) -> pa.Array:
    out = []
    for text, gone in zip(texts, spans, strict=True):
        text, gone = text.as_py(), gone.as_py()
        if text and gone:
            places = [m.span() for m in _IN_TEXT.finditer(text)]
            kept, at = [], 0
            for span in gone:
                kept.append(text[at : places[span["start"]][0]])
                at = places[span["end"] - 1][1]
            text = "".join([*kept, text[at:]])
        out.append(text)
    return pa.array(out, pa.string())


def remove(df: DataFrame, benchmark: DataFrame, whole_documents: bool = True, text: str = "text", **options) -> DataFrame:
    """Rows of ``df`` without benchmark passages: contaminated documents go, or, else, the stretches of hit words are cut out of their texts."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    keep = unused(df, "_keep")
    kept = df.select(F.struct(*columns).alias(keep), F.col(text).cast("string").alias("_text"))
    found = find(kept, benchmark, text="_text", **options)
    if whole_documents:
        return found.filter("n_hit = 0").select(f"{keep}.*")
    fields = [F.when(F.col("n_hit") > 0, arrow_udf(_without, "string")("_text", "spans")).otherwise(F.col("_text")).alias(c) if c == text else F.col(keep)[c].alias(c) for c in df.columns]
    return found.select(*fields)


_SQL_WORDS = rf"regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '{WORD_PATTERN}')"
DECONTAMINATION_SQL = rf"""
WITH d AS (SELECT doc_id, coalesce({_SQL_WORDS}, []) AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_SQL_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
g AS (
    SELECT DISTINCT item_id, least(len(w), {WORDS}) AS n,
           unnest(list_transform(range(1, greatest(len(w) - {WORDS}, 0) + 2), lambda i: array_to_string(w[i:i + least(len(w), {WORDS}) - 1], ' '))) AS gram
    FROM b WHERE len(w) > 0
), p AS (
    SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda i: {{'i': i, 'gram': array_to_string(w[i:i + n - 1], ' ')}})) AS s
    FROM d JOIN (SELECT DISTINCT n FROM g) ON len(w) >= n
), h AS (
    SELECT p.doc_id, p.s.i AS i, p.n, g.item_id FROM p JOIN g ON g.n = p.n AND g.gram = p.s.gram
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM h)) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS names FROM h GROUP BY doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hit.n_hit, 0) AS n_hit, coalesce(named.n_items, 0) AS n_items,
       sha256(coalesce(named.names, '')) AS items_sha256, coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""
