"""Documents whose word n-gram sets overlap by Jaccard 0.8 or more: an exact join, and its connected groups.

A set holds 64-bit hashes of the distinct shingles of :data:`WORDS` words. Documents with the same set (by a 128-bit digest of the sorted hashes) are one
class, stood for by its smallest id; only classes are compared, so copies are never expanded into pairs.

1. Most links, cheaply: of the classes with the smallest and those with the largest id among all that share one of :data:`KEYS` min-hashes with it,
   each class takes the one that shares most of them: two pairs per class at most. The pairs are checked exactly and give first groups.
2. All others: two sets link only if they share a shingle among the first ``n - ceil(0.8 n) + 1`` of each, in any common order. The order puts
   shingles that many documents share last, so prefixes hold rare ones. Classes that share such a shingle and lie in different
   groups so far meet in a tile: by shingle and size band, as sizes of a linked pair differ by 1.25 at most. A tile of more than
   :data:`TILE` classes is cut, and parts meet part by part. In a tile, bitmap signatures (one bit per hashed shingle) are compared: the bits
   that differ bound the overlap from above. What is left is checked exactly, by intersecting the sorted arrays.
3. Links give groups by connected components.

Step 1 and the order of step 2 only save work: whatever they miss, step 2 finds, as its filters never drop a pair that links.

Defined results: a text that is null or has no words has an empty set and links with nothing; with fewer words than a shingle the
whole sequence is the only shingle; a long text gives all its shingles, held as one array in the task that reads it; rows that repeat an id are one node; a row without an id links with nothing and has no group;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import connected_components, materialize, release

WORDS = 5
KEYS = 8
TILE = 1024
# Tiles up to this size go without signatures; the pairs they leave are compared by signature afterwards.
SMALL_TILE = 64
# Shingles known as common: how many, in how many documents of a run one must stand to be counted, and shingles in such a run.
COMMON = 1 << 16
COMMON_IN_RUN = 3
COMMON_RUN = 1 << 21
RUN_CHARS = 1_000_000
# Ids that may be broadcast to pick texts; beyond it texts and ids are shuffled.
BROADCAST_IDS = 1_000_000
_FACTOR = np.uint64(0x9E3779B97F4A7C17)
_PERMUTE = [np.uint64(x * 2 + 1) for x in np.random.default_rng(5).integers(1 << 62, size=KEYS).tolist()]


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes. Bytes split at and lower-case just the ASCII characters meant."""
    import xxhash

    words = (text or "").encode().lower().split()
    w = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    size = max(1, len(w) - WORDS + 1) if len(w) else 0
    h = np.full(size, min(len(w), WORDS), dtype=np.uint64)
    for i in range(min(len(w), WORDS)):
        h = h * _FACTOR + w[i : i + size]
    return np.unique(_mix(h))


def needed(n: int) -> int:
    """Least overlap of a set of n with any partner."""
    return -(-4 * n // 5)


def width(n: int) -> int:
    """Bits of the signature: a power of two, at least 4 n, so that few shingles share a bit."""
    return max(64, 1 << (4 * n - 1).bit_length())


def signature(s: np.ndarray) -> bytes:
    bits = np.zeros(width(len(s)), dtype=np.uint8)
    bits[(s & np.uint64(len(bits) - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little").tobytes()


def fold(bits: np.ndarray, words: int) -> np.ndarray:
    """A signature (64-bit words) made narrower: bit i and bit i + half become one."""
    while len(bits) > words:
        bits = bits[: len(bits) // 2] | bits[len(bits) // 2 :]
    return bits


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[list, list]]:
    """Ids and texts in runs of bounded size."""
    ids, texts, size = [], [], 0
    for id, value in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
        ids.append(id)
        texts.append(value.as_py())
        size += len(texts[-1] or "")
        if size >= RUN_CHARS:
            yield ids, texts
            ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


SKETCH = "id bigint, n bigint, digest binary, keys array<bigint>, bits binary, common array<bigint>, counts array<bigint>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per document, and per run of :data:`COMMON_RUN` shingles one (n = -1) with those that several of its documents share."""
    many = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), pa.binary(), many, pa.binary(), many, many]
    names = ["id", "n", "digest", "keys", "bits", "common", "counts"]
    held: list[np.ndarray] = []

    def shared() -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        often = counts >= COMMON_IN_RUN
        row = [None, -1, None, None, None, values[often].view(np.int64), counts[often]]
        held.clear()
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

    for batch in batches:
        for ids, texts in _texts(batch):
            sets = [shingles(t) for t in texts]
            keys = [[int((s * p).min().view(np.int64)) for p in _PERMUTE] if len(s) else [] for s in sets]
            none = [None] * len(sets)
            columns = [
                ids, [len(s) for s in sets], [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], keys,
                [signature(s) if len(s) else b"" for s in sets], none, none,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)
            held += sets
            if sum(map(len, held)) >= COMMON_RUN:
                yield shared()
    if held:
        yield shared()
    release()


def _bound_holds(a: pa.Array, b: pa.Array, na: pa.Array, nb: pa.Array) -> pa.Array:
    """Whether the signatures leave room for a link."""
    out = []
    for x, y, m, n in zip(a, b, na.to_pylist(), nb.to_pylist(), strict=True):
        if not x.is_valid or not y.is_valid:  # an id with several texts
            out.append(True)
            continue
        x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
        words = min(len(x), len(y))
        differ = int(np.bitwise_count(fold(x, words) ^ fold(y, words)).sum())
        out.append(9 * (m + n - differ) >= 8 * (m + n))
    return pa.array(out, pa.bool_())


def _links(a: pa.Array, b: pa.Array) -> pa.Array:
    """Exact intersection of sorted arrays: does 100 * common >= 80 * union hold."""
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
        short, long = (x, y) if len(x) <= len(y) else (y, x)
        at = np.minimum(np.searchsorted(long, short), len(long) - 1)
        common = int((long[at] == short).sum())
        out.append(100 * common >= 80 * (len(x) + len(y) - common))
    return pa.array(out, pa.bool_())


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for ids, texts in _texts(batch):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array([shingles(t).tobytes() for t in texts], pa.binary())], ["id", "set"])
    release()


def verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Those of the pairs ``a``, ``b`` that link."""
    pairs = materialize(pairs, "jaccard-pairs")
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "jaccard-ids")
    few = ids.count() <= BROADCAST_IDS
    texts = docs.join(F.broadcast(ids) if few else ids, "id", "left_semi")
    sets = materialize(texts.mapInArrow(_sets, "id bigint, set binary").filter(F.length("set") > 0), "jaccard-sets")
    both = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("_x")), "a")
    both = both.join(sets.select(F.col("id").alias("b"), F.col("set").alias("_y")), "b")
    test = F.arrow_udf(_links, "boolean")
    return materialize(both.filter(test("_x", "_y")).select("a", "b").distinct(), "jaccard-links")


def _prefixes(docs: DataFrame, common: list[int]) -> DataFrame:
    """``id``, set size ``n`` and prefix shingles of every document. ``common``: shared shingles, the less common first."""
    values = np.array(common, dtype=np.int64).view(np.uint64)
    order = np.argsort(values)
    shared = docs.sparkSession.sparkContext.broadcast((np.append(values[order], np.uint64(0)), order))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, place = shared.value
        size = len(place)
        for batch in batches:
            for ids, texts in _texts(batch):
                out, sizes = [], []
                for text in texts:
                    s = shingles(text)
                    sizes.append(len(s))
                    length = len(s) - needed(len(s)) + 1 if len(s) else 0
                    at = np.searchsorted(known[:size], s)
                    shared_here = (known[at] == s) & (at < size)
                    first = s[~shared_here]
                    if len(first) < length:
                        last = s[shared_here][np.argsort(place[at[shared_here]])]
                        first = np.concatenate([first, last])
                    out.append(first[:length].view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(out, pa.list_(pa.int64()))], ["id", "n", "prefix"]
                )
        release()

    return docs.mapInArrow(cut, "id bigint, n bigint, prefix array<bigint>")


def _tile_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of a tile that lie in different groups and whose sizes and signatures leave room for a link."""
    for batch in batches:
        for members in batch.column(0):
            rows = members.as_py()
            n = np.array([r["n"] for r in rows])
            part, home, group = (np.array([r[k] for r in rows]) for k in ("part", "home", "group"))
            ids = np.array([r["id"] for r in rows])
            # Without a signature (an id with several texts) nothing is ruled out.
            raw = [np.frombuffer(r["bits"] or b"", dtype=np.uint64) for r in rows]
            own = np.array([len(b) for b in raw])
            # Each pair is compared at the narrower of its two widths.
            widths = [w for w in np.unique(own).tolist() if w]
            folded = {w: np.array([fold(b, w) if len(b) >= w else np.zeros(w, dtype=np.uint64) for b in raw]) for w in widths}
            left, right = [], []
            low, high = rows[0]["low"], rows[0]["high"]
            for i in range(len(rows)):
                # Home meets home once, and home meets guest; within the two parts of this tile.
                fits = (part[i] == low) & (part == high) | (part[i] == high) & (part == low)
                fits &= (group != group[i]) & (4 * n[i] <= 5 * n) & (4 * n <= 5 * n[i])
                fits &= home & (ids > ids[i]) if home[i] else home
                others = np.flatnonzero(fits)
                if len(others):
                    room = (own[others] == 0) | (own[i] == 0)
                    for w in widths:
                        if w > own[i]:
                            break
                        here = own[others] >= w if w == own[i] else own[others] == w
                        at = others[here]
                        differ = np.bitwise_count(folded[w][at] ^ folded[w][i]).sum(axis=1).astype(np.int64)
                        total = n[at] + n[i]
                        room[here] |= 9 * (total - differ) >= 8 * total
                    others = others[room]
                    left += np.minimum(ids[others], ids[i]).tolist()
                    right += np.maximum(ids[others], ids[i]).tolist()
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])
    release()


def _tiles(entries: DataFrame, bits: DataFrame) -> DataFrame:
    """Candidate pairs ``a``, ``b`` of entries (``key``, ``id``, ``group``, ``n``), with the signatures ``bits`` by ``id``."""
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25)) + 1e-9)
    # Linked sizes lie in one band or in neighbours: a class is at home in its band and a guest in the one below.
    homes = F.array(*[F.struct((band - d).cast("int").alias("band"), F.lit(d == 0).alias("home")) for d in (0, 1)])
    spread = entries.withColumn("_tile", F.explode(homes)).select("key", "id", "group", "n", "_tile.band", "_tile.home")
    tiles = spread.groupBy("key", "band").agg(
        F.count(F.lit(1)).alias("_size"), F.min("group").alias("_low"), F.max("group").alias("_high"), F.max("home").alias("_any")
    ).filter((F.col("_low") < F.col("_high")) & F.col("_any"))
    parts = F.ceil(F.col("_size") / TILE).cast("int").alias("parts")
    tiles = materialize(tiles.select("key", "band", parts, (F.col("_size") <= SMALL_TILE).alias("small")), "jaccard-tiles")
    placed = spread.join(tiles, ["key", "band"])
    one = F.lit(0)
    alone = F.struct("id", "group", "n", "home", one.alias("part"), one.alias("low"), one.alias("high"), F.lit(None).cast("binary").alias("bits"))
    small = placed.filter("small").groupBy("key", "band").agg(F.collect_list(alone).alias("members"))
    met = placed.filter("not small").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
    met = met.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumns(
        {"low": F.least("part", "_other"), "high": F.greatest("part", "_other")}
    )
    row = F.struct("id", "group", "n", "home", "part", "low", "high", "bits")
    large = met.join(bits.select("id", "bits"), "id").groupBy("key", "band", "low", "high").agg(F.collect_list(row).alias("members"))
    found = small.select("members").unionAll(large.select("members")).mapInArrow(_tile_pairs, "a bigint, b bigint").distinct()
    return _within_bound(materialize(found, "jaccard-found"), bits)


def _within_bound(pairs: DataFrame, sides: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` whose sizes and signatures leave room for a link. ``sides``: ``id``, ``n``, ``bits``."""
    both = pairs.join(sides.withColumnsRenamed({"id": "b", "n": "_nb", "bits": "_y"}), "b")
    both = both.join(sides.withColumnsRenamed({"id": "a", "n": "_na", "bits": "_x"}), "a")
    # An id with several texts has no signature, and no one size.
    fits = both.filter("_x is null or _y is null or (4 * _na <= 5 * _nb and 4 * _nb <= 5 * _na)")
    return fits.filter(F.arrow_udf(_bound_holds, "boolean")("_x", "_y", "_na", "_nb")).select("a", "b").distinct()


def near_duplicates(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id``, ``n_shingles``, ``component_id`` (smallest id reachable by links)."""
    docs = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    sketches = materialize(docs.mapInArrow(_sketch, SKETCH), "jaccard-sketches")
    rows = sketches.filter("n >= 0").select("id", "n", "digest")
    named = docs.filter("id is not null")
    classes = materialize(
        sketches.filter("n > 0 and id is not null").groupBy("digest", "n")
        .agg(F.min("id").alias("id"), F.any_value("keys").alias("keys"), F.any_value("bits").alias("bits")),
        "jaccard-classes",
    )

    # 1. One partner per class by min-hashes.
    keyed = classes.select("id", "n", F.explode("keys").alias("key"))
    ends = keyed.groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last")
    either = F.explode(F.array("first", "last")).alias("a")
    votes = keyed.join(materialize(ends, "jaccard-leaders"), "key").select("id", either, "first")
    votes = votes.filter("a <> id").groupBy("id", (F.col("a") == F.col("first")).alias("_low"), "a").agg(F.count(F.lit(1)).alias("_votes"))
    chosen = votes.groupBy("id", "_low").agg(F.max(F.struct("_votes", (-F.col("a")).alias("a"))).alias("_best"))
    partners = chosen.select(F.greatest("id", -F.col("_best.a")).alias("b"), F.least("id", -F.col("_best.a")).alias("a")).distinct()
    first = verified(named, _within_bound(partners, classes.select("id", "n", "bits")))
    # Rows that repeat an id: their classes are one node.
    member = rows.filter("n > 0 and id is not null").join(classes.select("digest", "n", F.col("id").alias("class")), ["digest", "n"])
    twice = member.groupBy("id").agg(F.min("class").alias("a"), F.max("class").alias("_last")).filter("a < _last")
    same = member.join(twice.select("id", "a"), "id").select("a", F.col("class").alias("b"))
    first = materialize(first.union(same), "jaccard-first")
    groups = materialize(connected_components(first), "jaccard-groups")

    # 2. Tiles by rare shared shingles, between groups.
    counted = sketches.filter("n = -1").select(F.explode(F.arrays_zip("common", "counts")).alias("_c"))
    counted = counted.groupBy(F.col("_c.common").alias("value")).agg(F.sum("_c.counts").alias("n"))
    top = counted.orderBy(F.desc("n"), "value").limit(COMMON)
    common = [r["value"] for r in top.orderBy("n", "value").collect()]  # at most COMMON integers
    one = F.count(F.lit(1)) == 1
    signatures = classes.groupBy("id").agg(F.max("n").alias("n"), F.when(one, F.any_value("bits")).alias("bits"))
    grouped = classes.select("id").distinct().join(groups.withColumnsRenamed({"node": "id", "component": "group"}), "id", "left")
    prefixes = _prefixes(named, common).filter("n > 0").join(grouped.withColumn("group", F.coalesce("group", "id")), "id")
    # One shuffle of the entries serves both the search for shared keys and their members: both read all its columns.
    entries = prefixes.select(F.explode_outer("prefix").alias("key"), "id", "group", "n").repartition("key")
    whole = F.struct("group", "id", "n")
    ends = entries.groupBy("key").agg(F.min(whole).alias("_low"), F.max(whole).alias("_high"))
    shared = ends.filter("_low.group < _high.group").select("key")
    met = materialize(entries.join(shared.hint("shuffle_hash"), "key").distinct(), "jaccard-entries")
    second = verified(named, _tiles(met, signatures))

    # 3. Groups over all links.
    found = connected_components(first.union(second))
    class_group = classes.select("digest", "n", F.col("id").alias("class")).join(found.withColumnRenamed("node", "class"), "class", "left")
    class_group = materialize(class_group.select("digest", "n", F.coalesce("component", "class").alias("component")), "jaccard-components")
    linked = rows.join(class_group, ["digest", "n"], "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return linked.select(F.col("id").alias(id), F.col("n").alias("n_shingles"), component.alias("component_id"))


NEAR_SQL = r"""
WITH RECURSIVE d AS (
    SELECT row_number() OVER () AS r, doc_id,
           list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
                       lambda w: w <> '') AS w
    FROM documents
), s AS (
    SELECT DISTINCT r, array_to_string(w[i : i + 4], ' ') AS g
    FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT r, count(*) AS n FROM s GROUP BY r
), p AS (
    SELECT a.r AS a, b.r AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r GROUP BY 1, 2
), l AS (
    SELECT a, b FROM p JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), t AS (
    SELECT r, r AS root FROM d
    UNION
    SELECT l.b AS r, t.root FROM t JOIN l ON l.a = t.r
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (r) JOIN (SELECT t.r, min(d.doc_id) AS component_id FROM t JOIN d ON d.r = t.root GROUP BY t.r) m USING (r)"""
