"""Hard negatives: for an anchor and each of its nearest rows of the same label, the nearest rows of other labels that score just below.

Scores are integer inner products of quantised vectors. Rows are packed into blocks, and every block of anchors meets every block of rows as a
pair of matrices; the anchors are a stated set of queries. Blocks are dealt to the cells of a grid, groups of rows by groups of anchors: a cell is
a task that holds its rows and lets its anchors pass. They come there by a shuffle and never by a broadcast, whose copies the driver would
gather. Two passes:

1. Positives: a cell gives, per anchor, its best rows of the same label; of those the best :data:`POSITIVES` stay.
2. Negatives: the scores of the positives open windows: a row of another label belongs to the window of a positive of score ``p`` if its own is
   at most ``p`` and at least :data:`LOW` / :data:`HIGH` of it. A cell gives, per anchor and window, the best :data:`NEGATIVES` rows, as only
   they can be among the best of all.

What is left goes through a secondary sort: positives and candidates are packed into binary keys (anchor, descending score, kind, id), partitioned
by anchor and sorted inside partitions by key (the DataFrame form of ``repartitionAndSortWithinPartitions``). An iterator streams over the sorted
rows: a positive opens its window, a candidate is given to all open windows that it is in and that are not full, and nothing but the open
windows of one anchor is held. At equal scores positives come first, since a candidate of the same score is in their window.

Skew: blocks are cut by rows, so neither a label, nor a vector, nor an id that holds a third of all rows makes a task larger. The work is queries x rows, as the
question is; nothing of it is broadcast, and only counts reach the driver.

Defined results: rows with a null id, label or vector, or with a component that is null or not finite, take no part. Rows of the
anchor's own id are no partners of it; each row of an anchor's id is an anchor of its own. Rows that repeat as a whole are rows. Vectors of
different lengths have no score with each other. Components so large that a score would not be exact as a double are
multiplied as 64-bit integers; where even that would not do, the query stops with a message. An empty table, or one without anchors, gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import struct
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import hashed, materialize, release
from offerloom.session import shuffle_width

SCALE = 256
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100
# Rows and anchors of a block.
ROWS, ANCHORS = 4096, 512
# Anchors that are scored at a time, so that a matrix of scores stays in the cache.
SLICE = 256
# A cell has at least so many products of components (or is the only one), and holds about so many bytes of rows. Bytes that an anchor's best rows take in each cell.
CELL, HELD, GIVEN = 1 << 33, 1 << 25, 256
_BLOCK = "place long, dim int, ids binary, labels binary, vectors binary, windows binary"
_NONE, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
_KEY = struct.Struct(">QQQBQ")
_SIGN = 1 << 63


def quantised(vector: Column, scale: int = SCALE) -> Column:
    """Each component x becomes floor(scale * x), as an integer."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite numbers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    return F.coalesce(F.forall(vector, finite), F.lit(False))


def _packed(rows: DataFrame, size: int, windows: int) -> DataFrame:
    """Blocks of up to ``size`` rows of one length. ``rows``: id, label, q and, with ``windows``, that many scores of positives."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[pa.RecordBatch]] = {}
        count: dict[int, int] = {}

        def block(dim: int) -> pa.RecordBatch:
            t = pa.Table.from_batches(held.pop(dim)).combine_chunks()
            del count[dim]
            flat = lambda name: pa.concat_arrays([c.flatten() for c in t.column(name).chunks]).to_numpy(zero_copy_only=False).astype("<i8")
            plain = lambda name: t.column(name).to_numpy().astype("<i8").tobytes()
            columns = [[0], [dim], [plain("id")], [plain("label")], [narrow(flat("q")).tobytes()], [flat("scores").tobytes() if windows else b""]]
            kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 4]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], _BLOCK_NAMES)

        for batch in batches:
            dims = np.diff(batch.column("q").offsets.to_numpy())
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                while len(part):
                    taken = part.slice(0, size - count.get(dim, 0))
                    held.setdefault(dim, []).append(taken)
                    count[dim] = count.get(dim, 0) + len(taken)
                    part = part.slice(len(taken))
                    if count[dim] == size:
                        yield block(dim)
        for dim in list(held):
            yield block(dim)
        release()

    names = ["id", "label", "q"] + (["scores"] if windows else [])
    packed = rows.select(*names).mapInArrow(pack, _BLOCK)
    # The number of the task and that of the block in it, which takes far fewer bits than are kept for it.
    number = F.monotonically_increasing_id()
    return packed.withColumn("place", F.shiftleft(F.shiftright(number, 33), 20) + number.bitwiseAND(F.lit((1 << 20) - 1)))


_BLOCK_NAMES = [c.split()[0] for c in _BLOCK.split(", ")]


def narrow(a: np.ndarray) -> np.ndarray:
    """The same integers in two, four or eight bytes each."""
    for kind in ("<i2", "<i4"):
        if a.min(initial=0) >= np.iinfo(kind).min and a.max(initial=0) <= np.iinfo(kind).max:
            return a.astype(kind)
    return a


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of all rows of ``a`` and ``b``, exact: as floats where all sums fit them, else as 64-bit integers."""
    size = lambda x: max(int(x.max(initial=0)), -int(x.min(initial=0)))
    most = size(a) * size(b) * max(1, a.shape[1])
    if most < 1 << 24:
        return a.astype(np.float32) @ b.astype(np.float32).T
    if most < 1 << 53:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if most < 1 << 63:
        return a.astype(np.int64) @ b.astype(np.int64).T
    raise ValueError("components are too large: an inner product might not fit 64 bits")


def _bound(least: np.ndarray, score: np.ndarray) -> np.ndarray:
    """A bound per row of ``score`` in its type; all scores lie inside the limits of that type."""
    limit = {np.dtype(np.float32): 1 << 24, np.dtype(np.float64): 1 << 53}.get(score.dtype)
    return (least if limit is None else np.clip(least, -limit, limit).astype(score.dtype))[:, None]


def _places(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.divmod(np.flatnonzero(chosen), chosen.shape[1])


def best(score: np.ndarray, allowed: np.ndarray, order: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``n`` largest allowed scores of each row, in no order and beside others that tie; ``order``: the rank of a column's id."""
    n_columns = score.shape[1]
    if n_columns <= n:
        return _places(allowed)
    # A threshold: columns in chunks, and of their largest scores the n-th, which n scores reach at least.
    masked = np.where(allowed, score, _NONE if score.dtype == np.int64 else score.dtype.type(-np.inf))
    chunk = max(1, n_columns // (16 * n))
    chunks = n_columns // chunk
    largest = masked[:, : chunks * chunk].reshape(len(score), chunks, chunk).max(axis=2)
    chosen = allowed & (masked >= np.partition(largest, chunks - n, axis=1)[:, chunks - n, None])
    most = max(abs(int(score.max())), abs(int(score.min())))
    if np.count_nonzero(chosen) <= 4 * n * len(score) or most >= (1 << 62) // n_columns:
        return _places(chosen)
    # Many ties: score and rank in one integer.
    key = np.where(chosen, score.astype(np.int64) * n_columns + (n_columns - 1 - order), _NONE)
    column = np.argpartition(key, n_columns - n, axis=1)[:, n_columns - n:]
    row, at = np.nonzero(np.take_along_axis(chosen, column, axis=1))
    return row, column[row, at]


class _Rows(NamedTuple):
    """A block of rows; ``sorted``: its ids in order, ``order``: the rank of each row by id."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    sorted: np.ndarray
    order: np.ndarray


def _rows(ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> _Rows:
    by = np.argsort(ids, kind="stable")
    order = np.empty(len(ids), dtype=np.int64)
    order[by] = np.arange(len(ids))
    return _Rows(ids, labels, vectors, ids[by], order)


def _unpack(record: dict, windows: int) -> tuple[np.ndarray, ...]:
    ids, labels = np.frombuffer(record["ids"], "<i8"), np.frombuffer(record["labels"], "<i8")
    components = len(ids) * record["dim"]
    vectors = np.frombuffer(record["vectors"], f"<i{len(record['vectors']) // components if components else 8}").reshape(len(ids), record["dim"])
    return ids, labels, vectors, np.frombuffer(record["windows"], "<i8").reshape(len(ids), windows)


def search(
    ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, blocks: list[_Rows], same: bool, tops: np.ndarray, bottoms: np.ndarray, n: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor, id and score of the rows of ``blocks`` that are among the ``n`` best of an anchor in one of its windows, each row once.

    ``same``: rows of the anchor's label, or of others; ``tops`` and ``bottoms``: the windows' bounds, a row per anchor.
    """
    # A window with n rows rises to the score of the last of them: few scores of later blocks reach it.
    floors, width = bottoms.copy(), bottoms.shape[1]
    tops_of_all = tops.max(axis=1)
    # Of the best so far: anchor * width + window, id, score, and a number of the row in all blocks.
    own, id, value, place = (np.empty(0, dtype=np.int64) for _ in range(4))
    before = 0
    for block in blocks:
        score = scores(vectors, block.vectors)
        allowed = score >= _bound(floors.min(axis=1), score)
        allowed &= score <= _bound(tops_of_all, score)
        allowed &= (labels[:, None] == block.labels) if same else (labels[:, None] != block.labels)
        met = block.sorted[np.minimum(np.searchsorted(block.sorted, ids), len(block.sorted) - 1)] == ids
        allowed[met] &= ids[met, None] != block.ids
        found = [(own, id, value, place)]
        sparse = np.count_nonzero(allowed) <= 16 * n * len(ids)
        if sparse:
            all_rows, all_columns = _places(allowed)
            all_values = score[all_rows, all_columns].astype(np.int64)
        for window in range(width):
            if sparse:
                inside = (all_values >= floors[all_rows, window]) & (all_values <= tops[all_rows, window])
                row, column = all_rows[inside], all_columns[inside]
            else:
                inside = allowed & (score >= _bound(floors[:, window], score)) & (score <= _bound(tops[:, window], score))
                row, column = best(score, inside, block.order, n)
            found.append((row * width + window, block.ids[column], score[row, column].astype(np.int64), column + before))
        before += len(block.ids)
        own, id, value, place = (np.concatenate(x) for x in zip(*found, strict=True))
        by = np.lexsort((id, -value, own))
        own, id, value, place = own[by], id[by], value[by], place[by]
        rank = np.arange(len(own)) - np.searchsorted(own, own)
        last = rank == n - 1
        floors.reshape(-1)[own[last]] = value[last]
        own, id, value, place = (x[rank < n] for x in (own, id, value, place))
    # Windows overlap: a row comes once per anchor.
    row = own // width
    _, first = np.unique(row * before + place, return_index=True)
    return row[first], id[first], value[first]


def _grid(rows: DataFrame, anchors: DataFrame) -> tuple[int, int]:
    """Groups of rows and of anchors, whose pairs are the cells."""

    def size(blocks: DataFrame) -> list[int]:
        n, bytes_of = F.length("ids") / 8, F.length("ids") + F.length("labels") + F.length("vectors")
        return [int(x or 0) for x in blocks.agg(F.count(F.lit(1)), F.sum(n), F.sum(n * F.col("dim")), F.sum(bytes_of)).first()]

    (blocks, n, components, row_bytes), (anchor_blocks, n_anchors, _, anchor_bytes) = size(rows), size(anchors)
    # Scores cost about as much as products of 64 components do.
    cells = min(shuffle_width(rows.sparkSession), math.ceil((components + 64 * n) * n_anchors / CELL))
    across = round(math.sqrt(cells * (anchor_bytes + GIVEN * n_anchors) / max(1, row_bytes)))
    across = max(1, min(across, anchor_blocks, cells))
    return max(1, min(max(math.ceil(cells / across), math.ceil(row_bytes / HELD)), blocks)), across


def _meet(rows: DataFrame, anchors: DataFrame, grid: tuple[int, int]) -> DataFrame:
    """Blocks of rows (``kind`` 0) and of anchors (1) by cell, a cell in a partition of its own, its rows first."""
    down, across = grid
    group = lambda n: F.pmod(F.xxhash64("place"), F.lit(n).cast("long")).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    own = rows.select(*_BLOCK_NAMES, F.lit(0).alias("kind"), group(down).alias("_down"), every(across).alias("_across"))
    asked = anchors.select(*_BLOCK_NAMES, F.lit(1).alias("kind"), every(down).alias("_down"), group(across).alias("_across"))
    dealt = own.unionByName(asked).withColumn("cell", F.col("_down") * across + F.col("_across")).drop("_down", "_across")
    return dealt.repartitionById(down * across, "cell").sortWithinPartitions("cell", "kind")


_PAIR = "anchor long, place long, id long, score long"


def _pairs(met: DataFrame, windows: int, n: int, low: int, high: int, rows_in_block: int = ROWS) -> DataFrame:
    """Best rows per anchor: of the same label without windows, of other labels and per window with them. ``place``: number of the anchor row."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, held = None, {}
        for record in (batch.slice(i, 1).to_pylist()[0] for batch in batches for i in range(len(batch))):
            if record["cell"] != cell:
                cell, held = record["cell"], {}
            if record["kind"] == 0:
                *block, _ = _unpack(record, 0)
                blocks = held.setdefault(record["dim"], [])
                # Small blocks of many files become larger ones.
                if blocks and len(blocks[-1].ids) + len(block[0]) <= rows_in_block:
                    block = [np.concatenate(x) for x in zip(blocks.pop()[:3], block, strict=True)]
                blocks.append(_rows(*block))
                continue
            ids, labels, vectors, opened = _unpack(record, windows)
            if windows:
                tops, bottoms = _bounds(opened, low, high)
            else:
                tops, bottoms = np.full((len(ids), 1), _MOST), np.full((len(ids), 1), _NONE)
            for start in range(0, len(ids), SLICE):
                part = slice(start, start + SLICE)
                row, id, score = search(ids[part], labels[part], vectors[part], held.get(record["dim"], []), not windows, tops[part], bottoms[part], n)
                place = record["place"] * ANCHORS + start + row
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (ids[part][row], place, id, score)], ["anchor", "place", "id", "score"])
        release()

    return met.mapInArrow(meet, _PAIR)


def _bounds(window: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest and least score of each window (low * window <= high * score), without products that leave 64 bits."""
    least = np.array([min(-(-low * w // high), _MOST) if w != _NONE else 0 for w in window.reshape(-1).tolist()], dtype=np.int64).reshape(window.shape)
    # A missing positive has no window; one below zero has an empty one.
    none = (window == _NONE) | (least > window)
    return np.where(none, _NONE, window), np.where(none, _MOST, least)


def _key(anchor: int, place: int, score: int, kind: int, id: int) -> bytes:
    """Binary key whose bytes sort by anchor, its row, descending score, kind and id."""
    return _KEY.pack(anchor + _SIGN, place, _SIGN - 1 - score, kind, id + _SIGN)


def stream(keys: Iterator[bytes], negatives: int, low: int, high: int) -> Iterator[tuple[int, int, int, int, int, int]]:
    """Results off the sorted keys: (anchor, positive, rank, negative, score of the positive, score of the negative)."""
    now, windows = None, []
    for key in keys:
        anchor, place, score, kind, id = _KEY.unpack(key)
        if (anchor, place) != now:
            now, windows = (anchor, place), []
        anchor, score, id = anchor - _SIGN, _SIGN - 1 - score, id - _SIGN
        if kind == 0:
            windows.append([id, score, 0])
            continue
        for window in windows:
            if window[2] < negatives and high * score >= low * window[1] and score <= window[1]:
                window[2] += 1
                yield anchor, window[0], window[2], id, window[1], score
        # Full windows close, and so do those that lie above all scores to come.
        windows = [w for w in windows if w[2] < negatives and high * score >= low * w[1]]


_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(
    df: DataFrame, anchors: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding", scale: int = SCALE,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, rows_in_block: int = ROWS,
) -> DataFrame:
    """Hard negatives of the rows of ``df`` where ``anchors`` holds, against all rows."""
    rows = df.filter(F.col(id).isNotNull() & F.col(label).isNotNull() & usable(F.col(vector))).select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), quantised(F.col(vector), scale).alias("q"),
        F.coalesce(anchors, F.lit(False)).alias("_anchor"),
    )
    blocks = materialize(_packed(rows, rows_in_block, 0), "negatives-rows")
    asked = materialize(_packed(rows.filter("_anchor"), ANCHORS, 0), "negatives-anchors")

    grid = _grid(blocks, asked)
    found = _pairs(_meet(blocks, asked, grid), 0, positives, low, high, rows_in_block)
    kept = materialize(_best_of(found, positives), "negatives-positives")
    opened = materialize(_with_windows(asked, kept, positives), "negatives-windows")
    candidates = _pairs(_meet(blocks, opened, grid), positives, negatives, low, high, rows_in_block)
    every = kept.select("anchor", "place", "score", F.lit(0).alias("kind"), "id").union(
        candidates.select("anchor", "place", "score", F.lit(1).alias("kind"), "id")
    )

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [_key(*row) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(keys, pa.binary())], ["place", "key"])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        held: list[tuple] = []

        def out() -> pa.RecordBatch:
            columns = list(zip(*held, strict=True)) or [()] * 6
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [c.split()[0] for c in _RESULT.split(", ")])

        for row in stream((key for batch in batches for key in batch.column(0).to_pylist()), negatives, low, high):
            held.append(row)
            if len(held) == 10_000:
                yield out()
        yield out()

    keyed = every.mapInArrow(packed, "place long, key binary")
    ordered = keyed.repartition(shuffle_width(df.sparkSession), "place").select("key").sortWithinPartitions("key")
    return ordered.mapInArrow(windows, _RESULT)


def _best_of(pairs: DataFrame, n: int) -> DataFrame:
    """The ``n`` best rows of each anchor row, of the few that each cell gave."""
    order = Window.partitionBy("place").orderBy(F.desc("score"), "id")
    return pairs.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _with_windows(asked: DataFrame, positives: DataFrame, n: int) -> DataFrame:
    """The blocks of anchors with the scores of their positives, a mark where there are fewer."""
    mine = (
        positives.withColumn("block", F.shiftright("place", ANCHORS.bit_length() - 1))
        .groupBy("block").agg(F.collect_list(F.struct((F.col("place") % ANCHORS).alias("row"), "rank", "score")).alias("found"))  # at most ANCHORS x n
    )
    joined = asked.drop("windows").join(hashed(mine), F.col("place") == F.col("block"), "left").select(*_BLOCK_NAMES[:-1], "found")

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            filled = []
            for ids, found in zip(batch.column("ids").to_pylist(), batch.column("found").to_pylist(), strict=True):
                window = np.full((len(ids) // 8, n), _NONE, dtype="<i8")
                for f in found or []:
                    window[f["row"], f["rank"] - 1] = f["score"]
                filled.append(window.tobytes())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(filled, pa.binary())], _BLOCK_NAMES)

    return joined.mapInArrow(fill, _BLOCK)


NEGATIVES_SQL = f"""
WITH r AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.q, c.q) AS BIGINT) AS score
    FROM r a JOIN r c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id AND len(a.q) = len(c.q)
), p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT p.anchor_id, p.positive_id,
       CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
       s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND {LOW} * p.positive_score <= {HIGH} * s.score AND s.score <= p.positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) <= {NEGATIVES}"""
