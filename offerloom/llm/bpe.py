"""Byte-level byte-pair encoding and decoding.

Texts are cut by a pattern; each match is encoded on its own (a match that is a token as a whole is that token). A segment tree over the byte positions of a match keeps
the leftmost pair of least rank; a merge takes the root, joins the pair and updates three leaves (the merged
position, its live left neighbour and the position that vanishes), each along one path to the root. The trees of
many matches are rows of one array, so that a step merges once in every match of a batch; where few rows are left they
are finished one by one.

Defined results: a null text counts as empty and gives no ids; an id list that is null decodes to no bytes; rows
repeat as they come; other columns pass through untouched, and an existing column of the output's name is replaced. An empty table gives
an empty result. A text of any length is encoded whole; it is worked on match by match, so only a single match without
any cut costs memory beyond the text: about 100 bytes a character, and time in proportion to n log n.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import StructType

from offerloom.llm.common import release, slices, unused

# Bytes of the memory of encoded matches (one per worker), what an entry costs besides its ids and characters, and the longest match
# (characters) that stays in it.
MEMORY_BYTES = 40_000_000
ENTRY_BYTES = 190
MEMORY_LENGTH = 64
# Bytes of text that are cut and encoded together, and tokens that are decoded together.
RUN_BYTES = 250_000
# Runs after which freed memory goes back to the system.
RELEASE_EVERY = 16
# Tree cells that are worked on together, and the number of rows up to which they are finished one by one.
CELLS = 1 << 18
FEW_ROWS = 12
_NONE = np.int64(2**62)
_POSITION_BITS = 36
_NO_RANK = _NONE >> _POSITION_BITS


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PairTable:
    """Rank of every pair of tokens whose bytes together are a token: a hash table in arrays, looked up by many keys at once."""

    def __init__(self, ranks: dict[bytes, int]):
        found: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    found[left << 32 | right] = rank
        self.ranks = ranks
        self.tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.byte = np.array([ranks[bytes([i])] for i in range(256)], dtype=np.int64)
        self.bits = max(4, (4 * len(found)).bit_length())
        self.keys = np.full(1 << self.bits, -1, dtype=np.int64)
        self.values = np.full(1 << self.bits, _NO_RANK, dtype=np.int64)
        keys = np.fromiter(found, dtype=np.int64, count=len(found))
        values = np.fromiter(found.values(), dtype=np.int64, count=len(found))
        slot = self._slot(keys)
        while len(keys):
            # One key takes each free slot; the others go on to the next slot.
            free = self.keys[slot] == -1
            self.keys[slot[free]] = keys[free]
            own = self.keys[slot] == keys
            self.values[slot[own]] = values[own]
            keys, values, slot = keys[~own], values[~own], (slot[~own] + 1) & (len(self.keys) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).view(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merged token, or a value above all ranks."""
        key = left << 32 | right
        slot = self._slot(key)
        there = self.keys[slot]
        out = np.where(there == key, self.values[slot], _NO_RANK)
        open_ = np.nonzero((there != key) & (there != -1))
        while len(open_[0]):
            slot[open_] = (slot[open_] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[open_]]
            hit = there == key[open_]
            done = tuple(i[hit] for i in open_)
            out[done] = self.values[slot[done]]
            open_ = tuple(i[~hit & (there != -1)] for i in open_)
        return out


def finish_row(tree: list[int], token: list[int], after: list[int], before: list[int], size: int, pairs: PairTable) -> list[int]:
    """Merge one row to its end by the same steps, cell by cell; returns its tokens."""
    width, tokens, ranks = len(tree) // 2, pairs.tokens, pairs.ranks
    mask, none = (1 << _POSITION_BITS) - 1, int(_NONE)

    def put(at: int, right: int) -> None:
        """Write the cell of the pair at ``at`` and follow its path up as far as something changes."""
        rank = ranks.get(tokens[token[at]] + tokens[token[right]]) if right < size else None
        climb(at + width, none if rank is None else rank << _POSITION_BITS | at)

    def climb(node: int, value: int) -> None:
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            value = left if left < right else right
            if tree[node] == value:
                return
            tree[node] = value
            node >>= 1

    while (least := tree[1]) < none:
        at = least & mask
        gone = after[at]
        then, prior = after[gone], before[at]
        token[at], token[gone] = least >> _POSITION_BITS, -1
        after[at] = then
        if then < size:
            before[then] = at
        climb(gone + width, none)
        put(at, then)
        if prior >= 0:
            put(prior, at)
    return [x for x in token[:size] if x >= 0]


def merge_rows(data: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> tuple[np.ndarray, np.ndarray]:
    """Merge every row to its end. ``data``: bytes, one match a row, padded to a power of two.

    Returns the token at each position and whether the position is alive.
    """
    n_rows, width = data.shape
    column = np.arange(width, dtype=np.int64)
    token = pairs.byte[data]
    alive = column < lengths[:, None]
    after = np.broadcast_to(column + 1, data.shape).copy()
    before = np.broadcast_to(column - 1, data.shape).copy()
    tree = np.full((n_rows, 2 * width), _NONE, dtype=np.int64)
    if width > 1:
        rank = pairs.rank(token[:, :-1], token[:, 1:])
        cell = np.where(alive[:, 1:] & (rank < _NO_RANK), rank << _POSITION_BITS | column[:-1], _NONE)
        tree[:, width : 2 * width - 1] = cell
    level = width
    while level > 1:
        half = level >> 1
        tree[:, half:level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
        level = half
    # From here on all arrays are flat: a row starts at row * width, its tree at row * 2 * width.
    cells, tokens, nexts, priors, living = tree.ravel(), token.ravel(), after.ravel(), before.ravel(), alive.ravel()
    rows = np.flatnonzero(tree[:, 1] < _NONE)

    def pair_cell(start: np.ndarray, size: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Cell of the pair at ``left``; none if a side lies outside the row."""
        inside = (left >= 0) & (right < size)
        rank = pairs.rank(tokens[start + np.where(inside, left, 0)], tokens[start + np.where(inside, right, 0)])
        return np.where(inside & (rank < _NO_RANK), rank << _POSITION_BITS | left, _NONE)

    while len(rows) > FEW_ROWS:
        start, size, root = rows * width, lengths[rows], rows * (2 * width)
        least = cells[root + 1]
        at = least & ((1 << _POSITION_BITS) - 1)
        gone = nexts[start + at]
        then = nexts[start + gone]
        prior = priors[start + at]
        tokens[start + at] = least >> _POSITION_BITS
        living[start + gone] = False
        nexts[start + at] = then
        inner = then < width
        priors[(start + then)[inner]] = at[inner]
        # Three leaves change; a missing left neighbour writes the vanished leaf once more.
        left = np.where(prior >= 0, prior, gone)
        node = np.concatenate([gone, at, left]) + width
        base = np.concatenate([root, root, root])
        cells[base + node] = np.concatenate(
            [np.full(len(rows), _NONE), pair_cell(start, size, at, then), pair_cell(start, size, prior, at)]
        )
        while node[0] > 1:
            node = node >> 1
            child = base + 2 * node
            cells[base + node] = np.minimum(cells[child], cells[child + 1])
        rows = rows[cells[root + 1] < _NONE]
    for row in rows.tolist():
        left = np.where(alive[row], token[row], -1).tolist()
        merged = finish_row(tree[row].tolist(), left, after[row].tolist(), before[row].tolist(), int(lengths[row]), pairs)
        token[row, : len(merged)] = merged
        alive[row] = column < len(merged)
    return token, alive


def encode_pieces(pieces: list[bytes], ranks: dict[bytes, int], pairs: PairTable) -> list[bytes]:
    """Ids of each piece as little-endian 32-bit integers. A piece that is a token as a whole is that token."""
    known = list(map(ranks.get, pieces))
    out = [b"" if rank is None else rank.to_bytes(4, "little") for rank in known]
    sizes = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
    rest = np.flatnonzero(np.fromiter((rank is None for rank in known), dtype=bool, count=len(pieces)) & (sizes > 0))
    bits = np.ceil(np.log2(np.maximum(sizes[rest], 1))).astype(np.int64)
    for bit in np.unique(bits).tolist():
        width, members = 1 << bit, rest[bits == bit]
        step = max(1, CELLS // width)
        for start in range(0, len(members), step):
            part = members[start : start + step]
            lengths = sizes[part]
            data = np.zeros((len(part), width), dtype=np.uint8)
            data[np.arange(width) < lengths[:, None]] = np.frombuffer(b"".join([pieces[i] for i in part.tolist()]), dtype=np.uint8)
            token, alive = merge_rows(data, lengths, pairs)
            flat = token[alive].astype("<u4").tobytes()
            ends = np.cumsum(alive.sum(axis=1)) * 4
            for i, begin, end in zip(part.tolist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
                out[i] = flat[begin:end]
    return out


class Codec:
    """Encoder and decoder of one worker, with a bounded memory of matches seen."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.split = regex.compile(pattern).findall
        self.ranks = read_ranks(path)
        self.pairs = PairTable(self.ranks)
        self.memory: dict[str, bytes] = {}
        self.held = 0
        tokens = self.pairs.tokens
        self.sizes = np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens))
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        memory = self.memory
        cut = [self.split(text) if text else [] for text in texts]
        unknown = [x for x in set(chain.from_iterable(cut)) if x not in memory]
        memory.update(zip(unknown, encode_pieces([x.encode() for x in unknown], self.ranks, self.pairs), strict=True))
        out = [b"".join(map(memory.__getitem__, pieces)) for pieces in cut]
        for x in unknown:
            if len(x) > MEMORY_LENGTH:
                del memory[x]
            else:
                self.held += ENTRY_BYTES + len(x) + len(memory[x])
        if self.held > MEMORY_BYTES:  # the matches met first are the common ones
            while self.held > MEMORY_BYTES * 3 // 4:
                x, ids = memory.popitem()
                self.held -= ENTRY_BYTES + len(x) + len(ids)
        return out

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All bytes of the ids, and the number of bytes up to each id."""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[ids] - ends + sizes, sizes)
        return self.bytes[places + np.arange(len(places))], ends


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(path: str, pattern: str) -> Codec:
    """The codec of this worker; one vocabulary is held at a time."""
    if (path, pattern) not in _CODECS:
        _CODECS.clear()
        _CODECS[path, pattern] = Codec(path, pattern)
    return _CODECS[path, pattern]


def _lists(rows: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    values = np.concatenate([np.zeros(0, "<i4"), *rows]).astype("<i4", copy=False)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def _decoded(worker: Codec, rows: list[np.ndarray]) -> pa.Array:
    data, ends = worker.decode(np.concatenate([np.zeros(0, "<i4"), *rows]))
    offsets = np.concatenate([[0], ends])[np.cumsum([0, *map(len, rows)])].astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _add(df: DataFrame, source: Column, kinds: dict[str, pa.DataType], work: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """``df`` with the columns ``kinds``, which ``work`` makes of ``source`` for a few rows at a time, so that no batch is held twice."""
    kept = [c for c in df.columns if c.lower() not in {name.lower() for name in kinds}]
    read = df.select(*[F.col(f"`{c}`") for c in kept], source.alias(unused(df, "_source")))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.num_columns - 1
            for i, part in enumerate(slices(batch, RUN_BYTES, at)):
                yield pa.RecordBatch.from_arrays([*part.columns[:at], *work(part.column(at))], [*kept, *kinds])
                if i % RELEASE_EVERY == 0:
                    release()
            del batch
        release()

    added = [f"`{name}` {'array<int>' if pa.types.is_list(kind) else 'binary'}" for name, kind in kinds.items()]
    schema = StructType(df.select(*[F.col(f"`{c}`") for c in kept]).schema.fields + StructType.fromDDL(", ".join(added)).fields)
    return read.mapInArrow(rows, schema)


def _encoded(path: str, pattern: str, texts: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(ids, "<i4") for ids in codec(path, pattern).encode(texts.to_pylist())]


def encode(df: DataFrame, path: str, pattern: str, text: str = "text", out: str = "ids") -> DataFrame:
    """Add ``out``: the token ids (array of int) of the whole text. ``path``: rank file, readable on the executors."""
    return _add(df, F.col(text).cast("string"), {out: pa.list_(pa.int32())}, lambda texts: [_lists(_encoded(path, pattern, texts))])


def decode(df: DataFrame, path: str, pattern: str, ids: str = "ids", out: str = "bytes") -> DataFrame:
    """Add ``out``: the bytes (binary) of the token ids."""

    @arrow_udf("binary")
    def back(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        worker = codec(path, pattern)
        for rows in batches:
            lists = (x.values.to_numpy() if x.is_valid else np.zeros(0, "<i4") for x in rows)
            # A few rows at a time, as a token may be many bytes.
            parts = [_decoded(worker, run) for run in _runs(lists, RUN_BYTES)]
            yield pa.concat_arrays(parts) if parts else pa.array([], pa.binary())
        release()

    return df.withColumn(out, back(F.col(ids)))


def _runs(lists: Iterator[np.ndarray], most: int) -> Iterator[list[np.ndarray]]:
    run, size = [], 0
    for x in lists:
        run.append(x)
        size += len(x)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode_decode(df: DataFrame, path: str, pattern: str, text: str = "text", ids: str = "ids", out: str = "bytes") -> DataFrame:
    """:func:`encode` and :func:`decode` in one pass: adds ``ids`` and the bytes that they decode to."""

    def both(texts: pa.Array) -> list[pa.Array]:
        rows = _encoded(path, pattern, texts)
        return [_lists(rows), _decoded(codec(path, pattern), rows)]

    return _add(df, F.col(text).cast("string"), {ids: pa.list_(pa.int32()), out: pa.binary()}, both)
