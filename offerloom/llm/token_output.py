"""Token ids as length-delimited binary records, with a separate offset index.

A record is, in little-endian order::

    length of the payload (4 bytes) | masked checksum of the length (4) | payload | masked checksum of the payload (4) | line feed

The payload is a byte that says whether the document has an id, the id (8 bytes), a byte with the width of a token id (2 if all of the record fit,
else 4), and the token ids. A checksum is the crc32,
rotated right by 15 bits plus a constant, so that checksums of data that hold checksums stay sound. The line feed is what Spark's text
writer puts after a record, so files go through Spark's own commit protocol to any file system it knows: a task that is retried leaves
no second copy.

Documents are cut by range of id, sorted inside, and written as blocks of records: a block is one row for the writer, and a file takes
:data:`FILE_BLOCKS` of them. So a file (a shard) has a bounded size whatever the lengths of its documents, unless one document alone is
larger. The rows of an id that are more than a part are cut by the start of their text, and by a running number where even that is equal, so no id,
repeated or null, makes a task large. The index has one row per record: shard, ordinal, id, byte
offset and size of the record, tokens, and the number of ids of all documents before it. Readers that want another order take records by
the index.

Defined results: a null text counts as empty and gives the end id alone; a null id sorts first; rows that repeat an id stay rows of their own, ordered by
text; other columns are ignored; an empty table gives no files with records and an empty index. A text of any length is one record; the ids of a
record are held in memory once, and its size must stay below the 2 GB of a value.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerloom.llm.common import release, slices
from offerloom.session import shuffle_width

END_ID = 1
# Characters of text in a part (the work of one task), about: at least as many as the first, at most as many as the second if the session
# has fewer shuffle partitions than such parts.
LEAST_PART, MOST_PART = 4_000_000, 64_000_000
# Bytes of a block of records, about, and blocks of a file. A file is read as one value.
BLOCK_BYTES = 1 << 20
FILE_BLOCKS = 8
# Bytes of text that are encoded together.
RUN_BYTES = 2_000_000
# Characters that a row counts besides its text, and leading characters by which the rows of an id are cut.
ROW_CHARS = 24
TIE_CHARS = 64
# Bytes of the encoded words that a worker remembers, what one costs besides its characters and ids, and the longest among them.
MEMORY_BYTES = 100_000_000
ENTRY_BYTES = 170
MEMORY_LENGTH = 64
_MASK = 0xA282EAD8
_HEAD = struct.Struct("<II")
_ID = struct.Struct("<BqB")
# Files are numbered by task and place; no task writes as many.
FILES_OF_A_TASK = 1_000_000
INDEX_SCHEMA = "shard bigint, ordinal int, id bigint, offset bigint, size int, n_tokens bigint, before bigint"


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(id: int | None, ids: np.ndarray) -> bytes:
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    payload = _ID.pack(id is not None, id or 0, width) + ids.astype(f"<u{width}").tobytes()
    length = struct.pack("<I", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def unframe(data: memoryview, offset: int) -> tuple[int | None, np.ndarray, int]:
    """Id, token ids and end of the record at ``offset``; raises if a checksum is wrong."""
    length, check = _HEAD.unpack_from(data, offset)
    start = offset + _HEAD.size
    payload = data[start : start + length]
    if check != masked(bytes(data[offset : offset + 4])) or len(payload) != length:
        raise ValueError(f"damaged record length at {offset}")
    if struct.unpack_from("<I", data, start + length)[0] != masked(bytes(payload)):
        raise ValueError(f"damaged record at {offset}")
    known, id, width = _ID.unpack_from(payload)
    return id if known else None, np.frombuffer(payload[_ID.size :], dtype=f"<u{width}"), start + length + 5


# Steps of a tokenizer that lower-cases, drops white space and looks at nothing across it (fixed values, as its file states them).
WORD_STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
    "truncation": None, "padding": None, "post_processor": None,
}


class Encoder:
    """The tokenizer of one worker, with a bounded memory of words.

    If the file's steps are :data:`WORD_STEPS`, the ids of a text are those of its words. The words of a run of texts are cut and numbered by
    Arrow, without the mark behind a letter, which is a token of its own; each word is encoded by the library once while it is remembered. A
    word of letters that no step changes beyond their case goes to the library's model at once; others go through all steps as one text,
    with a mark between that none of them holds. Texts that hold one of the file's added tokens, and all texts of other tokenizers, go to the
    library whole.
    """

    MARK = "|"
    LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
    PLAIN = re.compile(f"[{LETTERS}]+")
    TAIL = f"([{LETTERS}])([.,;:!?])([ \\t-\\r]|$)"

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        added = steps.get("added_tokens") or []
        self.added = [t["content"] for t in added]
        self.by_word = all(steps.get(k) == v for k, v in WORD_STEPS.items()) and not any(
            t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added
        )
        self.memory: dict[str, bytes] = {}
        self.held = 0
        if self.by_word:
            # The model alone, for words that the steps before it leave as they are.
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = WhitespaceSplit()
            (self.mark,) = self.ids([self.MARK])[0]
            # The model reads bytes as letters: printable ones as they are, the others from 256 on.
            shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
            self.letter = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in shown)}

    def ids(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(ids, dtype="<u4").tobytes() for text in texts for ids in self.ids([text])]

    def fresh(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words that are not remembered."""
        others, plain, shown = [], [], []
        for w in words:
            if self.PLAIN.fullmatch(w) is None:
                others.append(w)
            else:
                plain.append(w)
                low = w.lower()
                shown.append(low if low.isascii() else low.encode().decode("latin-1").translate(self.letter))
        odd = [w for w in others if self.MARK in w]
        rest = [w for w in others if self.MARK not in w]
        out = dict(zip(odd, self.whole(odd), strict=True))
        out |= zip(rest, self.together(self.tokenizer, rest), strict=True)
        out |= zip(plain, self.together(self.model, shown), strict=True)
        return out

    def together(self, tokenizer, words: list[str]) -> Iterator[bytes]:
        """Ids of words that do not hold the mark, many at a time."""
        for start in range(0, len(words), 250):
            joined = f" {self.MARK} ".join([*words[start : start + 250], ""])
            ids = np.array(tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, dtype="<u4")
            data, ends = ids.tobytes(), (np.flatnonzero(ids == self.mark) * 4).tolist()
            yield from (data[i:j] for i, j in zip([0, *(e + 4 for e in ends[:-1])], ends, strict=True))

    def look_up(self, words: list[str]) -> list[bytes]:
        """Ids of distinct words, remembered within the bound."""
        memory = self.memory
        found = list(map(memory.get, words))
        places = [i for i, ids in enumerate(found) if ids is None]
        fresh = self.fresh([words[i] for i in places])
        for i in places:
            found[i] = fresh[words[i]]
        short = {w: ids for w, ids in fresh.items() if len(w) <= MEMORY_LENGTH}
        memory |= short
        self.held += sum(ENTRY_BYTES + len(w) + len(ids) for w, ids in short.items())
        if self.held > MEMORY_BYTES:  # the words met first are the common ones
            while self.held > MEMORY_BYTES * 3 // 4:
                w, ids = memory.popitem()
                self.held -= ENTRY_BYTES + len(w) + len(ids)
        return found

    def encode(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        if not self.by_word:
            return self.whole(texts.to_pylist())
        apart = pa.array(np.zeros(len(texts), dtype=bool))
        for token in self.added:
            apart = pc.or_(apart, pc.match_substring(texts, token))
        kept = pc.if_else(apart, "", texts)
        # Plain ASCII can be lower-cased at once, and fewer words are new.
        kept = pc.if_else(pc.string_is_ascii(kept), pc.ascii_lower(kept), kept)
        lists = pc.ascii_split_whitespace(pc.replace_substring_regex(kept, self.TAIL, r"\1 \2\3"))
        words = lists.flatten().dictionary_encode()
        known = self.look_up(words.dictionary.to_pylist())
        offsets = np.cumsum([0, *map(len, known)]) // 4
        ids_of = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(known), dtype="<u4")))
        ids = ids_of.take(words.indices)
        data, ends = ids.flatten().to_numpy().tobytes(), ids.offsets.to_numpy() * 4
        # Where the words of each text end, in bytes of ids.
        cuts = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()]
        out = [data[i:j] for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for i in np.flatnonzero(apart.to_numpy(zero_copy_only=False)).tolist():
            out[i] = self.whole([texts[i].as_py()])[0]
        return out


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # one core per task
        _ENCODERS.clear()
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _cut(docs: DataFrame, least: int, most: int) -> DataFrame:
    """``_id`` and ``_text`` by range in parts of about ``least`` to ``most`` characters, sorted inside."""
    size = F.length("_text").cast("long") + ROW_CHARS
    own = docs.groupBy("_id").agg(F.sum(size).alias("size"), F.count(F.lit(1)).alias("n"))
    # Ids whose rows are more than a part.
    heavy = own.filter((F.col("size") > least) & (F.col("n") > 1))
    chars, n_heavy = own.agg(F.sum("size"), F.count(F.when((F.col("size") > least) & (F.col("n") > 1), 1))).first()
    parts = 1 + max((chars or 0) // most, min((chars or 0) // least, shuffle_width(docs.sparkSession)))
    if not n_heavy:
        return docs.repartitionByRange(parts, "_id").sortWithinPartitions("_id", "_text")
    known = docs.join(heavy.select(F.col("_id").alias("_heavy"), F.lit(True).alias("_split")), F.col("_id").eqNullSafe(F.col("_heavy")), "left")
    # Equal rows travel as a count, then as runs of up to a part, and become rows again when the runs are dealt out. Unlike a number
    # by place, theirs is the same whenever a lost task runs again.
    texts = known.filter("_split").groupBy("_id", F.substring("_text", 1, TIE_CHARS).alias("_tie"), "_text").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_id", "_tie").orderBy("_text").rowsBetween(Window.unboundedPreceding, -1)
    numbered = texts.withColumns({"_n": F.coalesce(F.sum("_rows").over(before), F.lit(0)), "_run": F.greatest(F.lit(1), F.floor(F.lit(least) / size))})
    runs = numbered.withColumn("_from", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_rows") - 1, "_run"))).repartition("_id", "_tie", "_n", "_from")
    rows = runs.withColumn("_at", F.explode(F.sequence("_from", F.least(F.col("_from") + F.col("_run"), F.col("_rows")) - 1)))
    rest = known.filter("_split IS NULL").select("_id", F.lit("").alias("_tie"), F.lit(0).cast("long").alias("_n"), "_text")
    every = rest.union(rows.select("_id", "_tie", F.col("_n") + F.col("_at"), "_text"))
    return every.repartitionByRange(parts, "_id", "_tie", "_n").select("_id", "_text").sortWithinPartitions("_id", "_text")


def write_records(
    df: DataFrame, path: str, tokenizer: str, id: str = "doc_id", text: str = "text", end_id: int = END_ID,
    part_chars: tuple[int, int] = (LEAST_PART, MOST_PART), block_bytes: int = BLOCK_BYTES,
) -> None:
    """Write the records below ``path/records`` and the index below ``path/index``."""
    docs = df.select(F.col(id).cast("long").alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    tail = struct.pack("<I", end_id)

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, size = [], 0
        for batch in batches:
            for part in slices(batch, RUN_BYTES):
                for i, found in zip(part.column(0).to_pylist(), encoder(tokenizer).encode(part.column(1)), strict=True):
                    record = frame(i, np.frombuffer(found + tail, dtype="<u4"))
                    if block and size + len(record) > block_bytes:
                        yield _blocks(block)
                        block, size = [], 0
                    block.append(record)
                    size += len(record) + 1
        if block:
            yield _blocks(block)
        release()

    # The text is dealt out before it is encoded: finding the ranges must not encode it twice.
    sorted_docs = _cut(docs, *part_chars)
    # The writer puts the bytes of a string out as they are, and a line feed after them.
    blocks = sorted_docs.mapInArrow(framed, "block binary").select(F.col("block").cast("string"))
    blocks.write.option("compression", "none").option("maxRecordsPerFile", FILE_BLOCKS).text(f"{path}/records")
    _write_index(df.sparkSession, path)


def _blocks(records: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([b"\n".join(records)], pa.binary())], ["block"])


def _files(spark: SparkSession, path: str) -> DataFrame:
    """One row per shard: number and content. A file is named by the number of its task, then by its own number in the task."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
    number = lambda group: F.regexp_extract("path", r"part-(\d+)-.*-c(\d+)[^/]*$", group).cast("bigint")
    return files.select((number(1) * FILES_OF_A_TASK + number(2)).alias("shard"), "content")


def _write_index(spark: SparkSession, path: str) -> None:
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, at, rows, before = memoryview(content.as_buffer()), 0, [], 0
                while at < len(data):
                    id, tokens, end = unframe(data, at)
                    rows.append((shard, len(rows), id, at, end - at, len(tokens), before))
                    before, at = before + len(tokens), end
                columns = list(zip(*rows, strict=True)) or [()] * 7
                types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], list(_INDEX_NAMES))
        release()

    rows = _files(spark, path).mapInArrow(scan, INDEX_SCHEMA)
    rows.write.parquet(f"{path}/local-index")
    local = spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/local-index")
    sums = local.groupBy("shard").agg(F.sum("n_tokens").alias("_n")).withColumn("_task", F.floor(F.col("shard") / FILES_OF_A_TASK))
    # One row per task of the writer, then the files of each task.
    earlier = lambda w: F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    tasks = sums.groupBy("_task").agg(F.sum("_n").alias("_n")).select("_task", earlier(Window.orderBy("_task")).alias("_first"))
    within = sums.withColumn("_before", earlier(Window.partitionBy("_task").orderBy("shard")))
    shards = within.join(tasks, "_task").select("shard", (F.col("_first") + F.col("_before")).cast("long").alias("first"))
    shards.write.parquet(f"{path}/shards")
    local.join(_shards(spark, path), "shard").select(
        "shard", "ordinal", "id", "offset", "size", "n_tokens", (F.col("first") + F.col("before")).alias("start")
    ).write.parquet(f"{path}/index")


def _shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("shard bigint, first bigint").parquet(f"{path}/shards")


_INDEX_NAMES = tuple(re.findall(r"(\w+) \w+(?:,|$)", INDEX_SCHEMA))


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX_SCHEMA.replace("before", "start")).parquet(f"{path}/index")


def _batch(rows: list[tuple[int, int | None, int, np.ndarray]]) -> pa.RecordBatch:
    shard, id, before, ids = zip(*rows, strict=True)
    data = [x.astype("<u4").tobytes() for x in ids]
    return pa.RecordBatch.from_arrays(
        [pa.array(shard, pa.int64()), pa.array(id, pa.int64()), pa.array(before, pa.int64()), pa.array(data, pa.binary())], ["shard", "id", "before", "ids"]
    )


_RECORD = "shard bigint, id bigint, before bigint, ids binary"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``id``, ``start``, ``ids`` (binary, 4 bytes each whatever the width in the file) of all records, file by file."""
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data, at, before, rows, given = memoryview(content.as_buffer()), 0, 0, [], 0
                while at < len(data):
                    id, ids, at = unframe(data, at)
                    rows.append((shard, id, before, ids))
                    before += len(ids)
                    if at - given >= BLOCK_BYTES or at >= len(data):
                        yield _batch(rows)
                        rows, given = [], at
        release()

    # Records are read before the join, so that no file content is shuffled.
    found = _files(spark, path).mapInArrow(parse, _RECORD).join(_shards(spark, path), "shard")
    return found.select("id", (F.col("first") + F.col("before")).alias("start"), "ids")


def read_shuffled(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """The same records, taken from the files by the index: shards in a shuffled order, and the records of each too."""
    entry = F.struct("ordinal", "offset", "start")
    entries = read_index(spark, path).groupBy("shard").agg(F.array_sort(F.collect_list(entry)).alias("entries"))  # bounded by the shard
    files = _files(spark, path).join(entries, "shard").orderBy(F.xxhash64("shard", F.lit(seed)))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, content, entries in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                data = memoryview(content.as_buffer())
                np.random.default_rng([seed, shard]).shuffle(entries)
                for begin in range(0, len(entries), 1000):
                    part = [(e["start"], unframe(data, e["offset"])) for e in entries[begin : begin + 1000]]
                    yield _batch([(shard, id, start, ids) for start, (id, ids, _) in part])
        release()

    return files.select("shard", "content", "entries").mapInArrow(take, _RECORD).select("id", F.col("before").alias("start"), "ids")
