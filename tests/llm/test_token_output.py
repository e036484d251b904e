import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from offerloom.llm import token_output
from offerloom.llm.queries import QUERIES, WORD_TOKENIZER
from offerloom.session import scratch_path


def expected(texts, path=WORD_TOKENIZER):
    tokenizer = Tokenizer.from_file(path)
    return [e.ids + [1] for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


ODD = [
    None, "", " \n", "It's HERE, we'll see!", "Éléphant ÀÉ ß İstanbul ΣΑΣ", "é ạ̈ ́x", "日本語 テキスト。", "🙂👍🏽 ok", "<|endoftext|> <|startoftext|>", "a" * 3000, "1234 5.6", " x　y z",
    "x\x1cy \x85z", "don ' t", "a​b ͅ",
    "a|b || | |x| é|é", "ẖ H̱ ẖ Å",
]


def test_words_alone_give_the_ids_of_the_text():
    encoder = token_output.Encoder(WORD_TOKENIZER)
    for text, ids, got in zip(ODD, expected(ODD), encoder.encode(ODD)):
        assert np.frombuffer(got, "<u4").tolist() == ids[:-1], text


def test_frame_finds_damage():
    record = token_output.frame(7, np.array([5, 70_000])) + b"\n"
    narrow = token_output.frame(7, np.array([5, 6, 65_535])) + b"\n"
    for data, ids in ((record, [5, 70_000]), (narrow, [5, 6, 65_535])):
        assert token_output.unframe(memoryview(data), 0)[1].tolist() == ids
    assert token_output.unframe(memoryview(record), 0)[0] == 7 and token_output.unframe(memoryview(record), 0)[2] == len(record)
    assert token_output.unframe(memoryview(token_output.frame(None, np.zeros(0, dtype=int)) + b"\n"), 0)[0] is None
    for i in range(len(record) - 1):
        broken = bytearray(record)
        broken[i] ^= 1
        with pytest.raises((ValueError, struct.error)):
            token_output.unframe(memoryview(bytes(broken)), 0)


@pytest.mark.parametrize("seed", [None, 3])
def test_write_and_read_back(spark, make_docs, seed):
    rows = [(100 - i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (7, "b twice"), (7, "a twice")]
    path = scratch_path(spark, "records")
    token_output.write_records(make_docs(rows), path, WORD_TOKENIZER, part_chars=(800, 800), block_bytes=300)
    read = token_output.read_records(spark, path) if seed is None else token_output.read_shuffled(spark, path, seed)
    got = sorted(((r["start"], r["id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in read.collect()))
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for (id, _), ids in zip(order, expected([t for _, t in order])):
        want.append((start, id, ids))
        start += len(ids)
    assert got == want
    index = token_output.read_index(spark, path).collect()
    assert len({r["shard"] for r in index}) > 1 and len(index) == len(rows)


@pytest.mark.parametrize("shared", [7, None])
def test_no_id_makes_a_shard_large(spark, make_docs, shared):
    head = "the same beginning of many texts that goes on for more than the leading characters by which they are cut "
    rows = [(shared, f"{i:03} some words") for i in range(200)] + [(shared, f"{head}{i:03}") for i in range(50)] + [(shared, "equal")] * 300 + [(shared, None)] * 300
    rows += [(i, "other") for i in range(100, 150)]
    path = scratch_path(spark, "records")
    token_output.write_records(make_docs(rows), path, WORD_TOKENIZER, part_chars=(2_000, 2_000), block_bytes=500)
    got = sorted((r["start"], r["id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in token_output.read_records(spark, path).collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    start, want = 0, []
    for (id, _), ids in zip(order, expected([t for _, t in order])):
        want.append((start, id, ids))
        start += len(ids)
    assert got == want
    shards = token_output.read_index(spark, path).groupBy("shard").count().collect()
    assert max(r["count"] for r in shards) <= 200  # of 900 rows; 850 have one id


def test_empty_table(spark, make_docs):
    path = scratch_path(spark, "records")
    token_output.write_records(make_docs([(1, "a")]).limit(0), path, WORD_TOKENIZER)
    assert token_output.read_records(spark, path).collect() == [] and token_output.read_index(spark, path).count() == 0


def test_query(spark, base):
    docs = sorted((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{base}/documents.parquet").select("doc_id", "text").collect())
    got = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in QUERIES["op9_token_records"](spark, base).collect()}
    start = 0
    for (id, _), ids in zip(docs, expected([t for _, t in docs]), strict=True):
        assert got[id] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_other_tokenizers_get_texts_whole(spark, make_docs):
    other = public_tokenizers.path("byte_bpe_50k.json")
    path = scratch_path(spark, "records")
    rows = [(i, t) for i, t in enumerate(ODD)]
    token_output.write_records(make_docs(rows), path, other)
    got = {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_output.read_records(spark, path).collect()}
    assert [got[i] for i in range(len(ODD))] == expected(ODD, other)


def test_memory_is_bounded_and_harmless(monkeypatch):
    monkeypatch.setattr(token_output, "MEMORY_BYTES", 1_000)
    encoder = token_output.Encoder(WORD_TOKENIZER)
    for texts in (ODD, ODD[::-1], ["w" * 500 + " five"]):
        assert [np.frombuffer(x, "<u4").tolist() + [1] for x in encoder.encode(texts)] == expected(texts)
        assert encoder.held <= 1_000 and all(len(k) <= token_output.MEMORY_LENGTH for k in encoder.memory)
        assert encoder.held == sum(token_output.ENTRY_BYTES + len(k) + len(v) for k, v in encoder.memory.items())


def test_document_above_a_file(spark, make_docs):
    """Long neighbours: files stay at eight blocks, but for a document that is larger alone."""
    rows = [(i, "some words " * 400) for i in range(40)] + [(40, "a longer one " * 40_000), (41, "last")]
    path = scratch_path(spark, "records")
    token_output.write_records(make_docs(rows), path, WORD_TOKENIZER, block_bytes=4_000)
    got = {r["id"]: np.frombuffer(r["ids"], "<u4").tolist() for r in token_output.read_records(spark, path).collect()}
    assert [got[i] for i in range(42)] == expected([t for _, t in rows])
    sizes = [r["n"] for r in token_output.read_index(spark, path).filter("id <> 40").groupBy("shard").agg({"size": "sum"}).toDF("shard", "n").collect()]
    assert len(sizes) > 2 and max(sizes) <= token_output.FILE_BLOCKS * 4_000
    start = 0
    for r in token_output.read_index(spark, path).orderBy("shard", "ordinal").collect():
        assert r["start"] == start
        start += r["n_tokens"]
