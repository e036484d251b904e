import hashlib
import random
import time

import numpy as np
import public_tokenizers as P
import tiktoken

from offerloom.llm import bpe
from offerloom.llm.queries import BYTE_RANKS, QUERIES


def reference():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(BYTE_RANKS), special_tokens={})


ODD = [
    None, "", " ", "\n\n  \t", "a" * 5000, "é" * 777, "\x00\x01\x7f", "日本語のテキスト。" * 30, "🙂👍🏽👩‍👩‍👧" * 9, "it's we'll 've 3.14 1234567", "x  y\n \nz  ",
    "<|endoftext|> stays text", "́̈ combining", " trailing  ",
]


def test_matches_library_on_odd_texts_and_random_ones():
    want, codec = reference(), bpe.Codec(BYTE_RANKS, P.PATTERN)
    rnd = random.Random(3)
    texts = ODD + ["".join(rnd.choice(" \n\t 　ab1.é'ЖZ") for _ in range(rnd.randint(0, 40))) for _ in range(3000)]
    got = codec.encode(texts)
    for text, ids in zip(texts, got):
        ids = np.frombuffer(ids, "<i4")
        assert ids.tolist() == want.encode_ordinary(text or "")
        assert codec.decode(ids)[0].tobytes() == (text or "").encode()


def test_memory_is_bounded_and_harmless(monkeypatch):
    monkeypatch.setattr(bpe, "MEMORY_BYTES", 700)
    codec, want = bpe.Codec(BYTE_RANKS, P.PATTERN), reference()
    for text in ("one two three four five", "five four three", "w" * 500 + " five"):
        ids = codec.encode([text, text])
        assert ids[0] == ids[1]
        assert [int.from_bytes(ids[0][i : i + 4], "little") for i in range(0, len(ids[0]), 4)] == want.encode_ordinary(text)
        assert codec.held <= 700 and all(len(k) <= bpe.MEMORY_LENGTH for k in codec.memory)
        assert codec.held == sum(bpe.ENTRY_BYTES + len(k) + len(v) for k, v in codec.memory.items())


def test_one_long_match():
    """A match without any cut; the library itself takes the square of its length, so a shorter part is compared."""
    rnd = random.Random(5)
    word, want = "".join(rnd.choice("etaoinshr") for _ in range(300_000)), reference()
    codec = bpe.Codec(BYTE_RANKS, P.PATTERN)
    began = time.time()
    ids = np.frombuffer(codec.encode([word])[0], "<i4")
    assert time.time() - began < 20 and codec.decode(ids)[0].tobytes() == word.encode()
    for few in (0, 10**9):
        bpe.FEW_ROWS, kept = few, bpe.FEW_ROWS
        try:
            assert np.frombuffer(codec.encode([word[:3_000]])[0], "<i4").tolist() == want.encode_ordinary(word[:3_000])
        finally:
            bpe.FEW_ROWS = kept


def test_one_pass_gives_both(spark, make_docs):
    docs = make_docs([(i, t) for i, t in enumerate(ODD)] + [(None, "same"), (2, "same"), (2, "same")])
    both = bpe.encode_decode(docs, BYTE_RANKS, P.PATTERN)
    apart = bpe.decode(bpe.encode(docs, BYTE_RANKS, P.PATTERN), BYTE_RANKS, P.PATTERN)
    rows = lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    assert rows(both) == rows(apart)
    assert bpe.encode_decode(docs.limit(0), BYTE_RANKS, P.PATTERN).collect() == []


def test_query_encodes_each_text_once(spark, base):
    plan = QUERIES["op1_byte_bpe"](spark, base)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "ArrowEvalPython" not in plan


def test_vocabulary_without_merges():
    ranks = {bytes([i]): i for i in range(256)}
    pairs = bpe.PairTable(ranks)
    assert bpe.encode_pieces([b"abc", b"", b"z"], ranks, pairs) == [b"a\0\0\0b\0\0\0c\0\0\0", b"", b"z\0\0\0"]


def test_operator_keeps_rows_and_columns(make_docs):
    docs = make_docs([(1, t) for t in ODD] + [(None, "same"), (2, "same"), (2, "same")])
    rows = bpe.decode(bpe.encode(docs, BYTE_RANKS, P.PATTERN), BYTE_RANKS, P.PATTERN).collect()
    assert len(rows) == len(ODD) + 3
    for r in rows:
        assert bytes(r["bytes"]).decode() == (r["text"] or "") and r["kept"] == "clash"
    empty = bpe.encode(docs.limit(0), BYTE_RANKS, P.PATTERN)
    assert empty.collect() == [] and dict(empty.dtypes)["ids"] == "array<int>"


def test_query_equals_library(spark, base):
    want = reference()
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{base}/documents.parquet").collect()}
    got = QUERIES["op1_byte_bpe"](spark, base).collect()
    assert len(got) == len(docs)
    for r in got:
        ids = want.encode_ordinary(docs[r["doc_id"]])
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
