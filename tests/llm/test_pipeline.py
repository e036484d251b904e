"""The pipeline against plain Python on a small table."""

import random

import tiktoken
import public_tokenizers as P
from pyspark.sql import functions as F

import corpus_pipeline
from offerloom.llm import bpe
from tests.llm.test_exact_dedup import plain as plain_exact
from tests.llm.test_ngram_join import plain as plain_near

EN = "the of and to in that was with his for had not but have from they which one were all her she there would their".split()
DE = "der die und das ist nicht sich auch auf eine werden für mit dem den von zu haben wird sein noch nach über einer".split()


def rows():
    rnd = random.Random(6)
    out = []
    for i in range(160):
        lang, names = ("en", EN) if i % 3 else ("de", DE)
        w = [rnd.choice(names) for _ in range(rnd.randint(30, 120))]
        out.append((i, " ".join(w), lang, rnd.choice(["a", "b", None])))
        if i % 10 == 0:
            out.append((1000 + i, "  ".join(w), lang, "a"))
        if i % 10 == 1 and len(w) > 60:
            out.append((2000 + i, " ".join(w[:-1] + ["other"]), lang, "c"))
    return out + [(5000, None, "en", "a"), (5001, "", "en", "a"), (5002, "123 456 !!", "en", "b"), (None, " ".join(EN[5:] + EN[:5]), None, None)]


def test_stages_equal_plain_python(spark, make_docs):
    data = rows()
    docs = make_docs(data)
    text, stages = {r[0]: r[1] for r in data}, dict(corpus_pipeline.STAGES)
    kept = stages["language"](spark, docs, "")
    assert kept.columns == docs.columns
    ids = {r["doc_id"] for r in kept.collect()}
    assert ids == set(text) - {5000, 5001, 5002}  # clean documents stay
    pairs = [(i, text[i]) for i in ids]

    kept = stages["exact duplicates"](spark, kept, "")
    want = {r[0] for r in plain_exact(pairs) if r[3]}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want and len(want) < len(ids)
    pairs = [(i, text[i]) for i in want]

    kept = stages["near duplicates"](spark, kept, "")
    want = {r[0] for r in plain_near(pairs) if r[0] is None or r[0] == r[2]}
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == want and len(want) < len(pairs)

    mixed = stages["mix"](spark, kept, "")
    assert mixed.columns == docs.columns
    words = mixed.select(F.sum(F.size(F.split("text", " +")))).first()[0]
    assert abs(words / sum(len(text[i].split()) for i in want) - 1.5) < 0.05
    assert max(r["count"] for r in mixed.groupBy("doc_id").count().collect()) <= 2

    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(corpus_pipeline.RANKS), special_tokens={})
    for r in stages["byte BPE"](spark, mixed, "").collect():
        assert r["round_trip"] and list(r["ids"]) == encoding.encode_ordinary(text[r["doc_id"]]) and r["n_tokens"] == len(r["ids"])


def test_language_stage_keeps_what_it_cannot_judge(spark, make_docs):
    rnd = random.Random(9)
    data = [(i, " ".join(rnd.choice(EN) for _ in range(60)), "en", "a") for i in range(120)]
    short = [(200, "A.", "en", "a"), (201, "Qxzj vkw", "en", "a")]
    few = [(300, "ελληνικά κείμενα που κανείς δεν έμαθε ποτέ εδώ, γιατί είναι πολύ λίγα", "el", "a")]  # no gram is seen often enough
    bare = [(400, "русский текст без метки языка, которого никто здесь раньше не видел", None, "a")]
    gone = [(500, "qxzjv kwpfg zzxqj vvkqx jjqzw xkcdq " * 3, "en", "a"), (501, "12 34 !", None, "a"), (502, "5", "en", "a")]
    kept = corpus_pipeline.keep_known_languages(spark, make_docs(data + short + few + bare + gone), "")
    assert {r["doc_id"] for r in kept.collect()} == {r[0] for r in data + short + few + bare}


def test_empty_table_goes_through(spark, make_docs):
    docs = make_docs([(1, "a")]).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").collect() == []


def test_run(spark, base):
    out = corpus_pipeline.run(spark, base)
    total = spark.read.parquet(f"{base}/documents.parquet").count()
    assert out.filter("not round_trip").count() == 0 and total < out.count() < 2 * total
