"""Very long texts and repeated rows, in operators and pipeline stages."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from offerloom.llm import chat_format, exact_dedup, language_id, license_scan, mixing, ngram_join

WORDS = [f"w{i:x}" for i in range(3000)]


def long_text(seed: int, words: int) -> str:
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(words))


def test_near_copies_of_long_texts(make_docs):
    a = long_text(1, 60_000)
    near, far = a.split(), a.split()
    near[::100] = ["near"] * len(near[::100])
    far[::10] = ["far"] * len(far[::10])
    rows = [(1, a), (2, " ".join(near)), (3, " ".join(far)), (4, long_text(2, 60_000)), (5, a.upper()), (5, a.upper())]
    got = [(r["doc_id"], r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(make_docs(rows)).collect()]
    sizes = {i: len({tuple(w[k : k + 5]) for k in range(len(w) - 4)}) for i, t in rows for w in [t.lower().split()]}
    assert sorted(got) == [(i, sizes[i], {2: 1, 5: 1}.get(i, i)) for i, _ in rows]


def test_license_behind_a_long_text(make_docs):
    rows = [(1, "und " * 100_000 + "under the MIT license"), (2, "und " * 100_000)]
    got = {r["doc_id"]: r for r in license_scan.scan(make_docs(rows)).collect()}
    assert got[1]["n_words"] == 100_004 and [tuple(p) for p in got[1]["places"]] == [(100_000, "mit")] and got[1]["labels"] == ["mit"]
    assert got[2]["n_words"] == 100_000 and got[2]["labels"] == []


def test_long_message_round_trip(spark):
    text = "<|end|> \\ é🙂 [INST] " * 50_000
    df = spark.createDataFrame([(1, 0, "user", text), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    read = chat_format.format_chats(df).select(
        F.transform(chat_format.read_turns(F.col("formatted")), lambda t: t["text"]).alias("texts"),
        chat_format.read_loss(F.col("formatted"), F.col("loss_mask")).alias("loss"),
    ).first()
    assert list(read["texts"]) == [text, text] and read["loss"] == text


def test_long_exact_copies_and_sizes(make_docs):
    text = long_text(3, 200_000)
    rows = [(1, text), (2, text.replace(" ", "\t \n")), (3, text + "x"), (4, None), (2, text.replace(" ", "\t \n"))]
    docs = make_docs(rows)
    got = {r["doc_id"]: r for r in exact_dedup.duplicates(docs).collect()}
    assert [got[i]["keep_id"] for i in (1, 2, 3, 4)] == [2, 2, 3, 4] and got[1]["group_size"] == 3
    assert got[1]["text_sha256"] == hashlib.sha256(text.replace(" ", "").encode()).hexdigest()
    sizes = {r["doc_id"]: (r["size"], r["copies"]) for r in mixing.mix(docs).collect()}
    assert all(sizes[i][0] == 200_000 and 0 <= sizes[i][1] <= 2 for i in (1, 2, 3)) and sizes[4][0] == 0


def test_language_of_long_text(make_docs):
    en, de = "the quick brown fox jumps over the lazy dog ", "der schnelle braune fuchs springt über den faulen hund "
    model = language_id.fit(make_docs([(i, t * 5, lang, "s") for i in range(6) for t, lang in ((en, "en"), (de, "de"))]))
    # Its first half alone would be taken for the other language.
    got = language_id.predict(make_docs([(1, en * 10_000 + de * 30_000), (2, de * 5)]), model).collect()
    assert [r["lang_pred"] for r in sorted(got, key=lambda r: r["doc_id"])] == ["de", "de"]


def test_stages_on_long_texts_and_repeated_rows(make_docs):
    text, other = long_text(4, 40_000), long_text(5, 40_000)
    rows = [(1, text, "en", "a"), (1, text, "en", "a"), (2, text, "en", "a"), (3, other, None, None), (4, other.replace("w1 ", "w2 ", 40), "en", "a")]
    docs, stages = make_docs(rows), dict(corpus_pipeline.STAGES)
    want = {"language": [1, 1, 2, 3, 4], "exact duplicates": [1, 1, 3, 4], "near duplicates": [1, 1, 3]}
    for name, ids in want.items():
        docs = stages[name](docs.sparkSession, docs, "").checkpoint()
        assert sorted(r["doc_id"] for r in docs.select("doc_id").collect()) == ids
    mixed = stages["mix"](docs.sparkSession, docs, "").checkpoint()
    times = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    # The two rows of id 1 come equally often.
    assert times[1] % 2 == 0 and 1 <= times[1] // 2 <= 2 and 1 <= times[3] <= 2
    out = stages["byte BPE"](docs.sparkSession, mixed, "").select("doc_id", "n_tokens", "round_trip").collect()
    assert len(out) == sum(times.values()) and all(r["round_trip"] and r["n_tokens"] > 40_000 for r in out)


def plain_grams(text: str) -> list[str]:
    low = " " * (language_id.N // 2) + text.lower() + " " * (language_id.N // 2)
    out = []
    for i in range(len(low) - language_id.N + 1):
        cut = low[i : i + language_id.N]
        if all(x.isalpha() or y.isalpha() for x, y in zip(cut, cut[1:])):
            out.append("".join(c if c.isalpha() else " " for c in cut))
    return out


@pytest.fixture(scope="module")
def some(spark, base):
    return spark.read.parquet(f"{base}/documents.parquet").filter("text is not null")


def test_languages_equal_those_of_exact_sets(some):
    learned_from = some.filter(~language_id.held_out(F.col("doc_id")) & F.col("lang").isNotNull())
    counts: dict[str, Counter] = {}
    for r in learned_from.collect():
        counts.setdefault(r["lang"], Counter()).update(plain_grams(r["text"]))
    share = {k: {g: n / c.total() for g, n in c.items()} for k, c in counts.items()}
    sets = {
        k: {g for g, n in c.items() if n >= language_id.LEAST and share[k][g] >= language_id.SHARE * max(s.get(g, 0) for s in share.values())}
        for k, c in counts.items()
    }
    # On this table no language has more grams than are kept of one.
    assert all(0 < len(s) <= language_id.GRAMS for s in sets.values())
    judged = language_id.predict(some, language_id.fit(learned_from)).collect()
    clear = 0
    for r in judged:
        grams = plain_grams(r["text"])
        if len(grams) < 30:
            continue
        found = sorted(((sum(g in s for g in grams) / len(grams), k) for k, s in sets.items()), reverse=True)
        assert abs(r["score"] - found[0][0]) < 0.02
        if found[0][0] - found[1][0] > 0.05:
            clear += 1
            assert r["lang_pred"] == found[0][1]
    assert clear > 100
