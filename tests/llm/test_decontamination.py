"""Benchmark windows: the operator against a plain search, in one set and in blocks."""

import random
import re

import pytest

from offerloom.llm import decontamination as dc

TEN = "one two three four five six seven eight nine ten"
ITEMS = [
    (1, TEN), (2, f"zero {TEN} eleven"), (3, "Short Item"), (4, "x"), (5, ""), (6, None), (None, "no id here at all"), (7, "short, item!"),
    (7, "another of seven"), (10, "été à Zürich – 東京 "), (11, TEN.upper()),
]
DOCS = [
    (1, None), (2, ""), (3, "?!"), (4, TEN), (5, TEN[4:]), (6, f"a {TEN.replace(' ', '-').title()}. b {TEN} eleven"), (7, "short short item item x"), (8, "SHORT\nITEM"), (9, "shortitem"),
    (10, "no id here at all"), (11, "ÉTÉ à zürich – 東京"), (12, "été à Zürich – 東京 –"), (13, f"zero {TEN} eleven " * 3), (None, TEN), (4, TEN), (14, "one two three four five six seven eight nine six seven eight nine ten"),
]


def plain_words(text):
    return re.findall(dc.WORD_PATTERN, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(items, text, size=10):
    ws, hit, names = plain_words(text), set(), set()
    for name, item in items:
        iw = plain_words(item)
        n = min(size, len(iw))
        grams = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(ws) - n + 1 if n else 0):
            if tuple(ws[i : i + n]) in grams:
                hit |= set(range(i, i + n))
                names |= {str(name)} if name is not None else set()
    return len(ws), sorted(hit), sorted(names)


def result(df):
    rows = []
    for r in df.collect():
        hit = sorted(i for s in r["spans"] for i in range(s["start"], s["end"]))
        assert len(hit) == r["n_hit"] == len(set(hit)) and r["kept"] == "clash"
        rows.append((str(r["doc_id"]), r["n_words"], hit, r["items"]))
    return sorted(rows)


@pytest.fixture(scope="module")
def benchmark(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id bigint, text string")


@pytest.mark.parametrize("set_bytes", [dc.SET_BYTES, 150])
def test_odd_texts(make_docs, benchmark, set_bytes):
    got = result(dc.find(make_docs(DOCS), benchmark(ITEMS), set_bytes=set_bytes))
    assert got == sorted((str(i), *plain(ITEMS, t)) for i, t in DOCS)


@pytest.mark.parametrize("set_bytes", [dc.SET_BYTES, 400])
def test_random_texts(make_docs, benchmark, set_bytes):
    rnd = random.Random(11)
    text = lambda n: " ".join(rnd.choice("abc") for _ in range(n))
    items = [(i, text(rnd.choice([1, 4, 7, 9, 10, 11, 14]))) for i in range(3, 40)]
    docs = [(i, text(rnd.randint(0, 400))) for i in range(120)]
    got = result(dc.find(make_docs(docs), benchmark(items[5:]), set_bytes=set_bytes))
    assert got == sorted((str(i), *plain(items[5:], t)) for i, t in docs)


def test_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(dc, "_hashes", lambda rows: dc.np.full(len(rows), 5 << 60, dtype=dc.np.uint64))
    found = dc.GramSet([("1", "a b"), ("2", "b c"), ("3", "c d")], 2).scan(["x a b c d", "d c b"])
    assert [f["items"] for f in found] == [["1", "2", "3"], []] and found[0]["spans"] == [{"start": 1, "end": 5}]


def test_long_text_and_runs(monkeypatch, make_docs, benchmark):
    long = "filler " * 200_000 + TEN + " filler" * 100_000
    got = result(dc.find(make_docs([(1, long), (2, TEN)]), benchmark([(1, TEN)])))
    assert got == [("1", 300_010, list(range(200_000, 200_010)), ["1"]), ("2", 10, list(range(10)), ["1"])]
    monkeypatch.setattr(dc, "RUN_BYTES", 10)
    assert result(dc.find(make_docs(DOCS), benchmark(ITEMS))) == sorted((str(i), *plain(ITEMS, t)) for i, t in DOCS)


def test_empty_tables(make_docs, benchmark):
    docs = make_docs(DOCS)
    assert all(r["n_hit"] == 0 and r["items"] == [] for r in dc.find(docs, benchmark(ITEMS).limit(0)).collect())
    assert dc.find(docs.limit(0), benchmark(ITEMS)).collect() == []
    assert dc.remove(docs, benchmark([(1, None), (2, "...")])).count() == len(DOCS)


def test_removal(make_docs, benchmark):
    docs = make_docs(DOCS)
    kept = dc.remove(docs, benchmark(ITEMS))
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, t in DOCS if not plain(ITEMS, t)[1])
    cut = dc.remove(docs, benchmark(ITEMS), whole_documents=False)
    texts = {str(r["doc_id"]): r["text"] for r in cut.collect()}
    assert cut.columns == docs.columns and cut.count() == len(DOCS)
    assert texts["6"] == "a . b " and texts["1"] is None and texts["3"] == "?!" and texts["9"] == "shortitem" and texts["4"] == ""
    assert all(" ".join(w for i, w in enumerate(plain_words(t)) if i not in plain(ITEMS, t)[1]) == " ".join(plain_words(texts[str(i)])) for i, t in DOCS)
