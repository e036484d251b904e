import random
import re

import pytest

from offerloom.llm import ngram_join
from offerloom.llm.common import connected_components


def shingle_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain(rows):
    sets = [shingle_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            same = rows[i][0] is not None and rows[i][0] == rows[j][0]
            link = sets[i] and sets[j] and 100 * both >= 80 * len(sets[i] | sets[j]) and None not in (rows[i][0], rows[j][0])
            if link or same and sets[i] and sets[j]:
                root[find(i)] = find(j)
    low = {}
    for i, (id, _) in enumerate(rows):
        if id is not None:
            low[find(i)] = min(low.get(find(i), id), id)
    return sorted(((id, len(s), low[find(i)] if id is not None else None) for i, ((id, _), s) in enumerate(zip(rows, sets))), key=str)


def words(rnd, n, vocabulary=4000):
    return [f"w{rnd.randrange(vocabulary)}" for _ in range(n)]


def corpus():
    rnd = random.Random(9)
    rows, id = [], 0

    def put(w):
        nonlocal id
        id += 3
        rows.append((id, " ".join(w)))

    passage = words(rnd, 60)
    for _ in range(12):  # chains: each version changes a word of the one before, so the ends do not link
        w = words(rnd, rnd.choice([12, 60, 130, 400]))
        for _ in range(7):
            put(w)
            w = list(w)
            for _ in range(max(1, len(w) // 90)):
                w[rnd.randrange(len(w))] = f"new{rnd.randrange(10**6)}"
    for _ in range(25):  # a passage that many share
        put(passage + words(rnd, rnd.choice([10, 30, 90])))
    for _ in range(40):  # near copies of the passage itself
        w = list(passage)
        w[rnd.randrange(60)] = "other"
        put(w)
    for n in (0, 1, 2, 4, 5, 6):
        put(words(rnd, n))
        put(words(rnd, n))
    rows += [(1, None), (2, ""), (4, " \n "), (5, "Short Text"), (7, "short\ttext"), (8, "short text!"), (None, "short text"), (None, None), (10, rows[0][1]), (11, rows[0][1].upper())]
    rows += [(13, "repeated id with one text of its own here"), (13, "and another text for the very same id there"), (14, "repeated id with one text of its own here")]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", ["as it is", "no first step", "small tiles"])
def test_equals_brute_force(make_docs, monkeypatch, how):
    rows = corpus()
    if how == "no first step":  # all links must then come from the tiles
        verified, calls = ngram_join.verified, []
        monkeypatch.setattr(ngram_join, "verified", lambda docs, pairs: verified(docs, pairs if calls.append(1) or len(calls) > 1 else pairs.limit(0)))
    if how == "small tiles":
        monkeypatch.setattr(ngram_join, "TILE", 4)
        monkeypatch.setattr(ngram_join, "SMALL_TILE", 2)
        monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    got = ngram_join.near_duplicates(make_docs(rows))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)


def test_empty_table(make_docs):
    assert ngram_join.near_duplicates(make_docs([(1, "a")]).limit(0)).collect() == []


def test_signature_bound_never_below_overlap():
    import numpy as np

    rng = np.random.default_rng(4)
    for _ in range(300):
        a = np.unique(rng.integers(0, 2**63, size=rng.integers(1, 300)).astype(np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 2**63, size=rng.integers(0, 60)).astype(np.uint64)]))
        if not len(b):
            continue
        x, y = (np.frombuffer(ngram_join.signature(s), dtype=np.uint64) for s in (a, b))
        words = min(len(x), len(y))
        differ = int(np.bitwise_count(ngram_join.fold(x, words) ^ ngram_join.fold(y, words)).sum())
        assert 2 * len(np.intersect1d(a, b)) <= len(a) + len(b) - differ


def test_components(spark):
    rnd = random.Random(2)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(1000, i) for i in range(1001, 1040)] + [(rnd.randrange(5000, 5200), rnd.randrange(5000, 5200)) for _ in range(80)]
    pairs += [(b, a) for a, b in pairs[:30]] + [(3, 3)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in pairs:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    want = {i: find(i) for a, b in pairs if a != b for i in (a, b)}
    got = connected_components(spark.createDataFrame(pairs, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []
