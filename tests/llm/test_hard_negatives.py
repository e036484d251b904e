"""Hard negatives against a plain search over all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.llm import hard_negatives as hn
from offerloom.llm.queries import QUERIES

INF = float("inf")


def plain(rows, is_anchor):
    """All result rows; ``rows``: (id, label, vector)."""
    good = [
        (i, label, [int(np.floor(256 * x)) for x in v]) for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and np.isfinite(x) for x in v)
    ]
    out = []
    for anchor, label, v in good:
        if not is_anchor(anchor):
            continue
        scored = [(-sum(a * b for a, b in zip(v, w)), i, other == label) for i, other, w in good if i != anchor and len(w) == len(v)]
        for p, positive, _ in sorted(s for s in scored if s[2])[:5]:
            inside = sorted(s for s in scored if not s[2] and 80 * -p <= 100 * -s[0] <= 100 * -p)
            out += [(anchor, positive, rank, i, -p, -n) for rank, (n, i, _) in enumerate(inside[:5], 1)]
    return sorted(out)


def mined(spark, rows, modulus=1, **options):
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id long, label int, embedding array<double>, place string, score int")
    return sorted(tuple(r) for r in hn.mine(df, F.pmod("vec_id", F.lit(modulus)) == 0, **options).collect())


@pytest.mark.parametrize("rows_in_block", [hn.ROWS, 7])
def test_equals_plain_search(spark, rows_in_block):
    rnd = random.Random(2)
    # Few values, so that scores tie often; ids in no order, some labels rare.
    rows = [(i, rnd.choice([0, 0, 0, 1, 2, 9]), [rnd.choice([0.0, 0.5, 0.25, -0.3, 0.7]) for _ in range(6)]) for i in rnd.sample(range(-50, 500), 150)]
    assert mined(spark, rows, 5, rows_in_block=rows_in_block) == plain(rows, lambda i: i % 5 == 0)


def test_odd_rows(spark):
    rows = [
        (1, 0, None), (2, None, [1.0, 1.0]), (None, 0, [1.0, 1.0]), (3, 0, [1.0, None]), (4, 0, [float("nan"), 1.0]), (5, 0, [INF, 1.0]), (6, 0, [1.0]), (7, 0, []),
        (8, 0, [1.0, 1.0]), (8, 0, [1.0, 1.0]), (9, 0, [1.0, 1.0]), (9, 0, [1.0, 1.0]), (10, 1, [0.9, 1.0]), (10, 1, [0.9, 1.0]), (11, 1, [1.0, 1.0]), (12, 2, [0.0, 0.0]),
        (13, 2, [0.0, 0.0]), (14, 2, [-1.0, -1.0]), (15, 3, [1.0]), (16, 0, [1.0]), (17, 3, []), (18, 0, []), (8, 1, [1.0, 0.95]),
    ]
    assert mined(spark, rows) == plain(rows, lambda i: True)


def test_one_vector_in_many_rows(spark):
    rows = [(i, i % 3, [0.5, 0.25, 1.0]) for i in range(400)] + [(i, 1, [0.5, 0.25, 0.99]) for i in range(400, 420)]
    assert mined(spark, rows, 100, rows_in_block=50) == plain(rows, lambda i: i % 100 == 0)


def test_large_components(spark):
    large = [(1, 0, [3e6, 1.0]), (2, 0, [3e6, 2.0]), (3, 1, [3e6, 1.5]), (4, 1, [3e6, 3.0])]
    assert mined(spark, large) == plain(large, lambda i: True)
    with pytest.raises(Exception, match="too large"):
        mined(spark, [(1, 0, [1e15]), (2, 0, [1e15])])


def test_empty_tables(spark):
    assert mined(spark, [(1, 0, [1.0])]) == [] and mined(spark, [(1, 0, [1.0]), (2, 1, [1.0])], 100) == []
    empty = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hn.mine(empty, F.lit(True)).collect() == []


def test_stream_holds_open_windows_only():
    keys = [hn._key(1, 0, 100, 0, 5), hn._key(1, 0, 100, 1, 4), hn._key(1, 0, 90, 0, 6), hn._key(1, 0, 85, 1, 7), hn._key(1, 0, 79, 1, 8), hn._key(1, 0, -1, 1, 9), hn._key(2, 3, 79, 1, 8)]
    assert keys == sorted(keys)
    assert list(hn.stream(iter(keys), 5, 80, 100)) == [(1, 5, 1, 4, 100, 100), (1, 5, 2, 7, 100, 85), (1, 6, 1, 7, 90, 85), (1, 6, 2, 8, 90, 79)]


def test_query(spark, base):
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in spark.read.parquet(f"{base}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    rows = [(i, (label + 1) % 10 if label is not None and i % 7 == 0 else label, v) for i, label, v in rows]
    assert sorted(tuple(r) for r in QUERIES["op13_hard_negatives"](spark, base).collect()) == plain(rows, lambda i: i % 100 == 0)


def test_no_block_reaches_the_driver(spark, monkeypatch):
    # Copies of the anchors' blocks were joined by a broadcast, which the driver gathers; their size as planned was that of one copy.
    plans = []

    def ended(df):
        rows = df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return rows

    monkeypatch.setattr(hn, "materialize", lambda df, name, write=hn.materialize: (ended(df), write(df, name))[1])
    rows = [(i, i % 3, [float(i % 7), 1.0]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert sorted(tuple(r) for r in ended(hn.mine(df, F.pmod("vec_id", F.lit(3)) == 0))) == plain(rows, lambda i: i % 3 == 0)
    assert len(plans) == 5 and not any("Broadcast" in plan for plan in plans)


def test_many_cells(spark, monkeypatch):
    grids = []
    monkeypatch.setattr(hn, "CELL", 1)
    monkeypatch.setattr(hn, "GIVEN", 0)
    monkeypatch.setattr(hn, "_grid", lambda rows, anchors, grid=hn._grid: grids.append(grid(rows, anchors)) or grids[-1])
    rnd = random.Random(3)
    rows = [(i, rnd.choice([0, 0, 1, 2]), [rnd.choice([0.0, 0.5, 0.25, -0.3, 0.7]) for _ in range(rnd.choice([4, 5]))]) for i in rnd.sample(range(-50, 500), 200)]
    # One row in many places, and one id with several rows.
    rows += [rows[0]] * 20 + [(7, k % 3, [0.5] * 4) for k in range(20)]
    want = plain(rows, lambda i: True)
    assert mined(spark, rows, rows_in_block=9) == want
    # No more bytes of rows in a cell than a block has: as many groups of rows as blocks.
    monkeypatch.setattr(hn, "HELD", 1)
    assert mined(spark, rows, rows_in_block=9) == want
    assert min(grids[0]) > 1 and grids[1][0] > 4
    assert mined(spark, rows, 1000, rows_in_block=9) == plain(rows, lambda i: i % 1000 == 0)


@pytest.mark.parametrize("span", [2, 40, 3000, 10**7, 10**9])
def test_search_in_blocks(span):
    rnd = np.random.default_rng(span)
    vectors = [rnd.integers(-span, span, (300, 3)) // (1 + 50 * (k % 2)) for k in range(4)]
    ids = [rnd.integers(0, 900, 300) for _ in vectors]
    labels = [rnd.integers(0, 3, 300) for _ in vectors]
    blocks = [hn._rows(i, l, hn.narrow(v)) for i, l, v in zip(ids, labels, vectors, strict=True)]
    all_ids, all_labels, all_vectors = np.concatenate(ids), np.concatenate(labels), np.concatenate(vectors)
    at = rnd.integers(0, 1200, 40)
    of = all_ids[at], all_labels[at], hn.narrow(all_vectors[at])
    row, id, score = hn.search(*of, blocks, True, np.full((40, 1), hn._MOST), np.full((40, 1), hn._NONE), 4)
    opened = np.full((40, 4), hn._NONE)
    for a in range(40):
        all_scores = [(-sum(int(x) * int(y) for x, y in zip(of[2][a], w, strict=True)), int(i), bool(label == of[1][a])) for i, label, w in zip(all_ids, all_labels, all_vectors, strict=True) if i != of[0][a]]
        want = sorted(s[:2] for s in all_scores if s[2])[:4]
        assert sorted((-int(s), int(i)) for s, i in zip(score[row == a], id[row == a], strict=True)) == want
        opened[a, : len(want)] = [-s for s, _ in want]
    # Windows far below the positives too, in which most scores are.
    opened[::2] //= 3
    opened[::5, 1] = hn._NONE
    row, id, score = hn.search(*of, blocks, False, *hn._bounds(opened, 20, 100), 4)
    for a in range(40):
        others = sorted((-sum(int(x) * int(y) for x, y in zip(of[2][a], w, strict=True)), int(i)) for i, label, w in zip(all_ids, all_labels, all_vectors, strict=True) if i != of[0][a] and label != of[1][a])
        found = sorted((-int(s), int(i)) for s, i in zip(score[row == a], id[row == a], strict=True))
        for p in opened[a].tolist():
            inside = [s for s in others if p != hn._NONE and 20 * p <= 100 * -s[0] <= 100 * p]
            assert [s for s in found if s in inside][:4] == inside[:4]
        assert len(found) <= 16


def test_best_of_many_ties():
    score = np.zeros((3, 500), dtype=np.float32)
    score[1, ::7] = 5
    score[2, 3] = -1
    order = np.random.default_rng(1).permutation(500)
    allowed = np.ones((3, 500), dtype=bool)
    allowed[0, 250:] = False
    row, column = hn.best(score, allowed, order, 5)
    for a in range(3):
        want = sorted(np.nonzero(allowed[a])[0], key=lambda c: (-score[a, c], order[c]))[:5]
        assert sorted(column[row == a]) == sorted(want)
