import numpy as np
import pytest
from pyspark.sql import functions as F

from offerloom.llm import ann
from offerloom.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, score string, leaf string"


def brute(ids, x, is_query, k):
    unit = x / np.sqrt((x * x).sum(1, keepdims=True))
    out = {}
    for i in np.flatnonzero(is_query(ids)):
        s = ann.cosine(x[i], x)
        s[i] = -9
        order = np.lexsort((ids, -s))[: min(k, len(ids) - 1)]
        out[int(ids[i])] = [(int(ids[j]), float(s[j])) for j in order]
    return out, unit


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_small_table_is_exact(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(60, 4)).astype(np.float32)
    x[10:40] = x[10]  # one vector holds half of the rows
    ids = np.arange(60) * 5
    bad = [(None, [1.0] * 4), (1000, None), (1005, [0.0] * 4), (1010, [1.0, float("nan"), 0.0, 0.0]), (1015, [1.0, None, 0.0, 0.0]), (1020, [float("inf")] * 4), (1025, [1.0, 2.0])]
    rows = [(int(i), v.tolist(), "c", "c") for i, v in zip(ids, x)] + [(i, v, "c", "c") for i, v in bad]
    rows += [rows[3], (rows[5][0], [9.0] * 4, "c", "c")]  # a repeated row changes nothing, a further vector of an id is a row of its own
    ids, x = np.append(ids, ids[5]), np.vstack([x, [9.0] * 4])
    got = found(ann.nearest_neighbours(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") % 10 == 0, recall=1.0))
    want, _ = brute(ids, x.astype(float), lambda i: i % 10 == 0, 5)
    assert got == want


def test_fewer_candidates_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], "", ""), (7, [0.0, 1.0], "", "")], SCHEMA)
    assert found(ann.nearest_neighbours(df, F.col("vec_id") == 0)) == {0: [(7, 0.0)]}
    assert ann.nearest_neighbours(df.limit(0), F.col("vec_id") == 0).collect() == []
    assert ann.nearest_neighbours(df, F.col("vec_id") == 99).collect() == []


def test_vectors_of_one_id_are_rows_of_their_own(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 1.0]), (1, [2.0, 0.1]), (2, [0.1, 2.0]), (0, [1.0, 0.0])]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    got = sorted((r["rank"], r["vec_id"]) for r in ann.nearest_neighbours(df, F.col("vec_id") == 0, k=2, recall=1.0).collect())
    assert got == [(1, 1), (1, 2), (2, 1), (2, 2)]
    all_ = ann.nearest_neighbours(df, F.col("vec_id") == 0, k=9, recall=1.0).groupBy("vec_id").count().collect()
    assert {r["vec_id"]: r["count"] for r in all_} == {0: 2, 1: 2, 2: 2}


def test_every_length_is_searched(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.5]), (2, [0.0, 1.0]), (10, [1.0, 0.0, 0.0]), (11, [1.0, 1.0, 0.0]), (20, [4.0])]
    df = spark.createDataFrame([(*r, "", "") for r in rows], SCHEMA)
    got = found(ann.nearest_neighbours(df, F.col("vec_id") % 10 == 0, recall=1.0))
    assert {q: [v for v, _ in hits] for q, hits in got.items()} == {0: [1, 2], 10: [11]}


def test_large_and_small_components(spark):
    rows = [(0, [1e200, 0.0]), (1, [1e200, 1e200]), (2, [1e-300, 0.0]), (3, [0.0, 1e300])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = found(ann.nearest_neighbours(df, F.col("vec_id") == 0, recall=1.0))[0]
    assert [v for v, _ in got] == [2, 1, 3] and np.allclose([s for _, s in got], [1.0, 0.5**0.5, 0.0])


def test_leaves_grow_with_the_table():
    x = ann.unit(np.random.default_rng(3).normal(size=(4000, 8)))
    assert ann.Tree(x, 16).leaves > 4 * ann.Tree(x).leaves


def test_tree_visits_every_leaf_once():
    x = ann.unit(np.random.default_rng(2).normal(size=(3000, 8)))
    tree = ann.Tree(x)
    assert tree.leaves > 10
    order = list(tree.visits(x[0]))
    assert sorted(order) == list(range(tree.leaves)) and order.index(int(tree.assign(x[:1])[0])) < 5


@pytest.mark.parametrize("block", [16, 1024])
def test_query_recall(spark, base, monkeypatch, block):
    monkeypatch.setattr(ann, "BLOCK", block)
    rows = spark.read.parquet(f"{base}/embeddings.parquet").toPandas()
    ids, x = rows["vec_id"].to_numpy(), np.array(rows["embedding"].tolist(), dtype=float)
    want, _ = brute(ids, x, lambda i: i % 50 == 0, 5)
    got = found(QUERIES["op3_nearest_vectors"](spark, base))
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    hits = sum(len({v for v, _ in got[q]} & {v for v, _ in want[q]}) for q in want)
    assert hits >= 0.9 * 5 * len(want)
    exact = {q: dict(zip(ids.tolist(), ann.cosine(x[np.flatnonzero(ids == q)[0]], x))) for q in list(want)[:5]}
    assert all(abs(exact[q][v] - s) < 1e-12 for q in exact for v, s in got[q])
