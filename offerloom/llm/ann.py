"""Approximate nearest neighbours by cosine, with a hierarchical k-means tree.

Fit: unit vectors of a bounded sample (:data:`SAMPLE` rows) are clustered into :data:`BRANCH` parts, and each part again, until a part
stands for at most :data:`LEAF_ROWS` rows of the table, or holds at most :data:`LEAST_SAMPLE` of the sample; so leaves grow in number
with the table, up to the bound of the sample. The tree is small and travels with the tasks.

Index: every row goes down the tree to its leaf. Of identical vectors the ``k + 1`` smallest ids are kept, since no other id of
the group can be among the nearest of anything. A leaf is stored in blocks of about :data:`BLOCK` entries, so that a leaf
that holds a large share of all rows is spread over many tasks.

Search: best bin first. A priority queue holds the open branches by the distance of their centre; leaves come out nearest first. How
many leaves are visited is calibrated: for :data:`CALIBRATION` queries the true neighbours are found over all rows, and visits are
widened until :data:`RECALL` of them lie in visited leaves. A query goes on beyond that until it has met ``k + 1`` entries. Visited leaves
are compared block by block: a block of queries with a block of entries, as one matrix product; what may be among the
nearest is scored anew in double precision on the original vectors.

Defined results: vectors that are null or zero or hold null or non-finite components take no part, nor do rows without an id. Rows equal in id
and vector count once. Different vectors under one id are rows of their own: each is a candidate, also for the others, and each that is a query has a
list of its own. Vectors of different length have no cosine with each other, so each length is searched apart, with a tree of its own (a table
has few). Ties go to the smaller id. Other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.llm.common import materialize

SAMPLE = 20_000
BRANCH = 16
LEAF_SAMPLE = 256
LEAF_ROWS = 1024
LEAST_SAMPLE = 16
BLOCK = 1024
QUERY_BLOCK = 256
CALIBRATION = 128
RECALL = 0.98
ROUNDS = 8
SEED = 11


@dataclass
class Node:
    centres: np.ndarray | None = None  # of the children
    children: list[int] = field(default_factory=list)
    leaf: int = -1


class Tree:
    """Hierarchical k-means over unit vectors."""

    def __init__(self, vectors: np.ndarray, leaf_sample: int = LEAF_SAMPLE):
        self.leaf_sample = leaf_sample
        self.nodes: list[Node] = []
        self.leaves = 0
        self.rng = np.random.default_rng(SEED)
        self._grow(vectors)

    def _grow(self, x: np.ndarray) -> int:
        at = len(self.nodes)
        self.nodes.append(Node())
        node, parts = self.nodes[at], []
        if len(x) > self.leaf_sample:
            centres = x[self.rng.choice(len(x), min(BRANCH, len(x)), replace=False)]
            for _ in range(ROUNDS):
                own = np.argmax(x @ centres.T - 0.5 * (centres * centres).sum(1), axis=1)
                centres = np.array([x[own == i].mean(0) for i in range(len(centres)) if (own == i).any()])
            own = np.argmax(x @ centres.T - 0.5 * (centres * centres).sum(1), axis=1)
            parts = [(c, x[own == i]) for i, c in enumerate(centres) if (own == i).any()]
        if len(parts) < 2:
            node.leaf, self.leaves = self.leaves, self.leaves + 1
            return at
        node.centres = np.array([c for c, _ in parts])
        node.children = [self._grow(part) for _, part in parts]
        return at

    def assign(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each unit vector: the nearest centre at every node."""
        out = np.zeros(len(x), dtype=np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            node = self.nodes[at]
            if node.centres is None:
                out[rows] = node.leaf
                continue
            own = np.argmax(x[rows] @ node.centres.T - 0.5 * (node.centres * node.centres).sum(1), axis=1)
            todo += [(child, rows[own == i]) for i, child in enumerate(node.children) if (own == i).any()]
        return out

    def visits(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in best-bin-first order."""
        queue = [(0.0, 0)]
        while queue:
            _, at = heapq.heappop(queue)
            node = self.nodes[at]
            if node.centres is None:
                yield node.leaf
                continue
            far = ((node.centres - q) ** 2).sum(1)
            for d, child in zip(far.tolist(), node.children, strict=True):
                heapq.heappush(queue, (d, child))


def unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    largest = np.abs(x).max(axis=1, keepdims=True)
    x = x / largest
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def cosine(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Cosines of one vector with each row; a row's value does not depend on the others, so equal rows tie exactly.

    Vectors are scaled by powers of two, which changes no digit, so that squares of large components stay finite.
    """
    q = np.ldexp(q, -np.frexp(np.abs(q).max())[1])
    x = np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, keepdims=True))[1])
    return (x * q).sum(1) / (np.sqrt((q * q).sum()) * np.sqrt((x * x).sum(1)))


def nearest(q: np.ndarray, x: np.ndarray, ids: np.ndarray, k: int, rough: np.ndarray) -> list[tuple[int, float]]:
    """Places and exact cosines of the k best rows, ties to the smaller id. ``rough``: cosines that are off by rounding only."""
    if len(x) > k:
        near = np.flatnonzero(rough >= np.partition(rough, len(x) - k)[len(x) - k] - 1e-9)
    else:
        near = np.arange(len(x))
    exact = cosine(q, x[near])
    order = np.lexsort((ids[near], -exact))[:k]
    return list(zip(near[order].tolist(), exact[order].tolist(), strict=True))


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of equal length as one matrix."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(vectors), -1) if len(vectors) else flat.reshape(0, 0)


def usable(df: DataFrame, id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Rows that take part: ``vec_id``, ``vector`` (array of double), without repeats."""
    x = F.col(vector)
    whole = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v.cast("double")) & (F.abs(v.cast("double")) < float("inf")))
    rows = df.filter(F.col(id).isNotNull() & x.isNotNull() & whole & F.exists(x, lambda v: v != 0)).select(
        F.col(id).cast("long").alias("vec_id"), x.cast("array<double>").alias("vector")
    )
    return rows.distinct()


@dataclass
class Index:
    tree: Tree
    entries: DataFrame  # leaf, vec_id, vector
    sizes: dict[int, int]  # entries per leaf: one number a leaf
    k: int


def build(rows: DataFrame, k: int, sample: int = SAMPLE) -> Index | None:
    """Fit the tree on about ``sample`` rows of one length and index all of them. None for an empty table."""
    total = rows.count()
    if not total:
        return None
    part = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = rows.filter(part < sample / total).orderBy("vec_id", "vector").select("vector").toArrow()  # about ``sample`` rows
    leaf_sample = max(LEAST_SAMPLE, min(LEAF_SAMPLE, LEAF_ROWS * len(chosen) // total))
    tree = Tree(unit(_matrix(chosen.column(0).combine_chunks())), leaf_sample) if len(chosen) else Tree(np.zeros((0, 1)))
    shared = rows.sparkSession.sparkContext.broadcast(tree)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                leaf = shared.value.assign(unit(_matrix(batch.column(1))))
                yield pa.RecordBatch.from_arrays([pa.array(leaf), batch.column(0), batch.column(1)], ["leaf", "vec_id", "vector"])

    same = Window.partitionBy("vector").orderBy("vec_id")
    kept = rows.withColumn("_rank", F.row_number().over(same)).filter(F.col("_rank") <= k + 1).drop("_rank")
    entries = materialize(kept.mapInArrow(assign, "leaf int, vec_id bigint, vector array<double>"), "ann-entries")
    sizes = {r["leaf"]: r["n"] for r in entries.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    return Index(tree, entries, sizes, k)


def calibrate(index: Index, queries: DataFrame, recall: float = RECALL, size: int = CALIBRATION) -> int:
    """Visits that reach ``recall`` for ``size`` queries, whose true neighbours are found over all entries."""
    chosen = queries.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(size).toArrow()
    if not len(chosen):
        return 1
    ids, vectors = chosen.column(0).to_numpy(), _matrix(chosen.column(1).combine_chunks())
    units, k = unit(vectors), index.k

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            leaf, own, x = batch.column(0).to_numpy(), batch.column(1).to_numpy(), _matrix(batch.column(2))
            rough, rows = unit(x) @ units.T, []
            for i in range(len(ids)):
                near = nearest(vectors[i], x, own, k + 1, rough[:, i])
                rows += [(i, leaf[j], own[j], s) for j, s in near if own[j] != ids[i] or (x[j] != vectors[i]).any()]
            columns = list(zip(*rows, strict=True)) or [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, [pa.int32(), pa.int32(), pa.int64(), pa.float64()], strict=True)], ["q", "leaf", "vec_id", "score"])

    found = index.entries.mapInArrow(best, "q int, leaf int, vec_id bigint, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))
    true = found.withColumn("_rank", rank).filter(F.col("_rank") <= k).select("q", "leaf").collect()  # size * k rows
    if not true:
        return 1
    places = [{leaf: i for i, leaf in enumerate(index.tree.visits(u))} for u in units]
    needed = np.sort([places[r["q"]][r["leaf"]] + 1 for r in true])
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)])


def search(index: Index, queries: DataFrame, visits: int) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the k nearest found of every query but itself."""
    k, spark = index.k, queries.sparkSession
    shared, sizes = spark.sparkContext.broadcast(index.tree), index.sizes

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for q in unit(_matrix(batch.column(1))) if batch.num_rows else ():
                met, row = 0, []
                for leaf in shared.value.visits(q):
                    if len(row) >= visits and met > k:
                        break
                    row.append(leaf)
                    met += sizes.get(leaf, 0)
                out.append(row)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.list_(pa.int32()))], ["query", "vector", "leaves"])

    # Queries with the same vector are one; each takes its own id out of the common list afterwards.
    groups = materialize(queries.select("vector").distinct().withColumn("query", F.monotonically_increasing_id()), "ann-groups")
    members = queries.join(groups, "vector").select(F.col("vec_id").alias("query_id"), "query")
    sent = groups.select("query", "vector").mapInArrow(leaves, "query bigint, vector array<double>, leaves array<int>")
    sent = materialize(sent, "ann-queries").select("query", "vector", F.explode("leaves").alias("leaf"))

    def blocks(rows: DataFrame, id: str, size: int, name: str) -> DataFrame:
        counts = rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / size).alias("_parts"))
        part = F.pmod(F.xxhash64(id, F.lit(SEED)), F.col("_parts"))
        packed = F.array_sort(F.collect_list(F.struct(id, "vector")))
        return rows.join(counts, "leaf").groupBy("leaf", part.alias(f"{name}_part")).agg(packed.alias(name))

    pairs = blocks(sent, "query", QUERY_BLOCK, "asked").join(blocks(index.entries, "vec_id", BLOCK, "held"), "leaf")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for asked, held in zip(batch.column(0), batch.column(1), strict=True):
                (q_ids, q), (x_ids, x) = ((v.values.field(0).to_numpy(), _matrix(v.values.field(1))) for v in (asked, held))
                rough, rows = unit(q) @ unit(x).T, []
                for i, query in enumerate(q_ids.tolist()):
                    rows += [(query, x_ids[j], s, bool((x[j] == q[i]).all())) for j, s in nearest(q[i], x, x_ids, k + 1, rough[i])]
                columns, kinds = list(zip(*rows, strict=True)), [pa.int64(), pa.int64(), pa.float64(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["query", "vec_id", "score", "same"])

    found = pairs.select("asked", "held").mapInArrow(compare, "query bigint, vec_id bigint, score double, same boolean")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    best = found.withColumn("_rank", rank).filter(F.col("_rank") <= k + 1)
    lists = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct("_rank", "vec_id", "score", "same"))).alias("_best"))
    # A query's own row alone is left out: its id with its vector.
    own = F.slice(F.filter("_best", lambda b: ~((b["vec_id"] == F.col("query_id")) & b["same"])), 1, k)
    hits = members.join(lists, "query").select("query_id", F.posexplode(own).alias("_pos", "_hit"))
    return hits.select("query_id", (F.col("_pos") + 1).alias("rank"), "_hit.vec_id", "_hit.score")


def nearest_neighbours(
    df: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "embedding", recall: float = RECALL
) -> DataFrame:
    """The k nearest rows of every row that ``is_query`` (a condition on ``vec_id``) picks."""
    usable_rows = materialize(usable(df, id, vector).withColumn("_n", F.size("vector")), "ann-rows")
    out = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    for n in sorted(r["_n"] for r in usable_rows.select("_n").distinct().collect()):  # one row per length
        rows = usable_rows.filter(F.col("_n") == n).drop("_n")
        queries, index = rows.filter(is_query), build(rows, k)
        if index is not None:
            out = out.union(search(index, queries, calibrate(index, queries, recall)))
    return out
