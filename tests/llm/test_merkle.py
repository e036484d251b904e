"""Manifest against a plain tree that hashes everything anew."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from offerloom.llm import merkle
from offerloom.session import scratch_path


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def framed(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Levels of the plain tree."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h("".join(now[i : i + 3])) for i in range(0, len(now), 3)])
    return levels


def siblings(levels, place):
    out = []
    for nodes in levels[:-1]:
        start = place - place % 3
        out += [x for i, x in enumerate(nodes[start : start + 3], start) if i != place]
        place //= 3
    return out


def expected(rows, change):
    """(id, leaf, subroot, root, proof, folded root, verified) per row (doc_id, source, lang, n_chars, text)."""
    leaves = [(r, framed(r)) for r in rows]
    names = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {n: sorted((x for x in leaves if x[0][1] == n), key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1])) for n in names}
    trees = {n: tree([leaf for _, leaf in own[n]]) for n in names}
    top = tree([trees[n][-1][0] for n in names])
    out = []
    for at, n in enumerate(names):
        for place, (row, leaf) in enumerate(own[n]):
            new = [x for _, x in own[n]]
            new[place] = framed(change(row)) if change(row) else leaf
            roots = [trees[m][-1][0] for m in names]
            roots[at] = tree(new)[-1][0]
            folded = tree(roots)[-1][0]
            proof = h("".join(siblings(trees[n], place) + siblings(top, at)))
            out.append((row[0], leaf, trees[n][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def run(spark, rows, changed, levels=merkle.BLOCK_LEVELS):
    df = spark.createDataFrame([(*r, "clash", "clash") for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, key string, digest string")
    columns = [F.col(c) for c in merkle.COLUMNS]
    other = merkle.leaf(*columns[:-1], F.concat(F.col("text"), F.lit("!")))
    manifest = merkle.build(df, merkle.leaf(*columns), keep={"candidate": F.when(F.col("doc_id").isin(changed), other)}, levels=levels)
    return manifest, [tuple(r) for r in merkle.verify(manifest, "candidate").collect()]


@pytest.mark.parametrize("levels, sizes", [(7, [1]), (1, [1, 1]), (7, [40, 1, 3, 4, 9, 10]), (1, [40, 1, 3, 4, 9, 10]), (2, [28, 27, 2] + [1] * 11)])
def test_equals_plain_tree(spark, levels, sizes):
    rnd = random.Random(len(sizes))
    names = [None, "", "é", "z", "a", "web", "s"] + [f"x{i}" for i in range(20)]
    ids = rnd.sample(range(-5, 1000), sum(sizes))
    rows = [(ids.pop(), names[i], None if k % 4 == 0 else "en", k, None if k % 5 == 0 else f"été {k}\n") for i, n in enumerate(sizes) for k in range(n)]
    changed = [r[0] for r in rows if r[0] % 2 == 0]
    manifest, got = run(spark, rows, changed, levels)
    want = expected(rows, lambda r: (*r[:4], r[4] + "!" if r[4] is not None else None) if r[0] in changed else None)
    assert sorted(got) == sorted(want)
    assert manifest.root == want[0][3]


def test_repeated_rows_null_ids_and_long_text(spark):
    rows = [(None, "a", "en", 1, "x"), (None, "a", "en", 1, "y"), (5, "a", None, None, "x" * 2_000_000), (5, "a", "en", 1, "same"), (5, "a", "en", 1, "same"), (6, "b", "en", 0, "")]
    _, got = run(spark, rows, [5])
    want = expected(rows, lambda r: (*r[:4], r[4] + "!") if r[0] == 5 else None)
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(spark):
    manifest, got = run(spark, [(1, "a", "en", 1, "x")], [])
    empty = merkle.build(manifest.leaves.limit(0).withColumn("source", F.lit("a")), F.col("digest"), id="id", keep={"candidate": F.col("candidate")})
    assert empty.root is None and merkle.verify(empty, "candidate").collect() == [] and len(got) == 1


def test_fold_hashes_nothing_to_the_left(monkeypatch):
    """A fold takes the kept states; only the replacement and the siblings to its right are hashed."""
    tree_ = merkle.MidstateTree([h(str(i)) for i in range(30)])
    fed = []

    class Counting:
        def __init__(self, state):
            self.state = state

        def copy(self):
            return Counting(self.state.copy())

        def update(self, data):
            fed.append(data)
            self.state.update(data)

        def hexdigest(self):
            return self.state.hexdigest()

    tree_.states = [[[Counting(s) for s in parent] for parent in level] for level in tree_.states]
    new = [h(str(i)) for i in range(30)]
    new[17] = h("new")
    assert tree_.fold(17, h("new")) == tree(new)[-1][0]
    assert len(fed) == sum(1 + len(nodes[p + 1 : p - p % 3 + 3]) for nodes, p in zip(tree_.levels, (17, 5, 1, 0)))


def test_written_manifest(spark):
    manifest, got = run(spark, [(i, "a" if i % 3 else None, "en", i, f"text {i}") for i in range(20)], [])
    path = scratch_path(spark, "manifest")
    merkle.write_manifest(manifest, path)
    assert spark.read.parquet(f"{path}/root").first()["root"] == got[0][3]
    assert {(r["source"], r["rows"], r["subroot"]) for r in spark.read.parquet(f"{path}/sources").collect()} == {(None, 7, manifest.sources.filter("source IS NULL").first()["subroot"]), ("a", 13, manifest.sources.filter("source = 'a'").first()["subroot"])}
    assert sorted(r["digest"] for r in spark.read.parquet(f"{path}/leaves").collect()) == sorted(r[1] for r in got)
