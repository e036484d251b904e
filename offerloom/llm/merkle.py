"""Merkle manifest of a dataset: one digest per row, per source and for the whole, and proofs that a row belongs to it.

A row is a leaf: the sha256 of its columns, each framed by its length. The leaves of a source ascend by id; runs of :data:`FAN` consecutive nodes
become their parent, the sha256 of their digests as hex text, level by level until one node is left, the source's subroot. Subroots,
ordered by source, give the root in the same way.

A parent keeps a copy of its hash state before each child slot. To replace a child, the state of its slot is resumed with the new digest and the
right siblings only; the left ones are in the state already. So a fold costs a resumed state per level, not a level of nodes.

Leaves are made by Spark expressions, numbered along sorted ranges, and worked on in blocks of :data:`FAN` ** :data:`BLOCK_LEVELS` consecutive
leaves of a source: a block's tree is built in one task, so a source with a third of all rows has a third of all blocks. The roots of the blocks are
nodes of the next round, which is smaller by that factor, and so on. The way down takes the siblings above each block back to it, one row
per block, and the leaves of a block are folded beside them.

Defined results: null columns are marked as such and differ from empty ones; a null id comes first; rows of one id are ordered by leaf, equal
rows stay rows; a null source is a source of its own, first in order; a source of one row has its leaf as subroot; an empty table gives an
empty result; other columns are not part of a leaf unless named; a text of any length is hashed whole by Spark.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.llm.common import materialize, numbered, release

FAN = 3
# A block holds FAN ** BLOCK_LEVELS nodes, unless the caller says otherwise.
BLOCK_LEVELS = 7
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_NODE = "key string, idx bigint, n bigint, digest string"
_PATH = "array<struct<left:string,right:string>>"
_PATH_TYPE = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def leaf(*columns: Column) -> Column:
    """Digest of a row: each column as ``-`` if null, else as its length in bytes, a colon and its text."""
    framed = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-")) for c in columns]
    return F.sha2(F.concat(*framed), 256)


class MidstateTree:
    """Tree over some digests: for each parent the hash state before each child slot.

    With ``levels`` the tree goes exactly so many levels up, else until one node is left.
    """

    def __init__(self, digests: list[str], levels: int | None = None):
        self.levels = [digests]
        self.states: list[list[list]] = []
        while len(self.levels[-1]) > 1 if levels is None else len(self.states) < levels:
            nodes, parents, states = self.levels[-1], [], []
            for start in range(0, len(nodes), FAN):
                state, before = hashlib.sha256(), []
                for digest in nodes[start : start + FAN]:
                    before.append(state.copy())
                    state.update(digest.encode())
                parents.append(state.hexdigest())
                states.append(before)
            self.levels.append(parents)
            self.states.append(states)

    def root(self) -> str:
        return self.levels[-1][0]

    def path(self, place: int) -> list[tuple[str, str]]:
        """Siblings of the node at ``place`` and of those above it: those to the left and those to the right, joined."""
        out = []
        for nodes in self.levels[: len(self.states)]:
            start = place - place % FAN
            out.append(("".join(nodes[start:place]), "".join(nodes[place + 1 : start + FAN])))
            place //= FAN
        return out

    def fold(self, place: int, digest: str) -> str:
        """Root of the tree if the node at ``place`` were ``digest``."""
        for nodes, states in zip(self.levels, self.states, strict=False):
            parent, slot = divmod(place, FAN)
            state = states[parent][slot].copy()
            for right in (digest, *nodes[place + 1 : (parent + 1) * FAN]):
                state.update(right.encode())
            digest, place = state.hexdigest(), parent
        return digest


class MidstatePath:
    """The nodes above a block: the hash state before its slot at each level, and the siblings to the right."""

    def __init__(self, path: list[dict]):
        self.steps = [(hashlib.sha256(step["left"].encode()), step["right"].encode()) for step in path]
        self.siblings = "".join(step["left"] + step["right"] for step in path)

    def fold(self, digest: str) -> str:
        for before, right in self.steps:
            state = before.copy()
            state.update(digest.encode())
            state.update(right)
            digest = state.hexdigest()
        return digest


def _tree(table: pa.Table, levels: int) -> tuple[MidstateTree, list[int]]:
    """Tree of one block of nodes, and the rows in the order of its leaves."""
    size = FAN**levels
    idx = table.column("idx").to_pylist()
    order = sorted(range(len(idx)), key=idx.__getitem__)
    digests = table.column("digest").to_pylist()
    whole = table.column("n")[0].as_py() <= size  # the last block of its sequence: nothing is above
    return MidstateTree([digests[i] for i in order], None if whole else levels), order


def _with_block(nodes: DataFrame, levels: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("idx") / FAN**levels).cast("bigint"))


def _rounds(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes, then the roots of their blocks, and so on until every sequence has one node. ``n``: nodes of the sequence."""
    size = FAN**levels

    def block_root(table: pa.Table) -> pa.Table:
        tree, _ = _tree(table, levels)
        block, n = table.column("idx")[0].as_py() // size, -(-table.column("n")[0].as_py() // size)
        return pa.table({"key": table.column("key").slice(0, 1), "idx": pa.array([block], pa.int64()), "n": pa.array([n], pa.int64()), "digest": [tree.root()]})

    rounds = [nodes]
    while rounds[-1].filter("n > 1").limit(1).count():
        open_ = rounds[-1].filter("n > 1").select("key", "idx", "n", "digest")
        rounds.append(materialize(_with_block(open_, levels).groupBy("key", "block").applyInArrow(block_root, _NODE), "merkle-nodes"))
    return rounds


def _tops(rounds: list[DataFrame]) -> DataFrame:
    """The one node left of every sequence: ``key``, ``digest``."""
    tops = None
    for nodes in rounds:
        top = nodes.filter("n = 1").select("key", "digest")
        tops = top if tops is None else tops.union(top)
    return tops


def _beside(nodes: DataFrame, blocks: DataFrame):
    """The nodes of every block beside its row in ``blocks``, by ``key`` and ``block``."""
    # Columns of the two sides may come from one table, so those of the right side are made anew.
    right = blocks.select(*[F.col(c).alias(f"_{c}") for c in blocks.columns]).toDF(*[f"{c}_" for c in blocks.columns])
    return nodes.groupBy("key", "block").cogroup(right.groupBy("key_", "block_"))


def _node_paths(nodes: DataFrame, blocks: DataFrame, levels: int) -> DataFrame:
    """Path of every node: inside its block, then that of the block itself."""

    def paths(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.table({"key": pa.array([], pa.string()), "idx": pa.array([], pa.int64()), "path": pa.array([], _PATH_TYPE)})
        tree, order = _tree(left, levels)
        above = right.column("path_")[0].as_py()
        found = [[{"left": a, "right": b} for a, b in tree.path(i)] + above for i in range(len(order))]
        ordered = left.take(pa.array(order))
        return pa.table({"key": ordered.column("key"), "idx": ordered.column("idx"), "path": pa.array(found, _PATH_TYPE)})

    return _beside(nodes, blocks).applyInArrow(paths, f"key string, idx bigint, path {_PATH}")


def _paths(rounds: list[DataFrame], tops: DataFrame, levels: int) -> DataFrame:
    """Path above every block of the first round: ``key``, ``block``, ``path``. ``tops`` has the path above each whole sequence."""
    paths = None
    for i in range(len(rounds) - 1, 0, -1):
        nodes = _with_block(rounds[i].select("key", "idx", "n", "digest"), levels)
        # A sequence that ends in this round goes on with the path of its top.
        ended = nodes.filter("n = 1").select("key", "idx").join(tops, "key").select("key", "idx", "path")
        if paths is None:
            paths = ended
        else:
            above = paths.select("key", F.col("idx").alias("block"), "path")
            paths = ended.union(_node_paths(nodes.filter("n > 1"), above, levels))
        paths = materialize(paths, "merkle-paths")
    alone = rounds[0].filter("n = 1").select("key", F.lit(0).cast("bigint").alias("block")).join(tops, "key").select("key", "block", "path")
    if paths is None:
        return alone
    return paths.select("key", F.col("idx").alias("block"), "path").union(alone)


@dataclass
class Manifest:
    """``leaves``: key, idx, n, digest, id and the columns kept. ``blocks``: key, block, path, subroot. ``sources``: source, rows, subroot."""

    leaves: DataFrame
    blocks: DataFrame
    sources: DataFrame
    root: str | None
    levels: int


def build(
    df: DataFrame, digest: Column, id: str = "doc_id", source: str = "source", keep: dict[str, Column] | None = None, levels: int = BLOCK_LEVELS
) -> Manifest:
    """Trees of all sources and of the whole. ``keep``: further columns of the leaves, such as a digest to verify."""
    keep = keep or {}
    named = F.col(source).cast("string")
    # A key without nulls in the same order: the null source is the empty key, before all others.
    rows = df.select(
        F.coalesce(F.concat(F.lit("s"), named), F.lit("")).alias("key"), F.col(id).alias("id"), digest.alias("digest"),
        *[column.alias(name) for name, column in keep.items()],
    )
    leaves = materialize(numbered(rows, ["key"], ["id", "digest"], "idx"), "merkle-leaves")
    counts = leaves.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    leaves = leaves.join(materialize(counts, "merkle-counts"), "key")
    rounds = _rounds(leaves, levels)
    subroots = materialize(_tops(rounds), "merkle-subroots")

    n = subroots.count()
    order = numbered(subroots.select(F.lit("").alias("key"), F.col("key").alias("source"), "digest"), ["key"], ["source"], "idx")
    top_nodes = materialize(order.withColumn("n", F.lit(n).cast("bigint")), "merkle-sources")
    top_rounds = _rounds(top_nodes, levels)
    root = _tops(top_rounds).first()
    # Above the root there is nothing.
    nothing = rows.sparkSession.createDataFrame([("", [])], f"key string, path {_PATH}")
    above = _paths(top_rounds, nothing, levels)
    found = _node_paths(_with_block(top_nodes, levels), above, levels)
    source_paths = materialize(
        top_nodes.join(found, ["key", "idx"]).select(F.col("source").alias("key"), "path", F.col("digest").alias("subroot")), "merkle-source-paths"
    )
    blocks = _paths(rounds, source_paths.select("key", "path"), levels).join(source_paths.select("key", "subroot"), "key")
    sources = source_paths.join(counts, "key").select(
        F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).alias("source"), F.col("n").alias("rows"), "subroot"
    )
    return Manifest(leaves, blocks, sources, root["digest"] if root else None, levels)


_PROOF = "id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def verify(manifest: Manifest, candidate: str) -> DataFrame:
    """Fold the digest in column ``candidate`` of every leaf (null: the leaf itself) into its place, with the siblings of the manifest.

    Columns ``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256`` (over all siblings, upwards, left to right), ``folded_root`` and ``verified``.
    """
    root, levels = manifest.root, manifest.levels

    def fold(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return pa.table({name: pa.array([], kind) for name, kind in _PROOF_TYPES.items()})
        tree, order = _tree(left, levels)
        above = MidstatePath(right.column("path_")[0].as_py())
        ids, digests, others = (left.column(c).to_pylist() for c in ("id", "digest", "_candidate"))
        proofs, folded = [], []
        same = above.fold(tree.root())
        for place, i in enumerate(order):
            siblings = "".join(a + b for a, b in tree.path(place)) + above.siblings
            proofs.append(hashlib.sha256(siblings.encode()).hexdigest())
            top = tree.fold(place, others[i] if others[i] is not None else digests[i])
            folded.append(same if top == tree.root() else above.fold(top))
        n = len(order)
        columns = [
            [ids[i] for i in order], [digests[i] for i in order], [right.column("subroot_")[0].as_py()] * n, [root] * n, proofs, folded, [f == root for f in folded],
        ]
        release()
        return pa.table({name: pa.array(c, kind) for c, (name, kind) in zip(columns, _PROOF_TYPES.items(), strict=True)})

    rows = _with_block(manifest.leaves.select("key", "idx", "n", "digest", "id", F.col(candidate).alias("_candidate")), levels)
    blocks = manifest.blocks.select("key", "block", "path", "subroot")
    return _beside(rows, blocks).applyInArrow(fold, _PROOF)


_PROOF_TYPES = {
    "id": pa.int64(), "leaf": pa.string(), "subroot": pa.string(), "root": pa.string(), "proof_sha256": pa.string(), "folded_root": pa.string(), "verified": pa.bool_(),
}


def write_manifest(manifest: Manifest, path: str) -> None:
    """The manifest as tables: ``leaves`` (source, place, id, digest), ``sources`` (source, rows, subroot) and ``root``."""
    named = F.when(F.col("key") != "", F.substring("key", 2, 1 << 30)).alias("source")
    manifest.leaves.select(named, F.col("idx").alias("place"), "id", "digest").write.parquet(f"{path}/leaves")
    manifest.sources.write.parquet(f"{path}/sources")
    manifest.sources.sparkSession.createDataFrame([(manifest.root,)], "root string").write.parquet(f"{path}/root")


def _sql(levels: int = 16, source_levels: int = 6) -> str:
    """The same for DuckDB, a level per step: up, then folding every document upwards. Holds to 3 ** levels rows a source."""
    framed = lambda c, v: f"coalesce(CAST(strlen(CAST({v} AS VARCHAR)) AS VARCHAR) || ':' || CAST({v} AS VARCHAR), '-') "
    row = lambda text: " || ".join(framed(c, text if c == "text" else c) for c in COLUMNS)
    table = []
    for i in range(256):
        for _ in range(8):
            i = i >> 1 ^ (0xEDB88320 if i & 1 else 0)
        table.append(str(i))
    byte_list = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    crc = (
        f"xor(4294967295, list_reduce([4294967295::BIGINT] || {byte_list}, "
        f"lambda c, b: xor(([{', '.join(table)}]::BIGINT[])[1 + (xor(c, b) & 255)], c >> 8)))"
    )
    steps = [
        f"""d AS MATERIALIZED (
    SELECT doc_id, coalesce('s' || source, '') AS key, sha256({row("text")}) AS leaf,
           CASE WHEN {crc} % 2 = 0 THEN sha256({row("replace(text, chr(10), '')")}) END AS other
    FROM documents
)""",
        "up0 AS MATERIALIZED (SELECT key, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf AS h, count(*) OVER (PARTITION BY key) AS n FROM d)",
        """f0 AS MATERIALIZED (SELECT doc_id, key, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, leaf,
        coalesce(other, leaf) AS h, '' AS proof FROM d)""",
    ]

    def level(up: str, fold: str, now: int, then: int) -> None:
        steps.append(
            f"""{up}{then} AS MATERIALIZED (
    SELECT key, i // {FAN} AS i, CASE WHEN any_value(n) > 1 THEN sha256(string_agg(h, '' ORDER BY i)) ELSE any_value(h) END AS h,
           (any_value(n) + {FAN - 1}) // {FAN} AS n
    FROM {up}{now} GROUP BY key, i // {FAN}
)"""
        )
        steps.append(
            f"""{fold}{then} AS MATERIALIZED (
    SELECT f.doc_id, f.key, f.i // {FAN} AS i, f.leaf, COLUMNS_KEPT
           CASE WHEN s.n > 1 THEN sha256(s.l || f.h || s.r) ELSE f.h END AS h, f.proof || s.l || s.r AS proof
    FROM {fold}{now} f JOIN (
        SELECT a.key, a.i, any_value(a.n) AS n, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l,
               coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r
        FROM {up}{now} a JOIN {up}{now} b ON a.key = b.key AND a.i // {FAN} = b.i // {FAN} GROUP BY a.key, a.i
    ) s ON f.key = s.key AND f.i = s.i
)""".replace("COLUMNS_KEPT", "f.subroot," if fold == "g" else "")
        )

    for x in range(levels):
        level("up", "f", x, x + 1)
    steps.append(f"top0 AS MATERIALIZED (SELECT '' AS key, row_number() OVER (ORDER BY key) - 1 AS i, h, count(*) OVER () AS n, key AS source FROM up{levels})")
    steps.append(f"g0 AS MATERIALIZED (SELECT f.doc_id, '' AS key, t.i, f.leaf, t.h AS subroot, f.h, f.proof FROM f{levels} f JOIN top0 t ON t.source = f.key)")
    for x in range(source_levels):
        level("top", "g", x, x + 1)
    return (
        "WITH " + ",\n".join(steps)
        + f"""
SELECT g.doc_id, g.leaf, g.subroot, t.h AS root, sha256(g.proof) AS proof_sha256, g.h AS folded_root, g.h = t.h AS verified
FROM g{source_levels} g CROSS JOIN top{source_levels} t"""
    )


MERKLE_SQL = _sql()
