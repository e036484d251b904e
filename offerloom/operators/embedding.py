"""State vectors: encoding, fitting and reading back."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerloom.session import cut_lineage

# Size of a slice of the token table, states compared with it at a time, and bands of vector lengths.
SLICE_BYTES = 16 * 1024 * 1024
BLOCK_ROWS = 1024
BANDS = 64
# States that the attention encoder unpacks at a time.
ATTEND_ROWS = 64


@dataclass(frozen=True)
class EncoderWeights:
    """Parameters of the state encoder: token table, self-attention, position weights, output layer."""

    embeddings: np.ndarray  # (vocabulary, dim); row 0 is padding
    attn_in: np.ndarray  # (dim, dim)
    attn_out: np.ndarray  # (dim, 2 * dim)
    positions: np.ndarray  # (length,)
    position_bias: float
    out: np.ndarray  # (features, dim)
    out_bias: np.ndarray  # (features,)


def _attend(w: EncoderWeights, vectors: np.ndarray) -> np.ndarray:
    """Forward pass for a small batch of embedded sequences ``(rows, length, dim)``."""
    query = vectors @ w.attn_in.T
    scores = query @ vectors.transpose(0, 2, 1)
    scores = np.exp(scores - scores.max(axis=2, keepdims=True))
    scores /= scores.sum(axis=2, keepdims=True)
    mixed = np.concatenate([scores @ vectors, query], axis=2)
    attended = np.tanh(mixed @ w.attn_out.T)
    pooled = np.tensordot(attended, w.positions, axes=(1, 0)) + w.position_bias
    return pooled @ w.out.T + w.out_bias


def _attended(w: EncoderWeights, padding: np.ndarray, places: pa.Array, numbers: pa.Array) -> pa.Array:
    """Forward pass for lists of positions and, end to end, of the vectors at them.

    The lists stay flat Arrow arrays, no Python object stands for a token, and :data:`ATTEND_ROWS` states are unpacked at a time.
    """
    out = [np.zeros((0, len(w.out_bias)))]
    for start in range(0, len(places), ATTEND_ROWS):
        part = places.slice(start, ATTEND_ROWS)
        x = np.tile(padding, (len(part), len(w.positions), 1))
        row = np.repeat(np.arange(len(part)), pc.list_value_length(part).to_numpy(zero_copy_only=False))
        at = part.flatten().to_numpy(zero_copy_only=False)
        x[row, at] = numbers.slice(start, ATTEND_ROWS).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(padding))
        out.append(_attend(w, x))
    found = np.concatenate(out)
    ends = np.arange(len(found) + 1, dtype=np.int32) * found.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found.ravel()))


def encode_states(weights: EncoderWeights, c: Column, batch: int = 64) -> Column:
    """Token arrays to dense vectors, by Arrow batches.

    Sequences are cut to their newest tokens and padded on the right with 0. The token table travels with the
    task; :func:`encode_states_attention` gives the same vectors with the table as a DataFrame of any size.
    """
    length = len(weights.positions)

    @F.pandas_udf("array<double>")
    def encode(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for states in batches:
            out = []
            for start in range(0, len(states), batch):
                part = states.iloc[start:start + batch]
                ids = np.zeros((len(part), length), dtype=np.int64)
                for i, s in enumerate(part):
                    s = np.zeros(1, dtype=np.int64) if s is None else np.asarray(s, dtype=np.int64)[-length:]
                    ids[i, :len(s)] = s
                out.extend(_attend(weights, weights.embeddings[ids]))
            yield pd.Series(out, dtype=object)

    return encode(c)


def encode_states_attention(
    df: DataFrame, vectors: DataFrame, weights: EncoderWeights, keys: list[str], tokens: str = "state_tokenized"
) -> DataFrame:
    """The vectors of :func:`encode_states` for token tables of any size: ``keys`` (unique) and ``vector``.

    ``vectors`` has ``token, vector``. Token vectors are joined to the positions of each state and gathered again, at most ``length``
    of them; only the small matrices of ``weights`` travel with the task. A missing token counts as padding.
    """
    length, dim = len(weights.positions), weights.attn_in.shape[0]
    newest = F.slice(F.col(tokens), F.greatest(F.size(tokens) - (length - 1), F.lit(1)), length)
    asked = df.select(*keys, F.posexplode_outer(newest).alias("_pos", "token"))
    held = vectors.select("token", F.col("vector").cast("array<double>").alias("vector"))
    wrong = F.raise_error(F.lit(f"a token vector has not the {dim} numbers of the encoder"))
    placed = F.when(F.size("vector") == dim, F.struct("_pos", "vector")).when(F.col("vector").isNotNull(), wrong)
    lists = asked.join(held, "token", "left").groupBy(*keys).agg(F.collect_list(placed).alias("_v"))
    padding = np.zeros(dim) if not len(weights.embeddings) else np.asarray(weights.embeddings[0], dtype=float)

    @F.arrow_udf("array<double>")
    def attend(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for places, numbers in batches:
            yield _attended(weights, padding, places, numbers)

    places, numbers = F.transform("_v", lambda v: v["_pos"]), F.flatten(F.transform("_v", lambda v: v["vector"]))
    return lists.select(*keys, attend(places, numbers).alias("vector"))


def _scaled(x: Column) -> Column:
    return F.transform(x["vector"], lambda y: y * x["n"])


def encode_states_joined(df: DataFrame, vectors: DataFrame, keys: list[str], tokens: str = "state_tokenized") -> DataFrame:
    """Mean token vector of each state by joins alone, for token tables of any size.

    ``vectors`` has ``token, vector``.
    """
    counts = df.select(*keys, F.explode(tokens).alias("token")).groupBy(*keys, "token").agg(
        F.count(F.lit(1)).alias("n")
    )
    # A state has a bounded number of tokens, so its list of vectors is bounded too.
    lists = counts.join(vectors, "token").groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct("token", "n", "vector"))).alias("_v"), F.sum("n").alias("_n")
    )
    total = F.aggregate(
        F.slice("_v", 2, F.size("_v")), _scaled(F.get("_v", F.lit(0))),
        lambda acc, x: F.zip_with(acc, _scaled(x), lambda a, b: a + b),
    )
    mean = F.transform(total, lambda t: t / F.col("_n"))
    return lists.filter("_n > 0").select(*keys, mean.alias("vector"))


def is_rectangular(df: DataFrame, col: str) -> DataFrame:
    """1 if all arrays of the column have one length, with the shortest and the longest."""
    sizes = df.agg(F.min(F.size(col)).alias("shortest"), F.max(F.size(col)).alias("longest"))
    return sizes.withColumn("rectangular", F.when(F.col("shortest") == F.col("longest"), 1).otherwise(0))


def pad_to_longest(df: DataFrame, col: str, token: int = 0) -> DataFrame:
    """Arrays filled on the right to the longest length of the column."""
    longest = df.agg(F.max(F.size(col))).scalar()
    filled = F.concat(F.col(col), F.array_repeat(F.lit(token), F.col("_n") - F.size(col)))
    return df.withColumn("_n", longest).withColumn(col, filled).drop("_n")


def _sign(token: Column, j: int) -> Column:
    """+1 or -1, by a hash of token and dimension."""
    return F.when(F.substring(F.md5(F.concat(token, F.lit(f":{j}"))), 1, 1) < "8", 1.0).otherwise(-1.0)


def fit_state_embedding(
    df: DataFrame, dim: int, keys: list[str], state: str = "state", window: int = 5, min_count: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Token vectors and state vectors fitted on token sequences. Returns ``(vectors, states)``.

    Tokens are described by the tokens near them: counts of pairs at most ``window`` apart, weighed by positive pointwise mutual
    information, and projected to ``dim`` numbers by hashed signs (dot products are kept in expectation). All of it is grouping and joining, so
    neither the sequences nor the dictionary meet in one place, and the result does not depend on layout or luck.
    ``vectors`` has ``token_name, vector``; ``states`` has ``keys`` and the mean vector of the tokens. Tokens seen less than
    ``min_count`` times get no vector; a token without neighbours has zeros.
    """
    near = F.flatten(F.transform(state, lambda x, i: F.transform(
        F.slice(F.col(state), i + 2, window), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    seen = df.select(F.explode(state).alias("token_name")).groupBy("token_name").agg(F.count(F.lit(1)).alias("_n")).filter(
        (F.col("_n") >= min_count) & F.col("token_name").isNotNull()
    )
    pairs = df.select(F.explode(near).alias("p")).select("p.a", "p.b").filter("a is not null and b is not null")
    counts = pairs.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
    both = counts.union(counts.select("b", "a", "n")).groupBy("a", "b").agg(F.sum("n").alias("n"))
    both = cut_lineage(both)  # one row per pair of tokens that ever meet
    total = both.groupBy("a").agg(F.sum("n").alias("_of"))
    everything = both.agg(F.sum("n").cast("double")).scalar()
    weighed = (
        both.join(total.withColumnRenamed("_of", "_na"), "a").join(total.withColumnsRenamed({"a": "b", "_of": "_nb"}), "b")
        .withColumn("w", F.ln(F.col("n") * everything / (F.col("_na").cast("double") * F.col("_nb")))).filter("w > 0")
    )
    parts = weighed.groupBy("a").agg(*[F.sum(F.col("w") * _sign(F.col("b"), j)).alias(f"_{j}") for j in range(dim)])
    scale = F.lit(float(dim) ** 0.5)
    vectors = seen.select("token_name").join(parts.withColumnRenamed("a", "token_name"), "token_name", "left").select(
        "token_name", F.array(*[F.coalesce(F.col(f"_{j}"), F.lit(0.0)) / scale for j in range(dim)]).alias("vector")
    )
    return vectors, encode_states_joined(df, vectors.withColumnRenamed("token_name", "token"), keys, state)


def extend_embedding(old: DataFrame, vocab: DataFrame, dim: int) -> DataFrame:
    """Vectors for a grown dictionary: known tokens keep theirs, new ones start at zero."""
    return vocab.join(old, "token_name", "left").withColumn(
        "vector", F.coalesce("vector", F.array_repeat(F.lit(0.0), dim))
    )


def _norm(c: str) -> Column:
    return F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x * x))


def _best_of_slices(asked: DataFrame, held: DataFrame, k: int, blocks: int) -> DataFrame:
    """Best ``k`` tokens by state: ``asked`` has ``_key, vector, _slice``, ``held`` one record per slice."""
    kind = asked.schema["_key"].dataType.simpleString()
    packed = asked.groupBy("_slice", F.pmod(F.xxhash64("_key"), F.lit(blocks)).alias("_block")).agg(
        F.collect_list(F.struct("_key", "vector")).alias("_asked")
    )

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for asked, held in zip(batch["_asked"], batch["_held"]):
                names = np.array([h["token_name"] for h in held], dtype=object)
                scores = np.stack([a["vector"] for a in asked]) @ np.stack([h["vector"] for h in held]).T
                # Slices are sorted by name, so a stable sort leaves ties by name.
                top = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                width = top.shape[1]
                yield pd.DataFrame({
                    "_key": np.repeat([a["_key"] for a in asked], width), "token_name": names[top].ravel(),
                    "score": np.take_along_axis(scores, top, axis=1).ravel(),
                })

    return packed.join(held, "_slice").select("_asked", "_held").mapInPandas(best, f"_key {kind}, token_name string, score double")


def _top(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("_key").orderBy(F.desc("score"), "token_name"))
    return found.withColumn("_rank", rank).filter(F.col("_rank") <= k)


def decode_tokens(df: DataFrame, vectors: DataFrame, k: int, key: str, slice_bytes: int = SLICE_BYTES, bands: int = BANDS) -> DataFrame:
    """The ``k`` tokens whose vectors have the largest product with the ``vector`` of each state, ties by name.

    The token table is cut into bands by the length of the vectors, and a band into slices by a hash, each one record of bounded size. All states
    meet the band of the longest vectors first; their k-th best product so far is a threshold, and by Cauchy-Schwarz a
    state needs no band whose longest vector times its own length is below it. Block and slice meet in a join, are multiplied in Arrow batches, and the
    best of each slice are merged by state. Only counts and the borders of the bands come to the driver. On vectors of one length all slices are compared.
    """
    states = cut_lineage(df.select(F.col(key).alias("_key"), F.col("vector").cast("array<double>").alias("vector")).withColumn("_norm", _norm("vector")))
    held = cut_lineage(vectors.select("token_name", F.col("vector").cast("array<double>").alias("vector")).withColumn("_norm", _norm("vector")))
    shape = held.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("vector")).alias("d")).first()
    row_bytes = (shape["d"] or 1) * 8
    wanted = min(bands, max(1, -(-(shape["n"] * row_bytes) // slice_bytes)))
    edges: list[float] = []
    if wanted > 1:
        ranks = [1 - i / wanted for i in range(1, wanted)]
        edges = sorted(set(held.agg(F.percentile_approx("_norm", ranks, 10_000)).first()[0]), reverse=True)
    borders = F.array(*map(F.lit, edges)) if edges else F.array().cast("array<double>")
    # The number of borders above a vector's length: all vectors of band b > 0 are shorter than border b - 1.
    held = held.withColumn("_band", F.size(F.filter(borders, lambda e: e > F.col("_norm"))))
    sizes = {r["_band"]: r["n"] for r in held.groupBy("_band").agg(F.count(F.lit(1)).alias("n")).collect()}
    parts = [max(1, -(-(sizes.get(b, 0) * row_bytes) // slice_bytes)) for b in range(len(edges) + 1)]
    first = [sum(parts[:b]) for b in range(len(parts) + 1)]

    def of_band(values: list[int], band: Column) -> Column:
        return F.get(F.array(*[F.lit(v).cast("bigint") for v in values]), band)

    part = F.pmod(F.xxhash64("token_name"), of_band(parts, F.col("_band")))
    sliced = held.groupBy((of_band(first, F.col("_band")) + part).alias("_slice")).agg(
        F.sort_array(F.collect_list(F.struct("token_name", "vector"))).alias("_held")
    )
    blocks = max(1, -(-states.count() // BLOCK_ROWS))

    def sent(rows: DataFrame, start: int, end: Column) -> DataFrame:
        numbers = F.when(end > start, F.sequence(F.lit(start).cast("bigint"), end - 1))
        return rows.select("_key", "vector", F.explode(numbers).alias("_slice"))

    best = _top(_best_of_slices(sent(states, 0, F.lit(first[1]).cast("bigint")), sliced, k, blocks), k)
    if edges:
        best = cut_lineage(best)
        least = best.filter(F.col("_rank") == k).select("_key", F.col("score").alias("_least"))
        # A little slack, for products and lengths are rounded.
        reached = F.filter(borders, lambda e: F.col("_least").isNull() | (e * F.col("_norm") * (1 + 1e-9) >= F.col("_least")))
        open_ = states.join(least, "_key", "left").withColumn("_end", of_band(first, F.size(reached) + 1))
        more = _best_of_slices(sent(open_, first[1], F.col("_end")), sliced, k, blocks)
        best = _top(best.select("_key", "token_name", "score").union(more), k)
    lists = best.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("_rank", "token_name", "score"))).alias("_best"))
    return lists.select(
        F.col("_key").alias(key), F.transform("_best", lambda b: b["token_name"]).alias("tokens"),
        F.transform("_best", lambda b: b["score"]).alias("scores"),
    )
