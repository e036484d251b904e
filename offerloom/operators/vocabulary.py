"""Token names, the token dictionary, and its use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerloom.fixed_values import TOKEN_SEPARATOR
from offerloom.operators.blocks import dense_index


def token_name(name: str = "feature_name", value: str = "feature_value") -> Column:
    """``name___value``; a null value leaves the name alone."""
    return F.concat_ws(TOKEN_SEPARATOR, name, value)


def new_tokens(df: DataFrame, col: str, existing: DataFrame) -> DataFrame:
    """Distinct token names that the dictionary does not hold yet."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().join(existing.select(col), col, "left_anti")


def max_token(vocab: DataFrame) -> int:
    """Largest id in use, 0 for an empty dictionary."""
    return vocab.agg(F.coalesce(F.max("token"), F.lit(0)).alias("m")).first()["m"]


def vocab_size(vocab: DataFrame) -> DataFrame:
    """Size of an embedding table for this dictionary: largest id plus the padding row."""
    return vocab.agg((F.coalesce(F.max("token"), F.lit(0)) + 1).alias("vocab_size"))


def added_tokens(df: DataFrame, col: str, existing: DataFrame) -> DataFrame:
    """The rows that extend an existing dictionary: new names with the ids after the largest one."""
    return dense_index(new_tokens(df, col, existing), col, "token", start=max_token(existing), dtype="int")


def build_vocabulary(df: DataFrame, col: str = "token_name", existing: DataFrame | None = None) -> DataFrame:
    """Dictionary ``(token name, token)``.

    Without an existing dictionary the names get 1..N in name order. With one, known ids never change
    and new names get the next ids. Id 0 stays free for padding.
    """
    if existing is None:
        return dense_index(df.select(col).where(F.col(col).isNotNull()).distinct(), col, "token", dtype="int")
    return existing.select(col, "token").unionByName(added_tokens(df, col, existing))


def apply_vocabulary(df: DataFrame, vocab: DataFrame, col: str = "token_name") -> DataFrame:
    """Attach the id to each token. Spark broadcasts the dictionary if its size allows, else joins by shuffle."""
    return df.join(vocab, on=col)
