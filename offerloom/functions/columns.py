"""Scalar expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def uniform(*keys: Column | str, seed: int | str) -> Column:
    """Repeatable number in (0, 1) from the text of the keys and a seed.

    The value depends on the row alone, so it is the same under any partitioning and after
    the loss of an executor.
    """
    text = F.concat_ws(":", *[_col(k).cast("string") for k in keys], F.lit(str(seed)))
    bits = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return (bits + F.lit(0.5)) / F.lit(4294967296.0)


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den as double, NULL when the denominator is zero."""
    return F.try_divide(_col(num).cast("double"), _col(den).cast("double"))


def half_even(c: Column | str, scale: int = 0) -> Column:
    """Banker's rounding (2.5 and 3.5 become 2 and 4)."""
    return F.bround(_col(c), scale)


def week_ending_sunday(c: Column | str) -> Column:
    """Label of the Monday-to-Sunday week: its Sunday."""
    return F.date_add(F.date_trunc("week", _col(c)).cast("date"), 6)


def yearmonth(c: Column | str) -> Column:
    """``2024-1`` style label, month without leading zero."""
    c = _col(c)
    return F.concat_ws("-", F.year(c), F.month(c))


def map_codes(c: Column | str, mapping: Mapping) -> Column:
    """Label of a code; NULL when the code is not in the mapping."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.element_at(F.create_map(*pairs), _col(c))


def decrypt(c: Column | str, key: Column, iv: Column) -> Column:
    """Text from base64 AES-CBC ciphertext. Key and vector come from the caller's secret store."""
    data = F.concat(iv.cast("binary"), F.unbase64(_col(c)))
    return F.aes_decrypt(data, key, F.lit("CBC"), F.lit("DEFAULT")).cast("string")
