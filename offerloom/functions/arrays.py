"""Array expressions. All of them stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from offerloom.fixed_values import SENTINEL_LOGIT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def with_value(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it in ``body``, also inside other lambdas.

    A column used inside ``transform`` is evaluated again for every element; binding it as a
    lambda argument keeps array work linear in the array length.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tail(c: Column | str, n: int) -> Column:
    """The last ``n`` elements; an array shorter than ``n`` comes back whole."""
    c = _col(c)
    return F.slice(c, F.greatest(F.size(c) - F.lit(n - 1), F.lit(1)), n)


def pad(c: Column | str, n: int, token: int = 0, side: str = "right") -> Column:
    """Fill up to ``n`` elements with ``token``; longer arrays are left alone."""
    if side not in ("left", "right"):
        raise ValueError("side must be 'left' or 'right'")
    c = _col(c)
    fill = F.array_repeat(F.lit(token), F.greatest(F.lit(n) - F.size(c), F.lit(0)))
    return F.concat(c, fill) if side == "right" else F.concat(fill, c)


def pad_mask(c: Column | str, token: int = 0) -> Column:
    """1 for a real token, 0 for padding."""
    return F.transform(_col(c), lambda x: F.when(x == token, 0).otherwise(1))


def with_top(scores: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a struct of the scores ``s`` and the largest of them, ``top``; the scores are evaluated once."""
    return with_value(scores, lambda s: with_value(F.struct(s.alias("s"), F.array_max(s).alias("top")), body))


def _exp_shares(scores: Column) -> Column:
    """exp(x - max) / sum, in two linear passes."""
    return with_top(
        scores,
        lambda v: with_value(
            F.transform(v["s"], lambda x: F.exp(x - v["top"])),
            lambda e: with_value(
                F.struct(e.alias("e"), F.aggregate(e, F.lit(0.0), lambda a, x: a + x).alias("total")),
                lambda w: F.transform(w["e"], lambda x: x / w["total"]),
            ),
        ),
    )


def _lift_sentinel(scores: Column) -> Column:
    return with_top(
        scores,
        lambda v: F.transform(v["s"], lambda x: F.when(x == SENTINEL_LOGIT, v["top"]).otherwise(x)),
    )


def softmax(c: Column | str) -> Column:
    """Softmax of logits; entries equal to the sentinel count as the largest logit."""
    return _exp_shares(_lift_sentinel(_col(c).cast("array<double>")))


def log_softmax(c: Column | str) -> Column:
    """Natural log of :func:`softmax`: x - max - ln(sum), which is finite also where the share itself is too small for a number."""
    return with_value(
        _lift_sentinel(_col(c).cast("array<double>")),
        lambda s: with_value(
            F.struct(s.alias("s"), F.array_max(s).alias("top")),
            lambda v: with_value(
                F.struct(v.alias("v"), F.ln(F.aggregate(v["s"], F.lit(0.0), lambda a, x: a + F.exp(x - v["top"]))).alias("ln")),
                lambda w: F.transform(w["v"]["s"], lambda x: x - w["v"]["top"] - w["ln"]),
            ),
        ),
    )


def softmax_without(c: Column | str, index: Column) -> Column:
    """Softmax after one position has been made impossible (position 0 included)."""
    knocked = F.transform(
        _col(c).cast("array<double>"),
        lambda x, i: F.when(i == index, F.lit(float(SENTINEL_LOGIT))).otherwise(x),
    )
    return _exp_shares(knocked)


def pick(c: Column | str, index: Column | str) -> Column:
    """Zero-based element, NULL outside the array."""
    return F.get(_col(c), _col(index))


def dot(a: Column, b: Column) -> Column:
    """Scalar product of two arrays of equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def number_matrix(rows: Iterable[Iterable[float]]) -> Column:
    """Constant array of arrays: model parameters of a fixed, small size."""
    return F.expr("array(" + ", ".join("array(" + ", ".join(f"{float(x)!r}D" for x in row) + ")" for row in rows) + ")")


def masked_scores(scores: Column, mask: Column) -> Column:
    """Scores where the mask allows the action, NULL where it does not."""
    return F.zip_with(scores, mask, lambda s, m: F.when(m == 1, s))


def legal_argmax(scores: Column, mask: Column) -> Column:
    """Position of the best legal score (the first one on ties), NULL when nothing is legal."""
    return with_top(
        masked_scores(scores, mask),
        lambda v: F.when(v["top"].isNotNull(), F.array_position(v["s"], v["top"]).cast("int") - 1),
    )


def action_mask(names: Column, eligible: Column) -> Column:
    """0/1 per action position: is its name among the eligible names?"""
    return with_value(
        eligible, lambda e: F.transform(names, lambda n: F.when(F.array_contains(e, n), 1).otherwise(0))
    )


def concat_obs(mask: Column, obs: Column) -> Column:
    """Observation the learner sees: mask first, then the state vector."""
    return F.concat(mask.cast("array<double>"), obs)


def normalize_state(c: Column | str, is_text: bool) -> Column:
    """State stored as JSON text or as an array becomes array<int>."""
    c = _col(c)
    return F.from_json(c, "array<int>") if is_text else c.cast("array<int>")
