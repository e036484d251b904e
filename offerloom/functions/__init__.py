"""Column expressions: arrays, probabilities, flags, dates, hashing."""

from offerloom.functions.arrays import (
    action_mask,
    concat_obs,
    dot,
    legal_argmax,
    log_softmax,
    masked_scores,
    normalize_state,
    number_matrix,
    pad,
    pad_mask,
    pick,
    softmax,
    softmax_without,
    tail,
    with_top,
    with_value,
)
from offerloom.functions.columns import decrypt, half_even, map_codes, ratio, uniform, week_ending_sunday, yearmonth

__all__ = [
    "action_mask", "concat_obs", "decrypt", "dot", "half_even", "legal_argmax", "log_softmax", "map_codes", "masked_scores",
    "normalize_state", "number_matrix", "pad", "pad_mask", "pick", "ratio", "softmax", "softmax_without", "tail", "uniform",
    "week_ending_sunday", "with_value", "yearmonth",
]
