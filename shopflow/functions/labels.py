"""Targets, class decoding, thresholds, argmax, confidence bands and probability rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import (ACTION_NAMES, BINARY_OUTCOME_LABELS, CONFIDENCE_LABELS, NUM_CLASSES,
                      PURCHASE_ACTION, UNKNOWN_ACTION)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def binary_target(action_type="action_type") -> Column:
    return (_col(action_type) == PURCHASE_ACTION).cast("int")


def multiclass_label(action_type="action_type") -> Column:
    return (_col(action_type) - 1).cast("int")


def _names_map() -> Column:
    pairs = []
    for k, v in ACTION_NAMES.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)


def action_name(code, one_based: bool = False) -> Column:
    """Action name for a class code; unknown codes fall back to ``未知行为(code)``."""
    c = _col(code)
    zero = c - 1 if one_based else c
    fallback = F.concat(F.lit(UNKNOWN_ACTION + "("), c.cast("string"), F.lit(")"))
    return F.coalesce(_names_map()[zero], fallback)


def threshold_predict(probability, threshold: float = 0.5) -> Column:
    """Positive iff probability is strictly greater than the threshold."""
    return (_col(probability) > F.lit(threshold)).cast("int")


def argmax(probs) -> Column:
    """Zero-based index of the largest probability; ties go to the lowest class."""
    p = _col(probs)
    return (F.array_position(p, F.array_max(p)) - 1).cast("int")


def binary_outcome(probability, threshold: float = 0.5) -> tuple[Column, Column]:
    """(outcome text, probability of that outcome)."""
    p = _col(probability)
    pos = p > F.lit(threshold)
    return (F.when(pos, F.lit(BINARY_OUTCOME_LABELS[0])).otherwise(F.lit(BINARY_OUTCOME_LABELS[1])),
            F.when(pos, p).otherwise(1 - p))


def confidence_binary(probability) -> Column:
    """>0.9 or <0.1 very high; >0.7 or <0.3 high; otherwise medium; exactly 0.5 gives NULL."""
    p = _col(probability)
    return (F.when((p > 0.9) | (p < 0.1), F.lit(CONFIDENCE_LABELS[0]))
            .when((p > 0.7) | (p < 0.3), F.lit(CONFIDENCE_LABELS[1]))
            .when((p > 0.5) | (p < 0.5), F.lit(CONFIDENCE_LABELS[2])))


def confidence_multiclass(probs) -> Column:
    """Band on the largest class probability: >0.8, >0.6, >0.4, else low."""
    m = F.array_max(_col(probs))
    return (F.when(m > 0.8, F.lit(CONFIDENCE_LABELS[0]))
            .when(m > 0.6, F.lit(CONFIDENCE_LABELS[1]))
            .when(m > 0.4, F.lit(CONFIDENCE_LABELS[2]))
            .otherwise(F.lit(CONFIDENCE_LABELS[3])))


def pad_probabilities(probs, n: int = NUM_CLASSES) -> Column:
    """Append zeros to a short probability row until it has ``n`` entries."""
    p = _col(probs)
    missing = F.greatest(F.lit(n) - F.size(p), F.lit(0))
    return F.concat(p, F.array_repeat(F.lit(0.0), missing))


def two_valued(probs) -> Column:
    """True when the row holds at most two distinct values (a binary model's padded output)."""
    return F.size(F.array_distinct(_col(probs))) <= 2


def prob_array(*cols) -> Column:
    return F.array(*[_col(c).cast("double") for c in cols])
