"""Span (character interval) column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def interval_iou(a_first: Column, a_last: Column, b_first: Column,
                 b_last: Column) -> Column:
    """Intersection over union of half-open ranges ``[a,b)`` as DOUBLE.

    0.0 when the ranges do not overlap.
    """
    inter = F.least(a_last, b_last) - F.greatest(a_first, b_first)
    union = F.greatest(a_last, b_last) - F.least(a_first, b_first)
    return (F.when(inter <= 0, F.lit(0.0))
            .when(union > 0, inter.cast("double") / union.cast("double"))
            .otherwise(F.lit(0.0)))


def slice_text(text: Column, first: Column, last: Column) -> Column:
    """``text[first:last]`` in code points; '' for an invalid range or
    a missing text (the row is kept)."""
    valid = (text.isNotNull() & (first >= 0) & (last >= first)
             & (last <= F.length(text)))
    return F.when(valid, text.substr(first + 1, last - first)).otherwise(F.lit(""))
