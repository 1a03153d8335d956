"""Logistic loss of raw scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bce_from_logits(logit: Column, label: Column) -> Column:
    """Binary cross-entropy of a raw score, in the form that cannot overflow."""
    return F.greatest(logit, F.lit(0.0)) - logit * label + F.log1p(F.exp(-F.abs(logit)))
