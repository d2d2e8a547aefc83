"""Null-safe change flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def changed(old: Sequence[Column], new: Sequence[Column]) -> Column:
    """True where any pair differs; null equals null."""
    flag = F.lit(False)
    for a, b in zip(old, new, strict=True):
        flag = flag | ~a.eqNullSafe(b)
    return flag
