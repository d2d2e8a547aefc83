"""Surrogate ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.operators.skew import with_position


def assign_ids(
    df: DataFrame, order: Sequence[Column], existing: DataFrame | None = None, id_col: str = "id"
) -> DataFrame:
    """Number rows behind the highest existing id, in a total order; an empty table starts at 1."""
    top = F.lit(0)
    if existing is not None:
        top = existing.agg(F.coalesce(F.max(id_col), F.lit(0)).cast("bigint")).scalar()
    return (
        with_position(df, order, "_position")
        .withColumn(id_col, F.col("_position") + top)
        .drop("_position")
    )
