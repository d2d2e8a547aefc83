"""Keeping one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.functions.clean import norm_key


def distinct_on(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], columns: Sequence[str] | None = None, last: bool = False
) -> DataFrame:
    """The first (or last) row of each key under a total order, with all or some of its columns.

    Aggregates before the shuffle, so a hot key costs one row per task.
    """
    first = (F.max_by if last else F.min_by)(F.struct(*(columns or df.columns)), F.struct(*order))
    return df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(first.alias("_row")).select("_row.*")


def first_by_key(df: DataFrame, key: Column, order: Sequence[Column]) -> DataFrame:
    """The first row per normalised key; rows with a blank key are dropped."""
    keyed = df.withColumn("_key", norm_key(key)).filter(F.col("_key").isNotNull())
    return distinct_on(keyed, ["_key"], order).drop("_key")


def keyed_else_unkeyed(df: DataFrame, id_col: str, fk: str, order: Sequence[Column]) -> DataFrame:
    """One row per id; a row with the optional reference beats rows without it."""
    ranked = [F.col(fk).isNull(), *order]
    return distinct_on(df, [id_col], ranked).withColumn("is_unkeyed", F.col(fk).isNull())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def drop_archived_copies(main: DataFrame, archive: DataFrame, id_col: str, offset: int) -> DataFrame:
    """Main rows plus the archive rows whose shifted id main does not hold."""
    known = main.select((F.col(id_col)).alias("_known"))
    only_old = archive.join(known, F.col(id_col) + F.lit(offset) == F.col("_known"), "left_anti")
    return only_old.withColumn("source_rank", F.lit(0)).unionByName(
        main.withColumn("source_rank", F.lit(1))
    )


def unanimous_or_null(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Per key, the value if all non-null values agree, else null and ambiguous."""
    low, high = F.min(value), F.max(value)
    return df.groupBy(*keys).agg(
        F.when(low == high, low).alias(value),
        F.coalesce(low != high, F.lit(False)).alias("is_ambiguous"),
    )
