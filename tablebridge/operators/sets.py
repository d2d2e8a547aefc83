"""Set operations on rows and keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.operators.skew import left_lookup


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of tables with different column types: every column becomes text."""
    texts = [t.select(*[F.col(c).cast("string").alias(c) for c in t.columns]) for t in tables]
    out = texts[0]
    for t in texts[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def union_distinct(*keys: DataFrame) -> DataFrame:
    out = keys[0]
    for k in keys[1:]:
        out = out.unionByName(k)
    return out.distinct()


def set_diff(old: DataFrame, new: DataFrame, id_col: str, payload: Sequence[str]) -> DataFrame:
    """Status per id: added, removed, changed or unchanged."""
    before = old.select(id_col, F.struct(*payload).alias("_old"))
    after = new.select(id_col, F.struct(*payload).alias("_new"))
    status = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old").eqNullSafe(F.col("_new")), "unchanged")
        .otherwise("changed")
    )
    return before.join(after, id_col, "full_outer").select(id_col, status.alias("status"))


def multiset_missing(
    source: DataFrame, target: DataFrame, key: str, send: str, sendable: Column, multiset: bool = True
) -> DataFrame:
    """Per source key that the target holds too few times: rows missing and what to do.

    `send` is the id to ask the source for. If the target already holds other rows of that id the
    key is partial and is reported, not loaded, because loads replace whole ids.
    """
    need = F.count(F.lit(1)) if multiset else F.lit(1).cast("bigint")
    wanted = source.groupBy(key).agg(F.min(send).alias(send), need.alias("_need"))
    held = target.groupBy(key).agg(F.count(F.lit(1)).alias("_have"))
    short = wanted.join(held, key, "left").withColumn(
        "missing_rows", F.col("_need") - F.coalesce("_have", F.lit(0))
    ).filter("missing_rows > 0")
    started = target.select(send).filter(F.col(send).isNotNull()).distinct().withColumn("_started", F.lit(True))
    action = (
        F.when(F.col("_started"), "partial").when(sendable, "send").otherwise("unsendable")
    )
    # An id to send may be that of many keys: shuffled apart from the aggregate, it can be split.
    return left_lookup(short, started, [send], sparse=True).select(key, send, "missing_rows", action.alias("action"))
