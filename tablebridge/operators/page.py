"""Cursors, pages and gaps in ordered tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.operators.skew import with_position


def null_first(order: Sequence[str]) -> list[Column]:
    return [F.col(c).asc_nulls_first() for c in order]


def after_cursor(order: Sequence[str], cursor: Mapping[str, object]) -> Column:
    """Rows behind a cursor in ascending order, nulls first. Comparisons stay on raw columns."""
    beyond, equal = F.lit(False), F.lit(True)
    for c in order:
        value = cursor[c]
        greater = F.col(c).isNotNull() if value is None else F.coalesce(F.col(c) > F.lit(value), F.lit(False))
        same = F.col(c).isNull() if value is None else F.coalesce(F.col(c) == F.lit(value), F.lit(False))
        beyond = beyond | (equal & greater)
        equal = equal & same
    return beyond


def keyset_page(df: DataFrame, order: Sequence[str], cursor: Mapping[str, object] | None, k: int) -> DataFrame:
    """The next `k` rows behind a cursor (none: from the start). A top-k, not a full sort."""
    rows = df if cursor is None else df.filter(after_cursor(order, cursor))
    return rows.orderBy(*null_first(order)).limit(k)


def count_after_cursor(
    df: DataFrame, order: Sequence[str], cursor: Mapping[str, object], offset: int | None = None
) -> DataFrame:
    """Rows, rows behind the cursor, and the position: rows up to it, or the stored offset if that is less."""
    after = F.count_if(after_cursor(order, cursor)).cast("bigint")
    total = F.count(F.lit(1))
    position = total - after if offset is None else F.least(total - after, F.lit(offset).cast("bigint"))
    return df.agg(total.alias("total"), after.alias("after"), position.alias("position"))


def next_cursor(page: DataFrame, order: Sequence[str]) -> DataFrame:
    """The cursor of the last row of a page; struct order puts nulls first."""
    return page.agg(F.max(F.struct(*order)).alias("c")).select("c.*")


def boundary_tie_audit(
    df: DataFrame, cursor_cols: Sequence[str], full_order: Sequence[str], k: int
) -> DataFrame:
    """Rows a cursor over `cursor_cols` would skip: tied with the last row of a page but behind it.

    Positions come from range partitions, and each tie group is reduced to its first page boundary,
    so ties are not paired with each other.
    """
    placed = with_position(df, null_first(full_order), "position")
    first_edge = (
        placed.filter(F.col("position") % k == 0)
        .groupBy(*cursor_cols)
        .agg(F.min("position").alias("_edge"))
        .select(*[F.col(c).alias(f"_e_{c}") for c in cursor_cols], "_edge")
    )
    tied = F.lit(True)
    for c in cursor_cols:
        tied = tied & F.col(c).eqNullSafe(F.col(f"_e_{c}"))
    behind = tied & (F.col("position") > F.col("_edge"))
    return placed.join(first_edge, behind, "left_semi")


def row_index_range(df: DataFrame, order: Sequence[Column], first: int, last: int) -> DataFrame:
    """Rows ranked `first` to `last` (1-based, inclusive) under a total order."""
    return with_position(df, order, "row_index").filter(F.col("row_index").between(first, last))


def split_point(df: DataFrame, key: str, is_read: Column) -> DataFrame:
    """Where reading stopped: highest read key, lowest unread key, whether these are in order, and
    the highest key before the first unread one."""
    low = df.agg(F.min(F.when(~is_read, F.col(key)))).scalar()
    before = F.max(F.when(low.isNull() | (F.col(key) < low), F.col(key)))
    max_read = F.max(F.when(is_read, F.col(key)))
    min_unread = F.min(F.when(~is_read, F.col(key)))
    return df.agg(
        max_read.alias("max_read"),
        min_unread.alias("min_unread"),
        F.coalesce(max_read < min_unread, F.lit(True)).alias("is_ordered"),
        before.alias("split_key"),
    )


def gap_ids(ordered: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Source keys before the last present one that the target lacks."""
    last = present.join(ordered.select(key), key, "left_semi").agg(F.max(key)).scalar()
    return ordered.select(key).filter(F.col(key) < last).join(present.select(key), key, "left_anti")


def ordered_limit(df: DataFrame, order: Sequence[Column], n: int | None) -> DataFrame:
    rows = df.orderBy(*order)
    return rows if n is None else rows.limit(n)


def cap_to_snapshot(df: DataFrame, snapshot: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Only the rows that were counted when the snapshot was taken."""
    return df.join(snapshot.select(*keys), list(keys), "left_semi")

