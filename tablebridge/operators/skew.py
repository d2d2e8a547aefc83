"""Ranks and lookups that keep working when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablebridge.session import cut_lineage

#: Rows of one key that a window may rank in one task.
HOT_ROWS = 100_000
#: Rows that a task sorts or gathers by key, on average.
ROWS_PER_TASK = 500_000


def spread(df: DataFrame, keys: Sequence[str], rows: int) -> DataFrame:
    """`df`, of which there are `rows` rows, spread by its keys over tasks of about ROWS_PER_TASK rows.

    Otherwise the number of tasks is that of the session, and fewer where adaptive execution joins
    partitions: it goes by compressed bytes, and 64 MB of narrow columns are millions of rows. The number is never
    just the session's, as Spark would then take another shuffle by these keys for this one.
    """
    tasks = -(-rows // ROWS_PER_TASK)
    if tasks <= 1:
        return df
    return df.repartition(max(tasks, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) + 1), *keys)


def with_position(
    df: DataFrame, order: Sequence[Column], name: str = "position", range_name: str | None = None
) -> DataFrame:
    """1-based position under a total order, without a window over the whole table.

    Rows are spread by ranges of the full order, numbered inside their range, and shifted by the
    sizes of the ranges before. Writing them pins the ranges, so both reads see the same ones;
    the table of range sizes has one row per shuffle partition, which bounds the broadcast.
    `range_name` keeps the number of the range.
    """
    spark = df.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spread = cut_lineage(
        df.repartitionByRange(ranges, *order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        .withColumn("_range", F.shiftright("_slot", 33))
        .withColumn("_slot", F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1)))
    )
    sizes = spread.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    placed = spread.join(F.broadcast(offsets), "_range").withColumn(name, F.col("_slot") + F.col("_before") + 1)
    return placed.select(*df.columns, name, *([F.col("_range").alias(range_name)] if range_name else []))


def rank_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str = "rank", even: bool = True
) -> DataFrame:
    """1-based rank inside each key under `order`.

    Keys are counted first. Those of at most HOT_ROWS rows are ranked by a window, which costs one
    shuffle; rows of larger keys, if there are any, are placed by ranges, so a key of any size
    spreads over tasks. With `even` the tasks grow in number with the rows; it costs a shuffle where
    rows are already shuffled by a part of the keys.
    """
    total = Observation()
    ranked = lambda rows: rows.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("bigint"))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).observe(total, F.sum("_n").alias("rows"))
    counted = sizes.filter(F.col("_n") > HOT_ROWS)
    hot = cut_lineage(counted.select(*[F.col(k).alias(f"_s_{k}") for k in keys]))
    placed = lambda rows: spread(rows, keys, (total.get["rows"] or 0) if even else 0)
    if hot.isEmpty():
        return ranked(placed(df))
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys]
    large = _rank_by_ranges(df.join(hot, same, "left_semi"), keys, order, name)
    return ranked(placed(df.join(hot, same, "left_anti"))).unionByName(large)


def _rank_by_ranges(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """The same ranks, with no task that meets all rows of a key.

    Rows are placed by ranges of (keys, order). A key's first position is found from one row per key
    and range, and joined back by key and range.
    """
    placed = with_position(df, [*[F.col(k) for k in keys], *order], "_position", "_range")
    per_range = placed.groupBy(*keys, "_range").agg(F.min("_position").alias("_first"))
    first = F.min("_first").over(W.partitionBy(*keys))
    starts = per_range.select(
        *[F.col(k).alias(f"_s_{k}") for k in keys], F.col("_range").alias("_s_range"), first.alias("_first")
    )
    same = [F.col(k).eqNullSafe(F.col(f"_s_{k}")) for k in keys] + [F.col("_range") == F.col("_s_range")]
    ranked = placed.join(starts, same).withColumn(name, F.col("_position") - F.col("_first") + 1)
    return ranked.select(*df.columns, name)


def left_lookup(df: DataFrame, lookup: DataFrame, keys: Sequence[str], sparse: bool = False) -> DataFrame:
    """Left join to a table that is unique on `keys`.

    Hot keys are split by the adaptive skew join. Whether a side is broadcast is left to the
    optimizer, which knows its size. With `sparse`, for key columns that are null in many rows,
    those rows are not hashed to one task, as they match nothing: they are spread by the partition
    they come from, at the price of shuffling the lookup once more.
    """
    added = [c for c in lookup.columns if c not in keys]
    if not sparse:
        return df.join(lookup, list(keys), "left").select(*df.columns, *added)
    has_key = F.lit(True)
    for key in keys:
        has_key = has_key & F.col(key).isNotNull()
    left = df.withColumn("_spread", F.when(has_key, F.lit(0)).otherwise(F.spark_partition_id()))
    # Always 0, but not a constant: a constant would be folded out of the join keys.
    right = lookup.withColumn("_spread", F.pmod(F.hash(*keys), F.lit(1)))
    return left.join(right, [*keys, "_spread"], "left").select(*df.columns, *added)
