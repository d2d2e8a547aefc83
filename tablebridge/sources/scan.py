"""Reading tables and choosing rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.clean import null_if_blank, strip, to_int_strict


@dataclass(frozen=True)
class SourceSpec:
    """Where a table lives: a format, a path or table name, and reader options.

    For `jdbc`, options carry url, partitionColumn, lowerBound, upperBound and numPartitions, so
    the read is split by key range; credentials come from the caller's options, never from code.
    """

    format: str
    location: str
    options: Mapping[str, str] = field(default_factory=dict)
    schema: T.StructType | None = None
    columns: Mapping[str, str] | None = None


def read_source(spark: SparkSession, source: SourceSpec) -> DataFrame:
    reader = spark.read.format(source.format).options(**source.options)
    if source.schema is not None and source.format != "jdbc":
        reader = reader.schema(source.schema)
    if source.format == "jdbc":
        return reader.option("dbtable", source.location).load()
    return reader.load(source.location)


def as_text(c: Column, data_type: T.DataType) -> Column:
    """Text form of a column: trimmed, dates and times in ISO form with a T."""
    if isinstance(data_type, (T.TimestampNTZType, T.TimestampType)):
        return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS")
    if isinstance(data_type, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(data_type, T.BooleanType):
        return F.when(c, "1").when(~c, "0")
    return strip(c)


def scan_text(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """Read a table with every column as trimmed text. `columns` maps new names to source names."""
    df = read_source(spark, source)
    wanted = source.columns or {c: c for c in df.columns}
    types = {f.name.lower(): f.dataType for f in df.schema.fields}
    return df.select(*[as_text(F.col(c), types[c.lower()]).alias(name) for name, c in wanted.items()])


def filtered_scan(
    df: DataFrame, predicate: Column, ts: str, low: object = None, high: object = None
) -> DataFrame:
    """Constant predicate and half-open time range; a missing bound does not filter."""
    rows = df.filter(predicate)
    if low is not None:
        rows = rows.filter(F.col(ts) >= F.lit(low))
    if high is not None:
        rows = rows.filter(F.col(ts) < F.lit(high))
    return rows


def key_range(df: DataFrame, key: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """Inclusive range over a key; text keys are compared as numbers, others are dropped by a bound.

    A numeric key column is compared as it is, so the filter reaches the scan.
    """
    value = F.col(key) if isinstance(df.schema[key].dataType, T.NumericType) else to_int_strict(F.col(key))
    if low is not None:
        df = df.filter(value >= low)
    if high is not None:
        df = df.filter(value <= high)
    return df


def explicit_ids(df: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in a list of any length. The list is a table; its size decides the join."""
    return df.join(ids.select(*keys), list(keys), "left_semi")


def source_count(df: DataFrame, key: str | None = None) -> DataFrame:
    total = F.count(F.lit(1)).alias("total")
    if key is None:
        return df.agg(total)
    present = null_if_blank(F.col(key).cast("string")).isNotNull()
    return df.agg(
        total,
        F.count_if(present).cast("bigint").alias("with_key"),
        F.count_if(~present).cast("bigint").alias("without_key"),
    )


def source_fingerprint(
    source: DataFrame, target: DataFrame, order_key: str, stored: tuple[int, object], forward_only: bool = False,
    placeholder: Column | None = None,
) -> DataFrame:
    """(rows, highest key) of the source against the stored pair and the target's rows: load
    forward, or catch up first, with the reason.

    More rows than were stored may hold back-dated ones, and a target with fewer rows than the
    source has now lacks some, so both ask for a catch-up; `forward_only` keeps to rows behind the
    stored key as long as none were lost. Target rows that `placeholder` marks are not counted.
    """
    now = source.agg(F.count(F.lit(1)).alias("source_rows"), F.max(order_key).alias("source_max"))
    real = target if placeholder is None else target.filter(~F.coalesce(placeholder, F.lit(False)))
    held = real.agg(F.count(F.lit(1)).alias("target_rows"))
    rows, top = stored
    # Two one-row aggregates: union and fold, no join.
    both = now.unionByName(held, allowMissingColumns=True).agg(
        F.max("source_rows").alias("source_rows"),
        F.max("source_max").alias("source_max"),
        F.max("target_rows").alias("target_rows"),
    )
    n, m, t = F.col("source_rows"), F.col("source_max"), F.col("target_rows")
    reason = (
        F.when(t < rows, "target_lost_rows")
        .when(n < rows, "source_shrank")
        .when((n > rows) & m.eqNullSafe(F.lit(top)), "rows_behind_cursor")
        .when(n > rows, "rows_added")
        .when(t < n, "target_behind_source")
        .otherwise("nothing_new")
    )
    forward = ["nothing_new", *(["rows_added", "target_behind_source"] if forward_only else [])]
    mode = F.when(reason.isin(*forward), "forward").otherwise("catch_up")
    return both.select("*", mode.alias("mode"), reason.alias("reason"))
