"""Writing tables, snapshots and reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.functions.clean import norm_key


def write_snapshot(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """One write of a table version to a new folder; readers switch to it afterwards."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Rewrite only the partitions that occur in `df`, so a small change to a large target does
    not rewrite all of it."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def export_table(df: DataFrame, path: str, limit: int | None = None) -> None:
    """Dump a table to JSON files with a one-row manifest of its row count beside them."""
    rows = df if limit is None else df.limit(limit)
    rows.write.mode("overwrite").json(f"{path}/rows")
    spark = df.sparkSession
    written = spark.read.schema(rows.schema).json(f"{path}/rows")
    written.agg(F.count(F.lit(1)).alias("row_count")).withColumn(
        "limited_to", F.lit(limit).cast("bigint")
    ).coalesce(1).write.mode("overwrite").json(f"{path}/manifest")


def _readable(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def copy_tables(
    spark: SparkSession, source: str, target: str, names: Sequence[str]
) -> DataFrame:
    """Copy the listed tables and report rows on both sides; absent tables are skipped with a note."""
    report = None
    for name in names:
        origin, copy = f"{source}/{name}.parquet", f"{target}/{name}.parquet"
        if _readable(spark, origin):
            spark.read.parquet(origin).write.mode("overwrite").parquet(copy)
            counts = spark.read.parquet(origin).agg(F.count(F.lit(1)).alias("source_rows"))
            copied = spark.read.parquet(copy).agg(F.count(F.lit(1)).alias("target_rows"))
            part = counts.unionByName(copied, allowMissingColumns=True).agg(
                F.max("source_rows").alias("source_rows"), F.max("target_rows").alias("target_rows")
            ).withColumn("note", F.lit("copied"))
        else:
            part = spark.range(1).select(
                F.lit(None).cast("bigint").alias("source_rows"),
                F.lit(None).cast("bigint").alias("target_rows"),
                F.lit("skipped: no such table").alias("note"),
            )
        part = part.select(
            F.lit(name).alias("table_name"), "source_rows", "target_rows",
            (F.col("source_rows") != F.col("target_rows")).alias("mismatch"), "note",
        )
        report = part if report is None else report.unionByName(part)
    return report


def key_snapshot(df: DataFrame, key: Column, send: Column, path: str) -> DataFrame:
    """Save (compare key, id to request) of a source as it is now, and read it back."""
    df.select(norm_key(key).alias("key"), send.cast("string").alias("send")).filter(
        "key is not null"
    ).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def json_report_sink(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)
