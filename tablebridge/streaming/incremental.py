"""Incremental loads with Structured Streaming, and catch-up of late rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tablebridge.operators.dedup import distinct_on
from tablebridge.operators.merge import ACTION, MergeSpec, merge_insert_only
from tablebridge.operators.sets import multiset_missing
from tablebridge.session import cut_lineage


def read_arrivals(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet", glob: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream; the checkpoint remembers which were read."""
    reader = spark.readStream.format(file_format).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


class BatchFolders:
    """Numbered folders below one path, each written by one batch; only complete ones are read.

    A batch that is run again after a failure replaces its own folder and never sees it or later
    ones, so replays change nothing.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._new_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        root = self._new_path(self.path)
        self._fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def folder(self, number: int) -> str:
        return f"{self.path}/batch={number}"

    def complete(self, before: int | None = None) -> list[int]:
        root = self._new_path(self.path)
        if not self._fs.exists(root):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(root)]
        numbers = sorted(int(n[6:]) for n in names if n.startswith("batch="))
        known = [n for n in numbers if self._fs.exists(self._new_path(self.folder(n) + "/_SUCCESS"))]
        return [n for n in known if before is None or n < before]

    def _read(self, numbers: Sequence[int]) -> DataFrame:
        if not numbers:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[self.folder(n) for n in numbers])

    def read_all(self, before: int | None = None) -> DataFrame:
        """The rows of all batches: a table that only grows."""
        return self._read(self.complete(before))

    def write(self, df: DataFrame, number: int) -> None:
        df.select(*self.schema.fieldNames()).write.mode("overwrite").parquet(self.folder(number))


class VersionedBuckets(BatchFolders):
    """A table in buckets of its keys; a batch writes new versions of the buckets it touches.

    The present table is the newest version of each bucket, so a small batch reads and rewrites
    only its part of a large table.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], buckets: int = 64) -> None:
        super().__init__(spark, path, schema)
        self.keys, self.buckets = list(keys), buckets

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def current(self, before: int | None = None, only: Sequence[int] | None = None) -> DataFrame:
        """The newest version of all or some buckets."""
        newest: dict[int, str] = {}
        for number in self.complete(before):
            for status in self._fs.listStatus(self._new_path(self.folder(number))):
                name = status.getPath().getName()
                if name.startswith("bucket="):
                    newest[int(name[7:])] = f"{self.folder(number)}/{name}"
        paths = [p for b, p in sorted(newest.items()) if only is None or b in only]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that rows fall into: at most `buckets` numbers."""
        return [r[0] for r in rows.select(self.bucket_of()).distinct().collect()]

    def write(self, df: DataFrame, number: int) -> None:
        rows = df.select(*self.schema.fieldNames(), self.bucket_of().alias("bucket"))
        rows.repartition("bucket", *self.keys).write.mode("overwrite").partitionBy("bucket").parquet(self.folder(number))


def _run_once(arrivals: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    query = (
        arrivals.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def incremental_append(
    arrivals: DataFrame, table: BatchFolders, keys: Sequence[str], order: Sequence[Column], checkpoint: str
) -> StreamingQuery:
    """Load all files that arrived since the last run, insert-only, then stop.

    A batch writes only its new rows: the first of each key that no earlier batch holds. Of the
    table it reads the key columns. The position advances only after the write.
    """

    def load(batch: DataFrame, number: int) -> None:
        first = distinct_on(batch, keys, order)
        held = table.read_all(before=number).select(*keys)
        table.write(first.join(held, list(keys), "left_anti"), number)

    return _run_once(arrivals, load, checkpoint)


def incremental_load(
    arrivals: DataFrame, table: VersionedBuckets, merge: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str,
    order: Sequence[Column],
) -> StreamingQuery:
    """Merge all files that arrived since the last run into the table, then stop.

    For write modes that change existing rows by key; `merge` sees the touched buckets only, so it
    must not number new rows by the highest id of the table. Of several versions of a key in a
    batch the last one in `order` counts.
    """

    def load(batch: DataFrame, number: int) -> None:
        rows = cut_lineage(distinct_on(batch, table.keys, order, last=True))
        held = table.current(before=number, only=table.touched(rows))
        table.write(merge(held, rows), number)

    return _run_once(arrivals, load, checkpoint)


def catch_up_late(
    source: DataFrame,
    snapshot: DataFrame,
    target: DataFrame,
    spec: MergeSpec,
    key: str,
    max_ids: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(target with the rows it missed, plan of what was missing and what was done).

    Keys of the snapshot that the target lacks are loaded insert-only; ids that the source no longer
    has are `not_found`. With `max_ids` a run takes the lowest keys and the plan marks the rest as
    postponed; the next run continues there.
    """
    held = target.select(F.col(key).cast("string").alias("key"), F.lit(None).cast("string").alias("send"))
    plan = multiset_missing(snapshot, held, "key", "send", F.col("send").isNotNull(), multiset=False)
    asked = due = plan.filter("action = 'send'")
    if max_ids is not None:
        due = due.orderBy(F.col("send").try_cast("bigint"), "send").limit(max_ids)
    late = source.join(
        due.select(F.col("send").cast(source.schema[key].dataType).alias(key)), key, "left_semi"
    )
    loaded = merge_insert_only(target, late, spec)
    now = loaded.filter(F.col(ACTION) == "inserted").select(F.col(key).cast("string").alias("key")).distinct()
    there = source.select(F.col(key).cast("string").alias("send")).join(asked.select("send"), "send", "left_semi").distinct()
    report = plan.join(now.withColumn("_loaded", F.lit(True)), "key", "left").join(there.withColumn("_there", F.lit(True)), "send", "left")
    outcome = F.when(F.col("_loaded"), "loaded").when(F.col("action") != "send", F.col("action")).when(F.col("_there"), "postponed")
    report = report.select("key", "send", "missing_rows", outcome.otherwise("not_found").alias("action"))
    return loaded, report


def snapshot_closure(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child keys of a snapshot whose parent is not in the parent snapshot."""
    return child.select(*keys).distinct().join(parent.select(*keys), list(keys), "left_anti")


def stream_append_log(
    stream: DataFrame, ts: str, fingerprint: Column, delay: str, path: str, checkpoint: str
) -> StreamingQuery:
    """Append a log stream; rows replayed within `delay` of event time are dropped.

    The watermark bounds the state to the fingerprints of that period.
    """
    unique = (
        stream.withColumn("fingerprint", fingerprint)
        .withWatermark(ts, delay)
        .dropDuplicatesWithinWatermark(["fingerprint"])
    )
    query = (
        unique.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
