"""How far a streaming load has come, from its checkpoint, against what its target holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch, is_committed) of each batch that was begun: every one has an offset file, a finished one a commit file as well."""
    number = F.regexp_extract(F.col("_metadata.file_name"), "^([0-9]+)$", 1)
    found = None
    for folder, committed in (("offsets", False), ("commits", True)):
        some = spark.read.format("text").load(f"{checkpoint.rstrip('/')}/{folder}").select(number.alias("batch")).distinct()
        some = some.filter("batch <> ''").select(F.col("batch").cast("bigint").alias("batch"), F.lit(committed).alias("is_committed"))
        found = some if found is None else found.unionByName(some)
    return found.groupBy("batch").agg(F.bool_or("is_committed").alias("is_committed"))


def files_read(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(path, batch) of each file that a batch took from the inbox. Compacted lists repeat earlier ones."""
    lines = spark.read.format("text").load(f"{checkpoint.rstrip('/')}/sources/0").filter("value LIKE '{%'")
    entry = F.from_json("value", "path string, batchId bigint")
    return lines.select(entry.alias("e")).groupBy(F.col("e.path").alias("path")).agg(F.min("e.batchId").alias("batch"))


def parity_progress(arrivals: DataFrame, target: DataFrame, checkpoint: str, key: str) -> DataFrame:
    """(check_name, source_value, target_value, is_ok, reason) of a load's stored position.

    `arrivals` reads the inbox as it is now (files, so that each row knows its path). Checks: batches begun
    against committed; rows of the inbox against rows read by committed batches; distinct keys read against
    keys of the target; the highest key read against the highest of the target. Reasons: `equal`, `behind`
    (the right side lacks something), `ahead` (it holds more than was read). One pass over each side.
    """
    spark = arrivals.sparkSession
    begun = batches(spark, checkpoint)
    done = files_read(spark, checkpoint).join(begun.filter("is_committed").select("batch"), "batch")
    rows = arrivals.select(F.col(key).alias("_key"), F.col("_metadata.file_path").alias("path"))
    # A path is spelled with one slash behind its scheme by the one side, with three by the other.
    plain = lambda c: F.regexp_replace(c, "^[a-z0-9]+:/+", "/")
    marked = rows.withColumn("path", plain(F.col("path"))).join(done.select(plain(F.col("path")).alias("path"), F.lit(True).alias("_read")), "path", "left")
    read = F.coalesce(F.col("_read"), F.lit(False))
    source = marked.agg(
        F.count(F.lit(1)).alias("all"), F.count_if(read).alias("read"), F.count_distinct(F.when(read, F.col("_key"))).alias("keys"),
        F.max(F.when(read, F.col("_key"))).alias("top"),
    )
    held = target.agg(F.count_distinct(key).alias("held"), F.max(key).alias("held_top"))
    steps = begun.agg(F.count(F.lit(1)).alias("begun"), F.count_if("is_committed").alias("committed"))
    sides = source.unionByName(held, allowMissingColumns=True).unionByName(steps, allowMissingColumns=True)
    one = sides.agg(*[F.max(c).alias(c) for c in sides.columns])

    def check(name: str, a: str, b: str, gap: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), F.col(a).cast("string").alias("source_value"), F.col(b).cast("string").alias("target_value"), gap.cast("double").alias("_gap"))

    counts = [("batches", "begun", "committed"), ("rows", "all", "read"), ("keys", "keys", "held")]
    checks = [check(n, a, b, F.col(b) - F.col(a)) for n, a, b in counts] + [check("highest_key", "top", "held_top", F.when(F.col("held_top") > F.col("top"), 1).otherwise(-1))]
    out = one.select(F.explode(F.array(*checks)).alias("c")).select("c.*")
    same = F.col("source_value").eqNullSafe(F.col("target_value"))
    reason = F.when(same, "equal").when(F.col("_gap") > 0, "ahead").otherwise("behind")
    return out.select("check_name", "source_value", "target_value", same.alias("is_ok"), reason.alias("reason"))
