"""Resampling towards a target distribution: hashed n-gram weights, Gumbel scores, ranks by a distributed radix sort."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import Window as W

from tablebridge.llm.staging import rows_of, stage

#: Buckets of features (which also is the pseudo-count of both sides), the seed of the draw, words a drawn document needs, per cent drawn.
BUCKETS, SEED, LEAST_WORDS, PER_CENT = 10_000, 7, 20, 25
#: Bits of a digit of the radix sort, rows of a block, blocks whose counts are added up together.
DIGIT, BLOCK, GROUP = 12, 1024, 1024
#: Words are runs of ASCII letters and digits and of everything beyond ASCII; A-Z become a-z.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
#: Words of a text that are hashed at once.
STRETCH = 1 << 16


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(LETTERS).split()


def buckets(words: list[bytes]) -> Iterator[np.ndarray]:
    """The bucket of every word and of every pair of neighbouring words, in stretches; repeats stay."""
    for i in range(0, len(words), STRETCH):
        some = words[i : i + STRETCH + 1]
        ones = list(map(crc32, some))
        twos = list(map(crc32, some[1:], map(crc32, repeat(b" "), ones)))
        yield np.array(ones[:STRETCH] + twos, np.int64) % BUCKETS


def feature_counts(texts: DataFrame) -> np.ndarray:
    """How many features each bucket holds. One row a bucket and task reaches the shuffle, one row a bucket the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for b in rows_of(batches):
            for text in b.column(1).to_pylist():
                for found in buckets(words_of(text)):
                    total += np.bincount(found, minlength=BUCKETS)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], ["bucket", "n"])

    counts = np.zeros(BUCKETS, np.int64)
    for row in texts.select(F.lit(0), "text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row.bucket] = row.n
    return counts


def gains(docs: DataFrame, target: DataFrame) -> np.ndarray:
    """A thousand times the log ratio of each bucket's share in the target and in the documents, smoothed by one a bucket, floored."""
    s, t = feature_counts(docs).astype(float), feature_counts(target).astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weighed(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_words, n_features, weight): the floored mean gain, looked up in an array of a fixed number of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            out = []
            for text in b.column(1).to_pylist():
                words = words_of(text)
                n = max(0, 2 * len(words) - 1)
                out.append((len(words), n, sum(int(gain[x].sum()) for x in buckets(words)) // n if n else 0))
            columns = [pa.array(c, pa.int64()) for c in np.array(out, np.int64).reshape(-1, 3).T]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["doc_id", "n_words", "n_features", "weight"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def draw_score(doc_id: Column, weight: Column) -> Column:
    """weight plus a Gumbel variate that depends on the seed and the id alone (a null id hashes as empty text)."""
    text = F.concat(F.lit(f"{SEED}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return weight + F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def digits(parts: Sequence[tuple[Column, int]]) -> list[Column]:
    """Digits of a composite key, last first: parts (unsigned 64-bit value, bits in use), most significant part first."""
    out = []
    for value, bits in reversed(parts):
        n = -(-bits // DIGIT)
        for k in range(n):
            low, high = bits * k // n, bits * (k + 1) // n
            out.append(F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << (high - low)) - 1)).cast("int"))
    return out


def starts(counts: DataFrame) -> DataFrame:
    """(digit, block, n) -> (digit, block, start): rows of smaller digits, and of this digit in earlier blocks.

    Sums are carried in three steps, so that no window is longer than GROUP blocks of a digit, the groups of blocks of a digit, or the digits there are.
    """
    earlier = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    grouped = counts.withColumn("many", F.expr(f"block div {GROUP}"))
    per_group = grouped.groupBy("digit", "many").agg(F.sum("n").alias("n"))
    per_digit = per_group.groupBy("digit").agg(F.sum("n").alias("n"))
    base = per_digit.select("digit", earlier(W.orderBy("digit")).alias("base"))
    middle = per_group.select("digit", "many", earlier(W.partitionBy("digit").orderBy("many")).alias("middle"))
    inner = grouped.select("digit", "many", "block", earlier(W.partitionBy("digit", "many").orderBy("block")).alias("inner"))
    return inner.join(middle, ["digit", "many"]).join(base, "digit").select("digit", "block", (F.col("base") + F.col("middle") + F.col("inner")).alias("start"))


def radix_order(rows: DataFrame, keys: Sequence[Column]) -> DataFrame:
    """rows with `place` (any dense or sparse numbering) -> rows with `place` 0, 1, 2... in the order of the digits `keys`, last digit first.

    One stable counting sort a digit: rows are counted by digit and block of BLOCK places, prefix sums over
    the counts give where each block's rows of a digit begin, and a row's destination is that start plus its
    rank among them. A group that a task has to order holds at most BLOCK rows, however many rows share a
    digit. Each pass is written to the shared folder, as both its count and its move read it.
    """
    names = [c for c in rows.columns if c != "place"]
    for key in keys:
        at = rows.withColumn("digit", key).withColumn("block", F.expr(f"place div {BLOCK}"))
        first = starts(at.groupBy("digit", "block").agg(F.count("*").alias("n")))
        moved = at.withColumn("_rank", F.row_number().over(W.partitionBy("digit", "block").orderBy("place")))
        moved = moved.join(first.hint("merge"), ["digit", "block"])
        rows = stage(moved.select(*names, (F.col("start") + F.col("_rank") - 1).alias("place")), "radix")
    return rows


def resampled(docs: DataFrame, target: DataFrame) -> DataFrame:
    """documents (doc_id, text), target (text) -> (doc_id, n_features, weight, score, rank), one row per row of documents.

    PER_CENT of the documents with at least LEAST_WORDS words are drawn without replacement: the highest
    scores (Gumbel top-k), ties to the smaller doc_id, null ids last, repeated rows in any order; rank is
    null for the others. A null or empty text has no features and weight 0. Without target texts all
    documents are compared with an even distribution. Other columns are not read; an empty table gives an empty one.
    """
    gain = gains(docs, target)
    scored = weighed(docs, gain).withColumn("score", draw_score(F.col("doc_id"), F.col("weight")))
    scored = stage(scored.withColumn("place", F.monotonically_increasing_id()), "scored")
    able = scored.where(F.col("n_words") >= LEAST_WORDS).select("place", "doc_id", "score")
    span = able.agg(F.count("*"), F.min("score"), F.max("score"), F.min("doc_id"), F.max("doc_id"), F.count("doc_id")).first()
    n, low_score, high_score, low_id, high_id, named = span
    drawn = PER_CENT * n // 100
    if not drawn:
        return scored.select("doc_id", "n_features", "weight", "score", F.lit(None).cast("long").alias("rank"))
    parts = [(F.lit(high_score) - F.col("score"), (high_score - low_score).bit_length())]
    if named < n:
        parts.append((F.col("doc_id").isNull().cast("long"), 1))
    if named:
        # An offset from the least id; where that would not fit, the id with its sign turned, which as unsigned has the same order.
        far = high_id - low_id >= 1 << 63
        value = F.col("doc_id").bitwiseXOR(F.lit(-(1 << 63))) if far else F.col("doc_id") - F.lit(low_id)
        parts.append((F.coalesce(value, F.lit(0)), 64 if far else (high_id - low_id).bit_length()))
    ordered = radix_order(able.withColumn("row", F.col("place")), digits(parts))
    if not digits(parts):  # one score and one id only
        ordered = radix_order(able.withColumn("row", F.col("place")), [F.lit(0)])
    ranks = ordered.where(F.col("place") < drawn).select(F.col("row").alias("place"), (F.col("place") + 1).alias("rank"))
    return scored.join(ranks, "place", "left").select("doc_id", "n_features", "weight", "score", "rank")


#: The words of a text, as a pattern; the tests count by it.
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
