"""Quality of documents: boosted trees over statistics of the whole text."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tablebridge.llm.boosting import Trees, train
from tablebridge.llm.staging import rows_of

#: Labelled rows the trees are fitted on at most: those with the smallest hashes of their ids.
TRAIN_ROWS = 20_000
NAMES = (
    "log_chars", "log_words", "word_length", "upper", "digit", "symbol", "wide", "upper_words", "ends_odd", "same_as_before",
    "top_word", "distinct", "short_words", "no_letters", "log_lines", "same_lines", "line_words", "compressed", "sentence_ends", "long_words",
)
ODD_END = re.compile(r"[^\w\s.,;:?'\"()»«…-](?=\s|\Z)")


def statistics(text: str | None) -> list[float]:
    """The features of one text, in the order of `NAMES`; all of them are 0 for a text without words."""
    text = text or ""
    words = text.split()
    n = len(words)
    if not n:
        return [0.0] * len(NAMES)
    raw = text.encode("utf-8", "surrogatepass")
    codes = np.frombuffer(raw, np.uint8)
    kinds = np.bincount(codes, minlength=256)
    size = len(raw)
    upper, lower, digit = kinds[65:91].sum(), kinds[97:123].sum(), kinds[48:58].sum()
    white, wide = kinds[9:14].sum() + kinds[32], kinds[128:].sum()
    seen = size - white
    symbol = seen - upper - lower - digit - wide
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    lines = text.split("\n")
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        math.log1p(len(text)), math.log1p(n), float(lengths.mean()), upper / max(1, upper + lower), digit / seen, symbol / seen, wide / seen,
        sum(map(str.isupper, words)) / n, len(ODD_END.findall(text)) / n, same / n,
        counts.most_common(1)[0][1] / n, math.log(len(counts)) / math.log(n) if n > 1 else 1.0, float((lengths <= 3).mean()),
        counts["|"] / n, math.log1p(len(lines)), 1 - len(set(lines)) / len(lines), math.log1p(n / len(lines)),
        len(zlib.compress(raw, 1)) / size, (kinds[46] + kinds[63]) / n, float((lengths >= 15).mean()),
    ]


def _floats() -> str:
    return ", ".join(f"{x} double" for x in NAMES)


def with_statistics(docs: DataFrame, *keep: str) -> DataFrame:
    """The kept columns (bigint or int ones) and the features of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            x = np.array([statistics(t) for t in b.column(1).to_pylist()]).reshape(b.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), *b.columns[2:], *(pa.array(c) for c in x.T)], [*names, *NAMES])

    names = ["doc_id", *keep]
    rows = docs.select("doc_id", "text", *(F.col(c).cast("long") for c in keep))
    return rows.mapInArrow(run, ", ".join(f"{c} long" for c in names) + ", " + _floats())


def is_held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 by 3; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 3 == 1


def fit(docs: DataFrame, labels: DataFrame) -> Trees:
    """Trees from at most TRAIN_ROWS labelled documents outside the held-out fold.

    Labels without a document, null ids and null labels are left out; several labels of one document
    each count. Only the sample's features, numbers of a bounded count, come to the driver.
    """
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~is_held_out(F.col("doc_id")))
    chosen = chosen.select("doc_id", F.col("quality").cast("long").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(TRAIN_ROWS)
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = with_statistics(rows, "label").orderBy(F.xxhash64("doc_id"), "doc_id", "label", *NAMES).limit(TRAIN_ROWS).collect()
    x = np.array([[r[n] for n in NAMES] for r in sample]).reshape(len(sample), len(NAMES))
    return train(x, np.array([r.label for r in sample]))


def score(docs: DataFrame, trees: Trees) -> DataFrame:
    """(doc_id, text) -> (doc_id, score): the chance that a text is of good quality, one row per row."""
    sent = docs.sparkSession.sparkContext.broadcast(trees)  # some thousand numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            x = np.array([statistics(t) for t in b.column(1).to_pylist()]).reshape(b.num_rows, len(NAMES))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sent.value.score(x))], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of documents.

    Null and empty texts are scored by features of 0. Repeated rows and null ids stay (a null id is
    not held out). Without any usable label every score is 0.5. Extra columns are not read.
    """
    found = score(docs, fit(docs, labels))
    return found.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def accepted(docs: DataFrame, trees: Trees) -> DataFrame:
    """The rows, with all their columns, whose text scores at least 0.5."""
    sent, at = docs.sparkSession.sparkContext.broadcast(trees), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([statistics(t) for t in b.column(at).to_pylist()]).reshape(b.num_rows, len(NAMES))
            yield b.filter(pa.array(sent.value.score(x) >= 0.5))

    return docs.mapInArrow(run, docs.schema)
