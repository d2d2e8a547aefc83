"""Tables in the shared folder that cut lineage, and small helpers for batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from tablebridge.session import new_run_folder


def stage(df: DataFrame, purpose: str, codec: str = "zstd") -> DataFrame:
    """Write the rows once to the shared folder and read them back; every executor can reach them."""
    path = new_run_folder(df.sparkSession, purpose)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def rows_of(batches: Iterator[pa.RecordBatch], at_most: int = 4096, chars: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches: at most so many rows and, unless one text is longer, so many bytes of column 1."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(1)), 0).to_pylist() if batch.num_rows else []
        start = total = 0
        for i, n in enumerate(sizes):
            if i > start and (i - start >= at_most or total + n > chars):
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += n
        if sizes:
            yield batch.slice(start)


def parts_of(texts: pa.Array, mark: str) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts cut at a mark: the distinct parts, the number of each part as they come, and how many parts each text has (null: none)."""
    lists = pc.split_pattern(texts, mark)
    found = lists.flatten().dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False), pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)


def gathered(flat: np.ndarray, start: np.ndarray, size: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """The stretches of flat that numbers name by their start and size, one after another."""
    n = size[numbers]
    return flat[np.repeat(start[numbers] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
