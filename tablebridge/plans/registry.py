"""Queries by name, each with the SQL that should give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class Tables:
    """The driver tables of one folder, read lazily by name: `t.orders`."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name not in TABLES:
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))

    def derive(self, text: str, **dealt: DataFrame) -> DataFrame:
        """A derived input from SQL that names its tables in braces; `dealt` holds tables with their rows dealt to tasks otherwise."""
        used = {n: dealt.get(n, getattr(self, n)) for n in TABLES if "{" + n + "}" in text}
        return self.spark.sql(text, **used)


def plain(text: str) -> str:
    """The same derived input for the checking engine, where tables have their plain names."""
    return text.format(**{n: n for n in TABLES})


def query(sql: str | None = None, name: str | None = None) -> Callable:
    """Register a function of `Tables` under its name, with its SQL if SQL can say it."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} is registered twice")
        QUERIES[key] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add
