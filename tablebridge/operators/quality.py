"""Data-quality operators: issues are rows, not exceptions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.functions.clean import null_if_blank
from tablebridge.operators.document import group_to_struct_array
from tablebridge.session import cut_lineage


# Ids listed from one row.
SLICE = 10_000


@dataclass(frozen=True)
class FieldRule:
    """One mapped field: raw source column, mapped value, and the reason to give if it is lost."""

    field: str
    raw: str
    mapped: Column
    reason: str
    flag: Column | None = None
    required: bool = False

    def failed(self) -> Column:
        lost = null_if_blank(F.col(self.raw)).isNotNull() & self.mapped.isNull()
        return F.coalesce(lost if self.flag is None else self.flag, F.lit(False))


def _issue(rule: FieldRule) -> Column:
    # A lost value is null by definition; only a flagged one has something to show.
    mapped = F.lit(None).cast("string") if rule.flag is None else rule.mapped.cast("string")
    return F.when(
        rule.failed(),
        F.struct(
            F.lit(rule.field).alias("field"),
            F.lit(rule.reason).alias("reason"),
            F.col(rule.raw).cast("string").alias("source_raw"),
            mapped.alias("mapped"),
        ),
    )


def field_issues(df: DataFrame, record_id: Column, rules: Sequence[FieldRule]) -> DataFrame:
    """One row per field that held text but could not be mapped. One pass over the table."""
    found = F.explode(F.array(*[_issue(r) for r in rules])).alias("i")
    rows = df.select(record_id.cast("string").alias("record_id"), found)
    return rows.filter("i is not null").select("record_id", "i.*")


@dataclass(frozen=True)
class Relation:
    """A legacy key column and the parent it should resolve in; sentinels mean no relation."""

    name: str
    key: str
    parent: DataFrame
    parent_key: str
    sentinels: Sequence[object] = ()


def unresolved_relations(df: DataFrame, record_id: str, relations: Sequence[Relation]) -> DataFrame:
    out = None
    for r in relations:
        asked = df.filter(F.col(r.key).isNotNull())
        if r.sentinels:
            asked = asked.filter(~F.col(r.key).isin(*r.sentinels))
        known = r.parent.select(F.col(r.parent_key).alias(r.key))
        part = asked.join(known, r.key, "left_anti").select(
            F.col(record_id).cast("string").alias("record_id"),
            F.lit(r.name).alias("field"),
            F.lit(f"{r.name}_not_resolved").alias("reason"),
            F.col(r.key).cast("string").alias("source_raw"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def missing_after_load(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct source keys the target still lacks."""
    return source.select(*keys).distinct().join(target.select(*keys), list(keys), "left_anti")


def issue_log(issues: Sequence[DataFrame], max_items: int = 1000) -> DataFrame:
    """Issues of several checks per record, sorted; a record with very many spans several parts."""
    out = issues[0]
    for more in issues[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    fields = ["field", "reason", "source_raw"]
    # Finding issues is the expensive part; grouping reads them more than once.
    out = cut_lineage(out.select("record_id", *fields))
    return group_to_struct_array(
        out, ["record_id"], [F.col(c) for c in fields], fields, "issues", max_items
    )


def repair_ids(run_log: DataFrame, issues: DataFrame) -> DataFrame:
    """Ids to load again: failed ranges and lists of the latest run, plus records with issues.

    `run_log` holds run_id, status, first_id, last_id and ids. Every id of a range is taken, however
    wide: a range is cut into slices of `SLICE` ids before these are listed, so no row holds a long list.
    """
    latest = run_log.agg(F.max("run_id")).scalar()
    failed = run_log.filter((F.col("run_id") == latest) & (F.col("status") == "failed"))
    slices = failed.filter("first_id <= last_id").select(
        F.explode(F.sequence(F.col("first_id").cast("bigint"), F.col("last_id").cast("bigint"), F.lit(SLICE).cast("bigint"))).alias("_from"),
        F.col("last_id").alias("_last"),
    )
    listed = F.sequence("_from", F.least(F.col("_from") + SLICE - 1, F.col("_last"))).cast("array<string>")
    ranges = slices.select(F.explode(listed).alias("source_id"))
    lists = failed.select(F.explode(F.col("ids").cast("array<string>")).alias("source_id"))
    records = issues.select(F.col("record_id").alias("source_id"))
    ids = ranges.unionByName(lists).unionByName(records).select(null_if_blank(F.col("source_id")).alias("source_id"))
    return ids.filter("source_id is not null").distinct()


def repair_outcomes(planned: DataFrame, failed: DataFrame, not_found: DataFrame, key: str) -> DataFrame:
    """The outcome of each planned id: lists of any length, one row an id."""
    bad = failed.select(key).distinct().withColumn("_bad", F.lit(True))
    lost = not_found.select(key).distinct().withColumn("_lost", F.lit(True))
    outcome = F.when(F.col("_lost"), "not_found").when(F.col("_bad"), "failed").otherwise("success")
    ids = planned.select(key).distinct()
    return ids.join(bad, key, "left").join(lost, key, "left").select(key, outcome.alias("outcome"))


def repair_summary(planned: DataFrame, failed: DataFrame, not_found: DataFrame, key: str) -> DataFrame:
    """One row per outcome; each planned id has exactly one."""
    return repair_outcomes(planned, failed, not_found, key).groupBy("outcome").agg(F.count(F.lit(1)).alias("ids"))


def quarantine_bad_rows(df: DataFrame, rules: Sequence[FieldRule]) -> tuple[DataFrame, DataFrame]:
    """(rows all of whose required fields map, the others with the names of the lost fields)."""
    lost = F.filter(
        F.array(*[F.when(r.failed(), F.lit(r.field)) for r in rules if r.required]),
        lambda x: x.isNotNull(),
    )
    marked = df.withColumn("failed_fields", F.array_join(lost, ","))
    return (
        marked.filter(F.col("failed_fields") == "").drop("failed_fields"),
        marked.filter(F.col("failed_fields") != ""),
    )


def key_not_mappable(df: DataFrame, record_id: Column, parts: Mapping[str, Column]) -> DataFrame:
    """Rows with a key part that the target key type cannot hold."""
    bad = F.filter(
        F.array(*[F.when(c.isNull(), F.lit(name)) for name, c in parts.items()]), lambda x: x.isNotNull()
    )
    return df.select(
        record_id.cast("string").alias("record_id"), F.array_join(bad, ",").alias("bad_parts")
    ).filter("bad_parts <> ''")


def code_validity(df: DataFrame, record_id: str, column: str, allowed: Sequence[str]) -> DataFrame:
    """Rows whose code is set but not allowed. The allowed set is a literal of the spec."""
    code = null_if_blank(F.col(column))
    return df.filter(code.isNotNull() & ~code.isin(*allowed)).select(
        F.col(record_id).cast("string").alias("record_id"),
        F.lit(column).alias("field"),
        F.lit("code_not_allowed").alias("reason"),
        F.col(column).cast("string").alias("source_raw"),
    )
