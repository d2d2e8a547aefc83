"""Table loads: one composition of the operators, driven by a spec."""

from __future__ import annotations

from dataclasses import replace
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.functions.clean import norm_key
from tablebridge.operators import document, merge, profile, quality, resolve
from tablebridge.operators.dedup import distinct_on
from tablebridge.operators.merge import MergeSpec
from tablebridge.operators.skew import left_lookup
from tablebridge.session import cut_lineage
from tablebridge.spec import RelationSpec, TableSpec

# Care 1 outpatient, 2 inpatient; method 1 cash, 2 default, 3 invoice; rights by method.
CASH_RIGHTS = ("1", "2")
INVOICE_RIGHTS = ("3", "4", "5", "6")


def payment_method(care: Column, right: Column) -> Column:
    """How a bill is paid: inpatients by invoice, outpatients by their right, others by default."""
    invoiced = (care == "2") | ((care == "1") & right.isin(*INVOICE_RIGHTS))
    cash = (care == "1") & right.isin(*CASH_RIGHTS)
    return F.when(invoiced, "3").when(cash, "1").otherwise("2")


class LoadResult:
    """A load on demand: `shaped` source rows, `issues` found, new target `rows` with `merge_action`.

    Nothing is computed before it is asked for. A merge reads its source several times, so it
    stages the shaped rows once.
    """

    def __init__(self, spec: TableSpec, staging: DataFrame, target: DataFrame) -> None:
        self.spec, self.staging, self.target = spec, staging, target

    @cached_property
    def made_parents(self) -> dict[str, DataFrame]:
        """The parents to create, by relation."""
        return {
            r.name: cut_lineage(resolve.missing_parents(self.staging, asked_key(r), r.parent, r.ensure))
            for r in self.spec.relations if r.ensure is not None
        }

    @cached_property
    def shaped(self) -> DataFrame:
        relations = [
            replace(r, parent=r.parent.unionByName(self.made_parents[r.name], allowMissingColumns=True)) if r.ensure else r
            for r in self.spec.relations
        ]
        return shape_rows(replace(self.spec, relations=relations), self.staging)

    @cached_property
    def issues(self) -> DataFrame:
        return find_issues(self.spec, self.staging)

    @cached_property
    def rows(self) -> DataFrame:
        rows = _written(self.spec, self.shaped, self.target)
        return rows if self.spec.post_load is None else self.spec.post_load(rows)

    def log(self) -> DataFrame:
        return quality.issue_log([self.issues])


def relation_key(c: Column) -> Column:
    """How a key is spelled for resolving it and for reporting that it can't be: trimmed, small letters."""
    return F.lower(norm_key(c.cast("string")))


def asked_key(r: RelationSpec) -> Column:
    """The key a staging row asks for, as it is spelled; sentinels, compared as they are written, ask for none."""
    text = norm_key(F.col(r.source).cast("string"))
    return F.when(~text.isin(*r.sentinels), text) if r.sentinels else text


def shape_rows(spec: TableSpec, staging: DataFrame) -> DataFrame:
    """Cleansed, deduplicated and resolved source rows; rows without a full key stay behind."""
    raw = {f.source for f in spec.fields} | {r.source for r in spec.relations} | set(spec.order)
    base = staging.select(
        *[F.col(c).alias(f"_raw_{c}") for c in sorted(raw)],
        *[f.clean(F.col(f.source)).alias(f.name) for f in spec.fields],
    )
    for key in spec.keys:
        base = base.filter(F.col(key).isNotNull())
    if spec.keys and spec.mode != "append":
        kept = [f.name for f in spec.fields] + sorted({f"_raw_{r.source}" for r in spec.relations})
        base = distinct_on(base, spec.keys, [F.col(f"_raw_{c}") for c in spec.order], kept)
    for r in spec.relations:
        source = asked_key(replace(r, source=f"_raw_{r.source}"))
        if r.placeholder is not None:
            base = resolve.lookup_preferred(
                base, r.parent, source, r.parent_keys, r.id_col, r.placeholder(), r.name
            )
        else:
            parent = r.parent.select(
                relation_key(F.col(r.parent_keys[0])).alias("_legacy"), F.col(r.id_col).alias(r.id_col)
            )
            base = resolve.lookup_first(
                base.withColumn("_legacy_key", F.lower(source)), parent, "_legacy_key", "_legacy", r.id_col, r.name
            ).drop("_legacy_key")
    if spec.transform is not None:
        base = spec.transform(base)
    return base.drop(*[c for c in base.columns if c.startswith("_raw_")])


def find_issues(spec: TableSpec, staging: DataFrame) -> DataFrame:
    """Lost values and unresolved relations of all staging rows, duplicates included. A relation whose
    parents are made has none of the latter."""
    rules = [
        quality.FieldRule(f.name, f.source, f.clean(F.col(f.source)), f.reason, required=f.required)
        for f in spec.fields
        if f.reason
    ]
    found = None
    if rules:
        found = quality.field_issues(staging, F.col(spec.record_id), rules).drop("mapped")
    for r in spec.relations:
        if r.ensure is not None:
            continue
        known = None
        for key in r.parent_keys if r.placeholder is not None else r.parent_keys[:1]:
            part = r.parent.select(relation_key(F.col(key)).alias("_folded")).filter("_folded is not null")
            known = part if known is None else known.unionByName(part)
        asked = staging.select(
            F.col(spec.record_id).cast("string").alias("record_id"),
            F.col(r.source).cast("string").alias("source_raw"),
            F.lower(asked_key(r)).alias("_folded"),
        ).filter("_folded is not null")
        lost = asked.join(known, "_folded", "left_anti").select(
            "record_id", F.lit(r.name).alias("field"), F.lit(f"{r.name}_not_resolved").alias("reason"), "source_raw"
        )
        found = lost if found is None else found.unionByName(lost)
    return found


def _written(spec: TableSpec, shaped: DataFrame, target: DataFrame) -> DataFrame:
    if spec.mode == "append":
        rows = merge.append_log(target, shaped.select(*[c for c in target.columns if c in shaped.columns]))
        return rows.withColumn(merge.ACTION, F.lit("appended"))
    write = {
        "insert_only": merge.merge_insert_only,
        "overwrite": merge.merge_overwrite,
        "if_changed": merge.merge_if_changed,
        "fill_null": merge.fill_null_only,
        "prefer_source": merge.prefer_source_keep_target,
        "policy": merge.column_policy_merge,
        "replace": merge.replace_keep_id,
        "replace_new": merge.replace_new_id,
    }[spec.mode]
    plan = MergeSpec(spec.keys, spec.id_col, policies=spec.policies, keep=spec.keep)
    return write(target, cut_lineage(shaped), plan)


def run_load(spec: TableSpec, staging: DataFrame, target: DataFrame) -> LoadResult:
    """Cleanse, deduplicate, resolve, merge under the spec's write mode, and report, each when asked for."""
    return LoadResult(spec, staging, target)


def enrich_with_prior_result(
    appointments: DataFrame, exams: DataFrame, findings: DataFrame, is_signed: Column, max_items: int = document.MAX_ITEMS
) -> DataFrame:
    """Give each appointment the findings of the patient's last signed exam before its day.

    `appointments`: id, party, at, payload. `exams`: exam_id, party, appointment. `findings`:
    exam_id, found_at, finding_id. An exam made for the appointment itself is passed over.
    Lists come in parts: the result has one row per appointment and `part`, part 0 where there is none.
    """
    signed = (
        findings.withColumn("_signed", is_signed)
        .groupBy("exam_id")
        .agg(F.max("found_at").alias("exam_at"), F.bool_or("_signed").alias("_any"))
        .filter("_any")
        .drop("_any")
    )
    candidates = exams.join(signed, "exam_id").filter("party is not null")
    picked = resolve.asof_before_day(
        appointments, candidates, "party", "at", "exam_at", "exam_id", ("id", "appointment"), "picked_exam"
    )
    # Findings are gathered once per exam, not once per appointment.
    lists = document.group_to_struct_array(
        findings, ["exam_id"], [F.col("finding_id")], ["finding_id"], "found", max_items
    )
    parts = lists.select("exam_id", "part", F.to_json("found").alias("payload"))
    return document.denormalise_to_parent(picked, "picked_exam", parts, "exam_id", ["payload"], "part")


def prior_result_with_category(
    appointments: DataFrame, exams: DataFrame, findings: DataFrame, general: DataFrame, is_signed: Column, max_items: int = document.MAX_ITEMS
) -> DataFrame:
    """`enrich_with_prior_result`, and the category of the picked exam beside its findings.

    `appointments` also holds category and is_migrated: appointments of the new system keep what they have. `general`:
    exam_id, general_id, category; the lowest general_id of an exam counts, also if its category is null. A migrated appointment that picks an exam
    without a general row gets no category; one that picks nothing keeps its own. `is_updated` tells rows that change.
    """
    lists = profile.group_ids_having_any(findings, ["exam_id"], is_signed, "found_at", "finding_id", max_items)
    first = distinct_on(general.filter("exam_id is not null"), ["exam_id"], [F.col("general_id")], ["exam_id", "category"])
    signed = lists.filter("part = 0").select("exam_id", F.col("latest").alias("exam_at"))
    candidates = exams.join(signed, "exam_id").filter("party is not null")
    asking = appointments.filter(F.coalesce("is_migrated", F.lit(False)))
    picked = resolve.asof_before_day(asking, candidates, "party", "at", "exam_at", "exam_id", ("id", "appointment"), "picked_exam")
    payload = left_lookup(
        lists.select("exam_id", "part", F.to_json(F.transform("ids", lambda x: F.struct(x.alias("finding_id")))).alias("payload")), first, ["exam_id"]
    )
    filled = document.denormalise_to_parent(picked, "picked_exam", payload, "exam_id", ["payload", "category"], "part")
    others = appointments.filter(~F.coalesce("is_migrated", F.lit(False)))
    plain = others.select("*", F.lit(None).cast(filled.schema["picked_exam"].dataType).alias("picked_exam"), F.lit(0).alias("part"), F.lit(False).alias("is_updated"))
    return filled.unionByName(plain)
