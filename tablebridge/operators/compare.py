"""Comparing a source with its target."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablebridge.functions.clean import REAL_SHAPE, matched, strip
from tablebridge.operators.skew import rank_in_group


def _number_text(real: Column) -> Column:
    """n: for whole numbers in integer form, f: for others."""
    whole = (real == F.floor(real)) & (F.abs(real) < 1e15)
    return F.when(whole, F.concat(F.lit("n:"), real.cast("decimal(38,0)").cast("string"))).otherwise(
        F.concat(F.lit("f:"), real.cast("string"))
    )


def canonical_value(c: Column, data_type: T.DataType | None = None) -> Column:
    """Comparable text: blank equals null, numbers in one form whatever their type.

    Typed columns need no parsing; text is read as a whole number, a decimal number, or itself.
    """
    kind = data_type or T.StringType()
    if isinstance(kind, T.IntegralType):
        return F.concat(F.lit("n:"), c.cast("string"))
    if isinstance(kind, T.NumericType):
        return _number_text(c.cast("double"))
    if isinstance(kind, T.BinaryType):
        return F.concat(F.lit("t:"), F.lower(F.hex(c)))
    if not isinstance(kind, T.StringType):
        return F.concat(F.lit("t:"), c.cast("string"))
    text = strip(c)
    whole = matched(text, "^-?[0-9]{1,38}$").try_cast("decimal(38,0)").cast("string")
    real = matched(text, REAL_SHAPE).try_cast("double")
    # Text keeps its outer space: only blank and null are the same.
    return F.coalesce(
        F.concat(F.lit("n:"), whole), _number_text(real), F.when(text != "", F.concat(F.lit("t:"), c))
    )


def canonical_columns(df: DataFrame, columns: Sequence[str]) -> dict[str, Column]:
    return {c: canonical_value(F.col(c), df.schema[c].dataType) for c in columns}


def canonical_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """SHA-256 of a row in canonical form, columns in the order of their lower-case names."""
    values = canonical_columns(df, sorted(columns, key=str.lower))
    row = F.struct(*[v.alias(n.lower()) for n, v in values.items()])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def hash_overlap(a: DataFrame, b: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows of each side and the size of their multiset intersection by canonical row hash."""
    left = a.groupBy(canonical_hash(a, columns).alias("h")).agg(F.count(F.lit(1)).alias("_a"))
    right = b.groupBy(canonical_hash(b, columns).alias("h")).agg(F.count(F.lit(1)).alias("_b"))
    both = left.join(right, "h", "full_outer")
    n_a, n_b = F.coalesce("_a", F.lit(0)), F.coalesce("_b", F.lit(0))
    return both.agg(
        F.sum(n_a).alias("left_rows"), F.sum(n_b).alias("right_rows"), F.sum(F.least(n_a, n_b)).alias("overlap")
    )


@dataclass(frozen=True)
class CompareSpec:
    """Key per side, shared columns, order inside a repeated key, and waivers.

    A waiver names columns whose differences do not count where its condition (over `_l_` and
    `_r_` columns) holds.
    """

    left_key: str
    right_key: str
    columns: Sequence[str]
    order: Sequence[str]
    waivers: Sequence[tuple[Sequence[str], Column]] = ()


def compare_by_key(left: DataFrame, right: DataFrame, spec: CompareSpec) -> DataFrame:
    """Pair the k-th left row of a key with the k-th right row and list the differing fields.

    Result per pair: key, k, status (match, field_mismatch, missing_right, missing_left) and the
    names of the differing fields. All rows are kept; a report may show fewer.
    """

    waivable = {c for cols, _ in spec.waivers for c in cols}

    def side(df: DataFrame, key: str, prefix: str) -> DataFrame:
        needed = dict.fromkeys([*spec.order, *spec.columns])
        rows = df.select(F.col(key).cast("string").alias("key"), *[F.col(c).alias(f"_c_{c}") for c in needed]).filter("key is not null")
        ranked = rank_in_group(rows, ["key"], [F.col(f"_c_{c}") for c in spec.order], "k")
        both = ranked.select("key", "k", *[F.col(f"_c_{c}").alias(c) for c in needed])
        # Values meet in canonical form; columns a waiver reads also come as they are.
        values = [v.alias(f"{prefix}{c}_value") for c, v in canonical_columns(both, spec.columns).items()]
        plain = [F.col(c).alias(prefix + c) for c in spec.columns if c in waivable]
        return both.select("key", "k", *values, *plain, F.lit(True).alias(prefix + "in"))

    pairs = side(left, spec.left_key, "_l_").join(side(right, spec.right_key, "_r_"), ["key", "k"], "full_outer")
    waived = {c: F.coalesce(cond, F.lit(False)) for cols, cond in spec.waivers for c in cols}

    def differs(c: str) -> Column:
        unequal = ~F.col(f"_l_{c}_value").eqNullSafe(F.col(f"_r_{c}_value"))
        return unequal & ~waived[c] if c in waived else unequal

    fields = F.filter(
        F.array(*[F.when(differs(c), F.lit(c)) for c in spec.columns]), lambda x: x.isNotNull()
    )
    status = (
        F.when(F.col("_r_in").isNull(), "missing_right")
        .when(F.col("_l_in").isNull(), "missing_left")
        .when(F.size("_fields") > 0, "field_mismatch")
        .otherwise("match")
    )
    both = F.col("_l_in") & F.col("_r_in")
    empty = F.array().cast("array<string>")
    return pairs.withColumn("_fields", F.when(both, fields).otherwise(empty)).select(
        "key", "k", status.alias("status"), F.col("_fields").alias("fields")
    )


def compare_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def compare_details(diff: DataFrame, limit: int, include_missing: bool = False) -> DataFrame:
    """The first differing keys for a report; the counts of `compare_summary` stay exact."""
    shown = ["field_mismatch", "missing_right", "missing_left"] if include_missing else ["field_mismatch"]
    return diff.filter(F.col("status").isin(*shown)).orderBy("key", "k").limit(limit)


def field_mismatch_counts(diff: DataFrame) -> DataFrame:
    return (
        diff.select(F.explode("fields").alias("field"))
        .groupBy("field")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "field")
    )


def column_set_diff(a: DataFrame, b: DataFrame, prefix_a: str = "", prefix_b: str = "") -> DataFrame:
    """Where each column exists (name prefixes dropped, case ignored), with both row counts."""
    name = lambda c, p: c.lower().removeprefix(p)
    left, right = {name(c, prefix_a) for c in a.columns}, {name(c, prefix_b) for c in b.columns}
    sides = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit("shared" if c in left and c in right else "left" if c in left else "right").alias("side"),
        )
        for c in sorted(left | right)
    ]
    one = lambda df, s: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(s).alias("s"), "n")
    counts = one(a, "left").unionByName(one(b, "right")).agg(
        F.max(F.when(F.col("s") == "left", F.col("n"))).alias("left_rows"),
        F.max(F.when(F.col("s") == "right", F.col("n"))).alias("right_rows"),
    )
    return counts.select(F.explode(F.array(*sides)).alias("c"), "left_rows", "right_rows").select(
        "c.*", "left_rows", "right_rows"
    )


def _digit_list(*cells: Column) -> Column:
    digits = [F.regexp_replace(F.coalesce(strip(c), F.lit("")), "[^0-9]", "") for c in cells]
    return F.filter(F.array(*digits), lambda d: d != "")


def pair_multiset_equal(left_home: Column, left_biz: Column, right_home: Column, right_biz: Column) -> Column:
    """Two phone columns hold the same numbers in any order.

    If the left business cell holds a slash, its parts are the numbers and the left home cell,
    usually stale then, is ignored.
    """
    segments = F.filter(
        F.transform(F.split(left_biz, "/"), lambda p: F.regexp_replace(p, "[^0-9]", "")), lambda d: d != ""
    )
    left = F.when(F.coalesce(left_biz.contains("/"), F.lit(False)), segments).otherwise(
        _digit_list(left_home, left_biz)
    )
    return F.array_sort(left) == F.array_sort(_digit_list(right_home, right_biz))


def parity_check(source: DataFrame, target: DataFrame, checks: Mapping[str, Column]) -> DataFrame:
    """Per named check, a predicate over either side: rows on both sides, whether they agree, and the reason.

    All checks are counted in one pass over each side.
    """
    counts = [F.count_if(F.coalesce(p, F.lit(False))).cast("bigint").alias(f"c{i}") for i, p in enumerate(checks.values())]
    both = source.agg(*counts).withColumn("side", F.lit("s")).unionByName(target.agg(*counts).withColumn("side", F.lit("t")))
    of = lambda side, i: F.max(F.when(F.col("side") == side, F.col(f"c{i}")))
    rows = [
        F.struct(F.lit(name).alias("check_name"), of("s", i).alias("source_rows"), of("t", i).alias("target_rows"))
        for i, name in enumerate(checks)
    ]
    out = both.agg(F.array(*rows).alias("rows")).select(F.explode("rows").alias("r")).select("r.*")
    s, t = F.col("source_rows"), F.col("target_rows")
    reason = F.when(t < s, "target_short").when(t > s, "target_surplus").otherwise("equal")
    return out.withColumn("is_ok", s == t).withColumn("reason", reason)


def key_alias_range(
    df: DataFrame, key: str, low: object = None, high: object = None, numeric: bool = True, alias: str = "key"
) -> DataFrame:
    """Rows whose key, under its own name on this side, lies in an inclusive range."""
    value = matched(F.col(key).cast("string"), "^ *-?[0-9]{1,38} *$").try_cast("decimal(38,0)") if numeric else F.col(key).cast("string")
    keep = F.lit(True)
    if low is not None:
        keep = keep & (value >= F.lit(low))
    if high is not None:
        keep = keep & (value <= F.lit(high))
    return df.filter(keep).withColumnRenamed(key, alias)
