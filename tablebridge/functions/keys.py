"""Keys, fingerprints and sortable key text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablebridge.functions.clean import null_if_blank, to_int_strict

FIELD_SEPARATOR = "\x1e"
SYNTHETIC_HEX = 40
ID_WIDTH = 20


def composite_key(*parts: Column, sep: str = "_") -> Column:
    """Joined key parts; null as soon as one part is blank."""
    texts = [null_if_blank(p) for p in parts]
    joined = [texts[0]]
    for text in texts[1:]:
        joined += [F.lit(sep), text]
    return F.concat(*joined)


def text_digest(fields: Sequence[Column]) -> Column:
    parts = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    return F.sha2(F.concat_ws(FIELD_SEPARATOR, *parts), 256)


def synthetic_key(
    df: DataFrame, key: str, fields: Sequence[str], prefix: str, order: Sequence[str] | None = None
) -> DataFrame:
    """Give rows with a blank key a stable one: prefix and the first 40 hex digits of a digest.

    Equal rows are told apart by their rank among themselves, which does not depend on how the
    source was paged.
    """
    from tablebridge.operators.skew import rank_in_group

    digest = text_digest([F.col(f) for f in fields])
    marked = df.withColumn("_blank", null_if_blank(F.col(key)).isNull()).withColumn(
        "_digest", F.when(F.col("_blank"), digest)
    )
    keyed = marked.filter(~F.col("_blank")).withColumn("_rank", F.lit(None).cast("bigint"))
    blank = rank_in_group(
        marked.filter("_blank"), ["_digest"], [F.col(c) for c in (order or fields)], "_rank"
    )
    both = keyed.unionByName(blank)
    made = F.concat(
        F.lit(prefix),
        F.substring(
            F.sha2(F.concat(F.col("_digest"), F.lit(FIELD_SEPARATOR + "ord:"), F.col("_rank").cast("string")), 256),
            1,
            SYNTHETIC_HEX,
        ),
    )
    return both.withColumn(key, F.coalesce(null_if_blank(F.col(key)), made)).drop(
        "_blank", "_digest", "_rank"
    )


def row_fingerprint(key_fields: Mapping[str, Column], fields: Mapping[str, Column]) -> Column:
    """SHA-256 over tagged fields; a missing key field is marked, a missing plain field is empty."""
    tagged = [
        F.concat(F.lit(f"{tag}:"), F.coalesce(null_if_blank(c), F.lit("~"))) for tag, c in key_fields.items()
    ]
    tagged += [
        F.concat(F.lit(f"{tag}:"), F.coalesce(null_if_blank(c), F.lit(""))) for tag, c in fields.items()
    ]
    return F.sha2(F.concat_ws("|", *tagged), 256)


def id_sort_text(c: Column) -> Column:
    """Numbers zero-padded behind 0, other text behind 1, so that text order is key order."""
    number = to_int_strict(c)
    return F.when(
        number.isNotNull(), F.concat(F.lit("0"), F.lpad(number.cast("string"), ID_WIDTH, "0"))
    ).otherwise(F.concat(F.lit("1"), F.coalesce(null_if_blank(c), F.lit(""))))


def sort_key_text(ts: Column, c: Column) -> Column:
    """One text per row whose order is (rows without time first, time to the millisecond, key)."""
    stamped = F.concat(
        F.lit("1"), F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("_"), id_sort_text(c)
    )
    return F.when(ts.isNull(), F.concat(F.lit("0"), id_sort_text(c))).otherwise(stamped)


def null_safe_equal(left: Sequence[Column], right: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, [x.eqNullSafe(y) for x, y in zip(left, right, strict=True)])
