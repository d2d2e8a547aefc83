"""Finding, creating and re-linking the rows that references point to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tablebridge.functions.clean import (
    clean_person_name,
    first_phone,
    is_searchable_name,
    match_key,
    norm_key,
    phone_digit_set,
)
from tablebridge.operators.ids import assign_ids
from tablebridge.operators.skew import left_lookup


def lookup_preferred(
    df: DataFrame,
    parent: DataFrame,
    key: Column,
    parent_keys: Sequence[str],
    id_col: str,
    placeholder: Column,
    out: str = "parent_id",
) -> DataFrame:
    """Attach one parent id per row by a case-insensitive key.

    A real parent beats a placeholder, then an exact spelling of the first key column beats its
    other spellings, these beat the later key columns, and the lowest id wins. Each parent key column is one equality join: per
    folded key the parent is first reduced to its best row, and per exact spelling likewise.
    """
    views = [
        parent.select(
            norm_key(F.col(k)).alias("_spelling"),
            placeholder.cast("int").alias("_fake"),
            F.lit(rank).alias("_key_rank"),
            F.col(id_col).alias("_id"),
        )
        for rank, k in enumerate(parent_keys)
    ]
    keys = views[0]
    for view in views[1:]:
        keys = keys.unionByName(view)
    keys = keys.filter("_spelling is not null").withColumn("_folded", F.lower("_spelling"))
    best = F.min(F.struct("_fake", "_key_rank", "_id"))
    exact = keys.filter("_key_rank = 0").groupBy("_spelling").agg(best.alias("_exact"))
    folded = keys.groupBy("_folded").agg(best.alias("_any"))
    marked = df.withColumn("_spelling", norm_key(key)).withColumn("_folded", F.lower("_spelling"))
    joined = left_lookup(
        left_lookup(marked, exact, ["_spelling"], sparse=True), folded, ["_folded"], sparse=True
    )
    # The exact match is preferred unless it is a placeholder and another spelling is real.
    chosen = F.when(
        F.col("_exact").isNotNull() & (F.col("_exact._fake") <= F.col("_any._fake")),
        F.col("_exact._id"),
    ).otherwise(F.col("_any._id"))
    return joined.withColumn(out, chosen).drop("_spelling", "_folded", "_exact", "_any")


def lookup_first(
    df: DataFrame, parent: DataFrame, key: str, parent_key: str, id_col: str, out: str = "parent_id"
) -> DataFrame:
    """Attach the lowest parent id that carries the legacy key."""
    first = parent.filter(F.col(parent_key).isNotNull()).groupBy(F.col(parent_key).alias(key)).agg(
        F.min(id_col).alias(out)
    )
    return left_lookup(df, first, [key], sparse=True)


def null_invalid_fk(
    df: DataFrame, fk: str, parent: DataFrame, pk: str, record_id: str
) -> tuple[DataFrame, DataFrame]:
    """(rows with references to absent parents set to null, one issue per such row)."""
    known = parent.select(F.col(pk).cast(df.schema[fk].dataType).alias(fk)).filter(
        F.col(fk).isNotNull()
    ).distinct().withColumn("_known", F.lit(True))
    checked = left_lookup(df, known, [fk], sparse=True)
    bad = F.col(fk).isNotNull() & F.col("_known").isNull()
    issues = checked.filter(bad).select(
        F.col(record_id).cast("string").alias("record_id"),
        F.lit(fk).alias("field"),
        F.lit("fk_not_in_master").alias("reason"),
        F.col(fk).cast("string").alias("source_raw"),
    )
    return checked.withColumn(fk, F.when(F.col("_known"), F.col(fk))).drop("_known"), issues


@dataclass(frozen=True)
class ParentTemplate:
    """How to fill a parent that exists only because a row refers to it."""

    key: str
    id_col: str
    first_name: str
    last_name: str
    sentinel: str
    prefix: str


def missing_parents(df: DataFrame, fk: Column, parent: DataFrame, spec: ParentTemplate) -> DataFrame:
    """The parents to create: one per absent key without regard to case, lowest spelling first."""
    wanted = (
        df.select(norm_key(fk).alias(spec.key))
        .filter(F.col(spec.key).isNotNull())
        .groupBy(F.lower(spec.key).alias("_folded"))
        .agg(F.min(spec.key).alias(spec.key))
    )
    known = parent.select(F.lower(norm_key(F.col(spec.key))).alias("_folded"))
    created = wanted.join(known, "_folded", "left_anti").drop("_folded")
    created = assign_ids(created, [F.col(spec.key)], parent, spec.id_col)
    return created.select(
        spec.id_col,
        spec.key,
        F.lit(spec.sentinel).alias(spec.first_name),
        F.concat(F.lit(spec.prefix), F.col(spec.key)).alias(spec.last_name),
    )


def ensure_parent(
    df: DataFrame, fk: Column, parent: DataFrame, spec: ParentTemplate
) -> tuple[DataFrame, DataFrame]:
    """(parent table with placeholders for all absent keys, the placeholders)."""
    created = missing_parents(df, fk, parent, spec)
    return parent.unionByName(created, allowMissingColumns=True), created


def find_or_create_dim(
    df: DataFrame, column: str, dim: DataFrame, name: str, id_col: str
) -> tuple[DataFrame, DataFrame]:
    """(rows with the id of their name, dimension with the names that were missing)."""
    names = df.select(norm_key(F.col(column)).alias(name)).filter(F.col(name).isNotNull()).distinct()
    known = dim.groupBy(norm_key(F.col(name)).alias(name)).agg(F.min(id_col).alias(id_col))
    created = assign_ids(names.join(known, name, "left_anti"), [F.col(name)], dim, id_col)
    mapping = known.unionByName(created.select(name, id_col))
    keyed = df.withColumn("_name", norm_key(F.col(column)))
    resolved = left_lookup(keyed, mapping.withColumnRenamed(name, "_name"), ["_name"], sparse=True).drop("_name")
    return resolved, dim.unionByName(created, allowMissingColumns=True)


def entity_key(first: Column, last: Column, *phones: Column) -> Column:
    """Name, surname and first usable phone; null without a name or a phone."""
    name, phone = clean_person_name(first), first_phone(*phones)
    return F.concat(name, F.lit("\x01"), F.coalesce(clean_person_name(last), F.lit("")), F.lit("\x01"), phone)


def find_or_create_entity(
    df: DataFrame, key: Column, row_id: str, entities: DataFrame, entity_id: str
) -> tuple[DataFrame, DataFrame]:
    """(rows with an entity id, entities to create).

    `entities` holds `match_key` and its id. Rows with equal keys share an entity, also across
    runs; a row without a key gets one of its own and is never grouped with the others.
    """
    marked = df.withColumn("match_key", key)
    known = entities.filter("match_key is not null").groupBy("match_key").agg(
        F.min(entity_id).alias(entity_id)
    )
    fresh = (
        marked.filter("match_key is not null")
        .groupBy("match_key")
        .agg(F.min(row_id).alias("_first_row"))
        .join(known, "match_key", "left_anti")
        .unionByName(
            marked.filter("match_key is null").select("match_key", F.col(row_id).alias("_first_row"))
        )
    )
    created = assign_ids(fresh, [F.col("_first_row")], entities, entity_id)
    by_key = known.unionByName(
        created.filter("match_key is not null").select("match_key", entity_id)
    )
    by_row = created.filter("match_key is null").select(F.col("_first_row").alias(row_id), entity_id)
    keyed = marked.filter("match_key is not null").join(by_key, "match_key")
    lone = marked.filter("match_key is null").join(by_row, row_id)
    resolved = keyed.unionByName(lone).select(*df.columns, "match_key", entity_id)
    return resolved, created.select("match_key", entity_id)


def match_by_name_phone(
    df: DataFrame, row_id: str, people: DataFrame, person_id: str,
    first: str = "first_name", last: str = "last_name", phones: Sequence[str] = ("phone",),
) -> DataFrame:
    """Per row the person with the same name, or of several the only one sharing a phone.

    Both ways look up aggregates per name and per (name, phone), so a name carried by a third of
    all people costs one row, not all pairs.
    """
    first_name, last_name = clean_person_name(F.col(first)), clean_person_name(F.col(last))
    searchable = is_searchable_name(first_name) & is_searchable_name(last_name)
    names = [F.when(searchable, first_name).alias("_first"), F.when(searchable, last_name).alias("_last")]
    digits = phone_digit_set(*[F.col(p) for p in phones]).alias("_phones")
    pool = people.select(F.col(person_id).alias("_person"), *names, digits).filter("_first is not null")
    by_name = pool.groupBy("_first", "_last").agg(
        F.min("_person").alias("_low"), F.count(F.lit(1)).alias("name_matches")
    )
    by_phone = (
        pool.select("_first", "_last", "_person", F.explode("_phones").alias("_phone"))
        .groupBy("_first", "_last", "_phone")
        .agg(F.min("_person").alias("_phone_low"), F.max("_person").alias("_phone_high"))
    )
    named = left_lookup(df.select(row_id, *names, digits), by_name, ["_first", "_last"], sparse=True)
    # Only rows whose name is shared look at their phones; the others keep one row without any.
    calls = named.select(
        row_id, "_first", "_last", "_low", F.coalesce("name_matches", F.lit(0)).alias("name_matches"),
        F.explode_outer(F.when(F.col("name_matches") > 1, F.col("_phones"))).alias("_phone"),
    )
    tried = (
        left_lookup(calls, by_phone, ["_first", "_last", "_phone"], sparse=True)
        .groupBy(row_id)
        .agg(
            F.max("name_matches").alias("name_matches"), F.min("_low").alias("_low"),
            F.min("_phone_low").alias("_phone_low"), F.max("_phone_high").alias("_phone_high"),
        )
    )
    by_number = F.when(F.col("_phone_low") == F.col("_phone_high"), F.col("_phone_low"))
    return tried.select(
        row_id,
        "name_matches",
        F.when(F.col("name_matches") == 1, F.col("_low")).otherwise(by_number).alias(person_id),
        ((F.col("name_matches") > 1) & by_number.isNull()).alias("is_ambiguous"),
    )


def fallback_same_day(
    df: DataFrame, candidates: DataFrame, party: str, ts: str, cand_id: str, fk: str
) -> DataFrame:
    """Where the reference is null: the lowest candidate of the same party on the same day."""
    daily = (
        candidates.filter(F.col(party).isNotNull() & F.col(ts).isNotNull())
        .groupBy(party, F.to_date(ts).alias("_day"))
        .agg(F.min(cand_id).alias("_candidate"))
    )
    marked = df.withColumn("_day", F.when(F.col(fk).isNull(), F.to_date(ts)))
    return (
        left_lookup(marked, daily, [party, "_day"], sparse=True)
        .withColumn(fk, F.coalesce(F.col(fk), F.col("_candidate")))
        .drop("_day", "_candidate")
    )


def asof_before_day(
    df: DataFrame,
    candidates: DataFrame,
    party: str,
    ts: str,
    cand_ts: str,
    cand_id: str,
    own: tuple[str, str] | None = None,
    out: str = "asof_id",
) -> DataFrame:
    """The latest candidate of the same party before the start of the row's day.

    Ties go to the higher id. With `own` = (row column, candidate column) a candidate whose column
    equals the row's is passed over. Candidates are first reduced to the best of each party and
    day (and the best with another owner), so the window runs over days, not over rows: its size
    per party is bounded by the calendar however many rows a party has.
    """
    row_own, cand_own = own if own else (None, None)
    cand = candidates.filter(F.col(party).isNotNull() & F.col(cand_ts).isNotNull()).select(
        F.col(party).alias("_party"),
        F.to_date(cand_ts).alias("_day"),
        F.col(cand_ts).alias("_ts"),
        F.col(cand_id).alias("_id"),
        (F.col(cand_own) if cand_own else F.lit(None).cast("bigint")).alias("_owner"),
    )
    if own:
        # The two best of each party and day with different owners. The ranking stops at two, so
        # Spark cuts every group to two rows before the shuffle.
        per_owner = cand.groupBy("_party", "_day", "_owner").agg(F.max(F.struct("_ts", "_id", "_owner")).alias("_c"))
        place = F.row_number().over(W.partitionBy("_party", "_day").orderBy(F.col("_c").desc()))
        daily = (
            per_owner.withColumn("_place", place)
            .filter("_place <= 2")
            .groupBy("_party", "_day")
            .agg(
                F.max(F.when(F.col("_place") == 1, F.col("_c"))).alias("_best"),
                F.max(F.when(F.col("_place") == 2, F.col("_c"))).alias("_rival"),
            )
        )
    else:
        daily = cand.groupBy("_party", "_day").agg(F.max(F.struct("_ts", "_id", "_owner")).alias("_best"))
        daily = daily.withColumn("_rival", F.lit(None).cast(daily.schema["_best"].dataType))

    marked = df.withColumn("_party", F.col(party)).withColumn("_day", F.to_date(ts))
    asked = marked.select("_party", "_day").filter(
        F.col("_party").isNotNull() & F.col("_day").isNotNull()
    ).distinct()
    days = asked.join(daily, ["_party", "_day"], "full_outer")
    by_day = W.partitionBy("_party").orderBy("_day")
    earlier = by_day.rowsBetween(W.unboundedPreceding, -1)
    upto = by_day.rowsBetween(W.unboundedPreceding, 0)
    last_best = F.last("_best", ignorenulls=True).over(earlier)
    # Behind the newest candidate stands its same-day rival, else the newest before it with
    # another owner, else whatever stood there before.
    second_here = F.when(
        F.col("_best").isNotNull(),
        F.coalesce(
            F.col("_rival"),
            F.when(~F.col("_prior._owner").eqNullSafe(F.col("_best._owner")), F.col("_prior")),
        ),
    )
    line = (
        days.withColumn("_prior", last_best)
        .withColumn("_second_here", second_here)
        .withColumn("_second_upto", F.last("_second_here", ignorenulls=True).over(upto))
        .withColumn("_second", F.lag("_second_upto").over(by_day))
        .select("_party", "_day", F.col("_prior").alias("_first"), "_second")
    )
    joined = left_lookup(marked, line, ["_party", "_day"], sparse=True)
    if own:
        is_own = F.col("_first._owner").eqNullSafe(F.col(row_own))
        chosen = F.when(is_own, F.col("_second._id")).otherwise(F.col("_first._id"))
    else:
        chosen = F.col("_first._id")
    return joined.withColumn(out, chosen).drop("_party", "_day", "_first", "_second")


def lookup_slot(
    df: DataFrame, slots: DataFrame, clock: Column, slot_clock: str, slot_id: str,
    special: Column | None = None, out: str = "slot_id",
) -> DataFrame:
    """The first non-special slot for a clock time. A clock has at most 1440 values."""
    plain = slots if special is None else slots.filter(~F.coalesce(special, F.lit(False)))
    first = plain.groupBy(F.col(slot_clock).alias("_clock")).agg(F.min(slot_id).alias(out))
    return left_lookup(df.withColumn("_clock", clock), first, ["_clock"], sparse=True).drop("_clock")


def new_rows_only(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows whose key the target lacks; rows without a key pass, to be reported later."""
    return source.join(target.select(*keys), list(keys), "left_anti")


def exists_filter(df: DataFrame, child: DataFrame, key: str, child_key: str) -> DataFrame:
    return df.join(child.select(F.col(child_key).alias(key)), key, "left_semi")


@dataclass(frozen=True)
class RenameSpec:
    """Column names shared by both sides of the rename search."""

    pid: str = "pid"
    other_pid: str = "old_db_id"
    row_id: str = "id"
    first: str = "first_name"
    last: str = "last_name"
    birth: str = "birth_date"
    national: str = "national_id"


def pair_renamed(
    missing: DataFrame,
    existing: DataFrame,
    rename_log: DataFrame,
    live_keys: DataFrame,
    blocked: DataFrame,
    spec: RenameSpec = RenameSpec(),
) -> DataFrame:
    """Pair new keys with the existing row they renamed; one row per searched key, with a reason.

    Route `log` follows the rename log (new_pid, old_pid) and asks for the same birth date and
    first or last name. Route `identity` takes a row whose keys are gone from the source and whose
    identity is equal and unique on both sides. Every route looks up aggregates per key (lowest
    and highest id), never the pairs inside a group. `live_keys` and `blocked` hold `pid`.
    """
    fold = lambda c: F.lower(norm_key(F.col(c)))
    identity = [spec.first, spec.last, spec.birth]
    whole = F.lit(True)
    for c in identity:
        whole = whole & F.col(c).isNotNull()
    sought = missing.filter(whole).withColumn("_new", fold(spec.pid)).filter("_new is not null")

    # What is known about a key: it lives in the source, it is one of the missing ones.
    flag = lambda df, key, live: df.select(
        key.alias("_key"), F.lit(live).alias("_live"), F.lit(not live).alias("_wanted")
    )
    about = (
        flag(live_keys, fold("pid"), True)
        .unionByName(flag(sought, F.col("_new"), False))
        .filter("_key is not null")
        .groupBy("_key")
        .agg(F.max("_live").alias("_live"), F.max("_wanted").alias("_wanted"))
    )
    keyed = existing.select(
        F.col(spec.row_id).alias("_id"), fold(spec.pid).alias("_a"), fold(spec.other_pid).alias("_b"),
        *identity, F.col(spec.national).alias("_national"), F.col(spec.pid).alias("_old_pid"),
    ).filter("_a is not null or _b is not null")
    for key in ("_a", "_b"):
        named = about.select(F.col("_key").alias(key), F.col("_live").alias(f"{key}_live"), F.col("_wanted").alias(f"{key}_wanted"))
        keyed = left_lookup(keyed, named, [key], sparse=True)
    either = lambda what: F.coalesce(f"_a_{what}", F.lit(False)) | F.coalesce(f"_b_{what}", F.lit(False))
    # Candidates have a key of their own, and none of their keys is one that is missing.
    keyed = keyed.filter(~either("wanted")).withColumn("_stale", ~either("live"))
    row = F.struct("_id", "_old_pid", "_national", "_stale")
    span = [F.min(row).alias("_low"), F.max(row).alias("_high")]

    # Route by log: one lookup per (old key, birth date, first or last name).
    either_name = F.explode(F.array(F.struct(F.lit("f").alias("k"), F.col(spec.first).alias("v")), F.struct(F.lit("l").alias("k"), F.col(spec.last).alias("v"))))
    traits = ["_old", spec.birth, "_kind", "_name"]
    by_old = (
        keyed.select("*", F.explode(F.array_distinct(F.array("_a", "_b"))).alias("_old"))
        .filter("_old is not null")
        .select("*", either_name.alias("_n"))
        .withColumns({"_kind": F.col("_n.k"), "_name": F.col("_n.v")})
        .groupBy(*traits)
        .agg(*span)
    )
    log = rename_log.select(fold("new_pid").alias("_new"), fold("old_pid").alias("_old")).filter("_new <> _old")
    via_log = (
        sought.select("_new", spec.birth, either_name.alias("_n"))
        .withColumns({"_kind": F.col("_n.k"), "_name": F.col("_n.v")})
        .join(log.distinct(), "_new")
        .join(by_old, traits)
        .groupBy("_new")
        .agg(F.min("_low").alias("_log_low"), F.max("_high").alias("_log_high"))
    )
    # Route by identity: counts on both sides.
    stale = keyed.filter("_stale").filter(whole).groupBy(*identity).agg(
        F.count(F.lit(1)).alias("_stale_n"), F.min(row).alias("_stale_row")
    )
    twins = sought.groupBy(*identity).agg(F.count(F.lit(1)).alias("_twins"))
    found = left_lookup(left_lookup(left_lookup(sought, via_log, ["_new"]), stale, identity), twins, identity)

    logged = F.col("_log_low").isNotNull()
    unclear = F.when(logged & (F.col("_log_low._id") != F.col("_log_high._id")), "log_points_to_several").when(
        ~logged & ((F.col("_stale_n") > 1) | (F.col("_twins") > 1)), "identity_not_unique"
    )
    picked = (
        found.filter(logged | F.col("_stale_n").isNotNull())
        .withColumn("route", F.when(logged, "log").otherwise("identity"))
        .withColumn("_unclear", unclear)
        .withColumn(
            "_pick",
            F.when(F.col("_unclear").isNull(), F.when(logged, F.col("_log_low")).otherwise(F.col("_stale_row"))),
        )
        .withColumn("_id", F.col("_pick._id"))
    )
    held = blocked.select(fold("pid").alias("_new")).distinct().withColumn("_held", F.lit(True))
    judged = left_lookup(picked, held, ["_new"]).withColumn(
        "_reason",
        F.coalesce(
            F.col("_unclear"),
            F.when(F.col(spec.national) != F.col("_pick._national"), "national_id_differs"),
            F.when(F.col("_held"), "placeholder_exists"),
        ),
    )
    # Of the rows that passed, one existing row may be claimed once only.
    fit = F.when(F.col("_reason").isNull(), F.col("_id"))
    claims = judged.groupBy(fit.alias("_fit")).agg(F.count(F.lit(1)).alias("_claims")).filter("_fit is not null")
    reason = F.when(F.col("_reason").isNotNull(), F.col("_reason")).when(
        F.col("_claims") > 1, "claimed_by_several"
    )
    return left_lookup(judged.withColumn("_fit", fit), claims, ["_fit"], sparse=True).select(
        F.col(spec.pid).alias("new_pid"),
        F.col("_id").alias("row_id"),
        F.col("_pick._old_pid").alias("old_pid"),
        "route",
        reason.isNull().alias("is_paired"),
        reason.alias("reason"),
        (~F.col("_pick._stale")).alias("old_pid_alive"),
    )


def relink_fk(
    df: DataFrame, row_id: str, fk: str, pairs: DataFrame, generated: DataFrame, parent_id: str
) -> tuple[DataFrame, DataFrame]:
    """(rows moved from a generated parent to the real one, the generated parents set free).

    `pairs` holds the row id and `real_id`. A row paired with several real parents stays.
    """
    clear = (
        pairs.groupBy(row_id)
        .agg(F.min("real_id").alias("_real"), F.max("real_id").alias("_high"))
        .filter("_real = _high")
        .drop("_high")
    )
    fakes = generated.select(F.col(parent_id).alias(fk)).distinct().withColumn("_fake", F.lit(True))
    joined = left_lookup(left_lookup(df, clear, [row_id]), fakes, [fk], sparse=True)
    moves = F.col("_fake") & (F.col("_real") != F.col(fk))
    marked = joined.withColumn("_moves", F.coalesce(moves, F.lit(False)))
    freed = marked.filter("_moves").select(F.col(fk).alias(parent_id)).distinct()
    moved = marked.withColumn(fk, F.when(F.col("_moves"), F.col("_real")).otherwise(F.col(fk)))
    return moved.withColumnRenamed("_moves", "is_relinked").drop("_real", "_fake"), freed


def orphan_generated(
    parent: DataFrame, parent_id: str, generated: Column, references: Sequence[tuple[DataFrame, str]]
) -> DataFrame:
    """Generated parents that no child table refers to: one anti join per referring table."""
    left = parent.filter(generated)
    for child, fk in references:
        left = left.join(child.select(F.col(fk).alias(parent_id)), parent_id, "left_anti")
    return left


def self_pair_diff(
    left: DataFrame, right: DataFrame, key: str, offset: int, columns: Sequence[str]
) -> DataFrame:
    """Per pair of copies, which columns differ (null equals null)."""
    shifted = right.select(
        (F.col(key) - F.lit(offset)).alias(key), *[F.col(c).alias(f"_r_{c}") for c in columns]
    )
    pairs = left.join(shifted, key)
    return pairs.select(
        key, *[(~F.col(c).eqNullSafe(F.col(f"_r_{c}"))).alias(f"{c}_differs") for c in columns]
    )


def attribute_by_login(
    df: DataFrame, login: str, dim: DataFrame, dim_login: str, fills: dict[str, str]
) -> DataFrame:
    """Fill columns from a dimension found by a name without regard to case and outer space.

    `fills` maps a column to the dimension column it takes. Only rows whose values change are
    marked as updated.
    """
    per_login = dim.filter(match_key(F.col(dim_login)).isNotNull()).groupBy(
        match_key(F.col(dim_login)).alias("_login")
    ).agg(F.min_by(F.struct(*fills.values()), F.struct(*fills.values())).alias("_dim"))
    joined = left_lookup(df.withColumn("_login", match_key(F.col(login))), per_login, ["_login"], sparse=True)
    hit = F.col("_dim").isNotNull()
    changed = F.lit(False)
    for column, source in fills.items():
        changed = changed | ~F.col(column).eqNullSafe(F.col(f"_dim.{source}"))
    out = joined.withColumn("is_updated", hit & changed)
    for column, source in fills.items():
        out = out.withColumn(column, F.when(hit, F.col(f"_dim.{source}")).otherwise(F.col(column)))
    return out.drop("_login", "_dim")
