"""A load with several targets: bookings, and the people they are made for."""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablebridge.functions.clean import is_placeholder, norm_key
from tablebridge.operators import merge, resolve
from tablebridge.operators.dedup import distinct_on
from tablebridge.operators.merge import ACTION, MergeSpec
from tablebridge.operators.resolve import ParentTemplate
from tablebridge.operators.skew import left_lookup
from tablebridge.session import cut_lineage, new_run_folder
from tablebridge.streaming.incremental import BatchFolders

PERSON = ParentTemplate("pid", "id", "first_name", "last_name", "INFERRED", "PID ")


class BookingLoad:
    """Bookings arrive with a person's id, or before one is known with a name and a phone.

    `staging`: booking, visit_at, pid, first_name, last_name, phone, login and the attributes. `bookings`:
    id, booking, visit_at, patient, user_id. `people`: id, pid, first_name, last_name, phone, is_generated and
    `attribute`. `users`: login, user_id. Steps, each a table on demand:

    1. People that a pid asks for and that do not exist are made; placeholders take the name that came.
    2. Rows without a pid belong to the real person of their name and phone, else to a generated person that all
       rows of one name and phone share, also across runs.
    3. Bookings of a generated person move to the real one as soon as the source knows it; other persons stay.
    4. Generated persons that no booking refers to any more are gone.
    5. The last booking of a person sets the attribute; the login gives the user.
    """

    def __init__(self, staging: DataFrame, bookings: DataFrame, people: DataFrame, users: DataFrame, attribute: str) -> None:
        self.staging = distinct_on(staging.filter("booking is not null"), ["booking"], [F.col("visit_at"), F.col("pid")])
        self.bookings, self.people, self.users, self.attribute = bookings, people, users, attribute

    @cached_property
    def rows(self) -> DataFrame:
        return cut_lineage(self.staging.withColumn("pid", norm_key(F.col("pid"))))

    @cached_property
    def people_made(self) -> DataFrame:
        """Real people to create for unknown pids."""
        made = resolve.missing_parents(self.rows, F.col("pid"), self.people, PERSON)
        return cut_lineage(made.withColumn("is_generated", F.lit(False)))

    @cached_property
    def _real(self) -> DataFrame:
        """Real people, placeholders with the names that bookings brought."""
        real = self.people.filter("not is_generated").unionByName(self.people_made, allowMissingColumns=True)
        named = self.rows.filter("pid is not null and first_name is not null").withColumn("_folded", F.lower("pid"))
        names = distinct_on(named, ["_folded"], [F.col("visit_at"), F.col("booking")]).select("_folded", "first_name", "last_name", "phone")
        keyed = real.withColumn("_folded", F.lower(norm_key(F.col("pid"))))
        placeholder = is_placeholder(F.col("first_name"), PERSON.sentinel)
        spec = MergeSpec(["_folded"], columns=["first_name", "last_name", "phone"])
        upgraded = merge.upgrade_placeholder(keyed, names, spec, placeholder).filter(F.col(ACTION) != "inserted")
        return cut_lineage(upgraded.drop("_folded", ACTION))

    @cached_property
    def _found(self) -> tuple[DataFrame, DataFrame]:
        """(rows with patient, whether that is a real person and whether it is shared by name and phone; generated people to
        create: match_key, id)."""
        known = self._real.select("id", "pid").groupBy(F.lower(norm_key(F.col("pid"))).alias("_folded")).agg(F.min("id").alias("patient"))
        with_pid = left_lookup(self.rows.filter("pid is not null").withColumn("_folded", F.lower("pid")), known, ["_folded"]).drop("_folded")
        unnamed = self.rows.filter("pid is null")
        real = self._real.filter(~is_placeholder(F.col("first_name"), PERSON.sentinel)).withColumnRenamed("id", "person")
        matched = resolve.match_by_name_phone(unnamed, "booking", real, "person").select("booking", F.col("person").alias("patient"))
        found = cut_lineage(unnamed.join(matched, "booking", "left"))
        key = resolve.entity_key(F.col("first_name"), F.col("last_name"), F.col("phone"))
        # A row without name or phone was given a person of its own in an earlier run; that person stays.
        held = self.bookings.filter("patient is not null").groupBy("booking").agg(F.min("patient").alias("patient"))
        lone = found.filter("patient is null").drop("patient")
        own = lone.filter(key.isNull()).join(held, "booking").withColumn("is_real", F.lit(False))
        lone = lone.filter(key.isNotNull()).unionByName(lone.filter(key.isNull()).join(held, "booking", "left_anti"))
        everyone = self.people.select(F.when(F.col("is_generated"), key).alias("match_key"), "id")
        # New ids come after those of the real people made above.
        everyone = everyone.unionByName(self.people_made.select(F.lit(None).cast("string").alias("match_key"), "id"))
        grouped, created = resolve.find_or_create_entity(lone, key, "booking", everyone, "id")
        real_rows = with_pid.unionByName(found.filter("patient is not null")).withColumn("is_real", F.lit(True))
        others = grouped.select(*self.rows.columns, F.col("id").alias("patient")).withColumn("is_real", F.lit(False))
        held_or_real = real_rows.unionByName(own).withColumn("is_grouped", F.lit(False))
        return cut_lineage(held_or_real.unionByName(others.withColumn("is_grouped", F.lit(True)))), created

    @property
    def _resolved(self) -> DataFrame:
        return self._found[0]

    @cached_property
    def people_generated(self) -> DataFrame:
        """Generated people to create, with what their first booking tells. Bookings alone do without."""
        made = self._found[1].select("id")
        named = self._resolved.filter("is_grouped").withColumnRenamed("patient", "id").join(made, "id", "left_semi")
        first = distinct_on(named, ["id"], [F.col("booking")], ["id", "first_name", "last_name", "phone"])
        generated = made.join(first, "id").withColumn("pid", F.concat(F.lit("K"), F.col("id").cast("string"))).withColumn("is_generated", F.lit(True))
        return cut_lineage(generated)

    @cached_property
    def booking_rows(self) -> DataFrame:
        """The new target: relinked, kept and inserted bookings with their action."""
        source = self._resolved
        with_user = resolve.attribute_by_login(source.withColumn("user_id", F.lit(None).cast(self.users.schema["user_id"].dataType)), "login", self.users, "login", {"user_id": "user_id"})
        pairs = source.filter("is_real").select("booking", F.col("patient").alias("real_id"))
        moved, _ = resolve.relink_fk(self.bookings, "booking", "patient", pairs, self.people.filter("is_generated"), "id")
        policies = {"patient": merge.only_if_null, "user_id": lambda old, new: F.coalesce(new, old)}
        fresh = with_user.select("booking", "visit_at", "patient", "user_id")
        spec = MergeSpec(["booking"], "id", policies=policies)
        written = merge.column_policy_merge(moved.drop("is_relinked"), fresh, spec)
        relinked = moved.filter("is_relinked").select("booking", F.lit(True).alias("_moved"))
        action = F.when(F.col("_moved"), "relinked").otherwise(F.col(ACTION))
        out = left_lookup(written, relinked, ["booking"]).withColumn(ACTION, action).drop("_moved")
        return cut_lineage(out.select(*self.bookings.columns, ACTION))

    @cached_property
    def people_freed(self) -> DataFrame:
        """Generated people that no booking refers to after the load."""
        return cut_lineage(resolve.orphan_generated(self.people, "id", F.col("is_generated"), [(self.booking_rows, "patient")]).select("id", "pid"))

    @cached_property
    def people_rows(self) -> DataFrame:
        """The new people table: real ones, generated ones still in use, and the attribute of the last booking."""
        generated = self.people.filter("is_generated").join(self.people_freed.select("id"), "id", "left_anti")
        everyone = self._real.unionByName(generated.select(*self.people.columns)).unionByName(self.people_generated, allowMissingColumns=True)
        last = self._resolved.select(F.col("patient").alias("id"), F.col(self.attribute).alias("_value"), "visit_at", "booking")
        out = merge.last_wins_attribute(everyone, last, "id", "_value", [F.col("visit_at"), F.col("booking")], self.attribute)
        return out.select(*self.people.columns)

    def outputs(self) -> dict[str, DataFrame]:
        return {"bookings": self.booking_rows.drop(ACTION), "people": self.people_rows}


class Published:
    """Several tables that change together: a version is visible when all of its tables are written.

    Each table of a version goes to a folder of its own; the last write is the small list of these folders.
    Readers follow the newest complete list, so a job that is lost in between leaves the version before.
    """

    def __init__(self, spark: SparkSession, home: str) -> None:
        self.spark = spark
        self.lists = BatchFolders(spark, f"{home.rstrip('/')}/versions", spark.createDataFrame([], "name string, path string").schema)

    def publish(self, tables: Mapping[str, DataFrame]) -> int:
        """Write a version; tables it does not name stay as they are. Its number."""
        paths = dict(self.paths())
        for name, df in tables.items():
            paths[name] = new_run_folder(self.spark, name)
            df.write.parquet(paths[name])
        number = max(self.lists.complete(), default=-1) + 1
        self.lists.write(self.spark.createDataFrame(sorted(paths.items()), self.lists.schema).coalesce(1), number)
        return number

    def paths(self, version: int | None = None) -> dict[str, str]:
        known = self.lists.complete()
        if version is None and not known:
            return {}
        rows = self.spark.read.schema(self.lists.schema).parquet(self.lists.folder(known[-1] if version is None else version))
        return {r.name: r.path for r in rows.collect()}

    def read(self, name: str, version: int | None = None) -> DataFrame:
        return self.spark.read.parquet(self.paths(version)[name])
