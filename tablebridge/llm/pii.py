"""Personal data in texts: base rules, overlapping candidates, boosted trees and calibrated thresholds.

Built-in functions only. Trees and thresholds rest on the candidates of all documents, counted and summed by Spark.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from tablebridge.llm.boosting import Trees, train_table, walk
from tablebridge.llm.staging import stage

KINDS = ("email", "ip", "card", "phone")
#: A private-use character marks matches; one in a text is swapped for another of the same length, which no pattern knows either.
MARK, OTHER = "\ue000", "\ue001"
#: The base patterns, as possessive forms that find the same matches without trying a run of characters twice.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Generators of further candidates: anything like an address, also a written-out one, and any number of 7 or more digits.
WIDER = {
    "address": r"(?:\G|(?<![\p{L}0-9._%+-]))[\p{L}0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[\p{L}0-9-]++(?:(?:\.|\x20?(?:\(dot\)|\[dot\])\x20?)[\p{L}0-9-]++)++",
    "number": r"(?<![\p{L}0-9])[+(]?[0-9](?:[\x20().\-/]{0,2}[0-9]){6,}+",
}
#: A text without this holds no match.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9][\x20-]?[0-9]", "phone": r"\+[0-9]", "address": r"@|[(\[]at[)\]]", "number": r"[0-9][\x20().\-/]{0,2}[0-9]"}
PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
#: Words before a candidate that speak for a kind, in the languages of the corpus.
HINTS = (
    r"(?i)(?:tel|phone|call|fax|mobile|handy|ruf|appel|llam)[a-z.éó]*[\s:#-]*$",
    r"(?i)(?:card|visa|karte|carte|tarjeta|credit|kredit)[a-z]*[\s:#-]*$",
    r"(?i)(?:mail|contact|kontakt|correo|courriel)[a-z]*[\s:#-]*$",
)
#: Size of the trees, precision asked of a threshold and cases it must rest on, steps of a threshold in one unit of log-odds.
TREES, DEPTH, PRECISION, CASES, STEPS = 16, 3, 0.95, 20, 10_000


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once."""
    return F.transform(F.array(value), body)[0]


def digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def luhn(d: Column) -> Column:
    """Whether the checksum of a string of 1 to 19 digits holds."""

    def add(total: Column, i: Column) -> Column:
        n = F.substring(d, -i, F.lit(1)).cast("int")
        doubled = F.when(n > 4, 2 * n - 9).otherwise(2 * n)
        return total + F.when(i % 2 == 0, doubled).otherwise(n)

    return F.aggregate(F.sequence(F.lit(1), F.length(d)), F.lit(0), add) % 10 == 0


def is_valid(kind: str, x: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return x.rlike(rf"^{PART}(?:\.{PART}){{3}}$")
    if kind == "phone":
        return F.length(digits(x)).between(9, 15)
    return let(digits(x), lambda d: F.when(F.length(d).between(13, 19), luhn(d)).otherwise(False))


def count_of(x: Column, chars: str) -> Column:
    return F.length(x) - F.length(F.translate(x, chars, ""))


def features(x: Column, before: Column, after: Column) -> Column:
    """Format and context of a candidate; what makes a base phone (its plus sign and country code) is not among them."""
    d, groups = digits(x), F.array_remove(F.split(x, "[^0-9]+"), "")
    found = [
        F.length(d), F.length(x), F.size(groups), F.coalesce(F.array_max(F.transform(groups, F.length)), F.lit(0)), F.coalesce(F.length(F.try_element_at(groups, F.lit(-1))), F.lit(0)),
        F.coalesce(F.length(F.try_element_at(groups, F.lit(-2))), F.lit(0)), count_of(x, "."), count_of(x, " "), count_of(x, "-"), count_of(x, "()"), count_of(x, "@"),
        let(d, lambda n: F.when(F.length(n).between(13, 19), luhn(n)).otherwise(False)).cast("int"), x.rlike(rf"^{PART}(?:\.{PART}){{3}}$").cast("int"),
        *(before.rlike(h).cast("int") for h in HINTS),
        before.rlike(r"[\p{L}0-9]$").cast("int"), after.rlike(r"^[\p{L}0-9]").cast("int"), before.rlike("[=\"'/_]$").cast("int"),
    ]
    return F.array(*(f.cast("double") for f in found))


def kind_of(x: Column) -> Column:
    """The kind that a wider candidate would be."""
    n = F.length(digits(x))
    return F.when(x.rlike(r"@|at[)\]]"), F.lit("email")).when(x.rlike(r"^[0-9]+(?:\.[0-9]+){3}$"), F.lit("ip")).when(n >= 13, F.lit("card")).otherwise(F.lit("phone"))


def matches(text: Column, name: str, pattern: str, row: Callable[[Column, Column, Column, Column], Column], keep: Callable[[Column], Column], kind: str) -> Column:
    """Leftmost non-overlapping matches that `keep` accepts, as row(match, start, 24 characters before, 1 after).

    One replacement marks the matches, one split cuts the text at the marks, and one fold counts the
    code points up to each piece.
    """
    cut = F.split(F.regexp_replace(F.translate(text, MARK, OTHER), pattern, f"{MARK}$0{MARK}"), MARK)

    def fold(parts: Column) -> Column:
        def step(acc: Column, piece: Column) -> Column:
            own = row(piece, acc["at"], F.right(F.element_at(parts, acc["n"]), F.lit(24)), F.left(F.element_at(parts, acc["n"] + 2), F.lit(1)))
            found = F.when((acc["n"] % 2 == 1) & keep(piece), F.array_append(acc["found"], own)).otherwise(acc["found"])
            return F.struct((acc["at"] + F.length(piece)).alias("at"), (acc["n"] + 1).alias("n"), found.alias("found"))

        start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("n"), F.from_json(F.lit("[]"), kind).alias("found"))
        return F.aggregate(parts, start, step, lambda acc: acc["found"])

    return F.when(text.rlike(NEEDS[name]), let(cut, fold)).otherwise(F.from_json(F.lit("[]"), kind))


SPAN = "array<struct<rank:int,start:int,end:int>>"
CANDIDATE = "array<struct<kind:string,start:int,end:int,x:array<double>>>"


def base_spans(text: Column) -> Column:
    """The spans of the base rules, by kind in the order of `KINDS`, then start."""

    def of(rank: int, kind: str) -> Column:
        row = lambda x, at, *_: F.struct(F.lit(rank).alias("rank"), at.alias("start"), (at + F.length(x)).alias("end"))
        return matches(text, kind, BASE[kind], row, lambda x: is_valid(kind, x), SPAN)

    return F.concat(*(of(i, k) for i, k in enumerate(KINDS)))


def candidates(text: Column) -> Column:
    """What the wider generators propose, with features; proposals overlap each other and base spans."""
    row = lambda x, at, before, after: F.struct(kind_of(x).alias("kind"), at.alias("start"), (at + F.length(x)).alias("end"), features(x, before, after).alias("x"))
    return F.concat(*(matches(text, name, pattern, row, lambda x: F.lit(True), CANDIDATE) for name, pattern in WIDER.items()))


@dataclass(frozen=True)
class Selector:
    """Trees and the log-odds above which a candidate of a kind is selected (infinite: none is)."""

    trees: Trees
    threshold: dict[str, float]

    def margin(self, x: Column) -> Column:
        total = F.lit(self.trees.base)
        for t in range(len(self.trees.leaf)):
            total = total + walk(x, self.trees.feature[t], self.trees.threshold[t], lambda k, t=t: F.lit(float(self.trees.leaf[t, k])))
        return total

    def selects(self, candidate: Column) -> Column:
        if not any(np.isfinite(t) for t in self.threshold.values()):
            return F.lit(False)
        least = F.lit(float("inf"))
        for kind, t in self.threshold.items():
            least = F.when(candidate["kind"] == kind, F.lit(float(t))).otherwise(least)
        return self.margin(candidate["x"]) >= least


def overlaps(one: Column, others: Column) -> Column:
    return F.exists(others, lambda o: (o["start"] < one["end"]) & (one["start"] < o["end"]))


def cases(docs: DataFrame) -> DataFrame:
    """(kind, x, aside) -> (n, positive): how many candidates of all documents look like this and how many of them overlap a base span.

    Every fourth document by the hash of its id is set aside.
    """
    spans = docs.where("text is not null").select("doc_id", base_spans(F.col("text")).alias("base"), candidates(F.col("text")).alias("found"))
    each = spans.select((F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("aside"), "base", F.explode("found").alias("c"))
    rows = each.select("c.kind", "c.x", "aside", overlaps(F.col("c"), F.col("base")).cast("long").alias("y"))
    return rows.groupBy("kind", "x", "aside").agg(F.count("*").alias("n"), F.sum("y").alias("positive"))


def fit(docs: DataFrame) -> Selector:
    """Trees and thresholds from the candidates of all documents.

    A candidate counts as personal if it overlaps a base span. Three quarters of the documents grow
    the trees. On the others each kind's threshold is the lowest above which at least PRECISION of
    the candidates, and at least CASES of them, are personal; a kind without such a value selects none.
    Spark counts and sums; the driver gets histograms, and one threshold a kind.
    """
    counted = stage(cases(docs), "candidates")
    trees = train_table(counted.where("not aside"), TREES, DEPTH)
    scored = counted.where("aside").select("kind", F.floor(Selector(trees, {}).margin(F.col("x")) * STEPS).alias("step"), "n", "positive")
    above = W.partitionBy("kind").orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    sums = scored.groupBy("kind", "step").agg(F.sum("n").alias("n"), F.sum("positive").alias("positive"))
    sums = sums.select("kind", "step", F.sum("n").over(above).alias("n"), F.sum("positive").over(above).alias("positive"))
    threshold = dict.fromkeys(KINDS, float("inf"))
    for r in sums.where(f"n >= {CASES} and positive >= {PRECISION} * n").groupBy("kind").agg(F.min("step").alias("step")).collect():
        threshold[r.kind] = r.step / STEPS - 1e-6  # a quotient may differ in its last bits
    return Selector(trees, threshold)


def find(docs: DataFrame, selector: Selector) -> DataFrame:
    """All columns of docs and base_spans, all_spans: arrays of (rank of the kind, start, end), in code points.

    Base spans stay whatever the trees say. A selected candidate is added unless it overlaps one. Both
    arrays are in the order of kinds, then start; a null text has none.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rank = lambda c: F.array_position(F.array(*map(F.lit, KINDS)), c["kind"]).cast("int") - 1

    def both(base: Column) -> Column:
        added = F.filter(candidates(text), lambda c: ~overlaps(c, base) & selector.selects(c))
        more = F.transform(added, lambda c: F.struct(rank(c).alias("rank"), c["start"].alias("start"), c["end"].alias("end")))
        return F.struct(base.alias("base"), F.array_sort(F.array_distinct(F.concat(base, more))).alias("every"))

    return docs.withColumn("spans", let(base_spans(text), both)).select("*", F.col("spans.base").alias("base_spans"), F.col("spans.every").alias("all_spans")).drop("spans")


def written(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans), one row per row; counts are of base spans.

    Null and empty texts have no span. Repeated rows and null ids stay. Other columns are not read.
    An empty table gives an empty one.
    """
    found = find(docs.select("doc_id", "text"), fit(docs))
    count = lambda i: F.size(F.filter("base_spans", lambda s: s["rank"] == i)).cast("long")
    counts = [count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(written(F.col("base_spans")), 256).alias("base_sha256"), written(F.col("all_spans")).alias("spans"))


def redact(docs: DataFrame, selector: Selector) -> DataFrame:
    """The same rows and columns with every span of `text` replaced by its kind in brackets; null texts stay null.

    Of overlapping spans the first one (the longer one of those that begin together) gives the name,
    and the stretch they cover together is replaced.
    """

    def masked(spans: Column, text: Column) -> Column:
        ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["rank"].alias("rank"))))

        def step(acc: Column, s: Column) -> Column:
            name = F.concat(F.lit("["), F.upper(F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1)), F.lit("]"))
            more = F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), name))
            return F.struct(F.greatest(acc["at"], -s["back"]).alias("at"), F.when(s["start"] >= acc["at"], more).otherwise(acc["out"]).alias("out"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(ordered, start, step, lambda acc: F.array_join(F.concat(acc["out"], F.array(F.substring(text, acc["at"] + 1, F.length(text)))), ""))

    found = find(docs, selector)
    text = F.when(F.size("all_spans") > 0, masked(F.col("all_spans"), F.col("text"))).otherwise(F.col("text"))
    return found.withColumn("text", text).select(*docs.columns)
