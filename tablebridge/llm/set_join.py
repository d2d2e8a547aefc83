"""Exact Jaccard join of word n-gram sets: a partition of the universe, pigeonholed; candidates sketched, then verified."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tablebridge.llm.components import components
from tablebridge.llm.staging import rows_of, stage

#: Words of a shingle. Sets link at 100 * intersection >= 90 * union, which is 19 * difference <= sum of both sizes.
WORDS, SHARE = 3, 19
#: Price of one row of an index, in compared pairs.
ROW_PRICE = 4
#: 64-bit words of the largest sketch; a larger set has a weaker filter before it is verified.
SKETCH = 64
MIX = np.uint64(0x9E3779B97F4A7C15)
TURNS = np.uint64(29), np.uint64(32)
PLACE, CONTENT, BAND = np.uint64(0x51), np.uint64(0xC3), np.uint64(1 << 40)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> TURNS[0]) * MIX
    return x ^ x >> TURNS[1]


@lru_cache(1 << 18)
def word_hash(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shingles(text: str | None) -> np.ndarray:
    """64 bits of each distinct shingle, sorted; A-Z count as a-z, fewer words than WORDS are one shingle, none are none."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    one = np.array([word_hash(w) for w in words], np.uint64)
    n = min(WORDS, len(one))
    out = np.full(max(0, len(one) - n + 1) if n else 0, n, np.uint64)
    for i in range(n):
        out = mixed(out) + one[i : len(one) - n + 1 + i]
    return np.unique(mixed(out))


@lru_cache(1)
def bands() -> np.ndarray:
    """The least size of each band; a band's largest size is at most 10/9 of its least."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * 10 // 9))
    return np.array(out)


def most_unlike(band: int) -> int:
    """The largest difference of two linked sets of which the smaller is in the band."""
    largest = int(bands()[band + 1]) - 1
    return (largest + largest * 10 // 9) // SHARE


def bands_of(n: int) -> list[int]:
    """The band of a set's size and, where a smaller set in the band below can link with it, that one. Bands that link equal sets only are left out."""
    own = int(np.searchsorted(bands(), n, "right")) - 1
    below = [own - 1] * (own > 0 and 9 * n <= 10 * (int(bands()[own]) - 1))
    return [b for b in [own, *below] if n and most_unlike(b)]


def segments(found: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment of each shingle, its share of a content hash, content hash of each segment). Contents are sums, so a deletion is a subtraction."""
    m = most_unlike(band) + 1
    at = (mixed(found + PLACE) >> np.uint64(16)) % np.uint64(m)
    share = mixed(found ^ CONTENT)
    content = np.zeros(m, np.uint64)
    np.add.at(content, at.astype(np.int64), share)
    return at.astype(np.int64), share, content


def keyed(content: np.ndarray, segment: np.ndarray, band: int) -> np.ndarray:
    return mixed(mixed(content) + segment.astype(np.uint64) + np.uint64(band) * BAND).view(np.int64)


def signature(found: np.ndarray, band: int, spent: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the contents of segments that are given 1 or 2, and of all contents without one shingle of those given 2."""
    at, share, content = segments(found, band)
    numbers = np.arange(len(content))
    double = spent[at] == 2
    return keyed(content, numbers, band)[spent > 0], keyed((content[at] - share)[double], at[double], band)


def sketch(found: np.ndarray, band: int) -> np.ndarray:
    """Bits that count shingles modulo 2, some eight a difference allowed: sets differ at least as much as their sketches."""
    return parity(found, min(SKETCH, 1 << (most_unlike(band) // 8).bit_length()))


def parity(found: np.ndarray, words: int) -> np.ndarray:
    """64 * words bits (words: a power of two), each telling whether an odd number of members falls on it."""
    at = mixed(found + MIX) >> np.uint64(20) & np.uint64(64 * words - 1)
    odd = np.flatnonzero(np.bincount(at.astype(np.int64), minlength=64 * words) & 1)
    out = np.zeros(words, np.uint64)
    np.bitwise_or.at(out, odd // 64, np.uint64(1) << (odd % 64).astype(np.uint64))
    return out.view(np.int64)


def sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_shingles, point, keys): a digest of the set, and per band the keys of all segments; one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            sizes, points, keys = [], [], []
            for text in b.column(1).to_pylist():
                found = shingles(text)
                sizes.append(len(found))
                points.append(xxhash.xxh3_64_intdigest(found.tobytes()))
                keys.append([{"band": x, "keys": signature(found, x, np.ones(most_unlike(x) + 1, np.int8))[0]} for x in bands_of(len(found))])
            kind = pa.list_(pa.struct([("band", pa.int32()), ("keys", pa.list_(pa.int64()))]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(np.array(points, np.uint64).view(np.int64)), pa.array(keys, kind)], ["doc_id", "n_shingles", "point", "keys"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, point long, keys array<struct<band int, keys array<long>>>")


def spending(shared: DataFrame) -> DataFrame:
    """(band, segment, n, pairs) -> (band, spent): 0, 1 or 2 for each segment, in all one more than the difference allowed.

    Where linked sets differ in at most H shingles, some segment that is given v differs in at most v - 1, else
    they would differ in H + 1. At first each of the H + 1 segments is given 1. A segment whose contents many
    sets share passes its 1 on to a cheap one, as long as its pairs cost more than the cheap one's deletions.
    """

    def one(rows: pd.DataFrame) -> pd.DataFrame:
        band, points = int(rows.band.iloc[0]), int(rows.points.iloc[0])
        m = most_unlike(band) + 1
        pairs = np.zeros(m)
        pairs[rows.segment.to_numpy()] = rows.pairs.to_numpy()
        spent = np.ones(m, np.int8)
        deletions = ROW_PRICE * points * (1 + bands()[band] / m)
        order = np.argsort(-pairs, kind="stable")
        for dear, cheap in zip(order[: m // 2], order[::-1], strict=False):
            if pairs[dear] + pairs[cheap] > deletions + 2 * pairs[cheap]:
                spent[dear], spent[cheap] = 0, 2
        return pd.DataFrame({"band": [band], "spent": [spent.tolist()]})

    return shared.groupBy("band").applyInPandas(one, "band int, spent array<int>")


def texts_of(docs: DataFrame, points: DataFrame) -> DataFrame:
    """The shingles of the given points (point, first_id), one row each: (point, n, shingles). Only rows with those ids, or without one, are read again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, at_most=256):
            found = [shingles(t) for t in b.column(1).to_pylist()]
            digests = np.array([xxhash.xxh3_64_intdigest(x.tobytes()) for x in found], np.uint64).view(np.int64)
            columns = [pa.array(digests), pa.array([len(x) for x in found], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["point", "n", "shingles"])

    some = docs.select("doc_id", "text")
    named = some.join(points.select(F.col("first_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    raw = named.unionByName(some.where("doc_id is null")).mapInArrow(run, "point long, n long, shingles binary")
    return raw.join(points.select("point"), "point", "left_semi").dropDuplicates(["point"])


def signatures(raw: DataFrame) -> DataFrame:
    """(point, shingles, plans, n) -> (point, n, shingles, bands): the set itself and, per band, its sketch, keys and deletion keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, at_most=256):
            out = []
            for data, plans in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                found = np.frombuffer(data, np.uint64)
                parts = [(p["band"], sketch(found, p["band"]), *signature(found, p["band"], np.array(p["spent"]))) for p in plans]
                out.append([dict(zip(("band", "sketch", "whole", "less"), p, strict=True)) for p in parts])
            kind = pa.list_(pa.struct([("band", pa.int32()), *((n, pa.list_(pa.int64())) for n in ("sketch", "whole", "less"))]))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(3), b.column(1), pa.array(out, kind)], ["point", "n", "shingles", "bands"])

    form = "point long, n long, shingles binary, bands array<struct<band int, sketch array<long>, whole array<long>, less array<long>>>"
    return raw.select("point", "shingles", "plans", "n").mapInArrow(run, form)


def close(a: str, b: str) -> Column:
    """Whether two sketched sets may link: their sketches, and so they, may not differ too much. Never false for linked sets."""
    bits = F.aggregate(F.zip_with(f"sketch_{a}", f"sketch_{b}", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    sizes = F.col(f"n_{a}") + F.col(f"n_{b}")
    return (SHARE * F.abs(F.col(f"n_{a}") - F.col(f"n_{b}")) <= sizes) & (SHARE * bits <= sizes)


def verified(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """Of distinct pairs of points (a, b) those whose sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                both = np.concatenate([np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)])
                both.sort(kind="stable")
                keep.append(SHARE * (len(both) - 2 * int((both[1:] == both[:-1]).sum())) <= len(both))
            yield b.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    of = lambda c: known.select(F.col("point").alias(c), F.col("shingles").alias(f"set_{c}")).hint("merge")
    return pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(run, "a long, b long")


def links(members: DataFrame, known: DataFrame) -> DataFrame:
    """members (key, band, point, less) -> (a, b): links enough to join all linked points, and no others.

    First every member of a key meets one of its members only, another one in each key, so that a large group
    of near copies costs its size. Then members meet if no chain of links joins them yet and their sketches
    allow a link. Contents that both lack a shingle need not meet.
    """
    sized = known.select("point", "n", F.explode("bands").alias("b")).select("point", "n", "b.band", "b.sketch")
    side = lambda c: sized.select("band", F.col("point").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}")).hint("merge")
    head = F.min(F.when(~F.col("less"), F.struct(F.xxhash64("point", "key").alias("h"), "point")))["point"]
    heads = members.groupBy("key").agg(head.alias("head"), F.count("*").alias("n")).where("n > 1 and head is not null").select("key", "head")
    shared = stage(members.join(heads.hint("merge"), "key"), "members")
    ordered = lambda x, y: (F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))
    stars = shared.where("point <> head").select("band", *ordered("head", "point")).distinct()
    near = stars.join(side("a"), ["band", "a"]).join(side("b"), ["band", "b"]).where(close("a", "b")).select("a", "b").distinct()
    found = stage(verified(stage(near, "stars"), known), "links")
    roots = components(found)
    owned = shared.join(roots.select(F.col("node").alias("point"), "root").hint("merge"), "point", "left").select("key", "band", "point", "less", F.coalesce("root", "point").alias("own"))
    owned = stage(owned, "owned")
    mixed_keys = owned.groupBy("key").agg(F.min("own").alias("one"), F.max("own").alias("two")).where("one <> two").select("key")
    open_ = stage(owned.join(mixed_keys.hint("merge"), "key").join(sized, ["band", "point"]), "open")
    end = lambda c: open_.select("key", *(F.col(n).alias(f"{n}_{c}") for n in ("point", "less", "own", "n", "sketch")))
    apart = (F.col("own_x") != F.col("own_y")) & ~F.col("less_x") & (F.col("less_y") | (F.col("point_x") < F.col("point_y")))
    rest = end("x").hint("merge").join(end("y"), "key").where(apart & close("x", "y")).select(*ordered("point_x", "point_y")).distinct()
    return found.unionByName(stage(verified(stage(rest.join(found, ["a", "b"], "left_anti"), "rest"), known), "links"))


def linked(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_shingles, component_id), one row per row of the input.

    Equal sets are one point. A first pass counts how many points share each segment's content; points that
    share none link with nothing. The others' signatures follow what each band's segments cost (`spending`).
    component_id is the smallest doc_id reachable by links. Null texts and texts without words have no
    shingles and their own doc_id; rows with a null doc_id take part and do not count for the minimum, so a
    component of such rows alone has a null id. Repeated rows stay. Other columns are not read. Shingles are
    known by 64 bits of a hash. An empty table gives an empty one.
    """
    rows = stage(sets(docs), "sets")
    points = stage(rows.where("n_shingles > 0").groupBy("point").agg(F.min("doc_id").alias("first_id"), F.first("keys").alias("keys")), "points")
    entries = points.select("point", F.explode("keys").alias("k")).select("point", "k.band", F.posexplode("k.keys").alias("segment", "key"))
    counts = entries.groupBy("key").agg(F.count("*").alias("n"), F.min("band").alias("band"), F.min("segment").alias("segment"))
    shared = stage(counts.where("n > 1"), "shared")
    alive = stage(entries.join(shared.select("key"), "key", "left_semi").select("point", "band").distinct(), "alive")
    per_band = alive.groupBy("band").agg(F.count("*").alias("points"))
    costs = shared.groupBy("band", "segment").agg(F.sum(F.col("n") * (F.col("n") - 1) / 2).alias("pairs")).join(per_band, "band")
    plans = stage(spending(costs), "plans")
    asked = stage(alive.join(plans, "band").groupBy("point").agg(F.collect_list(F.struct("band", "spent")).alias("plans")), "asked")
    raw = stage(texts_of(docs, points.select("point", "first_id").join(asked.select("point"), "point", "left_semi")), "alive")
    known = stage(signatures(raw.join(asked, "point")), "signatures")
    each = known.select("point", F.explode("bands").alias("b"))
    keys = lambda c, less: each.select("point", "b.band", F.explode(f"b.{c}").alias("key"), F.lit(less).alias("less"))
    roots = components(links(keys("whole", False).unionByName(keys("less", True)), known))
    rooted = points.select("point", "first_id").join(roots.select(F.col("node").alias("point"), "root"), "point")
    least = stage(rooted.groupBy("root").agg(F.min("first_id").alias("least_id")), "least")
    moved = stage(rooted.join(least, "root").select("point", "least_id", F.lit(True).alias("moved")), "moved")
    ids = stage(points.select("point", "first_id").join(moved, "point", "left").select("point", F.when(F.col("moved"), F.col("least_id")).otherwise(F.col("first_id")).alias("component_id")), "ids")
    found = rows.join(ids, "point", "left")
    return found.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
