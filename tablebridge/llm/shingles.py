"""Near copies by the Jaccard similarity of word shingles: candidates by SimHash links and min-hash bands, every candidate verified exactly."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from tablebridge.llm import simhash
from tablebridge.llm.components import components
from tablebridge.llm.set_join import parity
from tablebridge.llm.staging import rows_of, stage

#: Words of a shingle and the least similarity of near copies, as a fraction of whole numbers.
WORDS, LEAST = 5, (4, 5)
#: Two texts meet if all ROWS minima of one of BANDS agree: at similarity 0.8 all but 0.59 ** 24 = 3 in a million pairs do, above it more.
BANDS, ROWS = 24, 4
#: Sets are near copies if MORE * difference <= LESS * sum of sizes; 64-bit words of the largest sketch (larger sets have a weaker filter).
LESS, MORE = LEAST[1] - LEAST[0], LEAST[1] + LEAST[0]
SKETCH = 128
MIX, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
FACTORS = np.random.default_rng(11).integers(0, 2**63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


def shingles(text: str | None) -> frozenset[tuple[str, ...]]:
    """The distinct runs of WORDS words; fewer words are one shingle, no words are none."""
    words = words_of(text)
    return frozenset(zip(*(words[i:] for i in range(WORDS)), strict=False)) if len(words) >= WORDS else frozenset([tuple(words)] * bool(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> TURN) * MIX
    return x ^ x >> TURN


def hashes(text: str | None) -> np.ndarray:
    """64 bits of each distinct shingle, sorted."""
    digest = xxhash.xxh3_64_intdigest
    one = np.array([digest(w.encode("utf-8", "surrogatepass")) for w in words_of(text)], np.uint64)
    n = min(WORDS, len(one))
    out = np.zeros(len(one) - n + 1 if n else 0, np.uint64)
    for i in range(n):
        out = mixed(out) + one[i : len(one) - n + 1 + i]
    return np.unique(mixed(out))


def sketch(text: str | None) -> tuple[int, np.ndarray, int, np.ndarray]:
    """A digest of the set of shingles, the key of each band, the size, and some 32 bits a difference allowed that count shingles modulo 2."""
    found = hashes(text)
    low = np.full(BANDS * ROWS, np.uint64(2**64 - 1))
    for i in range(0, len(found), 4096):
        low = np.minimum(low, (found[i : i + 4096, None] * FACTORS).min(axis=0))
    keys = np.arange(BANDS, dtype=np.uint64)
    for k in low.reshape(BANDS, ROWS).T:
        keys = mixed(keys) + k
    words = min(SKETCH, 1 << (len(found) * LESS // MORE).bit_length())
    return xxhash.xxh3_64_intdigest(found.tobytes()), mixed(keys), len(found), parity(found, words)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp, point, bands, n, bits), one row per row; fp is the SimHash fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            texts = b.column(1).to_pylist()
            prints, found = pa.array([simhash.fingerprint(t) for t in texts], pa.int64()), [sketch(t) for t in texts]
            points = pa.array(np.array([f[0] for f in found], np.uint64).view(np.int64))
            bands = pa.array([f[1].view(np.int64) for f in found], pa.list_(pa.int64()))
            rest = [pa.array([f[2] for f in found], pa.int64()), pa.array([f[3] for f in found], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), prints, points, bands, *rest], ["doc_id", "fp", "point", "bands", "n", "bits"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long, point long, bands array<long>, n long, bits array<long>")


def simhash_pairs(known: DataFrame) -> DataFrame:
    """(fp, point) -> (a, b): the points of a fingerprint meet its least point; these meet along the links of the fingerprints.

    Links are those of `simhash.links`, at 2 or fewer bits. Pairs grow with points and links, however many points share a fingerprint.
    """
    prints = stage(known.groupBy("fp").agg(F.min("point").alias("head")), "prints")
    own = known.select("fp", "point").distinct().join(prints.hint("merge"), "fp").select(F.col("head").alias("x"), F.col("point").alias("y"))
    head = lambda c, n: prints.select(F.col("fp").alias(c), F.col("head").alias(n)).hint("merge")
    linked = stage(simhash.links(prints), "prints_linked").join(head("a", "x"), "a").join(head("b", "y"), "b").select("x", "y")
    return own.unionByName(linked).where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (point, pack): the text of each point, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3).compress
        for b in rows_of(batches):
            texts = b.column(1).to_pylist()
            points = np.array([xxhash.xxh3_64_intdigest(hashes(t).tobytes()) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(points), pa.array([squeeze((t or "").encode("utf-8", "surrogatepass")) for t in texts], pa.binary())], ["point", "pack"])

    return docs.select("doc_id", "text").mapInArrow(run, "point long, pack binary")


def similar(one: frozenset, two: frozenset) -> bool:
    """Whether the Jaccard similarity reaches LEAST; sets without shingles are like each other only."""
    both = len(one & two)
    return LEAST[1] * both >= LEAST[0] * (len(one) + len(two) - both)


def verified(pairs: DataFrame, docs: DataFrame, points: DataFrame) -> DataFrame:
    """Of pairs of points (a, b) those whose texts are similar enough. Only texts that a pair names are read and moved."""
    asked = pairs.select(F.col("a").alias("point")).unionByName(pairs.select(F.col("b").alias("point"))).distinct()
    named = points.join(asked, "point", "left_semi").select(F.col("first_id").alias("doc_id")).distinct()
    packs = stage(packed(docs.join(named, "doc_id", "left_semi")).groupBy("point").agg(F.first("pack").alias("pack")), "packs")
    with_b = pairs.join(packs.select(F.col("point").alias("b"), F.col("pack").alias("pack_b")).hint("merge"), "b")
    both = with_b.join(packs.select(F.col("point").alias("a"), F.col("pack").alias("pack_a")).hint("merge"), "a")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        of = lru_cache(64)(lambda pack: shingles(open_(pack).decode("utf-8", "surrogatepass")))  # rows come in the order of a
        for b in batches:
            yield b.select([0, 1]).filter(pa.array([similar(of(x), of(y)) for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True)], pa.bool_()))

    return both.select("a", "b", "pack_a", "pack_b").mapInArrow(run, "a long, b long")


def close(x: str, y: str) -> str:
    """Whether two points may be near copies: sets differ at least as much as their sketches. Never false for near copies.

    A sketch of twice the length is folded first. Near copies' sketches differ in length by no more than that.
    """
    half = lambda b: f"zip_with(slice({b}, 1, size({b}) div 2), slice({b}, size({b}) div 2 + 1, size({b}) div 2), (p, q) -> p ^ q)"
    fit = lambda a, b: f"if(size(bits_{a}) > size(bits_{b}), {half('bits_' + a)}, bits_{a})"
    unlike = f"aggregate(zip_with({fit(x, y)}, {fit(y, x)}, (p, q) -> bit_count(p ^ q)), 0, (s, p) -> s + p)"
    sizes = f"{LESS} * (n_{x} + n_{y})"
    return f"{MORE} * abs(n_{x} - n_{y}) <= {sizes} and coalesce({MORE} * {unlike} <= {sizes}, true)"


def least_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, text), ids not null -> (doc_id): the least id of each group of near copies.

    Groups are the components of all pairs that reach LEAST among those that SimHash links (see `simhash_pairs`)
    and those that share a band. Texts of one set of shingles are one point. Every point of a band's bucket meets one point of it, another one in each
    bucket; then points of a bucket meet that no chain of links joins yet. Points meet by their sketches;
    only pairs that these allow become rows and are verified. A bucket of near copies costs its size;
    unlike points that share a bucket cost a comparison of sketches each.
    """
    known = stage(sketches(docs), "sketches")
    points = stage(known.groupBy("point").agg(F.min("doc_id").alias("first_id"), F.first("bands").alias("bands"), F.first("n").alias("n"), F.first("bits").alias("bits")), "points")
    keys = points.select("point", F.explode("bands").alias("band"))
    heads = keys.groupBy("band").agg(F.min(F.struct(F.xxhash64("point", "band").alias("h"), "point"))["point"].alias("head"), F.count("*").alias("n")).where("n > 1").select("band", "head")
    members = stage(keys.join(stage(heads, "heads").hint("merge"), "band"), "members")
    side = lambda c: points.select(F.col("point").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")).hint("merge")
    stars = members.where("point <> head").select(F.least("head", "point").alias("a"), F.greatest("head", "point").alias("b"))
    stars = stars.unionByName(simhash_pairs(known)).distinct()
    near = stage(stars.join(side("a"), "a").join(side("b"), "b").where(close("a", "b")).select("a", "b"), "stars")
    links = stage(verified(near, docs, points), "links")
    roots = stage(components(links), "roots")
    owned = members.join(roots.withColumnRenamed("node", "point").hint("merge"), "point", "left").select("band", "point", F.coalesce("root", "point").alias("own"))
    owned = stage(owned, "owned")
    open_bands = owned.groupBy("band").agg(F.min("own").alias("one"), F.max("own").alias("two")).where("one <> two").select("band")
    open_ = stage(owned.join(open_bands.hint("merge"), "band").join(points.select("point", "n", "bits"), "point"), "open")
    end = lambda c: open_.select("band", *(F.col(x).alias(f"{x}_{c}") for x in ("point", "own", "n", "bits"))).hint("merge")
    rest = end("x").join(end("y"), "band").where(f"own_x <> own_y and point_x < point_y and {close('x', 'y')}").select(F.col("point_x").alias("a"), F.col("point_y").alias("b")).distinct()
    more = stage(verified(stage(rest.join(near, ["a", "b"], "left_anti"), "rest"), docs, points), "links")
    if not more.isEmpty():
        roots = components(links.unionByName(more))
    found = points.select("point", "first_id").join(roots.withColumnRenamed("node", "point").hint("merge"), "point", "left")
    return found.groupBy(F.coalesce("root", "point").alias("root")).agg(F.min("first_id").alias("doc_id")).select("doc_id").distinct()
