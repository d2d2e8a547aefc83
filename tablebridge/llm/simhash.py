"""SimHash near-duplicates by anchor points of a covering code."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from tablebridge.llm.components import components
from tablebridge.llm.staging import rows_of, stage

WORDS, SEED, THRESHOLD = 3, 42, 2
#: The binary Golay code: 23 bits, 4096 code words, every word within 3 bits of exactly one of them.
LENGTH, RADIUS = 23, 3
#: Its generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 (a fixed value of the code).
GENERATOR = 0b110001110101
BLOCKS = 2


def fingerprint(text: str | None) -> int:
    """64 bits, signed; a bit is set if it is set in over half the hashes of the word shingles.

    Lower-cases A-Z only. Fewer words than a shingle: the whole sequence is the only shingle. No
    word (also a null text): zero. Repeated shingles count as often as they occur.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = map(b" ".join, zip(*(words[i:] for i in range(WORDS)), strict=False)) if len(words) >= WORDS else [b" ".join(words)]
    digest = xxhash.xxh64_digest
    hashes = np.frombuffer(b"".join([digest(s, SEED) for s in shingles]), np.uint8).reshape(-1, 8)
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 16384):
        counts += np.unpackbits(hashes[i : i + 16384], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text) of any rows -> (doc_id, fp), one row per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches):
            fp = pa.array([fingerprint(x) for x in b.column(1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), fp], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


@lru_cache(1)
def golay() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Error patterns up to 3 * 2 + 2 bits by syndrome, then weight; their offsets and counts [syndrome, weight]."""
    most = BLOCKS * RADIUS + THRESHOLD
    syndrome = np.zeros(LENGTH, np.int64)
    for i in range(LENGTH):
        v = 1 << i
        for k in range(i, 10, -1):
            if v >> k & 1:
                v ^= GENERATOR << (k - 11)
        syndrome[i] = v
    value, last, syn = (np.array([x], np.int64) for x in (0, -1, 0))
    levels = [(value, syn)]
    for _ in range(most):
        grown = [(value[last < i] | 1 << i, np.full((last < i).sum(), i), syn[last < i] ^ syndrome[i]) for i in range(LENGTH)]
        value, last, syn = (np.concatenate(x) for x in zip(*grown, strict=True))
        levels.append((value, syn))
    value = np.concatenate([v for v, _ in levels])
    syn = np.concatenate([s for _, s in levels])
    weight = np.concatenate([np.full(len(v), w) for w, (v, _) in enumerate(levels)])
    order = np.lexsort((value, weight, syn))
    counts = np.zeros((2048, most + 1), np.int64)
    np.add.at(counts, (syn, weight), 1)
    offsets = np.concatenate([[0], np.cumsum(counts.ravel())[:-1]]).reshape(counts.shape)
    return value[order], offsets, counts


@lru_cache(1)
def syndromes() -> np.ndarray:
    """The syndrome of each 23-bit word: its remainder by the generator."""
    out = np.arange(1 << LENGTH, dtype=np.int32)
    for k in range(LENGTH - 1, 10, -1):
        out ^= np.where(out >> k & 1, np.int32(GENERATOR << (k - 11)), np.int32(0))
    return out.astype(np.int16)


def split(fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two 23-bit blocks that the code covers; the other 18 bits count in the comparison only."""
    bits = fp.view(np.uint64)
    mask = np.uint64((1 << LENGTH) - 1)
    return (bits & mask).astype(np.int64), (bits >> np.uint64(LENGTH) & mask).astype(np.int64)


def home(fp: np.ndarray) -> np.ndarray:
    """The nearest anchor: the pair of code words nearest to the two blocks, at most 3 + 3 bits away."""
    value, offsets, counts = golay()
    leader = value[offsets[np.arange(2048), (counts > 0).argmax(axis=1)]]
    one, two = (b ^ leader[syndromes()[b]] for b in split(fp))
    return one << LENGTH | two


def anchors(fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All anchors within covering radius plus threshold (8 bits), as (index of the fingerprint, anchor)."""
    value, offsets, counts = golay()
    blocks = split(fp)
    syn = [syndromes()[b] for b in blocks]
    most = BLOCKS * RADIUS + THRESHOLD
    for w1 in range(most + 1):
        for w2 in range(most + 1 - w1):
            n1, n2 = counts[syn[0], w1], counts[syn[1], w2]
            each = n1 * n2
            if not each.any():
                continue
            of = np.repeat(np.arange(len(fp)), each)
            k = np.arange(len(of)) - np.repeat(np.cumsum(each) - each, each)
            a = blocks[0][of] ^ value[offsets[syn[0], w1][of] + k // n2[of]]
            b = blocks[1][of] ^ value[offsets[syn[1], w2][of] + k % n2[of]]
            yield of, a << LENGTH | b


def links(fps: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp) -> (a, b), a < b: every pair at 2 or fewer differing bits, once.

    A pair's smaller member lies within 6 bits of its home anchor, so its other member lies within 8
    bits of that anchor and has been replicated to it (78 anchors a fingerprint on average). A
    fingerprint has at most 2080 others within 2 bits, so links grow with the fingerprints, however
    many copies a group holds.
    """

    def homes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.asarray(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(home(fp)), b.column(0)], ["anchor", "a"])

    def replicas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 2048):
                fp = np.asarray(b.column(0).slice(i, 2048))
                for of, anchor in anchors(fp):
                    yield pa.RecordBatch.from_arrays([pa.array(anchor), pa.array(fp[of])], ["anchor", "b"])

    one = fps.select("fp").mapInArrow(homes, "anchor long, a long")
    two = fps.select("fp").mapInArrow(replicas, "anchor long, b long")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= THRESHOLD
    return one.join(two.hint("merge"), "anchor").where((F.col("a") < F.col("b")) & near).select("a", "b")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, fp, fingerprint, component_id), one row per row of the input.

    component_id is the smallest doc_id reachable over fingerprints that differ in 2 or fewer bits;
    equal fingerprints are one point, so copies need no links. Null texts and texts without words
    have fingerprint zero and link like others. Rows with a null doc_id take part and do not count
    for the minimum; a component of such rows alone has a null id. Repeated rows stay. Other columns
    are not read. An empty table gives an empty one.
    """
    points = stage(fingerprints(docs), "fingerprints")
    distinct = stage(points.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "points")
    roots = components(links(distinct))
    linked = stage(roots.withColumnRenamed("node", "fp").join(distinct, "fp").select("fp", "root", "first_id"), "linked")
    least = stage(linked.groupBy("root").agg(F.min("first_id").alias("least_id")), "least")
    moved = linked.join(least, "root").select("fp", "least_id")
    ids = stage(distinct.join(moved, "fp", "left").select("fp", F.when(F.col("least_id").isNotNull(), F.col("least_id")).otherwise(F.col("first_id")).alias("component_id")), "ids")
    return points.join(ids, "fp").select("doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
