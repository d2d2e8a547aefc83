"""Cross-entropy difference of two bigram models over all words of the corpus."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tablebridge.llm.staging import rows_of, stage

#: Weight of the unigram model under the bigram counts, and of a word under the unigram counts.
BELOW, FLOOR = 20.0, 0.5
#: Words of text that a chunk takes before it is closed (its n-grams are counted before they are passed on), and words whose n-grams a bucket holds at once.
HELD, BUCKET = 1_000_000, 4_000_000
MIX, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
#: Set apart the keys of a word as the first of a pair and as the second; the lowest bit of a key marks the latter.
FIRST, SECOND, ONE = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344), np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> TURN) * MIX
    return x ^ x >> TURN


def pack(*columns: np.ndarray) -> bytes:
    """Columns of 64 bits, byte by byte of all values, compressed."""
    planes = b"".join(np.ascontiguousarray(np.ascontiguousarray(c).view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(1).compress(planes)


def unpack(blob: bytes, n: int) -> list[np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = len(planes) // n
    return [np.ascontiguousarray(p.reshape(8, size // 8).T).view(np.uint64).ravel() for p in planes.reshape(n, size)]


@dataclass(frozen=True)
class Grams:
    """The n-grams of a chunk of texts, by their positions in sorted `keys`.

    Keys are 64-bit hashes of a pair of words, of a word that a pair begins with, and of one that it ends with.
    """

    keys: np.ndarray
    pair: np.ndarray  # of each token: the number of its pair
    place: np.ndarray  # of each pair: where its key is
    before: np.ndarray  # of each pair: where the key of its first word is
    after: np.ndarray  # of each pair: where the key of its second word is
    lengths: np.ndarray  # words of each text

    @classmethod
    def of(cls, texts: list[str]) -> Grams:
        ids: defaultdict[str, int] = defaultdict()
        ids.default_factory = lambda: len(ids) + 1
        found = [[ids[w] for w in t.lower().split()] for t in texts]
        lengths = np.array([len(x) for x in found], np.int64)
        second = np.fromiter((k for x in found for k in x), np.int64, int(lengths.sum()))
        first = np.roll(second, 1)
        first[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0  # the start of a document
        digest = xxhash.xxh3_64_intdigest
        word = np.array([0, *(digest(w.encode("utf-8", "surrogatepass")) for w in ids)], np.uint64)
        pairs, pair = np.unique(first * len(word) + second, return_inverse=True)
        a, b = pairs // len(word), pairs % len(word)
        keys = np.concatenate([mixed(mixed(word[a]) + word[b]), mixed(word ^ FIRST), mixed(word ^ SECOND)]) & ~ONE
        keys[len(keys) - len(word) :] |= ONE
        keys, place = np.unique(keys, return_inverse=True)
        return cls(keys, pair, place[: len(pairs)], place[len(pairs) + a], place[len(pairs) + len(word) + b], lengths)

    def counts(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often each key occurs in marked texts, and in all."""
        out = []
        for weights in (np.repeat(marks, self.lengths).astype(float), None):
            n = np.bincount(self.pair, weights, len(self.place))
            out.append(sum(np.bincount(at, n, len(self.keys)) for at in (self.place, self.before, self.after)).astype(np.uint64))
        return out[0], out[1]

    def losses(self, counts: np.ndarray, scale: float, total: float, places: int) -> np.ndarray:
        """The mean loss of a word of each text (nan without words), from the counts of the keys in the whole corpus."""
        n = counts * scale
        below = BELOW * (n[self.after] + FLOOR) / (total * scale + FLOOR * places)
        loss = np.log(n[self.before] + BELOW) - np.log(n[self.place] + below)
        of = np.repeat(np.arange(len(self.lengths)), self.lengths)
        with np.errstate(invalid="ignore"):
            return np.bincount(of, loss[self.pair], len(self.lengths)) / self.lengths


CHUNK = "chunk long, ids array<long>, sizes array<long>, texts binary"


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> `CHUNK`: texts and their numbers of words, gathered up to HELD words; no row is changed or lost."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n, held = TaskContext.get().partitionId() << 32, 0, []

        def closed() -> pa.RecordBatch:
            ids, texts, sizes = (list(x) for x in zip(*held, strict=True))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, pa.schema([("text", pa.large_string())])) as w:
                w.write_batch(pa.RecordBatch.from_arrays([pa.array(texts, pa.large_string())], ["text"]))
            values = [base + n, ids, sizes, zstandard.ZstdCompressor(3).compress(sink.getvalue())]
            kinds = [pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds, strict=True)], [x.split()[0] for x in CHUNK.split(", ")])

        total = 0
        for b in rows_of(batches):
            for doc, text in zip(*(b.column(k).to_pylist() for k in range(2)), strict=True):
                size = len((text or "").split())
                held.append((doc, text or "", size))
                total += size + 1
                if total >= HELD:
                    yield closed()
                    n, held, total = n + 1, [], 0
        if held:
            yield closed()

    return docs.select("doc_id", "text").mapInArrow(run, CHUNK)


def marked(held: DataFrame, target: DataFrame) -> DataFrame:
    """Chunks and target (doc_id) -> (chunk, places, n_target): where the target's texts stand in a chunk and their words; chunks without any are absent.

    Only ids meet here; the texts stay where they are.
    """
    mark = target.select("doc_id").where("doc_id is not null").distinct()
    rows = held.select("chunk", F.posexplode(F.arrays_zip(F.col("ids").alias("doc_id"), F.col("sizes").alias("size"))).alias("place", "x"))
    found = rows.select("chunk", "place", "x.doc_id", "x.size").join(mark, "doc_id", "left_semi")
    return found.groupBy("chunk").agg(F.collect_list("place").alias("places"), F.sum("size").alias("n_target"))


def texts_of(blob: bytes) -> list[str]:
    return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(blob)).read_all()["text"].to_pylist()


def shares(keys: np.ndarray, bits: int) -> np.ndarray:
    """Where the keys of each of 2**bits buckets begin in sorted keys, and the end."""
    return np.searchsorted(keys >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64))


BLOB = "chunk long, bucket long, blob binary"


def blobs(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in BLOB.split(", ")])


def asked(held: DataFrame, bits: int) -> DataFrame:
    """(chunk, places, texts) -> `BLOB`: of each chunk and bucket the keys and their counts in the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                chunk, places, texts = (b.column(c)[k].as_py() for c in range(3))
                grams = Grams.of(texts_of(texts))
                marks = np.zeros(len(grams.lengths), bool)
                marks[places or []] = True
                some, every = grams.counts(marks)
                ends = shares(grams.keys, bits).tolist()
                yield blobs([(chunk, k, pack(np.diff(grams.keys[i:j], prepend=np.uint64(0)), some[i:j], every[i:j])) for k, (i, j) in enumerate(zip(ends, ends[1:], strict=False)) if j > i])

    return held.select("chunk", "places", "texts").mapInArrow(run, BLOB)


def groups(batches: Iterator[pa.RecordBatch], by: int) -> Iterator[list[tuple]]:
    """Rows in the order of column `by`, gathered by its values."""
    rows: list[tuple] = []
    for b in batches:
        for k in range(b.num_rows):  # one row at a time, so that blobs are not held twice
            row = tuple(c[k].as_py() for c in b.columns)
            if rows and rows[0][by] != row[by]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def numbered(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of all parts in order, and where each value of each part stands; the parts are given up."""
    joined = np.concatenate(parts)
    parts.clear()
    order = np.argsort(joined)
    joined = joined[order]
    first = np.concatenate([[True], joined[1:] != joined[:-1]])
    at = np.empty(len(order), np.uint32)
    at[order] = np.cumsum(first, dtype=np.uint32) - np.uint32(1)
    return joined[first], at


def answered(requests: DataFrame, parts: int) -> DataFrame:
    """The same rows with each key's counts over all chunks instead of the keys; and one row (null, words that end a pair, empty) a bucket.

    Each bucket below `parts` has a task of its own: buckets that meet by hash would take the memory of several.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, 1):
            names, columns = [r[:2] for r in rows], ([], [], [])
            rows.reverse()
            while rows:  # what is packed, and each column once it is used, makes room for the next
                keys, *counts = unpack(rows.pop()[2], 3)
                columns[0].append(np.cumsum(keys, dtype=np.uint64))
                for column, n in zip(columns[1:], counts, strict=True):
                    column.append(n.astype(np.uint32))  # a chunk has fewer words than that
            ends = np.cumsum([0, *(len(x) for x in columns[0])]).tolist()
            keys, at = numbered(columns[0])
            totals = []
            for column in columns[1:]:
                total = np.zeros(len(keys), np.uint64)
                for n, i, j in zip(column, ends, ends[1:], strict=False):
                    total[at[i:j]] += n  # a chunk has a key once
                totals.append(total)
                column.clear()
            yield blobs([(None, int((keys & ONE)[totals[1] > 0].sum()), b"")])
            del keys
            for k in range(0, len(names), 64):
                yield blobs([(*name, pack(*(t[at[i:j]] for t in totals))) for name, i, j in zip(names[k : k + 64], ends[k:], ends[k + 1 :], strict=False)])

    return requests.repartitionById(parts, F.col("bucket").cast("int")).sortWithinPartitions("bucket").mapInArrow(run, BLOB)


SCHEMA = "doc_id long, n_tokens long, target_loss double, background_loss double, difference double"


def score(docs: DataFrame, target: DataFrame) -> DataFrame:
    """docs (doc_id, text) and target (doc_id) -> `SCHEMA`: mean losses per word and target minus background; lower is nearer to the target.

    Words are lower-cased runs between white space; the start of a document precedes its first word.
    Both models share all words of the corpus, the order and the smoothing (bigrams over unigrams
    over a uniform model); the background, counted over all documents, is scaled to the target's
    number of words, so that smoothing weighs alike in both. Texts without words (also null) have 0
    tokens and null losses. Without target documents the target model is uniform. Repeated rows and
    null ids stay; null ids are no target.

    Each chunk of texts counts its own n-grams and sends one row of them to each bucket of keys; the
    buckets send back the counts over all chunks, in the same order. A frequent n-gram is one value a
    chunk. Buckets are as many as the n-grams of BUCKET words each need, so that no task grows with the
    corpus; rows between chunks and buckets never outnumber the n-grams that they carry.
    """
    held = stage(chunks(docs), "chunks")
    places = stage(marked(held, target), "target")
    n, words = held.agg(F.count("*"), F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()
    of_target = places.agg(F.sum("n_target")).first()[0] or 0
    words = words or 0
    bits = max(3, (-(-words // BUCKET) - 1).bit_length())
    answers = stage(answered(asked(held.join(places, "chunk", "left"), bits), 1 << bits), "answers")
    size = 2 + (answers.where("chunk is null").agg(F.sum("bucket")).first()[0] or 0)
    scale = of_target / words if of_target else 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, 0):
            ids, grams = rows[0][3], Grams.of(texts_of(rows[0][2]))
            found = [unpack(r[2], 2) for r in rows[1:]]
            some, every = (np.concatenate([f[k] for f in found]).astype(float) for k in range(2))
            t, g = grams.losses(some, 1.0, of_target, size), grams.losses(every, scale, words, size)
            losses = [pa.array(x, pa.float64(), mask=grams.lengths == 0) for x in (t, g, t - g)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(grams.lengths), *losses], [x.split()[0] for x in SCHEMA.split(", ")])

    own = held.select("chunk", F.lit(-1).cast("long").alias("bucket"), F.col("texts").alias("blob"), "ids")
    back = answers.where("chunk is not null").withColumn("ids", F.lit(None).cast("array<long>"))
    return own.unionByName(back).repartition(max(8, n), "chunk").sortWithinPartitions("chunk", "bucket").mapInArrow(run, SCHEMA)
