"""Token ids in a compact, seekable table: static range asymmetric numeral system.

A token table is a Parquet table whose rows are blocks, in the order (part, offset). A block holds
whole documents and can be decoded alone; its bytes are, little-endian:

    magic 'TIDR', version u8, id width u8 (2 or 4), lanes u16, tokens u64, documents u32,
    words u32, checkpoints u32, crc32 of the ids as u32 words u32, crc32 of what follows u32
    documents: id i64, null flag u8 and tokens u64 of each, column after column
    checkpoints: words read before the step u64 and a state u64 of each lane, one after another
    words u32

Token i belongs to lane i % lanes and step i // lanes. All blocks share one frequency table, kept
beside them, whose frequencies sum to 2**20. States lie in [2**31, 2**63); a lane that falls below
takes one 32-bit word. Checkpoint k holds the states before step k * STEPS, so that a decoder may
begin there; the first one begins the block.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tablebridge.llm.staging import gathered, parts_of, rows_of, stage
from tablebridge.session import new_run_folder

BITS, LANES, STEPS, BLOCK = 20, 1024, 128, 524_288
LOW = np.uint64(1 << 31)
HEAD = struct.Struct("<4sBBHQIIIII")
#: After so many distinct words a Python worker lays them aside; it forgets those laid aside before.
KEPT_WORDS = 600_000


class Spelled:
    """The ids of numbered words in one array."""

    def __init__(self, dtype: np.dtype) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.start, self.size = np.zeros(0, dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, words: list[str], flat: list[int] | np.ndarray, size: list[int] | np.ndarray) -> None:
        size = np.asarray(size, np.int64)
        self.number.update(zip(words, range(len(self.size), len(self.size) + len(words)), strict=True))
        self.start = np.concatenate([self.start, len(self.flat) + np.cumsum(size) - size])
        self.flat, self.size = np.concatenate([self.flat, np.asarray(flat, self.flat.dtype)]), np.concatenate([self.size, size])

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.start, self.size, numbers)


class Encoder:
    """Ids of whole texts as bytes, equal to the library's, with the ids of words remembered.

    The tokenizer splits before a space that precedes a word and at a line break, so a text without
    further white space beside these falls into words whose ids don't depend on their neighbours.
    Any other text goes to the library whole. It also splits between a letter and punctuation, so a
    word that ends in punctuation is put together from two. Words not met lately are forgotten.
    """

    #: Texts with these, or with a space or line break at an end, are not cut into words.
    ODD = ("  ", " \n", "\n ", "\n\n", "\x1c", "<|")
    ENDS = ".,;:!?|*#%&$)"

    def __init__(self, path: str, dtype: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library, self.dtype = Tokenizer.from_file(path), np.dtype(dtype)
        self.words, self.older = Spelled(self.dtype), Spelled(self.dtype)
        self.model, kept = self.library.model, [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in kept]
        self.letters = {b: b for b in kept} | {b: 256 + i for i, b in enumerate(rest)}  # the byte-level alphabet

    def raw(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, words: list[str]) -> None:
        """Words of Latin letters after a space are one piece for the splitter, so the merges alone encode them."""
        plain, rest, flat, size = [], [], [], []
        tokenize, letters = self.model.tokenize, self.letters
        for w in words:
            if w[0] != " " or not w[1:].isalpha():
                rest.append(w)
                continue
            if w.isascii():
                found = tokenize("\u0120" + w[1:])
            elif max(w) < "\u0250":
                found = tokenize(w.encode().decode("latin-1").translate(letters))
            else:
                rest.append(w)
                continue
            plain.append(w)
            flat += [x.id for x in found]
            size.append(len(found))
        self.words.add(plain, flat, size)
        found = self.raw(rest)
        self.words.add(rest, [i for x in found for i in x], [len(x) for x in found])

    def meet(self, words: list[str]) -> None:
        """Add distinct words that `self.words` has not."""
        older = self.older.number
        if older:
            again = [w for w in words if w in older]
            at = np.array([older[w] for w in again], np.int64)
            self.words.add(again, self.older.of(at), self.older.size[at])
            words = [w for w in words if w not in older]
        ended = {w: s for w in words if not w[-1].isalnum() and (s := w.rstrip(self.ENDS)) != w and s[-1:].isalpha()}
        self.learn([w for w in words if w not in ended] if ended else words)
        if ended:
            stems, tails = list(ended.values()), [w[len(s) :] for w, s in ended.items()]
            self.meet(list({*stems, *tails}.difference(self.words.number)))
            at = np.array([self.words.number[x] for both in zip(stems, tails, strict=True) for x in both], np.int64)
            self.words.add(list(ended), self.words.of(at), self.words.size[at].reshape(-1, 2).sum(axis=1))

    def numbers(self, words: list[str]) -> np.ndarray:
        """Where `self.words` has distinct words; new ones are learnt first."""
        if len(self.words.number) > KEPT_WORDS:
            self.older, self.words = self.words, Spelled(self.dtype)
        at = list(map(self.words.number.get, words))
        missing = [w for w, n in zip(words, at, strict=True) if n is None]
        if missing:
            self.meet(missing)
            known = iter(map(self.words.number.__getitem__, missing))
            at = [next(known) if n is None else n for n in at]
        return np.array(at, np.int64)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        odd = [bool(t) and (t[0] in " \n" or t[-1] in " \n" or any(x in t for x in self.ODD)) for t in texts]
        cut = pa.array([t if t and not o else None for t, o in zip(texts, odd, strict=True)], pa.large_string())
        cut = pc.replace_substring(pc.replace_substring(cut, "\n", "\x1c\n"), " ", "\x1c ")
        words, at, n_words = parts_of(cut, "\x1c")
        each = self.numbers(words)[at]
        flat = self.words.of(each).tobytes()
        ends = np.insert(np.cumsum(self.words.size[each]), 0, 0)[np.cumsum(n_words)] * self.dtype.itemsize
        out = [flat[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist(), strict=False)]
        whole = [i for i, o in enumerate(odd) if o]
        for i, x in zip(whole, self.raw([texts[i] for i in whole]), strict=True):
            out[i] = np.array(x, self.dtype).tobytes()
        return out


@lru_cache(2)
def encoder_of(path: str, dtype: str) -> Encoder:
    """The encoder of a Python worker, which may serve several tasks."""
    return Encoder(path, dtype)


def token_ids(docs: DataFrame, path: str, end_id: int, dtype: str = "<u2") -> DataFrame:
    """(doc_id, text) -> (doc_id, n_tokens, ids_crc32, ids); null texts are empty; end_id closes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = encoder_of(path, dtype), np.array([end_id], dtype).tobytes()
        for b in rows_of(batches, chars=8_000_000):
            ids = [x + end for x in encoder.encode(b.column(1).to_pylist())]
            n = [len(x) // encoder.dtype.itemsize for x in ids]
            crc = [zlib.crc32(np.frombuffer(x, dtype).astype("<u4").tobytes()) for x in ids]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(crc, pa.int64()), pa.array(ids, pa.binary())], ["doc_id", "n_tokens", "ids_crc32", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, ids binary")


def id_counts(tokens: DataFrame, dtype: str) -> DataFrame:
    """How often each id occurs in all documents: (id, n). A row for each id and task is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for b in batches:
            n = np.bincount(np.frombuffer(b"".join(b.column(0).to_pylist()), dtype), minlength=len(total))
            n[: len(total)] += total
            total = n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def frequencies(ids: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """Integers that sum to 2**BITS, at least 1 for each id that occurs, near to its share."""
    out, share = np.zeros(size, np.int64), np.zeros(size)
    if not len(ids):
        return out
    share[ids] = counts / counts.sum() * (1 << BITS)
    out[ids] = np.maximum(1, np.floor(share[ids])).astype(np.int64)
    order = ids[np.lexsort((ids, -counts))]
    while (over := int(out.sum()) - (1 << BITS)) != 0:
        some = order[out[order] > 1] if over > 0 else order
        step = np.zeros(size, np.int64)
        step[some[: abs(over)]] = -1 if over > 0 else max(1, -over // len(some))
        if over > 0:
            step[some] = -np.minimum(out[some] - 1, np.maximum(0, out[some] * over // out[some].sum()))
            if not step.any():
                step[some[:over]] = -1
        elif -over < int(step.sum()):
            step[:] = 0
            step[some[:-over]] = 1
        out += step
    return out


def encode_block(ids: np.ndarray, freq: np.ndarray, first: np.ndarray, docs: list[tuple[int | None, int]]) -> bytes:
    """One block: the ids of whole documents; docs has each one's id and number of tokens."""
    n, f, c = len(ids), freq[ids].astype(np.uint64), first[ids].astype(np.uint64)
    steps = -(-n // LANES)
    state, words, points, read = np.full(LANES, LOW, np.uint64), [], [], []
    taken = 0
    for t in range(steps - 1, -1, -1):
        ft, ct = f[t * LANES : (t + 1) * LANES], c[t * LANES : (t + 1) * LANES]
        x = state[: len(ft)]
        full = x >= ft << np.uint64(63 - BITS)
        out = x[full]
        words.append(out.astype(np.uint32))
        taken += len(out)
        x[full] = out >> np.uint64(32)
        q = x // ft
        x[:] = (q << np.uint64(BITS)) + (x - q * ft) + ct
        if t % STEPS == 0:
            points.append(state.copy())
            read.append(taken)
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    states = b"".join(struct.pack("<Q", taken - r) + s.astype("<u8").tobytes() for r, s in zip(read[::-1], points[::-1], strict=True))
    table = np.array([d or 0 for d, _ in docs], "<i8").tobytes() + np.array([d is None for d, _ in docs], "u1").tobytes() + np.array([k for _, k in docs], "<u8").tobytes()
    body = table + states + stream.astype("<u4").tobytes()
    width = 4 if len(freq) > 65536 else 2
    return HEAD.pack(b"TIDR", 1, width, LANES, n, len(docs), len(stream), len(points), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(body)) + body


def decode_block(block: bytes, freq: np.ndarray, first: np.ndarray, symbol: np.ndarray, point: int = 0) -> tuple[np.ndarray, list[tuple[int | None, int]]]:
    """The ids from checkpoint `point` on (0: all) and the documents. A damaged block raises ValueError."""
    magic, version, _, lanes, n, n_docs, n_words, n_points, crc, body = HEAD.unpack_from(block)
    if (magic, version) != (b"TIDR", 1):
        raise ValueError("not a token block")
    if zlib.crc32(memoryview(block)[HEAD.size :]) != body:
        raise ValueError("a token block is damaged")
    at = HEAD.size
    ids = np.frombuffer(block, "<i8", n_docs, at)
    null = np.frombuffer(block, "u1", n_docs, at + 8 * n_docs)
    sizes = np.frombuffer(block, "<u8", n_docs, at + 9 * n_docs)
    docs = [(None if z else int(i), int(k)) for i, z, k in zip(ids, null, sizes, strict=True)]
    at += 17 * n_docs
    each = 8 + 8 * lanes
    stream = np.frombuffer(block, "<u4", n_words, at + n_points * each).astype(np.uint64)
    out = np.zeros(n, np.int64)
    if n_points:
        (read,) = struct.unpack_from("<Q", block, at + point * each)
        state = np.frombuffer(block, "<u8", lanes, at + point * each + 8).astype(np.uint64)
    mask, f64, c64 = np.uint64((1 << BITS) - 1), freq.astype(np.uint64), first.astype(np.uint64)
    for t in range(point * STEPS, -(-n // lanes)):
        x = state[: min(lanes, n - t * lanes)]
        slot = x & mask
        s = symbol[slot]
        out[t * lanes : t * lanes + len(x)] = s
        x[:] = f64[s] * (x >> np.uint64(BITS)) + slot - c64[s]
        low = x < LOW
        k = int(np.count_nonzero(low))
        x[low] = x[low] << np.uint64(32) | stream[read : read + k]
        read += k
    if point == 0 and zlib.crc32(out.astype("<u4").tobytes()) != crc:
        raise ValueError("the checksum of a token block differs")
    return out[point * STEPS * lanes :], docs


def starts(freq: np.ndarray) -> np.ndarray:
    return np.cumsum(freq) - freq


def write(tokens: DataFrame, size: int, dtype: str) -> str:
    """Write staged tokens in ascending doc_id order (nulls first, then equal ids by size and checksum) as a token table."""
    spark = tokens.sparkSession
    rows = id_counts(tokens, dtype).collect()  # at most one row for each id of the vocabulary
    freq = frequencies(np.array([r.id for r in rows], np.int64), np.array([r.n for r in rows], np.int64), size)
    sent = spark.sparkContext.broadcast(freq.astype(np.int32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = sent.value
        first, part, offset = starts(freq.astype(np.int64)), TaskContext.get().partitionId(), 0
        held: list[bytes] = []
        docs: list[tuple[int | None, int]] = []

        def close() -> pa.RecordBatch:
            nonlocal offset
            ids = np.frombuffer(b"".join(held), dtype)
            block = encode_block(ids, freq, first, docs)
            row = [[part], [offset], [len(ids)], [block]]
            offset += len(ids)
            held.clear()
            docs.clear()
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["part", "offset", "n_tokens", "block"])

        n = 0
        for b in batches:
            for doc, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                held.append(ids)
                docs.append((doc, len(ids) // np.dtype(dtype).itemsize))
                n += docs[-1][1]
                if n >= BLOCK:
                    yield close()
                    n = 0
        if docs:
            yield close()

    path = new_run_folder(spark, "tokens")
    order = [F.asc_nulls_first("doc_id"), "n_tokens", "ids_crc32"]
    blocks = tokens.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order).sortWithinPartitions(*order).select("doc_id", "ids")
    blocks.mapInArrow(run, "part int, offset long, n_tokens long, block binary").write.option("compression", "none").parquet(f"{path}/blocks")
    spark.createDataFrame([(bytearray(freq.astype("<u4").tobytes()),)], "frequencies binary").write.parquet(f"{path}/frequencies")
    return path


def read(spark: SparkSession, path: str) -> DataFrame:
    """A token table -> (doc_id, start, n_tokens, ids binary as little-endian u32), one row per document.

    start counts the ids of all documents before it, over all parts; the parts' totals are one row
    for each part. The table of frequencies has one row, bounded by the vocabulary.
    """
    blocks = spark.read.parquet(f"{path}/blocks")
    freq = np.frombuffer(spark.read.parquet(f"{path}/frequencies").first()[0], "<u4")
    sent = spark.sparkContext.broadcast(freq)
    parts = blocks.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = parts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        freq = sent.value.astype(np.int64)
        first, symbol = starts(freq), np.repeat(np.arange(len(freq), dtype=np.int32), freq)
        for b in batches:
            for part, offset, block in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                ids, docs = decode_block(block, freq, first, symbol)
                ids = ids.astype("<u4")
                ends = np.cumsum([k for _, k in docs])
                cols = [[d for d, _ in docs], [part] * len(docs), [offset + int(e) - k for e, (_, k) in zip(ends, docs, strict=True)], [k for _, k in docs], [ids[e - k : e].tobytes() for e, (_, k) in zip(ends, docs, strict=True)]]
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "part", "at", "n_tokens", "ids"])

    found = blocks.select("part", "offset", "block").mapInArrow(run, "doc_id long, part int, at long, n_tokens long, ids binary")
    return found.join(F.broadcast(base), "part").select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", "ids")


def round_trip(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """Encode (doc_id, text), write the token table and read it back, as `read` returns it.

    Null and empty texts hold the end id alone. Repeated rows and rows with a null doc_id (first in
    the order) are kept. Other columns are not read. An empty table gives an empty one.
    """
    dtype = "<u2" if size <= 65536 else "<u4"
    tokens = stage(token_ids(docs, path, end_id, dtype), "ids")
    return read(docs.sparkSession, write(tokens, size, dtype))
