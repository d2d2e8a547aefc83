"""SentencePiece encoding and decoding by a relational lattice and a Viterbi fold.

Texts are cut into units that no piece crosses; each distinct unit is segmented once: its substrings
are exploded, equi-joined to the piece table, grouped by unit, and folded by a higher-order aggregate.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tablebridge.llm.staging import gathered, parts_of, rows_of

SPACE = "▁"
#: Longest stretch of letters (or other characters, or spaces) that is segmented in one go, in code points.
LONGEST = 256
#: A unit: spaces and the letters, or the other characters, after them. No piece of the vocabulary joins letters and others, or letters before a space.
UNIT = re.compile(rf"{SPACE}{{0,{LONGEST}}}[^\W\d_]{{1,{LONGEST}}}|{SPACE}{{0,{LONGEST}}}(?:(?!{SPACE})[\W\d_]){{1,{LONGEST}}}|{SPACE}{{1,{LONGEST}}}")
#: Characters of text in a block of documents that share one list of units, distinct units after which it is closed all the same, and characters that are cut at once.
BLOCK_CHARS, BLOCK_UNITS, CUT_CHARS = 16_000_000, 500_000, 4_000_000
#: Buckets of units by hash, and partitions that they are dealt to at least: few units each, so that the lattice is sorted in memory.
BUCKETS, PARTITIONS = 4096, 256
#: The model's scores are ranks of merges, not chances; a piece of rank r weighs -log(EVEN + r). A character without a piece weighs the least of them less PENALTY.
EVEN, PENALTY = 100.0, 10.0


def pieces(path: str) -> list[tuple[str, float]]:
    """(piece, weight) by id; control, unknown and byte pieces have weight nan and stand in no lattice."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.get_piece_size()):
        other = model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
        out.append((model.id_to_piece(i), math.nan if other else -math.log(EVEN - model.get_score(i))))
    return out


def units_of(text: str) -> list[str]:
    return UNIT.findall(SPACE + text.replace(" ", SPACE)) if text else []


def units_of_word(word: str) -> list[str]:
    """The units of a word after a single space; letters alone are one."""
    return [SPACE + word] if word.isalpha() and len(word) <= LONGEST else UNIT.findall(SPACE + word)


def plain(text: str) -> bool:
    """No unit goes over a single space, so words stand alone."""
    return bool(text) and text[0] != " " and text[-1] != " " and "  " not in text and SPACE not in text


class Block:
    """The distinct units of a stretch of documents, numbered as they come, and its documents as numbers. Texts are dropped once their units are numbered."""

    def __init__(self) -> None:
        self.docs: list[int | None] = []
        self.sums: list[int] = []
        self.numbers: list[np.ndarray] = []
        self.units: dict[str, int] = {}
        self.waiting: list[str] = []
        self.size = self.waits = 0

    def add(self, doc: int | None, text: str) -> None:
        self.docs.append(doc)
        self.sums.append(xxhash.xxh64_intdigest(text.encode()))
        self.waiting.append(text)
        self.size += len(text)
        self.waits += len(text)
        if self.waits >= CUT_CHARS:
            self.cut()

    def full(self) -> bool:
        return self.size >= BLOCK_CHARS or len(self.units) >= BLOCK_UNITS

    def cut(self) -> None:
        """Number the units of the texts that wait. Distinct words are cut once; a text that can't be cut at its spaces counts as one word."""
        texts, units = self.waiting, self.units
        whole = [not plain(t) for t in texts]
        words, at, n_words = parts_of(pa.array([None if w else t for t, w in zip(texts, whole, strict=True)], pa.large_string()), " ")
        each = [units_of_word(w) for w in words] + [units_of(t) for t, w in zip(texts, whole, strict=True) if w]
        flat = np.array([units.setdefault(u, len(units)) for some in each for u in some], np.uint32)
        size = np.fromiter(map(len, each), np.int64, len(each))
        ends = np.cumsum(n_words)
        word = np.insert(at.astype(np.int64), ends[whole], np.arange(len(words), len(each)))
        ends = np.cumsum(np.where(whole, 1, n_words))
        numbers = gathered(flat, np.cumsum(size) - size, size, word)
        if texts:
            self.numbers += np.split(numbers, np.insert(np.cumsum(size[word]), 0, 0)[ends[:-1]])
        self.waiting, self.waits = [], 0

    def numbered(self) -> tuple[list[str], list[np.ndarray]]:
        """The units and the numbers of each document."""
        self.cut()
        return list(self.units), self.numbers

    def closed(self, block: int) -> Iterator[pa.RecordBatch]:
        """A row for each bucket with its units in order, then one with the documents, whose numbers follow the order of buckets and units."""
        units, docs = self.numbered()
        units = units or [SPACE]  # so that each block has an answer
        bucket = np.fromiter(map(zlib.crc32, map(str.encode, units)), np.uint32, len(units)) % BUCKETS
        order = np.argsort(bucket, kind="stable")
        place = np.empty(len(order), np.uint32)
        place[order] = np.arange(len(order), dtype=np.uint32)
        bucket, units = bucket[order], [units[i] for i in order.tolist()]
        edges = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(units)]
        lists = [" ".join(units[a:b]).encode() for a, b in zip(edges, edges[1:], strict=False)]
        yield self.batch([bucket[edges[:-1]].tolist(), [block] * len(lists), lists])
        table = pa.table(
            [
                pa.array(self.docs, pa.int64()), pa.array(self.sums, pa.uint64()),
                pa.array([place[n].tobytes() for n in docs], pa.binary()),
            ],
            ["doc_id", "sum", "numbers"],
        )
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table, 1000)
        yield self.batch([[home(block)], [block], [zstandard.ZstdCompressor(3).compress(sink.getvalue())]])

    @staticmethod
    def batch(cols: list[list]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, kinds, strict=True)], ["bucket", "block", "held"])


def home(block):
    """The bucket of a block's documents; those of units are 0 and more."""
    return -1 - block


def coded(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (bucket, block, held): each block's distinct units by buckets of their hash, joined by spaces, and its documents in a bucket below 0.

    A block is a bounded stretch of one partition; its name is the partition and the place in it, the
    same whenever a lost task runs again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, block = TaskContext.get().partitionId() << 32, Block()
        for b in rows_of(batches, chars=2_000_000):
            for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                block.add(doc, text or "")
                if block.full():
                    yield from block.closed(name)
                    name, block = name + 1, Block()
        if block.docs:
            yield from block.closed(name)

    return docs.select("doc_id", "text").mapInArrow(run, "bucket long not null, block long, held binary")


def viterbi(edges: Column) -> Column:
    """Ids of the best path; edges (end, start, id, weight) in the order of end, then start. Of equal paths the one with the longer last piece wins.

    The state holds the best path to each position passed (`done`) and to the present one (`top`).
    """
    path = "struct<weight:double,ids:array<int>>"
    empty = F.struct(F.lit(0.0).alias("weight"), F.array().cast("array<int>").alias("ids"))
    start = F.struct(F.array().cast(f"array<{path}>").alias("done"), F.lit(0).alias("at"), empty.alias("top"))

    def step(state: Column, edge: Column) -> Column:
        def moved(done: Column) -> Column:
            before = F.element_at(done, edge["start"] + 1)
            reached = F.struct((before["weight"] + edge["weight"]).alias("weight"), F.array_append(before["ids"], edge["id"]).alias("ids"))
            better = (edge["end"] > state["at"]) | (reached["weight"] > state["top"]["weight"])
            return F.struct(done.alias("done"), edge["end"].alias("at"), F.when(better, reached).otherwise(state["top"]).cast(path).alias("top"))

        done = F.when(edge["end"] > state["at"], F.array_append(state["done"], state["top"])).otherwise(state["done"])
        return F.transform(F.array(done), moved)[0]

    return F.aggregate(edges, start, step, lambda state: state["top"]["ids"])


def segmented(units: DataFrame, table: list[tuple[str, float]]) -> DataFrame:
    """(bucket, unit, kept) of distinct units -> (bucket, unit, ids, kept); a character without a piece stands as minus its code point less one.

    Rows that come partitioned by bucket stay where they are. Units are numbered, so that the lattice
    is sorted by numbers and not by strings; no number leaves its task. Substring 0 of a unit is none:
    it carries the unit and `kept` past the explosion. The piece table is the vocabulary's: its size is
    fixed by the model, so it is broadcast.
    """
    spark, longest = units.sparkSession, max(len(p) for p, w in table if not math.isnan(w))
    known = [(p, i, w) for i, (p, w) in enumerate(table) if not math.isnan(w)]
    lookup = spark.createDataFrame(known, "piece string, id int, weight double")
    least = min(w for _, _, w in known) - PENALTY
    n = F.length("unit")
    starts = units.select("bucket", "unit", "kept", F.monotonically_increasing_id().alias("no")).select("*", F.explode(F.sequence(F.lit(-1), n - 1)).alias("start"))
    starts = starts.select("bucket", "no", "unit", "start", F.when(F.col("start") < 0, F.struct("unit", "kept")).alias("own"))
    sizes = F.when(F.col("start") < 0, F.array(F.lit(0))).otherwise(F.sequence(F.lit(1), F.least(n - F.col("start"), F.lit(longest))))
    spans = starts.select("*", F.explode(sizes).alias("size"))
    spans = spans.select("bucket", "no", "own", "start", "size", F.expr("substring(unit, start + 1, size)").alias("piece"))
    found = spans.join(F.broadcast(lookup), "piece", "left").where("id is not null or size < 2")
    code = -F.ascii("piece") - 1
    edge = F.struct((F.col("start") + F.col("size")).alias("end"), "start", F.coalesce("id", code).alias("id"), F.coalesce("weight", F.lit(least)).alias("weight"))
    edges = found.select("bucket", "no", "own", F.when(F.col("size") > 0, edge).alias("edge"))
    gathered = edges.groupBy("bucket", "no").agg(F.sort_array(F.collect_list("edge")).alias("edges"), F.first("own", ignorenulls=True).alias("own"))
    return gathered.select("bucket", "own.unit", viterbi(F.col("edges")).alias("ids"), "own.kept")


class Spelling:
    """The ids of numbered units in one array, with each character that has no piece as the pieces of its bytes."""

    def __init__(self, ids: list[str], byte: int) -> None:
        flat = np.fromstring(" ".join(ids), np.int32, sep=" ")
        sizes = np.fromiter((x.count(" ") + 1 for x in ids), np.int64, len(ids))
        odd = np.flatnonzero(flat < 0)
        spelled = [chr(-i - 1).encode("utf-8", "surrogatepass") for i in flat[odd].tolist()]
        each = np.ones(len(flat), np.int64)
        each[odd] = [len(x) for x in spelled]
        begins = np.cumsum(each) - each
        self.flat = np.repeat(flat, each)
        for at, raw in zip(begins[odd].tolist(), spelled, strict=True):
            self.flat[at : at + len(raw)] = [byte + b for b in raw]
        heads = np.cumsum(sizes) - sizes
        self.start, self.size = begins[heads], np.add.reduceat(each, heads) if len(ids) else heads

    def of(self, numbers: np.ndarray) -> np.ndarray:
        return gathered(self.flat, self.start, self.size, numbers)


def bytes_of(table: list[tuple[str, float]]) -> list[bytes]:
    """What each id stands for."""
    byte = first_byte(table)
    return [bytes([i - byte]) if byte <= i < byte + 256 else p.encode() for i, (p, _) in enumerate(table)]


def text_of(ids: list[int], raw: list[bytes]) -> str:
    """The text that ids stand for: byte pieces are joined as UTF-8, the space before the first word goes."""
    return b"".join([raw[i] for i in ids]).decode("utf-8", "replace").replace(SPACE, " ")[1:]


def first_byte(table: list[tuple[str, float]]) -> int:
    return next(i for i, (p, _) in enumerate(table) if p == "<0x00>")


SCHEMA = "doc_id long, n_pieces long, ids array<int>, decoded string, exact boolean"


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, text) -> `SCHEMA`, one row per row: the ids, the text they decode to, and whether it is the text.

    A text's only loss is that of the model: its space sign becomes a space. Null and empty texts
    have no pieces and decode to an empty text. Repeated rows and null ids stay. Other columns are not
    read. An empty table gives an empty one. Units travel in lists, once for each block that holds
    them, so a frequent word brings one entry a block. Buckets of hashes are dealt out once: distinct
    units, lattice, fold and answers need no further shuffle of units. The same shuffle holds the
    documents: both readers of `both` take all its columns and rows, so that Spark reuses one exchange,
    and the texts are cut once. Answers travel to where their block's documents lie.
    """
    spark: SparkSession = docs.sparkSession
    table = pieces(path)
    parts = max(PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    both = coded(docs).repartition(parts, "bucket")
    # Outer, as a filter on what is exploded must not move below the shuffle.
    listed = F.split(F.when(F.col("bucket") >= 0, F.col("held").cast("string")), " ")
    placed = both.select("bucket", "block", F.posexplode_outer(listed).alias("at", "unit")).where("unit is not null")
    distinct = placed.groupBy("bucket", "unit").agg(F.collect_list(F.struct("block", "at")).alias("kept"))
    answers = segmented(distinct, table).select("bucket", F.array_join("ids", " ").alias("ids"), F.explode("kept").alias("p"))
    told = answers.groupBy("bucket", "p.block").agg(F.sort_array(F.collect_list(F.struct("p.at", "ids"))).alias("l"))
    told = told.select(home(F.col("block")).alias("home"), F.col("bucket").alias("of"), F.array_join(F.transform("l", lambda x: x["ids"]), ",").alias("ids"))
    lists = told.repartition(parts, "home").groupBy("home").agg(F.sort_array(F.collect_list(F.struct("of", "ids"))).alias("l")).select("home", F.col("l.ids").alias("ids"))
    sent, byte = spark.sparkContext.broadcast(table), first_byte(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, open_ = bytes_of(sent.value), zstandard.ZstdDecompressor().decompress
        kinds = (pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.string(), pa.bool_())
        names = [x.split()[0] for x in SCHEMA.split(", ")]
        for b in batches:
            for k in range(b.num_rows):
                units = Spelling([x for bucket in b.column(2)[k].as_py() for x in bucket.split(",")], byte)
                rows, size = [], 0
                for batch in pa.ipc.open_stream(open_(b.column(1)[k].as_py())):
                    for doc, total, numbers in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                        joined = units.of(np.frombuffer(numbers, np.uint32))
                        text = text_of(joined.tolist(), raw)
                        rows.append((doc, len(joined), joined, text, xxhash.xxh64_intdigest(text.encode()) == total))
                        size += len(joined)
                        if size > 300_000:
                            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return both.join(lists, F.col("bucket") == F.col("home")).select("block", "held", "ids").mapInArrow(run, SCHEMA)
