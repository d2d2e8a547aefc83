"""Benchmark passages in documents: exact hits of pieces, verified by bit-parallel edit distance."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from tablebridge.llm.staging import rows_of

#: An item is matched in passages of at most so many words; edits allowed per word; fewer words must stand in a document unchanged.
PASSAGE, RATE, LEAST = 24, 0.15, 8
#: Characters of benchmark text that are matched in one pass over the documents; a larger benchmark takes several passes.
PASS_CHARS = 16_000_000
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def cut(n: int, parts: int) -> list[tuple[int, int]]:
    """n things in so many runs, as even as may be."""
    return [(n * i // parts, n * (i + 1) // parts) for i in range(parts)]


def passages(item: list[str]) -> list[tuple[int, list[str]]]:
    """(number, words) of an item's passages: one for up to PASSAGE words, else as many even ones as needed."""
    return [(k, item[a:b]) for k, (a, b) in enumerate(cut(len(item), max(1, -(-len(item) // PASSAGE)))) if b > a]


def budget(n_words: int) -> int:
    return int(n_words * RATE) if n_words >= LEAST else 0


def myers(pattern: list[str], text: list[str], whole: bool = False) -> list[int]:
    """The edit distance of the pattern to the best stretch that ends at each word of the text (whole: that begins with the text)."""
    m = len(pattern)
    eq: dict[str, int] = defaultdict(int)
    for i, w in enumerate(pattern):
        eq[w] |= 1 << i
    mask, high, up, down, score, out = (1 << m) - 1, 1 << (m - 1), (1 << m) - 1, 0, m, []
    for w in text:
        e = eq.get(w, 0)
        vert = e | down
        horiz = (((e & up) + up) ^ up) | e
        plus, minus = (down | ~(horiz | up)) & mask, up & horiz
        score += bool(plus & high) - bool(minus & high)
        plus, minus = (plus << 1 | whole) & mask, minus << 1 & mask
        up, down = (minus | ~(vert | plus)) & mask, plus & vert
        out.append(score)
    return out


class Matcher:
    """The pieces of a block of items in one Aho-Corasick automaton over words joined by spaces."""

    def __init__(self, items: list[tuple[int | None, str | None]]) -> None:
        self.units: list[tuple[int | None, int, list[str], int]] = []
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item, text in items:
            words = words_of(text)
            for k, passage in passages(words):
                errors = budget(len(passage))
                for a, b in cut(len(passage), errors + 1):
                    pieces[f" {' '.join(passage[a:b])} "].append((len(self.units), a))
                self.units.append((item, k, passage, errors))
        self.automaton = ahocorasick.Automaton()
        for piece, where in pieces.items():
            self.automaton.add_word(piece, (len(piece), where))
        if pieces:
            self.automaton.make_automaton()

    def matches(self, text: str | None) -> list[tuple[int | None, int, int, int, int, int]]:
        """(item, passage, passage words, distance, start word, end word): the first best place of each passage within its budget, of an item the best passage."""
        words = words_of(text)
        if not words or not self.units:
            return []
        joined = f" {' '.join(words)} "
        hits = list(self.automaton.iter(joined))
        if not hits:
            return []
        begins = [0, *accumulate(len(w) + 1 for w in words)]
        windows: dict[int, set[tuple[int, int]]] = defaultdict(set)
        for end, (size, where) in hits:
            at = bisect_right(begins, end - size + 1) - 1
            for unit, offset in where:
                _, _, passage, errors = self.units[unit]
                windows[unit].add((max(0, at - offset - errors), min(len(words), at - offset + len(passage) + errors)))
        best: dict[int, tuple] = {}
        for unit, spans in windows.items():
            item, k, passage, errors = self.units[unit]
            for a, b in sorted(spans):
                scores = myers(passage, words[a:b])
                least = min(scores)
                if least > errors:
                    continue
                stop = a + scores.index(least) + 1
                back = myers(passage[::-1], words[a:stop][::-1], whole=True)
                start = stop - 1 - back.index(least) if least in back else a
                row = (least / len(passage), k, start, len(passage), least, stop)
                if unit not in best or row < best[unit][0]:
                    best[unit] = (row, item)
        found: dict[tuple, tuple] = {}
        for unit, (row, item) in best.items():
            key = (item is None, item or 0)
            if key not in found or row < found[key][0]:
                found[key] = (row, item)
        return [(item, k, n, least, start, stop) for (_, k, start, n, least, stop), item in (found[x] for x in sorted(found))]


def blocks(benchmark: DataFrame) -> Iterator[list[tuple[int | None, str | None]]]:
    """The benchmark in bounded blocks, partition by partition."""
    held, size = [], 0
    for row in benchmark.select("item_id", "text").toLocalIterator():
        held.append((row.item_id, row.text))
        size += len(row.text or "")
        if size >= PASS_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


SCHEMA = "doc_id long, item_id long, passage int, n_words int, distance int, start_word int, end_word int"


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, text) and (item_id, text) -> `SCHEMA`: one row for each document row and item with a passage within the budget.

    Words are runs of letters, digits and underscores, lower-cased. A passage of n words may differ
    by int(0.15 n) edits of words; it is cut into one piece more than that, so that an occurrence
    holds one piece unchanged. An item under 8 words counts wherever its words stand unchanged in a row
    (`n_words` tells its length, should very short ones not be wanted). Null and empty texts match nothing. Repeated documents and repeated
    items each have their rows; null ids stay null. Extra columns are not read. The benchmark is sent
    in blocks of bounded size, each of which is compared with all documents.
    """
    spark, out = docs.sparkSession, None
    for items in blocks(benchmark):
        sent = spark.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value)
            kinds = [pa.int64(), pa.int64()] + [pa.int32()] * 5
            for b in rows_of(batches):
                rows = [(doc, *m) for doc, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for m in matcher.matches(text)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(list(x), t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in SCHEMA.split(", ")])

        found = docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], SCHEMA) if out is None else out


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows, with all their columns, that hold no passage within its budget."""
    at = docs.columns.index("text")
    for items in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value)
            for b in batches:
                yield b.filter(pa.array([not matcher.matches(t) for t in b.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
