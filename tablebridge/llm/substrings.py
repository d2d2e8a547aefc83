"""Passages that repeat across documents: matching statistics against suffix automata of reference shards.

The reference of a document is every document with a smaller id, so to send each shard's automaton to
all documents would take time that grows with the square of the corpus. Shards are routed instead: a
window's sampled word pair ("minimizer") names its shard, so that equal windows meet in one shard.
"""

from __future__ import annotations

import gc
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import compress, tee

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from tablebridge.llm.staging import rows_of, stage

#: Words of a window; words of a sampled gram, of which every window holds one.
SPAN, GRAM = 13, 5
REACH = SPAN - GRAM + 1
#: Reference words in one automaton.
SHARD_WORDS = 150_000
#: Bytes of words that are hashed together.
TOGETHER = 100_000
ODD, STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finishing steps of a common public hash)."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    return x ^ x >> np.uint64(33)


@lru_cache(1)
def powers() -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.full(4095, ODD)]).cumprod(dtype=np.uint64)


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit hash of each word from all its bytes; only sampling rests on it."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    begins = np.cumsum(lengths) - lengths
    codes = np.frombuffer(b"".join(words), np.uint8).astype(np.uint64) + np.uint64(1)
    at = np.arange(len(codes)) - np.repeat(begins, lengths)
    codes *= powers()[at] if lengths.max() <= 4096 else powers()[at & 4095] ^ (at >> 12).astype(np.uint64)
    return mix(np.add.reduceat(codes, begins))


def samples(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return next(samples_of([words]))


def samples_of(texts: Iterable[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For the words of each text, runs of windows that share their least gram: (gram hash as signed, first window, windows). Equal windows have equal grams.

    Short texts are hashed together, up to some TOGETHER bytes; no window goes over the end of a text.
    """
    held, size = [], 0
    for words in texts:
        held.append(words)
        size += sum(map(len, words)) if len(words) < TOGETHER else TOGETHER
        if size >= TOGETHER:
            yield from sampled(held)
            held, size = [], 0
    if held:
        yield from sampled(held)


def sampled(texts: list[list[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    windows = np.array([max(0, len(words) - SPAN + 1) for words in texts])
    ends = np.cumsum(windows)
    if not ends[-1]:
        yield from [(np.zeros(0, np.int64),) * 3] * len(texts)
        return
    h = word_hashes([w for words, n in zip(texts, windows.tolist(), strict=True) if n for w in words])
    n = len(h) - GRAM + 1
    grams = np.zeros(n, np.uint64)
    for j in range(GRAM):
        grams = grams * STEP + h[j : j + n]
    grams = mix(grams)
    m = n - REACH + 1
    least, at = grams[:m].copy(), np.arange(m)
    for j in range(1, REACH):
        less = grams[j : j + m] < least
        np.copyto(least, grams[j : j + m], where=less)
        at[less] = np.flatnonzero(less) + j
    begins = np.cumsum(np.where(windows > 0, windows + SPAN - 1, 0)) - np.where(windows > 0, windows + SPAN - 1, 0)
    own = np.arange(ends[-1]) - np.repeat(ends - windows, windows)  # a window's place in its text
    at = at[own + np.repeat(begins, windows)]
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]) | (own == 0))
    gram, many, first_own = grams[at[first]].view(np.int64), np.diff(np.append(first, len(at))), own[first]
    cuts = np.searchsorted(first, ends)
    for x, y in zip([0, *cuts.tolist()], cuts.tolist(), strict=False):
        yield gram[x:y], first_own[x:y], many[x:y]


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def asked(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, gram, route, known): which grams each document samples.

    A gram that two documents of a batch sample is known to be shared: one row of it asks for others
    (route: the gram), and the batch's other documents need no answer (route: spread). So a gram
    that a third of all documents hold brings one asking row a batch, not one a document.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows_of(batches, chars=16_000_000):
            named = [(doc, t) for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) if doc is not None]
            found = [(doc, np.unique(s[0])) for (doc, _), s in zip(named, samples_of(words_of(t) for _, t in named), strict=True)]
            if not found:
                continue
            gram = np.concatenate([g for _, g in found])
            doc = np.repeat(np.array([d for d, _ in found], np.int64), [len(g) for _, g in found])
            order = np.lexsort((doc, gram))
            gram, doc = gram[order], doc[order]
            first = np.concatenate([[True], gram[1:] != gram[:-1]])[: len(gram)]
            group = np.cumsum(first) - 1
            many = np.maximum.reduceat(doc, np.flatnonzero(first)) > doc[first] if len(gram) else first
            known = many[group]
            route = np.where(first, gram, mix((gram ^ doc * 2 + 1).view(np.uint64)).view(np.int64))
            keep = first | known
            back = np.lexsort((gram[keep], doc[keep]))
            yield pa.RecordBatch.from_arrays([pa.array(x[keep][back]) for x in (doc, gram, route, known)], ["doc_id", "gram", "route", "known"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, gram long, route long, known boolean")


def shared(asking: DataFrame) -> DataFrame:
    """(doc_id, grams): the sampled grams of a document that another document samples too."""
    own = Window.partitionBy("route")
    found = asking.select("doc_id", "gram", "known", F.min("doc_id").over(own).alias("least"), F.max("doc_id").over(own).alias("most"))
    return found.where("known or least < most").groupBy("doc_id").agg(F.collect_set("gram").alias("grams"))


def digest_of(raw: bytes) -> bytes:
    return hashlib.blake2b(raw, digest_size=16).digest()


def key_of(text: str) -> Column:
    """A digest of a text's UTF-8 bytes (null: of none)."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def keys(docs: DataFrame) -> DataFrame:
    """(doc_id, key): a digest of each text."""
    return docs.select("doc_id", key_of("text").alias("key"))


def packed(docs: DataFrame) -> DataFrame:
    """(doc_id, key, pack): a digest of each text and the text compressed, for shuffles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3).compress
        for b in rows_of(batches):
            packs = [squeeze((t or "").encode("utf-8", "surrogatepass")) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(packs, pa.binary())], ["doc_id", "key", "pack"])

    return docs.select("doc_id", "text", key_of("text").alias("key")).mapInArrow(run, "doc_id long, key binary, pack binary")


def copies(texts: DataFrame) -> DataFrame:
    """(doc_id, key) -> (doc_id, copied): digests of the document's texts that a smaller id holds too. Least ids are aggregated before the shuffle."""
    own = stage(texts.where("doc_id is not null").distinct(), "keys")
    first = stage(own.groupBy("key").agg(F.min("doc_id").alias("first_id")), "first")
    return own.join(first, "key").where("first_id < doc_id").groupBy("doc_id").agg(F.collect_set("key").alias("copied"))


FRAGMENT = "doc_id long, key binary, first int, gram long, digest binary, fragment binary"


def fragments(texts: DataFrame) -> DataFrame:
    """(doc_id, key, pack, grams, copied) -> `FRAGMENT`: the words around each shared gram, all windows that sample it.

    A text that a smaller id holds whole has none: every window of it repeats.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        kinds = (pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
        names = [x.split()[0] for x in FRAGMENT.split(", ")]
        for b in batches:
            rows: list[tuple] = []
            some = [x for x in zip(*(c.to_pylist() for c in b.columns), strict=True) if x[3] and x[1] not in (x[4] or ())]
            first_read, second_read = tee(open_(pack).split() for _, _, pack, _, _ in some)
            for (doc, key, _, grams, _), words, (gram, first, n) in zip(some, first_read, samples_of(second_read), strict=True):
                for k in np.flatnonzero(np.isin(gram, np.array(grams, np.int64))).tolist():
                    f = b" ".join(words[first[k] : first[k] + n[k] + SPAN - 1])
                    rows.append((doc, key, int(first[k]), int(gram[k]), digest_of(f), f))
                if len(rows) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), kinds, strict=True)], names)

    return texts.select("doc_id", "key", "pack", "grams", "copied").mapInArrow(run, FRAGMENT)


class Automaton:
    """A suffix automaton of several word sequences; each state knows the least document that holds its words."""

    def __init__(self) -> None:
        self.next: list[dict[bytes, int]] = [{}]
        self.link, self.size, self.least = [-1], [0], [1 << 63]

    def state(self, size: int, link: int, moves: dict[bytes, int]) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        self.least.append(1 << 63)
        return len(self.size) - 1

    def split(self, p: int, word: bytes, q: int) -> int:
        """A state for the words of p and this word alone, where q holds longer ones too."""
        c = self.state(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = c
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = c
            p = self.link[p]
        return c

    def add(self, words: list[bytes], doc: int) -> list[int]:
        """The states of the sequence's prefixes: each stays the state of its prefix whatever is added later."""
        last, passed = 0, []
        moves, link, size, least = self.next, self.link, self.size, self.least
        for word in words:
            q = moves[last].get(word)
            if q is not None:
                last = q if size[q] == size[last] + 1 else self.split(last, word, q)
            else:
                new, p = len(size), last
                moves.append({})
                link.append(0)
                size.append(size[last] + 1)
                least.append(1 << 63)
                while p >= 0 and word not in moves[p]:
                    moves[p][word] = new
                    p = link[p]
                if p >= 0:
                    q = moves[p][word]
                    link[new] = q if size[q] == size[p] + 1 else self.split(p, word, q)
                last = new
            if doc < least[last]:
                least[last] = doc
            passed.append(last)
        return passed

    def close(self) -> None:
        """Hand each state's document down to the states of its suffixes, the longest first."""
        size, link, least = np.array(self.size), np.array(self.link), np.array(self.least, np.uint64)
        order = np.argsort(-size, kind="stable")[:-1]  # without the start
        for states in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
            np.minimum.at(least, link[states], least[states])
        self.least = least.tolist()

    def windows_at(self, passed: list[int], span: int = SPAN) -> np.ndarray:
        """For each state of a prefix the least document that holds the prefix's last `span` words. A prefix in the automaton matches whole, so
        its matching statistic is its length: only the cut at the span is left, which goes along the suffix links."""
        size, link = np.array(self.size), np.array(self.link)
        v = np.array(passed, np.int64)
        while len(longer := np.flatnonzero(size[link[v]] >= span)):
            v[longer] = link[v[longer]]
        return np.array(self.least, np.uint64)[v]

    def windows(self, words: list[bytes], span: int = SPAN) -> list[int]:
        """For each window of the sequence the least document that holds it, or 2**63: matching statistics, cut at the span."""
        v, matched, out = 0, 0, []
        for i, word in enumerate(words):
            while v and word not in self.next[v]:
                v = self.link[v]
                matched = self.size[v]
            v = self.next[v].get(word, 0)
            matched = min(span, matched + 1) if v else 0
            while v and self.size[self.link[v]] >= span:
                v = self.link[v]
            if i >= span - 1:
                out.append(self.least[v] if matched == span else 1 << 63)
        return out


def judged(parts: list[tuple[bytes, list[bytes], int]]) -> list[tuple[bytes, list[int]]]:
    """(digest, words, document) of whole shards -> the least document of each window, by automata of at most SHARD_WORDS words."""
    best = [[1 << 63] * (len(words) - SPAN + 1) for _, words, _ in parts]
    at = 0
    while at < len(parts):
        automaton, held, n, passed = Automaton(), 0, at, []
        while n < len(parts) and (n == at or held + len(parts[n][1]) <= SHARD_WORDS):
            passed += automaton.add(parts[n][1], parts[n][2])[SPAN - 1 :]
            held += len(parts[n][1])
            n += 1
        automaton.close()
        own, i = automaton.windows_at(passed).tolist(), 0
        for k, (_, words, _) in enumerate(parts):
            if at <= k < n:
                found = own[i : i + len(best[k])]
                i += len(found)
            else:
                found = automaton.windows(words)
            best[k] = found if at == 0 else list(map(min, best[k], found))
        at = n
    return [(digest, b) for (digest, _, _), b in zip(parts, best, strict=True)]


def first_documents(distinct: DataFrame) -> DataFrame:
    """(gram, digest, fragment, doc_id) of distinct fragments, a gram's in one partition -> (digest, least array<long>).

    Grams in order share an automaton until it is full; a gram with more words than that has several,
    and its fragments are streamed past each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def told(parts: list) -> pa.RecordBatch:
            gc.disable()  # an automaton has no cycles; the collector would walk its states again and again
            try:
                found = judged(parts)
            finally:
                gc.enable()
            # Each window is in its own fragment, so that it has a least document.
            return pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.binary()), pa.array([b for _, b in found], pa.list_(pa.int64()))], ["digest", "least"])

        parts, size, last = [], 0, None
        for b in batches:
            for gram, digest, fragment, doc in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if gram != last and size >= SHARD_WORDS * 2 // 3:
                    yield told(parts)
                    parts, size = [], 0
                words = fragment.split(b" ")
                parts.append((digest, words, doc))
                size, last = size + len(words), gram
        if parts:
            yield told(parts)

    ordered = distinct.repartition("gram").sortWithinPartitions("gram", "digest").select("gram", "digest", "fragment", "doc_id")
    return ordered.mapInArrow(run, "digest binary, least array<long>")


def repeated_windows(texts: DataFrame) -> DataFrame:
    """(doc_id, key, pack, grams, copied) -> (doc_id, spans): for each text key, where the windows start that a smaller id holds too."""
    rows = stage(fragments(texts), "fragments")
    distinct = rows.groupBy("gram", "digest").agg(F.min("doc_id").alias("doc_id"), F.first("fragment").alias("fragment"))
    least = stage(first_documents(distinct), "least")
    own = rows.select("doc_id", "key", "first", "digest")
    hits = own.join(least, "digest").withColumn("at", F.filter(F.sequence(F.lit(0), F.size("least") - 1), lambda i: F.element_at("least", i + 1) < F.col("doc_id")))
    hits = hits.where(F.size("at") > 0).select("doc_id", "key", F.transform("at", lambda i: i + F.col("first")).alias("starts"))
    each = hits.groupBy("doc_id", "key").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    return each.groupBy("doc_id").agg(F.collect_list(F.struct("key", "starts")).alias("spans"))


def deduplicated(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_words, n_removed, kept): texts without the words of windows that a smaller id holds too.

    A window is 13 consecutive words of one document, as the input has them; kept joins the other
    words by one space. Null texts have no words. A row with a null doc_id keeps all its words and
    is no reference. Rows of one doc_id never remove each other's words. Extra columns are not read;
    an empty table gives an empty one.
    """
    texts = packed(docs)
    side = stage(shared(asked(docs)).join(copies(keys(docs)), "doc_id", "full_outer"), "shared")
    spans = stage(repeated_windows(texts.join(side.where("grams is not null"), "doc_id")), "spans")
    answers = side.select("doc_id", "copied").join(spans, "doc_id", "full_outer").where("copied is not null or spans is not null")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor().decompress
        for b in batches:
            rows = []
            for doc, key, pack, copied, found in zip(*(c.to_pylist() for c in b.columns), strict=True):
                words = open_(pack).split()
                n, kept = len(words), words
                if key in (copied or ()) and n >= SPAN:
                    kept = []
                for s in found or ():
                    if s["key"] == key and kept:
                        starts = np.array(s["starts"])
                        begun = np.bincount(starts, minlength=n + 1) - np.bincount(starts + SPAN, minlength=n + 1)
                        kept = list(compress(words, (np.cumsum(begun)[:n] == 0).tolist()))
                rows.append((doc, n, n - len(kept), b" ".join(kept)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], ["doc_id", "n_words", "n_removed", "kept"])

    joined = texts.join(answers, "doc_id", "left").select("doc_id", "key", "pack", "copied", "spans")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept binary")
