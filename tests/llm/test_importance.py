"""Importance resampling against plain counting and sorting."""

import hashlib
import math
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from tablebridge.llm import importance
from tablebridge.llm.staging import table

SCHEMA = "doc_id long, text string, rank string, score int, place long"


def features(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = importance.WORD.findall(low)
    return len(words), [zlib.crc32(f.encode("utf-8", "surrogatepass")) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def brute(docs, target):
    own = [features(t) for _, t in docs]
    s, t = np.zeros(10000), np.zeros(10000)
    for _, f in own:
        np.add.at(s, f, 1)
    for x in target:
        np.add.at(t, features(x)[1], 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10000) / ((s[b] + 1) * (t.sum() + 10000)))) for b in range(10000)]
    rows = []
    for (i, _), (n, f) in zip(docs, own, strict=True):
        w = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n])
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): k for k, r in enumerate(able[: 25 * len(able) // 100], 1)}
    return sorted(map(str, ((*r[:4], rank.get(id(r))) for r in rows)))


def got(docs, target):
    return sorted(str(tuple(x)) for x in importance.resampled(docs, target).collect())


def test_the_driver_tables(spark):
    docs, target = table(spark, "/root/testdata/sf0.01", "documents"), table(spark, "/root/testdata/sf0.01", "benchmark")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    assert got(docs, target) == want and sum("None" not in x for x in want) > 100


def test_ties_nulls_repeats_and_far_ids(spark):
    r = random.Random(2)
    word = lambda: r.choice(["Alpha", "béta", "x", "42", "ünd", "日本"])
    docs = [(r.choice([-5, 3, 70]) * 10**k, " ".join(word() for _ in range(r.randrange(15, 40)))) for k in range(14) for _ in range(12)]
    docs = [(i + k, t) for k, (i, t) in enumerate(docs)]
    docs += [(-(2**63), docs[0][1]), (2**63 - 1, docs[1][1]), docs[5], docs[5], (None, docs[2][1]), (None, docs[2][1]), (1, None), (2, ""), (4, "--- ..."), (6, "a" * 300_000)]
    target = [docs[0][1], None, "", "alpha Alpha"]
    df = spark.createDataFrame([(*x, "c", 1, 5) for x in docs], SCHEMA)
    assert got(df, spark.createDataFrame([(x,) for x in target], "text string")) == brute(docs, target)


def test_one_document_many_times_no_documents_no_target(spark):
    none = spark.createDataFrame([], "text string")
    same = [(8, "one two three four five " * 5)] * 40
    assert got(spark.createDataFrame(same, "doc_id long, text string"), none) == brute(same, [])
    few = [(1, "a b"), (2, "w " * 30)]
    assert got(spark.createDataFrame(few, "doc_id long, text string"), none) == brute(few, [])
    empty = importance.resampled(spark.createDataFrame([], SCHEMA), none)
    assert empty.collect() == [] and dict(empty.dtypes) == dict.fromkeys(["doc_id", "n_features", "weight", "score", "rank"], "bigint")


def test_radix_order_is_stable_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 7)
    monkeypatch.setattr(importance, "GROUP", 3)
    monkeypatch.setattr(importance, "DIGIT", 3)
    r = random.Random(9)
    rows = [(k, r.choice([5, 5, 5, r.randrange(1 << 20)])) for k in range(500)]
    df = spark.createDataFrame(rows, "place long, key long").withColumn("was", F.col("place"))
    out = importance.radix_order(df, importance.digits([(F.col("key"), 20)])).orderBy("place").collect()
    assert [x.place for x in out] == list(range(500))
    assert [(x.key, x.was) for x in out] == sorted((k, p) for p, k in rows)


def test_long_texts_are_hashed_in_stretches(monkeypatch):
    words = importance.words_of("The cat, the DOG and über-cat " * 9)
    whole = np.sort(np.concatenate(list(importance.buckets(words))))
    for n in (1, 2, 7, len(words), len(words) - 1):
        monkeypatch.setattr(importance, "STRETCH", n)
        assert (np.sort(np.concatenate(list(importance.buckets(words)))) == whole).all()
