"""Cross-entropy difference against plain counting."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablebridge.llm import cross_entropy as ce


def brute(docs, target, size):
    words = Counter(w for _, t in docs for w in (t or "").lower().split())
    vocab = {w: k + 2 for k, (w, _) in enumerate(sorted(words.items(), key=lambda x: (-x[1], x[0]))[: size - 2])}
    ids = [(i, [1, *(vocab.get(w, 0) for w in (t or "").lower().split())]) for i, t in docs]
    pairs = [Counter(), Counter()]
    for i, x in ids:
        for p in zip(x, x[1:], strict=False):
            pairs[1][p] += 1
            pairs[0][p] += i in target
    scale = sum(pairs[0].values()) / max(1, sum(pairs[1].values())) or 1.0
    pairs[1] = {p: n * scale for p, n in pairs[1].items()}

    def loss(counts, x):
        after = [sum(n for (_, b), n in counts.items() if b == k) + ce.FLOOR for k in range(size)]
        before = Counter()
        for (a, _), n in counts.items():
            before[a] += n
        total = sum(after)
        return sum(-math.log((counts.get((a, b), 0) + ce.BELOW * after[b] / total) / (before[a] + ce.BELOW)) for a, b in zip(x, x[1:], strict=False)) / (len(x) - 1)

    return {(i, tuple(x)): (loss(pairs[0], x), loss(pairs[1], x)) if len(x) > 1 else (None, None) for i, x in ids}, vocab


def test_scores_equal_plain_counting(spark, monkeypatch):
    monkeypatch.setattr(ce, "HELD", 5)
    monkeypatch.setattr(ce, "BUCKET", 40)
    r = random.Random(7)
    words = [f"W{i}" for i in range(40)]
    docs = [(i, " ".join(r.choice(words[: 10 if i % 2 else 40]) for _ in range(r.randrange(1, 50)))) for i in range(60)] + [(70, None), (71, ""), (None, "w1 w2"), (3, "w3 w3 w3")]
    target = {i for i in range(1, 40, 2)}
    want, vocab = brute(docs, target, len({w for _, t in docs for w in (t or "").lower().split()}) + 2)
    df = spark.createDataFrame([(i, t, True) for i, t in docs], "doc_id long, text string, is_target boolean")
    mark = spark.createDataFrame([(i, "x") for i in [*target, 1, None, 500]], "doc_id long, text string")
    got = ce.score(df, mark).collect()
    assert len(got) == len(docs)
    for x in got:
        match = [v for (i, ids), v in want.items() if i == x.doc_id and len(ids) == x.n_tokens + 1]
        if x.n_tokens == 0:
            assert x.target_loss is None and x.difference is None
        else:
            assert any(abs(x.target_loss - t) < 1e-4 and abs(x.background_loss - b) < 1e-4 for t, b in match)
            assert x.difference == pytest.approx(x.target_loss - x.background_loss)
    mean = lambda odd: [x.difference for x in got if x.doc_id in range(60) and x.doc_id % 2 == odd]
    assert sum(mean(1)) / 30 < sum(mean(0)) / 30
    assert ce.score(df.limit(0), mark).count() == 0 and ce.score(df, mark.limit(0)).count() == len(docs)


def test_rare_words_tell_texts_apart(spark, monkeypatch):
    monkeypatch.setattr(ce, "HELD", 700)
    common = [f"c{i}" for i in range(2060)]
    docs = [(0, " ".join(common * 3)), (1, "red sun red sun red sun"), (2, "red sun"), (3, "dry ice"), (4, "dry ice dry"), (5, "")]
    target = {0, 1}
    want, vocab = brute(docs, target, len({w for _, t in docs for w in t.split()}) + 2)
    got = {x.doc_id: x for x in ce.score(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(i,) for i in target], "doc_id long")).collect()}
    for (i, ids), (t, b) in want.items():
        if i == 0:
            continue
        assert got[i].n_tokens == len(ids) - 1 and (t is None) == (got[i].target_loss is None)
        assert t is None or (got[i].target_loss == pytest.approx(t) and got[i].background_loss == pytest.approx(b))
    assert got[2].difference < got[3].difference - 1


def test_each_bucket_has_a_task_of_its_own(spark):
    keys = [np.array(x, np.uint64) for x in ([3, 5, 9], [5, 9, 11], [2])]
    rows = [(c, b, ce.pack(np.diff(k, prepend=np.uint64(0)), k % np.uint64(2), np.full(len(k), c + 1, np.uint64))) for b in range(16) for c, k in enumerate(keys)]
    found = ce.answered(spark.createDataFrame(rows, ce.BLOB), 16).withColumn("task", F.spark_partition_id()).collect()
    assert len({x.task for x in found}) == 16 and len(found) == 16 * 4
    for b in range(16):
        got = {x.chunk: [c.tolist() for c in ce.unpack(x.blob, 2)] for x in found if x.bucket == b and x.chunk is not None and x.blob}
        assert got == {0: [[1, 2, 2], [1, 3, 3]], 1: [[2, 2, 1], [3, 3, 2]], 2: [[0], [3]]}
    assert sorted(x.bucket for x in found if x.chunk is None) == [4] * 16


def test_values_are_numbered_in_order():
    r = np.random.default_rng(4)
    parts = [np.unique(r.integers(0, 50, n).astype(np.uint64)) for n in (0, 1, 30, 60)]
    keys, at = np.unique(np.concatenate(parts), return_inverse=True)
    got = ce.numbered(list(parts))
    assert got[0].tolist() == keys.tolist() and got[1].tolist() == at.tolist()
