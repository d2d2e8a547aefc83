"""Hard negatives against a scan of all pairs."""

import math
import random

import numpy as np

from tablebridge.llm import hard_negatives
from tablebridge.llm.hard_negatives import mined
from tablebridge.llm.staging import table

SCHEMA = "vec_id long, embedding array<double>, label int, q int, rank string"


def brute(rows):
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        found = ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * float(x)) for x in v])
        kept[i] = min(found, kept.get(i, found))
    score = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    out = []
    for a, (label, q) in kept.items():
        if a % 50:
            continue
        all_ = sorted(((-score(q, r), i, other == label) for i, (other, r) in kept.items() if i != a))
        for p, pid, _ in [x for x in all_ if x[2]][:5]:
            inside = [x for x in all_ if not x[2] and 50 * -p <= 100 * -x[0] <= 95 * -p]
            out += [(a, pid, k, n, -p, -s) for k, (s, n, _) in enumerate(inside[:3], 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(x) for x in mined(df).collect())


def made(seed, n, d, step):
    r = np.random.default_rng(seed)
    base = r.normal(size=(12, d))
    return [(i, (np.round((base[i % 12] + r.normal(size=d) * 0.6) / step) * step / math.sqrt(d)).tolist(), int(r.integers(0, 4))) for i in range(n)]


def test_rows_equal_a_scan_of_all_pairs_over_several_shards(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD", 70)
    monkeypatch.setattr(hard_negatives, "BATCH", 3)
    for seed, d, step in ((1, 16, 1e-3), (2, 4, 0.5), (3, 1, 0.5)):  # coarse steps make ties
        rows = made(seed, 400, d, step)
        want = brute(rows)
        assert got(spark.createDataFrame([(*x, 1, "x") for x in rows], SCHEMA)) == want and len(want) > 30


def test_the_driver_table(spark):
    df = table(spark, "/root/testdata/sf0.01", "embeddings")
    want = brute([(r.vec_id, r.embedding, r.label) for r in df.collect()])
    assert got(df) == want and want


def test_stops_before_the_end_of_the_lists():
    r = np.random.default_rng(4)
    rows = [{"vec_id": i, "label": i % 2, "q": [int(x), 0]} for i, x in enumerate(r.permutation(5000))]
    import pyarrow as pa

    lists = hard_negatives.Lists(pa.array(rows), 2)
    anchor = {"vec_id": 0, "label": 0}
    calls = []
    real = lists.visit
    lists.visit = lambda v, enough: calls.append(real(v, enough)) or calls[-1]
    found = list(hard_negatives.local_positives(lists, anchor, np.array([3, 0])))
    top = sorted((-3 * x["q"][0], x["vec_id"]) for x in rows if x["label"] == 0 and x["vec_id"])[:5]
    assert [(-s, i) for _, _, _, i, s in found] == top and len(calls[0][0]) < 100


def test_nulls_repeats_odd_vectors_and_empty_tables(spark):
    r = random.Random(7)
    vec = lambda: [r.uniform(-1, 1) for _ in range(3)]
    rows = [(i, vec(), r.randrange(2)) for i in range(0, 60)]
    rows += [(None, vec(), 1), (100, None, 1), (101, [1.0, None, 0.0], 1), (102, [1.0, math.nan, 0.0], 0), (103, [math.inf, 0.0, 0.0], 0), (104, vec(), None)]
    rows += [rows[3], rows[3], (3, vec(), 0), (150, [], 0), (151, [0.5], 1), (200, [0.0, 0.0, 0.0], 1), (250, [2.0, 1.0, 3.0, 4.0], 0)]
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], SCHEMA)
    want = brute(rows)
    assert got(df) == want and want
    assert got(df.limit(0)) == []
    assert got(df.where("label is null")) == []
    assert dict(mined(df.limit(0)).dtypes) == dict(anchor_id="bigint", positive_id="bigint", rank="int", negative_id="bigint", positive_score="bigint", negative_score="bigint")


def test_large_components_are_exact():
    big = np.array([[2**28, -(2**28) + 1]], np.int64)
    assert hard_negatives.product(big, big[0]).tolist() == [2**56 + (2**28 - 1) ** 2]


def test_scores_come_from_one_copy_in_doubles_unless_they_would_not_be_exact():
    import pyarrow as pa

    r = np.random.default_rng(6)
    for most in (100, 2**28):
        rows = [{"vec_id": i, "label": 1, "q": r.integers(-most, most, 5).tolist()} for i in range(300)]
        lists = hard_negatives.Lists(pa.array(rows), 5)
        for anchor in (r.integers(-most, most, 5), np.array([0, 3, 0, -2, 0]), np.zeros(5, np.int64)):
            want = [sum(int(x) * int(y) for x, y in zip(row["q"], anchor, strict=True)) for row in rows]
            assert lists.scores(np.arange(300), anchor).tolist() == want
            numbers, scores = lists.visit(anchor, lambda n, s, t: False)
            assert sorted(numbers.tolist()) == list(range(300)) and scores.tolist() == [want[i] for i in numbers]
            seen = []
            lists.visit(anchor, lambda n, s, t: seen.append((set(n.tolist()), t)) or False)
            assert all(want[i] <= t for some, t in seen for i in range(300) if i not in some)
        assert lists.exact(np.array([100] * 5)) and lists.exact(np.array([2**28] * 5)) == (most == 100)


def test_no_row_is_broadcast_and_parts_meet_once(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD", 70)
    monkeypatch.setattr(hard_negatives, "BATCH", 2)
    rows = made(5, 400, 4, 0.5)
    df = spark.createDataFrame([(*x, 1, "x") for x in rows], SCHEMA)
    plans, real = [], hard_negatives.stage
    monkeypatch.setattr(hard_negatives, "stage", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    for held in (1, 2, 100):
        monkeypatch.setattr(hard_negatives, "HELD", held, raising=False)
        found = mined(df)
        assert sorted(tuple(x) for x in found.collect()) == brute(rows)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        # Copies of the anchors are many times what Spark takes them for.
        assert not [p for p in plans if "Broadcast" in p]


def test_parts_are_bounded_and_send_few_copies():
    parts = hard_negatives.parts
    assert parts(0, 0, 12) == (1, 1) and parts(4096, 82, 200) == (1, 1)
    assert parts(51_282, 1_026, 12) == (12, 1)  # a task for each partition asked for
    assert parts(4097, 4097, 200) == (2, 5)  # never less than a shard or a batch
    for n in (10**5, 10**6, 10**8):
        for share in (1, 50):
            of_rows, of_anchors = parts(n, n // share, 200)
            assert n / of_rows <= 4096 * 16 and n / share / of_anchors <= 1024 * 16 and of_rows * of_anchors >= min(200, n / 4096 * n / share / 1024)


def test_stretches_join_a_shard_over_batches():
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"shard": pa.array(s, pa.int64()), "x": pa.array(x, pa.int64())}) for s, x in (([-1, -1, 0], [1, 2, 3]), ([], []), ([0, 2], [4, 5]), ([2], [6]))]
    assert [(s, b.column("x").to_pylist()) for s, b in hard_negatives.stretches(iter(batches))] == [(-1, [1, 2]), (0, [3, 4]), (2, [5, 6])]
