"""Boosted trees and the quality classifier: held-out accuracy, determinism, odd inputs."""

import zlib

import numpy as np
import pytest

from tablebridge.llm import quality
from tablebridge.llm.boosting import train, train_table
from tablebridge.llm.staging import table


def test_trees_learn_an_interaction_and_equal_a_plain_walk():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.3)).astype(int)
    trees = train(x[:2000], y[:2000])
    assert ((trees.score(x[2000:]) >= 0.5) == y[2000:]).mean() > 0.95

    def walk(row):
        total = trees.base
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            k = 0
            while k < len(f):
                k = 2 * k + 1 + (row[f[k]] > t[k])
            total += leaf[k - len(f)]
        return total

    assert np.allclose(trees.margin(x[:50]), [walk(r) for r in x[:50]])
    assert (train(x, y).leaf == train(x, y).leaf).all()


def test_trees_of_a_table_equal_trees_of_its_rows(spark):
    rng = np.random.default_rng(1)
    x = rng.integers(0, 90, size=(1500, 3)).astype(float)
    y = ((x[:, 0] > 40) ^ (x[:, 2] > 20)).astype(int)
    rows = [(r.tolist(), 1, int(c)) for r, c in zip(x, y, strict=True)]
    got = train_table(spark.createDataFrame([*rows[:1000], *((r, 2, 2 * c) for r, _, c in rows[1000:])], "x array<double>, n long, positive long"), 4, 3)
    want = train(np.concatenate([x, x[1000:]]), np.concatenate([y, y[1000:]]), 4, 3)
    assert (got.feature == want.feature).all() and (got.threshold == want.threshold).all()
    assert np.allclose(got.leaf, want.leaf, atol=1e-4) and got.base == want.base


@pytest.mark.parametrize(("y", "low", "high"), [([], 0.5, 0.5), ([1] * 30, 0.9, 1), ([0] * 30, 0, 0.1)])
def test_trees_without_a_choice(y, low, high):
    score = train(np.ones((len(y), 2)), np.array(y)).score(np.zeros((3, 2)))
    assert ((score >= low) & (score <= high)).all()


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    got = {r.doc_id: r for r in quality.assess(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    held = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(held) > 1000 and sum(r.predicted == q for r, q in held) / len(held) > 0.98


def test_only_training_labels_matter(spark):
    folder = "/root/testdata/sf0.001"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    turned = labels.selectExpr("doc_id", "case when crc32(cast(doc_id as string)) % 3 = 1 then 1 - quality else quality end as quality", "toxic")
    rows = lambda x: sorted(map(tuple, quality.assess(docs, x).collect()))
    assert rows(labels) == rows(turned)


def test_odd_rows_and_empty_tables(spark):
    schema = "doc_id long, text string, label string, score int"
    rows = [(1, None, "a", 1), (2, "", None, 2), (None, "some words", "c", 3), (4, "x" * 2_000_000, "d", 4), (4, "x y", "d", 4), (5, " \n ", "", 5)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (4, None, 0), (99, 1, 1)], "doc_id long, quality int, toxic int")
    for x in (labels, labels.limit(0)):
        got = quality.assess(docs, x).collect()
        assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert all(r.score == 0.5 and r.predicted == 1 for r in got)
    assert quality.assess(docs.limit(0), labels).count() == 0
    assert len(quality.statistics("a")) == len(quality.NAMES) == len(quality.statistics(None))
