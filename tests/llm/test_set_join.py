"""The Jaccard join against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablebridge.llm import set_join

SCHEMA = "doc_id long, text string, point string, n int, key long"


def shingle_set(text):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
    return {b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else set()


def brute(rows):
    found = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(found[i] & found[j])
            if both and 100 * both >= 90 * (len(found[i]) + len(found[j]) - both) and label[i] != label[j]:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    least = {}
    for (i, _), x in zip(rows, label, strict=True):
        if i is not None:
            least[x] = min(i, least.get(x, i))
    return sorted(str((i, len(s), least.get(x) if s else i)) for (i, _), s, x in zip(rows, found, label, strict=True))


def got(spark, rows):
    df = spark.createDataFrame([(i, t, "p", 1, 2) for i, t in rows], SCHEMA)
    return sorted(str(tuple(x)) for x in set_join.linked(df).collect())


def family(r, n, size, words=400):
    """Chains of edits: neighbours are near the limit, ends far beyond it."""
    base = [f"w{r.randrange(words)}" for _ in range(size)]
    for _ in range(n):
        yield " ".join(base)
        base = list(base)
        for _ in range(r.randrange(1, 2 + size // 60)):
            base[r.randrange(len(base))] = f"x{r.randrange(10**6)}"
        if r.random() < 0.4:
            base = base + [f"y{r.randrange(99)}" for _ in range(r.randrange(1, 4))] if r.random() < 0.5 else base[: -r.randrange(1, 4)]


def test_links_equal_all_pairs(spark):
    r = random.Random(1)
    texts = [t for size in (9, 10, 11, 14, 20, 30, 45, 70, 120, 260, 700) for _ in range(3) for t in family(r, 8, size)]
    texts += ["", None, " \n", "a", "A", "a b", "A  b", "a b c", "b c a", "one " * 4000, "é" * 90_000]
    ids = list(range(1000, 1000 + len(texts)))
    r.shuffle(ids)
    rows = list(zip(ids, texts, strict=True))
    want = brute(rows)
    assert got(spark, rows) == want and len({x.split(", ")[2] for x in want}) < len(rows) - 60


@pytest.mark.parametrize("price", [0, 1e9])
def test_any_spending_gives_the_same_links(spark, monkeypatch, price):
    """A hot passage: many texts share most of their words and still do not link."""
    monkeypatch.setattr(set_join, "ROW_PRICE", price)
    r = random.Random(2)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"{passage} " + " ".join(f"v{r.randrange(10**6)}" for _ in range(r.randrange(2, 12)))) for i in range(150)]
    rows += [(1000 + i, t) for i, t in enumerate(family(r, 60, 90))]
    assert got(spark, rows) == brute(rows)


def test_signatures_of_linked_sets_always_meet():
    rng = np.random.default_rng(3)
    for n in [*range(9, 60), 200, 999]:
        one = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        for _ in range(6):
            gone, more = rng.integers(0, n // 9 + 1, 2)
            two = np.unique(np.concatenate([one[gone:], rng.integers(0, 2**63, more).astype(np.uint64)]))
            unlike = len(np.setxor1d(one, two))
            if 19 * unlike > len(one) + len(two):
                continue
            common = set(set_join.bands_of(len(one))) & set(set_join.bands_of(len(two)))
            assert common or not unlike
            for band in common:
                m = set_join.most_unlike(band) + 1
                spent = np.ones(m, int)
                for dear, cheap in rng.permutation(m)[: m // 2 * 2].reshape(-1, 2)[: rng.integers(0, m // 2 + 1)]:
                    spent[dear], spent[cheap] = 0, 2
                (w1, l1), (w2, l2) = (set_join.signature(x, band, spent) for x in (one, two))
                assert np.isin(w1, w2).any() or np.isin(w1, l2).any() or np.isin(l1, w2).any()
                bits = sum(int(x).bit_count() for x in (set_join.sketch(one, band) ^ set_join.sketch(two, band)).view(np.uint64))
                assert bits <= unlike
        assert not set_join.bands_of(8) and not set_join.bands_of(0)


def test_copies_null_ids_repeats_and_empty_tables(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(None, text), (None, text + " z"), (7, text), (5, text), (5, text), (5, "other words here"), (None, "alone in the world"), (None, None), (3, None), (3, ""), (2, text.upper())]
    assert got(spark, rows) == brute(rows)
    assert got(spark, []) == []
    nulls = [(None, text), (None, text + " z"), (None, text)]
    assert got(spark, nulls) == brute(nulls)


def test_a_large_group_is_compared_with_heads_first(spark):
    r = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(300):
        words = list(base)
        words[r.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert set_join.linked(df).where(F.col("component_id") == 0).count() == 300
