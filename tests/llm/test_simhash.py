"""SimHash near-duplicates against brute force."""

import random

import numpy as np
import xxhash

from tablebridge.llm import simhash
from tablebridge.llm.components import components


def brute(texts):
    out = []
    for text in texts:
        words = (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split()
        grams = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] * bool(words)
        h = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        out.append(sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h)))
    return out


def groups(ids, fps):
    label = list(ids)
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if label[i] > label[j] and (fps[i] ^ fps[j]).bit_count() <= 2:
                    label[i], changed = label[j], True
    return label


def test_golay_code_covers_every_word_within_three_bits():
    value, offsets, counts = simhash.golay()
    assert (counts[:, :4].sum(axis=1) == 1).all() and counts.sum() == 880970


def test_anchors_are_all_pairs_of_code_words_in_reach():
    rng = np.random.default_rng(1)
    fp = rng.integers(-(2**63), 2**63, 5)
    homes = simhash.home(fp)
    got = {}
    for of, anchor in simhash.anchors(fp):
        for i, a in zip(of.tolist(), anchor.tolist(), strict=True):
            got.setdefault(i, []).append(a)
    for i, x in enumerate(fp.tolist()):
        low = x & ((1 << 46) - 1)
        swapped = (low & ((1 << 23) - 1)) << 23 | low >> 23
        assert len(set(got[i])) == len(got[i]) and int(homes[i]) in got[i]
        assert all((a ^ swapped).bit_count() <= 8 for a in got[i])
        for _ in range(50):
            y = np.array([x], np.int64)
            for k in random.sample(range(64), 2):
                y.view(np.uint64)[0] ^= np.uint64(1 << k)
            assert int(simhash.home(y)[0]) in got[i]


def test_near_duplicates_equal_brute_force(spark):
    r = random.Random(3)
    words = ["alpha", "Beta", "gamma", "dé", "eps", "zeta", "eta", "theta", "x"]
    base = [" ".join(r.choice(words) + str(r.randrange(9)) for _ in range(r.randrange(60, 200))) for _ in range(25)]
    texts = list(base)
    for t in base:
        for _ in range(4):
            w = t.split()
            w[r.randrange(len(w))] = "changed"
            texts.append("  ".join(w).upper() if r.random() < 0.3 else " ".join(w))
    texts += ["", None, " \t\n", "one", "ONE", "one two", "a b c", base[0], base[0], "é" * 50_000]
    ids = list(range(100, 100 + len(texts)))
    r.shuffle(ids)
    rows = [(i, t, "en", 7) for i, t in zip(ids, texts, strict=True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = {x.doc_id: x for x in simhash.near_duplicates(df).collect()}
    fps = brute(texts)
    assert [got[i].fingerprint for i in ids] == [f"{f:016x}" for f in fps]
    assert [got[i].component_id for i in ids] == groups(ids, fps)


def test_null_ids_repeated_rows_and_empty_tables(spark):
    schema = "doc_id long, text string"
    rows = [(None, "same text here now"), (5, "same text here now"), (5, "same text here now"), (None, "quite another one")]
    got = sorted(map(str, ((x.doc_id, x.component_id) for x in simhash.near_duplicates(spark.createDataFrame(rows, schema)).collect())))
    assert got == sorted(map(str, [(None, 5), (5, 5), (5, 5), (None, None)]))
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(50)] + [(2000, 2000)]
    got = {x.node: x.root for x in components(spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert {got[i] for i in range(61)} == {0} and {got[1000 + i] for i in range(51)} == {1000} and 2000 not in got
