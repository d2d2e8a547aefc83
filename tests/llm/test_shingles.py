"""Near copies by shingles against brute force over all pairs."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from tablebridge.llm import shingles, simhash
from tablebridge.llm.staging import table


def brute(rows):
    """The least id of each group of texts that share 0.8 of their five-word shingles."""
    ids = [i for i, _ in rows]
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    label = dict.fromkeys(range(len(ids)))
    for k in label:
        label[k] = k
    for i in range(len(ids)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a == b or len(a & b) >= 0.8 * len(a | b):
                x, y = label[i], label[j]
                label = {k: x if v == y else v for k, v in label.items()} if x != y else label
    least = {}
    for k, v in label.items():
        least[v] = min(least.get(v, ids[k]), ids[k])
    return set(least.values())


def test_near_copies_of_the_check_documents_go(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert {r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()} == brute(rows)


def test_chains_of_edits_and_short_texts(spark):
    r = random.Random(5)
    rows, n = [], 0
    for _ in range(12):
        words = [f"w{r.randrange(300)}" for _ in range(r.randrange(60, 200))]
        for _ in range(12):
            n += 1
            rows.append((1000 - n, " ".join(words).upper() if n % 2 else "  ".join(words)))
            words = list(words)
            for _ in range(r.randrange(1, 4)):
                words[r.randrange(len(words))] = f"x{n}"
    rows += [(1, ""), (2, None), (3, " \n"), (4, "a b"), (5, "A b"), (6, "a b c d e"), (7, "a b c d f")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute(rows)
    assert {x.doc_id for x in shingles.least_ids(df).collect()} == want and 20 < len(want) < len(rows) - 50
    assert shingles.least_ids(df.limit(0)).count() == 0


def test_simhash_links_propose_pairs_without_any_band(spark, monkeypatch):
    real = shingles.sketches
    monkeypatch.setattr(shingles, "sketches", lambda docs: real(docs).withColumn("bands", F.array("point")))
    r = random.Random(3)
    rows, linked = [], 0
    want = {1, 2}
    for i in range(10, 130, 3):
        words = [f"w{r.randrange(10**6)}" for _ in range(900)]
        one = [w if k != 450 else "edit" for k, w in enumerate(words)]
        rows += [(i, " ".join(words)), (i + 1, " ".join(one)), (i + 2, " ".join(words))]
        near = ((simhash.fingerprint(rows[-3][1]) ^ simhash.fingerprint(rows[-2][1])) & 2**64 - 1).bit_count() <= simhash.THRESHOLD
        linked += near
        want |= {i} if near else {i, i + 1}
    # One fingerprint, few shingles in common: SimHash proposes the pair, the exact check keeps both.
    rows += [(k, "spam " * 2000 + " ".join(f"v{k}x{j}" for j in range(150))) for k in (1, 2)]
    assert simhash.fingerprint(rows[-1][1]) == simhash.fingerprint(rows[-2][1])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {x.doc_id for x in corpus_pipeline.near_dedup(spark, df, "").collect()} == want and linked > 10


def test_sketches_allow_every_pair_of_near_copies(spark):
    r = random.Random(8)
    rows = []
    for i in range(60):
        words = [f"w{r.randrange(10**6)}" for _ in range(r.choice([5, 8, 30, 36, 37, 70, 150, 300, 900]))]
        other = words + [f"z{k}" for k in range(r.randrange(0, 1 + len(words) // 5))] if i % 2 else [w if r.random() < 0.98 else "q" for w in words]
        rows.append((" ".join(words), " ".join(other)))
    sketched = [(*[x for t in pair for x in (shingles.sketch(t)[2], shingles.sketch(t)[3].tolist())], shingles.similar(*map(shingles.shingles, pair))) for pair in rows]
    df = spark.createDataFrame(sketched, "n_x long, bits_x array<long>, n_y long, bits_y array<long>, near boolean")
    both = df.selectExpr("near", f"{shingles.close('x', 'y')} AS may", f"{shingles.close('y', 'x')} AS same").collect()
    assert all(x.may and x.same for x in both if x.near) and 10 < sum(x.near for x in both) and any(not x.may for x in both)
