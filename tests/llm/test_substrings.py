"""Repeated passages against brute force."""

import itertools
import random

from tablebridge.llm import substrings as s


def brute(rows):
    least = {}
    for doc, text in rows:
        w = s.words_of(text)
        for i in range(len(w) - 12):
            if doc is not None:
                t = tuple(w[i : i + 13])
                least[t] = min(doc, least.get(t, doc))
    out = []
    for doc, text in rows:
        w = s.words_of(text)
        gone = set()
        for i in range(len(w) - 12):
            if doc is not None and least[tuple(w[i : i + 13])] < doc:
                gone.update(range(i, i + 13))
        out.append((doc, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=str)


def test_automaton_windows_equal_search():
    r = random.Random(1)
    for _ in range(60):
        parts = [([b"abc"[k : k + 1] for k in (r.randrange(3) for _ in range(r.randrange(1, 40)))], r.randrange(50)) for _ in range(8)]
        a = s.Automaton()
        for words, doc in parts:
            a.add(words, doc)
        a.close()
        for words, _ in [*parts, ([b"a", b"c", b"z", b"b", b"a", b"a", b"b"], 0)]:
            want = [min((d for w, d in parts if any(w[j : j + 4] == words[i : i + 4] for j in range(len(w) - 3))), default=1 << 63) for i in range(len(words) - 3)]
            assert a.windows(words, 4) == want


def test_equal_windows_sample_equal_grams():
    r = random.Random(2)
    words = [b"w%d" % r.randrange(5) for _ in range(400)]
    gram, first, n = s.samples(words)
    assert first[0] == 0 and n.sum() == len(words) - 12
    of = {}
    for g, f, k in zip(gram.tolist(), first.tolist(), n.tolist(), strict=True):
        for i in range(f, f + k):
            assert of.setdefault(tuple(words[i : i + 13]), g) == g


def texts(r):
    vocab = [f"w{i}" for i in range(12)]
    pool = [" ".join(r.choice(vocab) for _ in range(r.randrange(5, 60))) for _ in range(6)]
    out = []
    for _ in range(70):
        bits = [r.choice(pool) if r.random() < 0.5 else " ".join(r.choice(vocab) + str(r.randrange(30)) for _ in range(r.randrange(30))) for _ in range(r.randrange(4))]
        out.append(("\n" if r.random() < 0.3 else "  ").join(bits))
    return out + [pool[0], pool[0], " ".join(["same"] * 40), " ".join(["same"] * 13), None, "", "é x y " * 10]


def test_whole_results_equal_brute_force(spark, monkeypatch):
    r = random.Random(6)
    for k in range(3):
        rows = [(i, t) for i, t in enumerate(texts(r))]
        rows += [(None, rows[3][1]), (None, "w1 " * 20), (20, rows[5][1]), (20, rows[20][1]), (900, "x " * 30_000), (901, "x " * 50_000)]
        r.shuffle(rows)
        df = spark.createDataFrame([(*x, b"k", 3) for x in rows], "doc_id long, text string, key binary, n_words int").repartition(1 + 3 * k)
        got = sorted(((x.doc_id, x.n_words, x.n_removed, bytes(x.kept)) for x in s.deduplicated(df).collect()), key=str)
        assert got == brute(rows)
    assert s.deduplicated(df.limit(0)).count() == 0 and s.deduplicated(df.where("doc_id is null")).count() == 2


def test_shards_larger_than_an_automaton(monkeypatch):
    r = random.Random(3)
    parts = [(bytes([k]), [b"w%d" % r.randrange(2) for _ in range(18)], r.randrange(9)) for k in range(60)]
    whole = s.judged(parts)
    monkeypatch.setattr(s, "SHARD_WORDS", 100)
    assert s.judged(parts) == whole


def test_texts_sampled_together_sample_what_they_sample_alone(monkeypatch):
    r = random.Random(12)
    texts = [[b"%d" % r.randrange(6) for _ in range(r.choice((0, 1, 12, 13, 14, 40, 300)))] for _ in range(200)] + [[b"x" * 9000] * 20, [b"a"] * 50]
    alone = [[x.tolist() for x in s.samples(words)] for words in texts]
    for together in (1, 700, s.TOGETHER):
        monkeypatch.setattr(s, "TOGETHER", together)
        assert [[x.tolist() for x in found] for found in s.samples_of(texts)] == alone
    for words, (gram, first, n) in zip(texts, alone, strict=True):
        assert sum(n) == max(0, len(words) - s.SPAN + 1) and first == [0, *itertools.accumulate(n)][: len(gram)]


def test_prefixes_kept_while_adding_give_the_windows_of_a_search():
    r = random.Random(7)
    for _ in range(40):
        parts = [([b"abc"[k : k + 1] for k in (r.randrange(3) for _ in range(r.randrange(4, 40)))], r.randrange(50)) for _ in range(8)]
        a = s.Automaton()
        passed = [a.add(words, doc)[3:] for words, doc in parts]
        a.close()
        for (words, _), p in zip(parts, passed, strict=True):
            assert a.windows_at(p, 4).tolist() == a.windows(words, 4)


def test_texts_are_cut_into_fragments_once(spark, monkeypatch):
    tried = []
    monkeypatch.setattr(s, "stage", lambda df, purpose, *a, f=s.stage: tried.append((purpose, df)) or f(df, purpose, *a))
    df = spark.createDataFrame([(i, " ".join(f"w{k}" for k in range(i, i + 30))) for i in range(9)], "doc_id long, text string")
    assert sum(x.n_removed > 0 for x in s.deduplicated(df).collect()) == 8
    plans = [d._jdf.queryExecution().optimizedPlan().toString() for _, d in tried]
    assert sum("fragment" in x and "MapInArrow run(doc_id" in x for x in plans) == 1
