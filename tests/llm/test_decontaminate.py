"""Benchmark passages: Myers against the plain table of distances, and whole results against brute force."""

import random

from tablebridge.llm import decontaminate as d


def distances(pattern, text):
    """The least distance of the pattern to any stretch of the text, and all ends at which it stands."""
    row = list(range(len(pattern) + 1))
    out = []
    for w in text:
        new = [0]
        for i, p in enumerate(pattern):
            new.append(min(row[i] + (p != w), row[i + 1] + 1, new[i] + 1))
        row = new
        out.append(row[-1])
    return out


def test_myers_equals_the_table():
    r = random.Random(2)
    for _ in range(500):
        a = [r.choice("abcd") for _ in range(r.randrange(1, 70))]
        b = [r.choice("abcd") for _ in range(r.randrange(1, 90))]
        assert d.myers(a, b) == distances(a, b)


def edited(r, words, edits):
    words = list(words)
    for _ in range(edits):
        k = r.randrange(len(words))
        kind = r.randrange(3)
        if kind == 0:
            words[k] = "zzz"
        elif kind == 1:
            words.insert(k, "qqq")
        elif len(words) > 1:
            del words[k]
    return words


def test_contamination_equals_brute_force(spark):
    r = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    items = [(i, [r.choice(vocab) for _ in range(r.choice([3, 8, 12, 24, 25, 55]))]) for i in range(20)]
    items += [(30, items[4][1]), (None, items[5][1])]
    docs = []
    for i in range(150):
        words = [r.choice(vocab) for _ in range(r.randrange(80))]
        if i % 3:
            k = r.randrange(len(words) + 1)
            words[k:k] = edited(r, r.choice(items)[1], r.randrange(6))
        docs.append((i, words))
    docs += [(200, items[0][1]), (201, []), (None, items[3][1])]
    want = set()
    for doc, words in docs:
        for item, text in items:
            found = []
            for k, p in d.passages(text):
                least = min(distances(p, words), default=99)
                if least <= d.budget(len(p)):
                    found.append((least / len(p), k, len(p), least))
            if found:
                best = min(found)
                want.add((doc, item, best[2], best[3]))
    text = lambda w: ", ".join(w).upper()
    df = spark.createDataFrame([(i, text(w), 5) for i, w in docs], "doc_id long, text string, item_id int")
    got = d.contamination(df, spark.createDataFrame([(i, " ".join(w)) for i, w in items], "item_id long, text string")).collect()
    assert {(x.doc_id, x.item_id, x.n_words, x.distance) for x in got} == want and len(got) == len(want)
    words = dict(docs)
    for x in got:
        near = words[x.doc_id][x.start_word : x.end_word]
        assert min(min(distances(p, near)[-1:], default=99) for _, p in d.passages(dict(items)[x.item_id])) <= x.distance


def test_null_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b c d e f g h")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "A b c d e f g h"), (4, "a")], "item_id long, text string")
    assert [(x.doc_id, x.item_id, x.distance, x.start_word, x.end_word) for x in d.contamination(docs, bench).collect()] == [(3, 3, 0, 0, 8), (3, 4, 0, 0, 1)]
    assert d.contamination(docs, bench.limit(0)).count() == 0 and d.contamination(docs.limit(0), bench).count() == 0


def test_short_items_stand_anywhere(spark):
    docs = [(1, "intro text What is the capital of France and more words"), (2, "what is the capitals of france"), (3, "of France"), (4, "the capital city of France"), (5, "capital of")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "What is the capital of France"), (2, "capital of France"), (3, "of france?"), (4, "one two three four five six seven")], "item_id long, text string")
    got = {(x.doc_id, x.item_id, x.start_word, x.end_word) for x in d.contamination(docs, bench).collect()}
    assert got == {(1, 1, 2, 8), (1, 2, 5, 8), (1, 3, 6, 8), (2, 3, 4, 6), (3, 3, 0, 2), (4, 3, 3, 5)}
    assert {x.doc_id for x in d.clean(docs, bench).collect()} == {5}
    seven = spark.createDataFrame([(1, "one two three four 5 six seven"), (2, "x one two three four five six seven y")], "doc_id long, text string")
    assert [x.doc_id for x in d.contamination(seven, bench).collect()] == [2]
