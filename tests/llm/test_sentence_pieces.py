"""Segmentation against brute force, exact round trips, agreement with the library's decoder."""

import itertools
import math
import random

import public_tokenizers
import sentencepiece

from tablebridge.llm import sentence_pieces as p

PATH = public_tokenizers.path("piece_bpe_32k.model")


def best(unit, weight, least):
    """Every segmentation of a short unit, the best one by weight."""
    found = []
    for n in range(len(unit)):
        for cuts in itertools.combinations(range(1, len(unit)), n):
            parts = [unit[a:b] for a, b in zip((0, *cuts), (*cuts, len(unit)), strict=True)]
            if all(x in weight or len(x) == 1 for x in parts):
                found.append((sum(weight.get(x, least) for x in parts), parts))
    return max(found)[0]


def test_segmentation_equals_brute_force(spark):
    table = p.pieces(PATH)
    weight = {x: w for x, w in table if not math.isnan(w)}
    least = min(weight.values()) - p.PENALTY
    r = random.Random(4)
    units = ["▁", "▁▁▁", "▁the", "é", "▁日本", "\n\n", "▁1234", "x"] + ["▁" * r.randrange(2) + "".join(r.choice("etaoinshrɓqué") for _ in range(r.randrange(1, 9))) for _ in range(300)]
    got = {x.unit: x.ids for x in p.segmented(spark.createDataFrame([(1, u, "k" + u) for u in set(units)], "bucket int, unit string, kept string"), table).where("kept = concat('k', unit)").collect()}
    assert set(got) == set(units)
    for u, ids in got.items():
        assert "".join(table[i][0] if i >= 0 else chr(-i - 1) for i in ids) == u
        assert abs(sum(weight[table[i][0]] if i >= 0 else least for i in ids) - best(u, weight, least)) < 1e-9


def test_round_trips(spark, monkeypatch):
    monkeypatch.setattr(p, "PARTITIONS", 5)
    r = random.Random(9)
    bits = ["the", " ", "  ", "\n", "é", "日本", "123", "!?", "\t", "😀", "word", "Ünïcode", "\x00", "_x_", " a"]
    texts = ["".join(r.choice(bits) for _ in range(r.randrange(30))) for _ in range(300)]
    texts += ["", None, " ", "a", " a ", "x" * 3000, " " * 1000, "\n" * 700, "long words of text " * 20_000]
    for chars in (p.BLOCK_CHARS, 200):
        monkeypatch.setattr(p, "BLOCK_CHARS", chars)
        df = spark.createDataFrame([(i if i != 5 else None, t, 1, "u") for i, t in enumerate(texts)], "doc_id long, text string, block int, unit string").repartition(3)
        got = {x.doc_id: x for x in p.encode(df, PATH).collect()}
        assert len(got) == len(texts)
        model = sentencepiece.SentencePieceProcessor(model_file=PATH)
        for i, t in enumerate(texts):
            x = got[i if i != 5 else None]
            assert x.exact and x.decoded == (t or "") and x.n_pieces == len(x.ids)
            assert model.decode(x.ids) == (t or "")
    assert p.encode(df.limit(0), PATH).count() == 0


def test_the_space_sign_is_told_from_a_space(spark):
    df = spark.createDataFrame([(1, "a▁b"), (1, "a▁b"), (2, "a b")], "doc_id long, text string")
    assert sorted((x.doc_id, x.decoded, x.exact) for x in p.encode(df, PATH).collect()) == [(1, "a b", False)] * 2 + [(2, "a b", True)]


def test_texts_are_cut_once_and_shuffled_once(spark):
    df = spark.createDataFrame([(i, f"some words of text {i}") for i in range(50)], "doc_id long, text string")
    found = p.encode(df, PATH)
    assert all(x.exact for x in found.collect())
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1 and plan.count("MapInArrow run(doc_id") == 1


def test_numbers_of_a_block_name_the_units_of_each_text():
    texts = ["a b c.", "  x", "", "aa, bb", " ", "a a a", "b  b", "1a é!\n日本 x", "x " * 300 + "y", "z▁z"]
    for some in (texts, texts[::-1], [""], ["", " "], ["a"]):
        block = p.Block()
        for t in some:
            block.add(None, t)
        units, docs = block.numbered()
        assert [[units[i] for i in n] for n in docs] == [p.units_of(t) for t in some]
    assert len(list(p.Block().closed(0))) == 2


def test_texts_of_a_block_are_cut_in_steps_and_dropped(monkeypatch):
    monkeypatch.setattr(p, "CUT_CHARS", 50)
    texts = [f"w{i % 7} some  text {i % 3}" if i % 5 else f"x{i} y" for i in range(200)]
    block = p.Block()
    for t in texts:
        block.add(None, t)
        assert sum(map(len, block.waiting)) < 50
    units, docs = block.numbered()
    assert [[units[i] for i in n] for n in docs] == [p.units_of(t) for t in texts]


def test_a_block_of_many_distinct_units_is_full(monkeypatch):
    monkeypatch.setattr(p, "CUT_CHARS", 1)
    monkeypatch.setattr(p, "BLOCK_UNITS", 3)
    block = p.Block()
    for t, full in (("a b", False), ("b a", False), ("c", True)):
        block.add(None, t)
        assert block.full() == full
