"""Token tables: the library's ids, exact round trips, damage, checkpoints."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tablebridge.llm import rans
from tablebridge.llm.staging import stage

PATH = public_tokenizers.path("byte_bpe_50k.json")
ODD = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a\nb", "a \nb", "a\n b", "a\n\nb", "x y", "x  y", "it's  we'll\tgo", "<|endoftext|>", "a <|endoftext|> b",
    "1234 ünï z", "日本語 テキスト", "a\x1cb \x85c", "'s 't", "don't\n'tis", "😀 😀\n😀", "tab\tb", None, "\x00 x",
]


def test_ids_equal_the_library():
    r = random.Random(5)
    bits = ["a", "the", " ", " ", " ", "\n", "'s", "é", "12", "!!", "\t", "word", "Ünï", " ", "|", "\r\n", "..."]
    texts = ODD + ["".join(r.choice(bits) for _ in range(r.randrange(40))) for _ in range(3000)]
    mine = rans.Encoder(PATH, "<u2").encode(texts)
    for t, got, want in zip(texts, mine, Tokenizer.from_file(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False), strict=True):
        assert np.frombuffer(got, "<u2").tolist() == want.ids, repr(t)


def test_words_are_learnt_once_and_kept_over_a_change_of_generations(monkeypatch):
    monkeypatch.setattr(rans, "KEPT_WORDS", 30)
    r, mine, library = random.Random(8), rans.Encoder(PATH, "<u2"), Tokenizer.from_file(PATH)
    words = [f"{''.join(r.choice('abcdé') for _ in range(3))}{e}" for _ in range(20) for e in ("", ".", "?!", "),")]
    seen = []
    real = mine.learn
    mine.learn = lambda some: seen.append(some) or real(some)
    for k in range(40):
        texts = [" ".join(r.choice(words) for _ in range(8)) + "\nx." for _ in range(k % 3)] + [None, "", " odd  "]
        got = [np.frombuffer(x, "<u2").tolist() for x in mine.encode(texts)]
        assert got == [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert all(len(set(some)) == len(some) for some in seen) and len(mine.older.number) > 30
    learnt = sum(map(len, seen))
    mine.encode([t for t in texts if t])
    assert sum(map(len, seen)) == learnt


@pytest.mark.parametrize("n", [1, 255, 256, 257, rans.LANES * rans.STEPS, rans.LANES * rans.STEPS * 2 + 77])
def test_blocks_decode_whole_and_from_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.geometric(0.01, n), 50_000)
    used, counts = np.unique(ids, return_counts=True)
    freq = rans.frequencies(used, counts, 50_257)
    assert freq.sum() == 1 << rans.BITS and (freq[used] > 0).all()
    first, symbol = rans.starts(freq), np.repeat(np.arange(len(freq)), freq)
    block = rans.encode_block(ids, freq, first, [(7, n - 1), (None, 1)])
    got, docs = rans.decode_block(block, freq, first, symbol)
    assert (got == ids).all() and docs == [(7, n - 1), (None, 1)]
    for point in range(1, -(-n // (rans.LANES * rans.STEPS))):
        assert (rans.decode_block(block, freq, first, symbol, point)[0] == ids[point * rans.STEPS * rans.LANES :]).all()
    broken = bytearray(block)
    broken[-1] ^= 1
    with pytest.raises((ValueError, IndexError)):
        rans.decode_block(bytes(broken), freq, first, symbol)


@pytest.mark.parametrize("counts", [[1], [1, 10**12], [1] * 50_257, [5, 5, 5], list(range(1, 50_258)), [10**9] + [1] * 50_256])
def test_frequencies_sum_and_cover(counts):
    freq = rans.frequencies(np.arange(len(counts)), np.array(counts), 50_257)
    assert freq.sum() == 1 << rans.BITS and (freq[: len(counts)] > 0).all()


def test_round_trip_in_order(spark, monkeypatch):
    r = random.Random(1)
    texts = ODD + [" ".join(r.choice(["alpha", "béta", "gamma,", "d"]) for _ in range(r.randrange(300))) for _ in range(120)] + ["long " * 40_000]
    ids = [None, None, 4, 4, *range(10, 10 + len(texts) - 4)]
    rows = list(zip(ids, texts, ["x"] * len(texts), [9] * len(texts), strict=True))
    r.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string, start int")
    got = rans.round_trip(df, PATH, 50_257, 2).collect()
    lib = Tokenizer.from_file(PATH)
    want = sorted(((i is not None, i or 0, len(w) + 1, zlib.crc32(np.array(w + [2], "<u4").tobytes())) for i, w in ((i, lib.encode(t or "", add_special_tokens=False).ids) for i, t, _, _ in rows)))
    mine = sorted(got, key=lambda x: x.start)
    assert [(x.doc_id is not None, x.doc_id or 0, x.n_tokens, zlib.crc32(x.ids)) for x in mine] == want
    assert [x.start for x in mine] == [sum(w[2] for w in want[:k]) for k in range(len(want))]
    assert rans.round_trip(df.limit(0), PATH, 50_257, 2).count() == 0


def test_a_damaged_table_is_noticed(spark):
    df = spark.createDataFrame([(1, "some words of text")], "doc_id long, text string")
    path = rans.write(stage(rans.token_ids(df, PATH, 2), "t"), 50_257, "<u2")
    assert rans.read(spark, path).count() == 1
