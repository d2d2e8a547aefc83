"""Personal data: base spans against Python's regular expressions, selection, redaction."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tablebridge.llm import pii
from tablebridge.llm.staging import table

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(x):
    total = 0
    for k, c in enumerate(reversed(x)):
        n = int(c) * (1 + k % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 13 <= len(d) <= 19 and luhn(d),
                "phone": 9 <= len(d) <= 15,
            }[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TEXTS = [
    None, "", "a@b.co_m@x.yz", "a@b@c.d", "a@b.c.@d.e", "..@x.y", "x@y", "1.2.3.4.5.6.7.8", "1.2.3.256", "001.02.3.0255", "a 4111 1111 1111 1111 b", "4111-1111-1111-1112",
    "+1 (555) 555-1234.", "+12345", "++49 30 1234567", "+1+49 301234567", "é" * 10 + " mé@b.fr 😀 1.1.1.1", "1 2 3 4 5 6 7 8 9 0 1 2 3", " a@b.c ", "0" * 19, "12345678901234567890", "a@" + "b." * 3000 + "c",
    "call 555 555 1234 or (415) 555-9999 now", "me (at) example (dot) com", "+1 (555) 555-1234 +1 (555) 555-1235,a@b.c;a@b.d", "$0 \\ a@b.c $1",
]


def test_base_spans_equal_python(spark):
    r = random.Random(8)
    bits = ["a", "b.c", "@", ".", "1", "23", "456", " ", "-", "+", "(", ")", "é", "😀", "\n", "x@y.z", "+1 555 123 4567", "4111111111111111", "9.9.9.9", "_%"]
    texts = TEXTS + ["".join(r.choice(bits) for _ in range(r.randrange(60))) for _ in range(1500)]
    df = spark.createDataFrame([(i, t, "email", 3) for i, t in enumerate(texts)], "doc_id long, text string, kind string, spans int")
    got = {x.doc_id: x for x in pii.report(df).collect()}
    for i, t in enumerate(texts):
        want = brute(t)
        assert got[i].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), (t, want, got[i])
        assert [got[i][f"n_{k}"] for k in pii.KINDS] == [sum(w.startswith(k) for w in want) for k in pii.KINDS]
        assert set(want) <= set(got[i].spans.split(",")) | {""}
    assert pii.report(df.limit(0)).count() == 0


def test_long_runs_take_linear_time(spark):
    texts = ["a" * 200_000, "1" * 200_000, "1." * 50_000, "a@" * 50_000, "+1 " * 50_000, "a@b" + ".c" * 100_000, "1 " * 100_000, "a." * 100_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert pii.report(df).count() == len(texts)


def test_selected_candidates_and_redaction(spark):
    r = random.Random(0)
    rows = []
    for i in range(900):
        n = f"+1 ({r.choice([r.randrange(20, 99), r.randrange(200, 999)])}) 555-{r.randrange(1000, 9999)}"
        rows.append((i, f"word {n} phone, {f'token {r.randrange(10**7, 10**8)}' * (i % 3 == 1)} x{i}", "en"))
    lone = "please (415) 555-2671 thanks"
    rows.append((5000, lone, None))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    chosen = pii.fit(df)
    found = pii.find(df, chosen).where("doc_id = 5000").first()
    assert found.base_spans == [] and [lone[s.start : s.end] for s in found.all_spans] == ["(415) 555-2671"]
    out = {x.doc_id: x for x in pii.redact(df, chosen).collect()}
    assert out[5000].text == "please [PHONE] thanks" and out[7].text.startswith("word [PHONE] phone, token ") and out[7].lang == "en"
    more = spark.createDataFrame([(1, None, None), (2, "a@b.c +1 555 123 4567, 4111111111111111, 9.9.9.9!", "x"), (3, "é😀 a@b.c", None)], df.schema)
    assert [x.text for x in pii.redact(more, chosen).orderBy("doc_id").collect()] == [None, "[EMAIL] [PHONE], [CARD], [IP]!", "é😀 [EMAIL]"]


def test_every_document_counts_in_the_fit(spark):
    """Personal numbers stand only in documents that come after 6,000 others by the hash of their ids."""
    ids = [x.id for x in spark.range(6800).orderBy(F.xxhash64("id"), "id").collect()]
    texts = {i: f"token {10_000_000 + k}" if k < 6000 else f"word +1 ({200 + k % 700}) 555-{1000 + k} phone" for k, i in enumerate(ids)}
    lone = "please (415) 555-2671 thanks"
    df = spark.createDataFrame([*texts.items(), (10_000, lone)], "doc_id long, text string")
    found = pii.find(df, pii.fit(df)).where("doc_id = 10000").first()
    assert [lone[s.start : s.end] for s in found.all_spans] == ["(415) 555-2671"]
    counted = pii.cases(df)
    assert counted.agg(F.sum("n"), F.sum("positive")).first()[:] == (6801, 800)


def test_no_python_on_the_executors(spark):
    plan = pii.report(table(spark, "/root/testdata/sf0.001", "documents"))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("rows", [[], [(None, None)]])
def test_nothing_to_learn_from(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [x.spans for x in pii.report(df).collect()] == [""] * len(rows)
