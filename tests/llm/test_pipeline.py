"""The pipeline: each stage against brute force on its own input, and odd inputs."""

import re

import corpus_pipeline
import public_tokenizers
import pytest
import sentencepiece

from tablebridge.llm import decontaminate, pii, quality
from tablebridge.llm.staging import stage, table
from tests.llm.test_pii import brute as personal
from tests.llm.test_shingles import brute as least_ids

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """Each stage's input and output, as rows."""
    docs, out = table(spark, FOLDER, "documents"), []
    for name, step in corpus_pipeline.STAGES:
        after = stage(step(spark, docs, FOLDER), name)
        out.append((docs, after))
        docs = after
    return out


def rows(df):
    return {x.doc_id: x for x in df.collect()}


def test_quality_drops_what_is_rejected(spark, steps):
    docs, after = steps[0]
    want = {x.doc_id for x in quality.assess(docs, table(spark, FOLDER, "labels")).collect() if x.predicted}
    assert set(rows(after)) == want and 0 < len(want) < docs.count() and after.columns == docs.columns
    assert all(rows(docs)[i] == x for i, x in rows(after).items())


def test_one_document_of_each_group_stays(steps):
    docs, after = rows(steps[1][0]), rows(steps[1][1])
    want = least_ids([(i, x.text) for i, x in docs.items()])
    assert set(after) == want and len(after) < len(docs) and all(docs[i] == x for i, x in after.items())


def test_contaminated_documents_go(spark, steps):
    docs, after = steps[2]
    bad = {x.doc_id for x in decontaminate.contamination(docs, table(spark, FOLDER, "benchmark")).collect()}
    assert bad and set(rows(after)) == set(rows(docs)) - bad
    items = [" ".join(decontaminate.words_of(x.text)) for x in table(spark, FOLDER, "benchmark").collect()]
    exact = {i for i, x in rows(docs).items() if any(f" {t} " in f" {' '.join(decontaminate.words_of(x.text))} " for t in items)}
    assert exact and exact <= bad


def test_personal_data_is_replaced(steps):
    docs, after = rows(steps[3][0]), rows(steps[3][1])
    assert set(docs) == set(after)
    changed = 0
    for i, x in docs.items():
        spans = sorted((int(s.split(":")[1]), int(s.split(":")[2]), s.split(":")[0]) for s in personal(x.text))
        text, at = "", 0
        for start, end, kind in spans:
            text, at = text + x.text[at:start] + f"[{kind.upper()}]", end
        changed += bool(spans)
        assert after[i].text == text + x.text[at:] and after[i].n_chars == len(after[i].text) and after[i].lang == x.lang
    assert changed


def test_all_that_is_left_is_encoded(steps):
    docs, after = rows(steps[4][0]), rows(steps[4][1])
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert set(docs) == set(after)
    assert all(x.exact and model.decode(x.ids) == docs[i].text == x.decoded and x.n_pieces == len(x.ids) for i, x in after.items())


def test_run_is_its_stages(spark, steps):
    assert sorted(map(str, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(str, steps[-1][1].collect()))
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "sentence_pieces"]


def test_odd_rows_and_no_rows(spark):
    schema = table(spark, FOLDER, "documents").schema
    some = table(spark, FOLDER, "documents").limit(30)
    odd = spark.createDataFrame([(None, None, None, None, None), (7_000, "", "en", None, 0), (7_001, None, "en", "s", None), (7_002, "word " * 30_000, None, "s", 1), (7_002, "word " * 30_000, None, "s", 1)], schema)
    for docs in (some.unionByName(odd), some.limit(0)):
        n = docs.count()
        for name, step in corpus_pipeline.STAGES:
            docs = stage(step(spark, docs, FOLDER), name)
            assert docs.count() <= n and (name == "sentence_pieces" or docs.columns == schema.names)


def test_kinds_have_names():
    assert all(re.fullmatch("[a-z]+", k) for k in pii.KINDS)
