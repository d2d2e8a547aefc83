"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tablebridge.llm import cross_entropy, decontaminate, hard_negatives, html_text, importance, mpeg, pii, quality, rans, sentence_pieces, set_join, simhash, substrings
from tablebridge.llm.staging import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).select("doc_id", "fingerprint", "component_id")


@query
def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op7_rans_tokens(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = rans.round_trip(table(spark, folder, "documents"), path, size=50_257, end_id=2)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_mpeg_audio(spark: SparkSession, folder: str) -> DataFrame:
    return mpeg.stored_features(table(spark, folder, "documents")).drop("frame_offsets")


@query
def op3_quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op5_cross_entropy(spark: SparkSession, folder: str) -> DataFrame:
    good = table(spark, folder, "labels").where("quality = 1 and toxic = 0")
    return cross_entropy.score(table(spark, folder, "documents"), good)


@query
def op6_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.report(table(spark, folder, "documents"))


@query
def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(table(spark, folder, "pages"))


@query
def op2_substrings(spark: SparkSession, folder: str) -> DataFrame:
    found = substrings.deduplicated(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op2_substrings"] = r"""
    WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    spans AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d)),
    firsts AS (SELECT t, min(doc_id) AS least FROM spans GROUP BY t),
    gone AS (SELECT doc_id, list(DISTINCT i + k) AS g FROM spans JOIN firsts USING (t), range(0, 13) AS r(k) WHERE least < doc_id GROUP BY doc_id),
    kept AS (
        SELECT doc_id, len(w) AS n, [x[1] FOR x IN list_zip(w, range(1, len(w) + 1)) IF NOT list_contains(coalesce(g, []), x[2])] AS k
        FROM d LEFT JOIN gone USING (doc_id)
    )
    SELECT doc_id, n AS n_words, n - len(k) AS n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept
"""


@query
def op9_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    found = sentence_pieces.encode(table(spark, folder, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_pieces", F.xxhash64("ids").alias("ids_hash"), F.length("decoded").cast("long").alias("n_chars"), "exact")


@query
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.mined(table(spark, folder, "embeddings"))


ORACLES["op11_hard_negatives"] = r"""
    WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS q
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(CAST(x AS DOUBLE))]) = 0
    ),
    parts AS (SELECT vec_id, label, unnest(q) AS x, unnest(range(len(q))) AS i FROM v),
    scores AS (
        SELECT a.vec_id AS anchor_id, b.vec_id AS id, any_value(a.label = b.label) AS same, CAST(sum(a.x * b.x) AS BIGINT) AS s
        FROM parts a JOIN parts b USING (i) WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id GROUP BY 1, 2
    ),
    positives AS (
        SELECT anchor_id, id AS positive_id, s AS positive_score FROM scores WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY s DESC, id) <= 5
    )
    SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, s AS negative_score
    FROM positives JOIN scores USING (anchor_id)
    WHERE NOT same AND 50 * positive_score <= 100 * s AND 100 * s <= 95 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s DESC, id)
    QUALIFY row_number() OVER w <= 3
"""


@query
def op13_importance(spark: SparkSession, folder: str) -> DataFrame:
    return importance.resampled(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


@query
def op12_set_join(spark: SparkSession, folder: str) -> DataFrame:
    return set_join.linked(table(spark, folder, "documents"))


ORACLES["op12_set_join"] = r"""
    WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
        FROM documents
    ),
    g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END) AS s FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
    links AS (
        SELECT x.doc_id AS a, y.doc_id AS b FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id
            JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
        GROUP BY 1, 2, p.n, q.n HAVING 100 * count(*) >= 90 * (p.n + q.n - count(*))
    ),
    reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, least_id AS component_id
    FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS least_id FROM reach GROUP BY a) USING (doc_id)
"""
