"""The registered queries of the training-data operators, with production parameters, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import crc_bucket, table
from .divergence_audit import divergence_audit
from .exact_dedup import exact_dedup
from .hard_negatives import hard_negatives
from .html_text import extract_text
from .jaccard_join import jaccard_components
from .language_id import fit_language_model, identify_language
from .lm_scoring import lm_scores
from .packing import best_fit_pack
from .quality import quality_scores
from .sentencepiece_codec import encode_n_best
from .substring_dedup import repeated_passages
from .token_counts import token_counts
from .top_k import top_k

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")


def op1_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.filter(F.col("vec_id") % 50 == 0))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = encode_n_best(table(spark, sf_dir, "documents"), VOCABULARY)
    scores = F.transform("nbest", lambda x: F.round(x["score"], 3))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), scores.alias("scores"), "round_trip")


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_bucket(F.col("doc_id"), 4) == 2
    model = fit_language_model(docs.filter(~held_out), VOCABULARY)
    out = identify_language(docs, model, VOCABULARY, carry=F.struct(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out")))
    return out.select("row.doc_id", "row.held_out", "lang_pred", "score")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents")).select("doc_id", "start", "end", "source_id", "source_start", "source_end", F.round("jaccard", 6).alias("jaccard"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), crc_bucket(F.col("doc_id"), 4) == 2)


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"), crc_bucket(F.col("doc_id"), 7) == 2, VOCABULARY)


def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_audit(table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", wrong.alias("label"))
    return hard_negatives(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op13_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"), carry=["page_id", "url"])


QUERIES = {f.__name__: f for f in (op1_top_k, op2_sentencepiece, op3_exact_dedup, op4_language_id, op5_token_counts, op6_jaccard_join, op7_best_fit_packing, op8_substring_dedup, op9_quality, op10_lm_scores, op11_divergence_audit, op12_hard_negatives, op13_html_text)}

SQL = {
    "op1_top_k": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
              FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)),
        r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op3_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[ \t\n\v\f\r]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
        FROM d""",
    "op11_divergence_audit": r"""
        WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
        o AS (SELECT lang, source, id, unnest(ts) AS term FROM d),
        kept AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 30),
        l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
        c AS (SELECT o.lang, source, term, count(*) AS n FROM o JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (SELECT d.lang, d.source, coalesce(any_value(l.v), 0) AS v, coalesce(any_value(x.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) d
              LEFT JOIN l USING (lang) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) x ON x.lang = d.lang AND x.source = d.source GROUP BY ALL),
        p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 5)) // (g.n + 5 * g.v) AS p, 1 + (1000000000::HUGEINT * (k.n + 5)) // (l.n + 5 * l.v) AS q
              FROM g JOIN kept k ON k.lang = g.lang JOIN l ON l.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
              LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
              UNION ALL SELECT lang, source, 'term', term, (p - q)::BIGINT FROM p WHERE c > 0 AND p > q)
        SELECT * FROM (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank FROM r) WHERE part = 'pair' OR rank <= 50""",
    "op12_hard_negatives": """
        WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e FROM embeddings
                   WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_sum(list_transform(list_zip(a.e, c.e), lambda p: p[1] * p[2]))::BIGINT AS score
              FROM v a JOIN v c ON a.vec_id % 100 = 0 AND c.vec_id <> a.vec_id AND len(a.e) = len(c.e)),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
        n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
              FROM p JOIN s USING (anchor_id) WHERE NOT same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score)
        SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5""",
}
