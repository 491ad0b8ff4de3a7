"""Queries opN_<name> of this subpackage, each over its whole table, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from afterglow.llm import ctph, factorisation, html_extract, line_dedup, packing, quality, sentencepiece_ops, simhash, substring_dedup
from afterglow.session import table


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file; looked up only when a query that needs it runs."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), min_words=20, repeat_percent=30)


def op2_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), width=3)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), size=2048, end_id=0)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return factorisation.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    done = line_dedup.drop_common_lines(docs, min_documents=10, min_chars=1)
    return done.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


OP5_SQL = r"""
WITH lines AS (
  SELECT d.doc_id, u.pos, u.line,
         translate(trim(u.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM documents d,
       LATERAL (SELECT unnest(string_split(coalesce(d.text, ''), chr(10))) AS line,
                       generate_subscripts(string_split(coalesce(d.text, ''), chr(10)), 1) AS pos) u
), frequent AS (
  SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT l.doc_id, l.pos, l.line, f.key IS NOT NULL AS gone FROM lines l LEFT JOIN frequent f ON l.key = f.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring_dedup.without_repeats(docs, window=35).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_ops.encode_documents(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), digest=True)


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctph.compare_with_next(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_ops.count_tokens(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), limit=4096)


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


OP6_SQL = r"""
WITH split AS (
  SELECT row_number() OVER () AS doc, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words
  FROM documents
), starts AS (
  SELECT doc, i, array_to_string(words[i : i + 34], ' ') AS k
  FROM (SELECT doc, words, unnest(range(1, len(words) - 33)) AS i FROM split WHERE len(words) >= 35)
), twice AS (
  SELECT k FROM starts GROUP BY k HAVING count(*) > 1
), repeated AS (
  SELECT doc, i FROM starts SEMI JOIN twice USING (k)
), placed AS (
  SELECT doc, unnest(range(1, len(words) + 1)) AS j, unnest(words) AS word FROM split
), judged AS (
  SELECT p.doc, p.j, p.word, count(r.i) OVER (PARTITION BY p.doc ORDER BY p.j ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM placed p LEFT JOIN repeated r ON r.doc = p.doc AND r.i = p.j
), summed AS (
  SELECT doc, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY j) FILTER (WHERE NOT gone) AS kept
  FROM judged GROUP BY doc
)
SELECT s.doc_id, coalesce(m.n_words, 0)::BIGINT AS n_words, coalesce(m.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(m.kept, '')) AS kept_sha256
FROM split s LEFT JOIN summed m USING (doc)
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_quality_rules, op2_simhash_dedup, op3_best_fit_packing, op4_quality_classifier, op5_line_dedup, op6_substring_dedup, op7_sentencepiece, op8_document_fingerprints, op9_token_counts, op10_html_extraction)}


def oracle_sql() -> dict[str, str]:
    return {"op5_line_dedup": OP5_SQL, "op6_substring_dedup": OP6_SQL}
