"""Registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerleaf.llm.alignment import op11_alignment
from ledgerleaf.llm.divergence import source_divergence
from ledgerleaf.llm.fingerprint import op10_fingerprints
from ledgerleaf.llm.lines import op9_line_dedup
from ledgerleaf.llm.mixing import op7_mix_sources
from ledgerleaf.llm.neardup import op8_near_duplicates
from ledgerleaf.llm.packing import op1_pack
from ledgerleaf.llm.passages import op3_shared_passages
from ledgerleaf.llm.quality import op2_quality
from ledgerleaf.llm.scoring import op12_scores
from ledgerleaf.llm.sharding import op5_shard_documents
from ledgerleaf.llm.tools import table
from ledgerleaf.llm.toxicity import op6_toxicity
from ledgerleaf.llm.vectors import op4_near_vectors


def _on_documents(operator: Callable[[DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"))


def _with_labels(operator: Callable[[DataFrame, DataFrame], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: operator(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_retrieval_packing": _on_documents(op1_pack),
    "op2_quality_classifier": _with_labels(op2_quality),
    "op3_shared_passages": _on_documents(op3_shared_passages),
    "op4_near_vectors": lambda spark, sf_dir: op4_near_vectors(table(spark, sf_dir, "embeddings")),
    "op5_karmarkar_karp_shards": _on_documents(op5_shard_documents),
    "op6_toxicity": _with_labels(op6_toxicity),
    "op7_source_mix": _on_documents(op7_mix_sources),
    "op8_near_duplicates": _on_documents(op8_near_duplicates),
    "op9_line_dedup": _on_documents(op9_line_dedup),
    "op10_lz_fingerprints": _on_documents(op10_fingerprints),
    "op11_tokenizer_alignment": _on_documents(op11_alignment),
    "op12_attention_scores": _on_documents(op12_scores),
    "op13_source_divergence": _on_documents(source_divergence),
}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE: dict[str, str] = {
    "op9_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
            FROM documents),
        keyed AS (
            SELECT *, translate(trim(line, {_BLANKS}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines),
        firsts AS (
            SELECT key, min(doc_id) AS first_doc FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) > 1),
        judged AS (
            SELECT doc_id, pos, line, coalesce(doc_id <> first_doc, FALSE) AS dropped
            FROM keyed LEFT JOIN firsts USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
        FROM judged GROUP BY doc_id""",
    "op13_source_divergence": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   coalesce(text, '') AS text
            FROM documents),
        occurrences AS (
            SELECT row_id, lang, source,
                   translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
            FROM docs),
        counts AS (SELECT lang, source, term, count(*) AS n FROM occurrences GROUP BY ALL),
        kept AS (
            SELECT lang, term, count(*) AS lang_n FROM occurrences
            GROUP BY lang, term HAVING count(DISTINCT row_id) >= 10),
        langs AS (SELECT lang, count(*) AS v, sum(lang_n) AS lang_total FROM kept GROUP BY lang),
        groups AS (
            SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS total
            FROM (SELECT DISTINCT lang, source FROM docs) g
            LEFT JOIN (SELECT c.* FROM counts c JOIN kept USING (lang, term)) c
              ON c.lang = g.lang AND c.source = g.source
            GROUP BY g.lang, g.source),
        shares AS (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
                   (1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v))::BIGINT AS p,
                   (1 + (1000000000::HUGEINT * (k.lang_n + 2)) // (l.lang_total + 2 * l.v))::BIGINT AS q
            FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
            LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
        sums AS (
            SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
            FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY ALL),
        pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
            FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
        terms AS (
            SELECT lang, source, term AS item, (((p - q) * (p - q)) // (p + q))::BIGINT AS value
            FROM shares WHERE n > 0 AND p > q),
        both_parts AS (
            SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term' AS part, * FROM terms)
        SELECT lang, source, part, item, value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
        FROM both_parts
        QUALIFY part = 'pair' OR rank <= 10""",
}
