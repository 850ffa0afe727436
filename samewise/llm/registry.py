"""Queries over the documents table, one for each operator of this subpackage, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samewise.llm import backoff_lm, bpe_stitch, exact_dedup, license_scan, ngram_join, packing, pairwise_quality, pii_bootstrap, quality_rules, token_store
from samewise.llm.common import read_table

END_ID = 2


def op1_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = token_store.write_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), END_ID, vocabulary=50_257)
    return token_store.read_tokens(spark, folder).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_bpe_stitch(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_stitch.encode_documents(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op4_pairwise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairwise_quality.quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_documents(read_table(spark, sf_dir, "documents"), size=4, percent=85)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(read_table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_rules(read_table(spark, sf_dir, "documents")).drop(*quality_rules.LEAST)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), END_ID)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op9_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.score_documents(read_table(spark, sf_dir, "documents"))


def op10_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_bootstrap.personal_data(read_table(spark, sf_dir, "documents"))
    listed = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.expr(f"size(filter(base, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_store, op2_bpe_stitch, op3_exact_dedup, op4_pairwise_quality, op5_ngram_join, op6_license_scan, op7_quality_rules, op8_packing, op9_backoff_lm, op10_pii_bootstrap)
}

#: A text without regard to the case of A-Z.
_NORM = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op3_exact_dedup": f"""
        WITH d AS (SELECT doc_id, {_NORM} AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(norm) AS text_sha256
        FROM d WINDOW w AS (PARTITION BY norm)""",
    "op5_ngram_join": f"""
        WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array({_NORM}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
        shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
        links AS (SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
        sides AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
        reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, y FROM reach JOIN sides ON x = r)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY 1) LEFT JOIN n USING (doc_id)""",
    "op7_quality_rules": f"""
        WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
        g AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM d, range(1, 1000000) q(i) WHERE i <= len(w) - 2),
        again AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g), range(0, 3) q(k) WHERE c > 1 GROUP BY 1),
        m AS (SELECT doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
                (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l) AS n_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
                length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks FROM d LEFT JOIN again USING (doc_id)),
        s AS (SELECT *, n_symbols / greatest(n_words, 1)::DOUBLE AS symbol_share, n_dup_lines / greatest(n_lines, 1)::DOUBLE AS dup_line_share, n_repeat_words / greatest(n_words, 1)::DOUBLE AS repeat_share,
                n_upper / greatest(word_chars, 1)::DOUBLE AS upper_share, n_marks / greatest(n_words, 1)::DOUBLE AS mark_share, word_chars / greatest(n_words, 1)::DOUBLE AS word_length FROM m),
        long AS (UNPIVOT (SELECT doc_id, lang, source, {', '.join(quality_rules.LEAST)} FROM s) ON {', '.join(quality_rules.LEAST)} INTO NAME name VALUE v),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, name ORDER BY v) AS k, count(*) OVER (PARTITION BY lang, source, name) AS n FROM long),
        q AS (SELECT lang, source, name, max(v) FILTER (k = ceil(0.25 * n)) AS q1, max(v) FILTER (k = ceil(0.75 * n)) AS q3 FROM ranked GROUP BY ALL),
        bad AS (SELECT DISTINCT doc_id FROM long l JOIN q ON q.name = l.name AND q.lang IS NOT DISTINCT FROM l.lang AND q.source IS NOT DISTINCT FROM l.source
                WHERE v > q3 + greatest({quality_rules.SPREADS}::DOUBLE * (q3 - q1), CASE l.name {' '.join(f"WHEN '{k}' THEN {v}::DOUBLE" for k, v in quality_rules.LEAST.items())} END))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept FROM s""",
}
