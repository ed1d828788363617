"""The registered queries of this subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from corpusloom.llm import decontam, dedup, htmltext, lattice, mixing, quality, secretscan, store, tokens, toxicity
from corpusloom.llm.common import read
from corpusloom.session import spread

Query = Callable[[SparkSession, str], DataFrame]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read(spark, sf_dir, "documents"), f"{sf_dir}/documents.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_counts(documents(spark, sf_dir))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_duplicates(documents(spark, sf_dir))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(documents(spark, sf_dir), read(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quality.quality(documents(spark, sf_dir))
    return q.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "fail_bits")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.secrets(documents(spark, sf_dir))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(documents(spark, sf_dir))


def op7_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.encode_and_digest(documents(spark, sf_dir))


def op8_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.score(documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(documents(spark, sf_dir), read(spark, sf_dir, "labels"))


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(read(spark, sf_dir, "pages"))


QUERIES: dict[str, Query] = {
    "op1_token_counts": op1_token_counts,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_decontamination": op3_decontamination,
    "op4_quality_rules": op4_quality_rules,
    "op5_secrets": op5_secrets,
    "op6_mixing": op6_mixing,
    "op7_token_store": op7_token_store,
    "op8_lattice_scores": op8_lattice_scores,
    "op9_toxicity": op9_toxicity,
    "op10_main_text": op10_main_text,
}

OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
g AS (SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
    FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM g) WHERE n > 1),
covered AS (SELECT rid, count(DISTINCT i + k) AS n FROM again CROSS JOIN (VALUES (0), (1), (2)) AS s(k) GROUP BY rid),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    len(lines)::BIGINT AS n_lines,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
    FROM w LEFT JOIN covered USING (rid)),
b AS (SELECT *, ((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
    + 4 * (100 * n_symbols > 10 * n_words)::INT + 8 * (100 * n_dup_lines > 40 * n_lines)::INT
    + 16 * (word_chars < 2 * n_words)::INT + 32 * (word_chars > 16 * n_words)::INT)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    fail_bits & 3 <> 0 AS base_failed, fail_bits & 63 = 0 AS kept, fail_bits FROM b
"""

OP6_SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5('mix-1|' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size,
    ([3, 1, 2])[(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
fill(i, level, n) AS (
    SELECT 0, 3 * sum(source_size) / (2.0 * sum(weight))::DOUBLE, 0::BIGINT FROM s
    UNION ALL
    SELECT i + 1, (3 * full_all - 2 * capped)::DOUBLE / (2.0 * open_weight)::DOUBLE, k FROM (
        SELECT f.i, f.level, f.n AS before,
            sum(source_size)::BIGINT AS full_all,
            sum(CASE WHEN 2 * source_size < f.level * weight THEN 2 * source_size ELSE 0 END)::BIGINT AS capped,
            sum(CASE WHEN 2 * source_size < f.level * weight THEN 0 ELSE weight END)::BIGINT AS open_weight,
            sum((2 * source_size < f.level * weight)::INT)::BIGINT AS k
        FROM fill f CROSS JOIN s GROUP BY f.i, f.level, f.n)
    WHERE k <> before AND open_weight > 0),
t AS (SELECT source, source_size, least(2.0 * source_size, level * weight)::DOUBLE AS target
    FROM s CROSS JOIN (SELECT arg_max(level, i) AS level FROM fill)),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
r AS (SELECT d.doc_id, d.size, d.u, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS rest,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u) AS run, sum(d.size) OVER (PARTITION BY d.source, d.u) AS own
    FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
    (size * (whole + CASE WHEN run - own + own / 2 <= rest THEN 1 ELSE 0 END))::BIGINT AS taken FROM r
"""

ORACLE_SQL: dict[str, str] = {"op4_quality_rules": OP4_SQL, "op6_mixing": OP6_SQL}
