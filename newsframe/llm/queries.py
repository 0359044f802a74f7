"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsframe.llm.common import table
from newsframe.llm.decontaminate import contaminated
from newsframe.llm.jaccard import jaccard_components
from newsframe.llm.lm import lm_scores
from newsframe.llm.packing import pack
from newsframe.llm.periodic import run_report
from newsframe.llm.pii import pii_report
from newsframe.llm.quality import quality_scores
from newsframe.llm.rules import RULES, STOP_WORDS, SYMBOLS, judged
from newsframe.llm.secrets import secret_report
from newsframe.llm.spelling import spelling_groups
from newsframe.llm.substrings import repeated_removed
from newsframe.llm.toxicity import toxicity_scores
from newsframe.llm.warc import page_of, read_archives, write_archives
from newsframe.session import checkpoint_dir

SCORED = ["doc_id", "held_out", "score", "predicted"]


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_documents(spark, sf_dir), k=4, num=85, den=100)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_documents(spark, sf_dir), table(spark, sf_dir, "labels")).select(*SCORED)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_report(_documents(spark, sf_dir))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(_documents(spark, sf_dir))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_removed(_documents(spark, sf_dir), width=13).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(_documents(spark, sf_dir))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), table(spark, sf_dir, "labels")).select(*SCORED)


def op9_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(_documents(spark, sf_dir))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir)).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = write_archives(pages, f"{checkpoint_dir(spark).rstrip('/')}/archives-{uuid.uuid4().hex}", least=1000)
    return read_archives(spark, path).select(
        page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest", F.col("warc_type").alias("record_type"),
        page_of("refers_to").alias("refers_to"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_groups(_documents(spark, sf_dir), least_length=6, least_count=5, ratio=5, plant=True)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_report(_documents(spark, sf_dir), least=12, plant=True).drop("n_words", "n_kept")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_toxicity, op3_pii, op4_quality_rules, op5_substring_dedup, op6_lm_scoring,
    op7_benchmark_decontamination, op8_quality_classifier, op9_secret_scans, op10_packing, op11_warc,
    op12_spelling_variants, op13_periodic_runs, pipeline)}

_WS = "[\\x20\\x09-\\x0D]"
_SPACES = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
_WORDS = f"list_filter(regexp_split_to_array(coalesce(text, ''), '{_WS}+'), lambda x: x <> '')"


def _removed(chars: str, text: str = "t") -> str:
    return f"(length({text}) - length(translate({text}, {chars}, '')))"


_RULE_SQL = " AND ".join(
    "(n_words < {} OR ({}))".format(least, " AND ".join(([f"{n} >= {low}"] if low is not None else []) + ([f"{n} <= {high}"] if high is not None else [])))
    for n, low, high, least in RULES)
_STOPS = ", ".join(f"'{s}'" for s in STOP_WORDS)

RULES_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS} AS w,
                  list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: trim(l, {_SPACES}) <> '') AS ls FROM documents),
win AS (SELECT rid, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT rid, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, sum(least(8, coalesce(nx - i, 8))) AS n FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nx FROM dup) GROUP BY rid),
f AS (SELECT doc_id, len(w) AS n_words, {_removed(f"'{SYMBOLS}'")} AS n_symbols, length(t) - {_removed(_SPACES)} AS word_chars,
             len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
             greatest(len(w), 1) AS pw, greatest(length(t) - {_removed(_SPACES)}, 1) AS pc, greatest(len(ls), 1) AS pl, t, ls
      FROM d LEFT JOIN rep USING (rid)),
g AS (SELECT *, word_chars / pw AS mean_word_length, n_symbols / pw AS symbols_per_word, {_removed("'!?'")} / pw AS marks_per_word,
             {_removed("'ABCDEFGHIJKLMNOPQRSTUVWXYZ'")} / pc AS upper_share, {_removed("'0123456789'")} / pc AS digit_share, n_dup_lines / pl AS dup_line_share,
             len(list_filter(ls, lambda l: suffix(rtrim(l, ' '), '...'))) / pl AS ellipsis_line_share,
             len(list_filter(ls, lambda l: regexp_matches(l, '^{_WS}*[-*•]{_WS}'))) / pl AS bullet_line_share,
             CAST(len(list_intersect(list_distinct(regexp_split_to_array(lower(t), '({_WS}|[.,;:!?])+')), [{_STOPS}])) AS DOUBLE) AS stop_words,
             n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND {_RULE_SQL} AS kept, {", ".join(r[0] for r in RULES)} FROM g"""

SUBSTRING_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS} AS w FROM documents),
win AS (SELECT rid, doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT rid, doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
dup AS (SELECT rid, i FROM (SELECT rid, doc_id, i, min(doc_id) OVER (PARTITION BY g) AS m FROM win) WHERE m < doc_id),
cov AS (SELECT DISTINCT rid, unnest(range(i, i + 13)) AS p FROM dup),
gone AS (SELECT rid, list(p) AS ps, count(*) AS n FROM cov GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(ps, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN gone USING (rid)"""

WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
g AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(encode(h)) AS d, max(page_id) OVER (PARTITION BY h) AS top FROM p),
r AS (SELECT *, n >= 1000 AND page_id < top AS again FROM g)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN top END AS refers_to FROM r"""

ORACLE: dict[str, str] = {"op4_quality_rules": RULES_SQL, "op5_substring_dedup": SUBSTRING_SQL, "op11_warc": WARC_SQL}
