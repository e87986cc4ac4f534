"""One query per operator over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landsales.llm import (byte_bpe, decontaminate, filter_audit, hard_negatives, licenses, near_dup, packing, pii,
                           ppm, quality, url_filter, warc, wavelet)
from landsales.llm.common import table


def _vocabulary(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.classes(table(spark, sf_dir, "documents"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree /source/lang/shelf; a short text with a licence line is a
    licence file, of its shelf or (under 20 words) of its language."""
    docs = table(spark, sf_dir, "documents")
    words = F.size(quality.word_list(F.col("text")))
    shelf = F.concat_ws("/", F.lit(""), "source", "lang")
    inner = F.concat(shelf, F.lit("/"), F.floor(F.col("doc_id") / 64).cast("string"))
    is_license = F.col("text").rlike(licenses.CUE)
    path = F.when(is_license & (words < 20), F.concat(shelf, F.lit("/LICENSE."), F.col("doc_id"))) \
        .when(is_license & (words < 60), F.concat(inner, F.lit("/LICENSE."), F.col("doc_id"))) \
        .otherwise(F.concat(inner, F.lit("/"), F.col("doc_id"), F.lit(".txt")))
    files = docs.select(F.col("doc_id").alias("file_key"), path.alias("path"), "text")
    return licenses.scan(files).withColumnRenamed("file_key", "doc_id")


def warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_digests(spark, table(spark, sf_dir, "pages"))


def benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return judged.drop("text", "quality_score")


def pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.json"))


def wavelet_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.index_corpus(table(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"))


def url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("canonical", "glob_hit")


def lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(table(spark, sf_dir, "documents"))


def pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents").select("doc_id", "text"))


def negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are the rows whose vec_id is divisible by 100; labels of the rows divisible by 7 are moved."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", label.alias("label"))
    return hard_negatives.mine(spark, rows, F.col("vec_id") % 100 == 0)


def filter_interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(filter_audit.failures(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def byte_bpe_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_probminhash": near_duplicates,
        "op2_license_scan": license_scan,
        "op3_warc_zstd": warc_archive,
        "op4_decontaminate": benchmark_leaks,
        "op5_quality_llr": quality_rules,
        "op6_min_bin_slack": pack_sequences,
        "op7_wavelet_matrix": wavelet_index,
        "op8_url_shift_and": url_verdicts,
        "op9_ppm": lm_scores,
        "op10_pii_surrogates": pii_surrogates,
        "op11_hard_negatives": negatives,
        "op12_filter_audit": filter_interactions,
        "op13_byte_bpe": byte_bpe_digests,
    }


WARC_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT payload_digest, min(page_id) AS first_id FROM p WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def _url_sql() -> str:
    """The contract's rules as a lookup of all fitting rules, and the globs as GLOB tests."""
    rules = ", ".join(f"('{verdict}', '{host}', '{path}')" for verdict, host, path in url_filter.RULES)
    globs = " OR ".join(f"canon GLOB '{g}'" for g in url_filter.BLOCK_GLOBS)
    return f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), h AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                            'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(lower(regexp_extract(rest, '^[^/?#]*')), '(:[0-9]*)?$', '')
           || regexp_extract(regexp_replace(rest, '#.*$', ''), '^[^/?]*(.*)$', 1) AS canon
  FROM u
), r(verdict, rule_host, prefix) AS (VALUES {rules}
), best AS (
  SELECT page_id, arg_max(rule_host || prefix, length(rule_host || prefix)) AS rule,
         arg_max(verdict, length(rule_host || prefix)) AS verdict
  FROM h, r WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, prefix) GROUP BY 1
)
SELECT h.page_id, host, path, rule,
       coalesce(verdict, CASE WHEN {globs} THEN 'block' ELSE 'allow' END) AS verdict
FROM h LEFT JOIN best USING (page_id)
"""


#: Scores are inner products of whole numbers in doubles: exact below 2^53.
NEGATIVES_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10
"""

#: Every order and step counts the documents anew, without masks of subsets.
AUDIT_SQL = """
WITH w AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         [x FOR x IN string_split_regex(coalesce(text, ''), '[ \\t-\\r]+') IF x <> ''] AS words
  FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS first_id FROM w GROUP BY t
), l AS (
  SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic
  FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         concat(CASE WHEN len(words) < 200 THEN 'A' ELSE '' END,
                CASE WHEN 100 * list_unique(words) < 50 * len(words) THEN 'B' ELSE '' END,
                CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' ELSE '' END,
                CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END,
                CASE WHEN first_id IS NOT NULL AND (w.doc_id IS NULL OR first_id < w.doc_id) THEN 'E' ELSE '' END) AS fails
  FROM w JOIN firsts USING (t) LEFT JOIN l ON w.doc_id = l.doc_id
), c AS (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails
), x(letter) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), o AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
  FROM x a, x b, x c, x d, x e
  WHERE a.letter NOT IN (b.letter, c.letter, d.letter, e.letter) AND b.letter NOT IN (c.letter, d.letter, e.letter)
    AND c.letter NOT IN (d.letter, e.letter) AND d.letter <> e.letter
), k AS (
  SELECT filter_order, step::INTEGER AS step, substr(filter_order, step, 1) AS letter,
         '[' || substr(filter_order, 1, step) || ']' AS upto,
         '[' || substr('-' || filter_order, 1, step) || ']' AS earlier
  FROM o, generate_series(1, 5) AS g(step)
), m AS (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT regexp_matches(fails, upto) THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN contains(fails, letter) AND NOT regexp_matches(fails, earlier) THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, letter) AND regexp_matches(fails, earlier) THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN contains(fails, letter) AND NOT regexp_matches(fails, earlier) THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN contains(fails, letter) AND NOT regexp_matches(fails, earlier) THEN toxic ELSE 0 END) AS toxic_lost
  FROM c, k GROUP BY ALL
)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley
FROM m
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_warc_zstd": WARC_SQL, "op8_url_shift_and": _url_sql(), "op11_hard_negatives": NEGATIVES_SQL,
            "op12_filter_audit": AUDIT_SQL}
