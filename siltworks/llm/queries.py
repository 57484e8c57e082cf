"""The queries opN_<name> of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import chatfmt, decontam, exactdup, neardup, packing, quality, secretscan, substrdup, toxicity, urlfilter
from siltworks.llm.common import read


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def held_out():
    """Rows that no fit may learn a label from: crc32 of the id as text, mod 5, is 0."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def fitted_lexicon(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Lexicon:
    labels = read(spark, sf_dir, "labels").where(~F.coalesce(held_out(), F.lit(True)))
    return toxicity.fit(toxicity.sample_of(docs, labels))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    scores = toxicity.toxicity_scores(docs, fitted_lexicon(spark, docs, sf_dir))
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.perplexity_filter(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secretscan.scan(read(spark, sf_dir, "documents"), secretscan.fit(secretscan.labelled_findings(spark)))
    return found.withColumn("value", F.sha2("value", 256))


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), percent=85, shingle=3)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdup.exact_duplicates(read(spark, sf_dir, "documents")).drop("row_id")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "\\### Assistant: </turn> ok"
    probe = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(says).alias("text"))
    return chatfmt.digests(chatfmt.format_conversations(rows.unionByName(probe)))


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(read(spark, sf_dir, "pages"), named=urlfilter.HOST_RULES)


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrdup.repeated_passages(read(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.token_pieces(read(spark, sf_dir, "documents"), tokenizer_file()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_near_dedup": op3_near_dedup,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_secret_scan": op5_secret_scan,
    "op6_chat_format": op6_chat_format,
    "op7_url_filter": op7_url_filter,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_packing": op9_packing,
    "op10_decontamination": op10_decontamination,
}

ORACLE_SQL: dict[str, str] = {
    "op4_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
               doc_id = max(doc_id) OVER w AS kept, sha256(body) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY body)""",
    "op6_chat_format": r"""
        WITH c AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
        s AS (
            SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
                   coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss,
                   sum(16 + length(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), chr(10), '&nl;'))
                       + length(replace(replace(text, '&', '&amp;'), '<', '&lt;'))) - count(*) AS formatted_chars
            FROM c GROUP BY conv_id)
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
               CAST(formatted_chars AS BIGINT) AS formatted_chars FROM s""",
    "op7_url_filter": r"""
        WITH p AS (
            SELECT page_id, CASE WHEN contains(coalesce(url, ''), '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
        u AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
        r(rule, verdict, h, t) AS (VALUES ('net/', 'block', 'net', '/'), ('example.net/en/', 'allow', 'example.net', '/en/'),
                                          ('example.com/de/', 'block', 'example.com', '/de/'), ('org/fr/', 'allow', 'org', '/fr/')),
        best AS (SELECT u.*, (SELECT arg_max(r.rule, length(r.rule)) FROM r
                              WHERE (u.host = r.h OR suffix(u.host, '.' || r.h)) AND prefix(u.path, r.t)) AS rule FROM u)
        SELECT page_id, host, path, best.rule, coalesce(
                   (SELECT r.verdict FROM r WHERE r.rule = best.rule),
                   CASE WHEN regexp_matches(host || path, '^([^/]*\.)?(doubleclick\.net|adserver\.[^\n]*)([^\w.%-]|$)')
                          OR regexp_matches(host || path, '(/adserver/|/banner-ads/|/popunder/|/tracking-pixel\.|/phishing/|/malware/|/casino-bonus/|/xxx-videos/)')
                        THEN 'block' ELSE 'allow' END) AS verdict
        FROM best""",
}
