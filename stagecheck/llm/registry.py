"""Queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from stagecheck.llm import language, licenses, neardup, pieces, privacy, quality, repeats, runs, sharding, tiling, urls, warc, whitening
from stagecheck.llm.common import table
from stagecheck.storage import scratch_path


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_texts(
        table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), spans=False)


def op2_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


#: (host, path, verdict) of the URL rules.
URL_RULES = (
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
)
#: Small enough that every given table splits many times, and that some documents are larger than a shard.
SHARD_BYTES = 16 << 10


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge_quality(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS rules(host, path, verdict)")
    return urls.apply_rules(table(spark, sf_dir, "pages"), rules)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language.learn_languages(docs.where(~language.held_out()))
    return predicted(docs, model)


def predicted(docs: DataFrame, model: language.LanguageModel | None) -> DataFrame:
    return language.predict_languages(docs, model).select(
        "doc_id", language.held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(table(spark, sf_dir, "documents"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "group_id", "group_size")


def op8_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.find_private(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tiling.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.find_runs(runs.with_planted_periods(table(spark, sf_dir, "documents")))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r.start, r.length, r.period), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.*",
        F.expr("1000 * best.length DIV best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = scratch_path(spark, "warc")
    warc.write_archive(table(spark, sf_dir, "pages"), archive)
    return warc.read_archive(spark, archive).select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


LLM_QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_repeats": op2_repeats,
    "op3_quality": op3_quality,
    "op4_url_filter": op4_url_filter,
    "op5_language": op5_language,
    "op6_licenses": op6_licenses,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_private_data": op8_private_data,
    "op9_sharding": op9_sharding,
    "op10_decontamination": op10_decontamination,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_warc": op13_warc,
}

_FITS = " UNION ALL ".join(
    f"""SELECT page_id, '{host}{path}' AS rule, '{verdict}' AS verdict FROM parts
    WHERE (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}')"""
    for host, path, verdict in URL_RULES)

LLM_ORACLES: dict[str, str] = {
    "op13_warc": f"""
        WITH payloads AS (
            SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
            FROM pages),
        led AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS leader FROM payloads)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= {warc.MIN_BYTES} AND page_id IS DISTINCT FROM leader THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= {warc.MIN_BYTES} AND page_id IS DISTINCT FROM leader THEN leader END AS refers_to
        FROM led""",
    "op4_url_filter": f"""
        WITH parts AS (
            SELECT page_id,
                translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), '{urls.UPPER}', '{urls.LOWER}') AS host,
                coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages),
        fits AS ({_FITS}),
        best AS (SELECT page_id, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY page_id)
        SELECT parts.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
        FROM parts LEFT JOIN best USING (page_id)""",
    "op9_sharding": f"""
        WITH hashed AS (
            SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash,
                coalesce(strlen(text), 0)::BIGINT AS n_bytes
            FROM documents),
        sizes AS (
            SELECT depth::INTEGER AS depth, hash >> (60 - depth)::INTEGER AS prefix, sum(n_bytes)::BIGINT AS shard_bytes, count(*) AS shard_rows
            FROM hashed, range(0, 61) AS depths(depth) GROUP BY ALL HAVING sum(n_bytes) <= {SHARD_BYTES}),
        leaf AS (
            SELECT doc_id, hash, n_bytes, min(depth) AS depth
            FROM hashed LEFT JOIN sizes ON sizes.prefix = hash >> (60 - depth)::INTEGER GROUP BY ALL),
        chained AS (
            SELECT *, n_bytes > {SHARD_BYTES // 2} AS big,
                row_number() OVER (PARTITION BY hash, n_bytes > {SHARD_BYTES // 2} ORDER BY doc_id) - 1 AS nth,
                coalesce(sum(n_bytes) OVER (PARTITION BY hash, n_bytes > {SHARD_BYTES // 2} ORDER BY doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
            FROM leaf WHERE depth IS NULL),
        paged AS (
            SELECT doc_id, hash, n_bytes, (CASE WHEN big THEN 2 * nth + 1 ELSE 2 * (ahead // {SHARD_BYTES // 2}) END)::BIGINT AS page FROM chained),
        placed AS (
            SELECT doc_id, depth, prefix, 0::BIGINT AS page, n_bytes, shard_bytes, shard_rows
            FROM leaf JOIN sizes USING (depth) WHERE prefix = hash >> (60 - depth)::INTEGER
            UNION ALL
            SELECT doc_id, 60, hash, page, n_bytes, sum(n_bytes) OVER (PARTITION BY hash, page)::BIGINT, count(*) OVER (PARTITION BY hash, page)
            FROM paged)
        SELECT doc_id, 'b' || CASE WHEN depth > 0 THEN lpad(bin(prefix), depth, '0') ELSE '' END AS shard, depth, page,
            n_bytes, shard_bytes, shard_rows, shard_bytes > {SHARD_BYTES} AS oversized
        FROM placed""",
}
