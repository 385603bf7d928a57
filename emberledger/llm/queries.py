"""One query per operator, over its whole table, and the SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberledger.llm import (
    alignment,
    embedding_dedup,
    line_dedup,
    mixing,
    ngram_join,
    packing,
    quality,
    sharding,
    suffix_dedup,
    toxicity,
    url_filter,
    warc,
    whitening,
)
from emberledger.llm.common import scratch, table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pack_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_warc_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_records(table(spark, sf_dir, "pages"), scratch(spark, "warc"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.grade_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_taken(table(spark, sf_dir, "documents"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = sharding.shard_rows(table(spark, sf_dir, "documents"), 16)
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_digests(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"), tokenizer_path(), tokenizer_path("piece_bpe_32k.model"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_pack_windows,
        op2_warc_reassembly,
        op3_toxicity,
        op4_mix_sources,
        op5_url_filter,
        op6_quality,
        op7_ngram_join,
        op8_line_dedup,
        op9_embedding_dedup,
        op10_shards,
        op11_suffix_dedup,
        op12_token_alignment,
        op13_whitening,
    )
}

SQL = {
    "op2_warc_reassembly": r"""
        WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
        d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
        f AS (SELECT *, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS first FROM d)
        SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
               CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first <> page_id THEN first END AS refers_to,
               CAST(NULL AS VARCHAR) AS error
        FROM f""",
    "op5_url_filter": r"""
        WITH u AS (
          SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS r FROM pages),
        k AS (
          SELECT page_id,
                 coalesce(translate(regexp_extract(r, '^([^/?#]*)', 1),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
                 coalesce(regexp_extract(r, '^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
        f AS (
          SELECT *, CASE
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule FROM k)
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN list_has_any(string_split(host, '.'),
                 ['ads-track', 'adult-x', 'casino-win', 'cheap-pills', 'free-bets', 'spam-farm']) THEN 'block'
            ELSE 'allow' END AS verdict
        FROM f""",
    "op8_line_dedup": r"""
        WITH l AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
          FROM documents),
        k AS (
          SELECT doc_id, pos, line,
                 translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
          FROM l),
        hot AS (
          SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
          GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        j AS (
          SELECT k.doc_id, k.pos, k.line, hot.key IS NOT NULL AND k.doc_id <> hot.keeper AS dropped
          FROM k LEFT JOIN hot ON k.key = hot.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
        FROM j GROUP BY doc_id""",
    "op9_embedding_dedup": r"""
        WITH RECURSIVE v AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        pairs AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
          ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
        reach AS (
          SELECT vec_id AS id, vec_id AS r FROM embeddings
          UNION SELECT reach.id, pairs.b FROM reach JOIN pairs ON reach.r = pairs.a),
        n AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
        SELECT id AS vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r) AS component_id,
               id = min(r) AS kept
        FROM reach LEFT JOIN n ON n.a = id GROUP BY id""",
}
