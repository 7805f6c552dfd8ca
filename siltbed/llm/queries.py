"""The registered queries of the operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, jaccard_join, jpeg, langid, line_dedup, mixing, sentencepiece_fst, sharding, suffix_dedup, window_dedup


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mix(documents(spark, sf_dir)).taken()


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(documents(spark, sf_dir))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 4 == 2
    filters = langid.learn(docs, ~F.coalesce(held_out, F.lit(False)))
    return langid.identify(docs, filters, keep=[F.coalesce(held_out, F.lit(False)).alias("held_out")])


def op4_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_dedup.remove_repeats(documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir))


def op6_sentencepiece(spark: SparkSession, sf_dir: str, model: str = sentencepiece_fst.DEFAULT_MODEL) -> DataFrame:
    return sentencepiece_fst.encode_documents(documents(spark, sf_dir), sentencepiece_fst.read_model(model))


def op7_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(documents(spark, sf_dir), map_path=sharding.new_map_path(spark))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "vslot"
    )


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(documents(spark, sf_dir))


def op9_jpeg_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jpeg.media_table(documents(spark, sf_dir))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(documents(spark, sf_dir))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix_sources": op1_mix_sources,
    "op2_line_dedup": op2_line_dedup,
    "op3_language_id": op3_language_id,
    "op4_window_dedup": op4_window_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_virtual_slots": op7_virtual_slots,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_jpeg_media": op9_jpeg_media,
    "op10_jaccard_join": op10_jaccard_join,
}

ORACLE_SQL: dict[str, str] = {
    "op4_window_dedup": r"""
        WITH w AS MATERIALIZED (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), win AS (
            SELECT doc_id, i, hash(ws[i:i+34]) AS k FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w)
        ), rep AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY k) AS c FROM win) WHERE c > 1
        ), gone AS (
            SELECT DISTINCT doc_id, j FROM (SELECT doc_id, unnest(range(i, i + 35)) AS j FROM rep)
        ), kept AS (
            SELECT doc_id, string_agg(x, ' ' ORDER BY j) AS t, count(*) AS n
            FROM (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS j FROM w) ANTI JOIN gone USING (doc_id, j)
            GROUP BY doc_id
        )
        SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM w LEFT JOIN kept USING (doc_id)
    """,
    "op8_suffix_dedup": r"""
        WITH t AS MATERIALIZED (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n FROM documents
        ), s AS (
            SELECT doc_id, i, hash(substr(h, 2 * i + 1, 200)) AS k FROM (SELECT doc_id, h, unnest(range(0, n - 99)) AS i FROM t)
        ), rep AS (
            SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM s) WHERE r > 1
        ), run AS (
            SELECT doc_id, min(i) AS a, max(i) + 100 AS b FROM (
                SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS g FROM (
                    SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS new FROM rep))
            GROUP BY doc_id, g
        ), gap AS (
            SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_ FROM run
        ), cut AS (
            SELECT doc_id, count(*) AS spans, sum(b - a) AS gone, max(b) AS last,
                   string_agg(substr(h, 2 * from_ + 1, 2 * (a - from_)), '' ORDER BY a) AS head
            FROM gap JOIN t USING (doc_id) GROUP BY doc_id
        )
        SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
               sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
        FROM t LEFT JOIN cut USING (doc_id)
    """,
    "op10_jaccard_join": r"""
        WITH RECURSIVE w AS MATERIALIZED (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), s AS MATERIALIZED (
            SELECT DISTINCT doc_id, hash(ws[i:i+4]) AS k FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0)
        ), c AS MATERIALIZED (
            SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
        ), p AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY 1, 2
        ), l AS MATERIALIZED (
            SELECT x, y FROM p JOIN c ON c.doc_id = x JOIN c d ON d.doc_id = y WHERE 100 * o >= 75 * (c.n + d.n - o)
        ), e AS MATERIALIZED (
            SELECT x, y FROM l UNION ALL SELECT y, x FROM l
        ), reach(doc_id, there) AS (
            SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.y FROM reach r JOIN e ON e.x = r.there
        )
        SELECT d.doc_id, CAST(coalesce(any_value(c.n), 0) AS BIGINT) AS n_shingles, min(r.there) AS component_id
        FROM documents d JOIN reach r ON r.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id GROUP BY d.doc_id
    """,
    "op5_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents
        )
        SELECT doc_id,
               min(doc_id) OVER (PARTITION BY norm) AS keep_id,
               CAST(count(*) OVER (PARTITION BY norm) AS BIGINT) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY norm) AS kept,
               sha256(norm) AS text_sha256
        FROM t
    """,
}
