"""The registered queries of this subpackage and their SQL counterparts."""

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import workspace
from tierline.llm import (
    exact_top_k,
    fuzzy_hashing,
    language_profiles,
    lexical_search,
    license_scan,
    main_text,
    oracle_sql,
    packing,
    repeated_windows,
    sentence_pieces,
    small_worlds,
    spelling_variants,
    token_counts,
    vectors,
    web_archives,
)
from tierline.llm.session import prepare


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_web_archives(spark: SparkSession, folder: str) -> DataFrame:
    place = workspace.new_folder(spark, "archives")
    now = datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")
    return web_archives.archive_pages(_table(spark, folder, "pages"), place, now).select(
        F.col("row_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        F.col("uri").alias("url"),
        "record_id",
    )


def op2_language_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return language_profiles.identify(_table(spark, folder, "documents"))


def op3_fuzzy_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy_hashing.near_duplicates(_table(spark, folder, "documents"))


def op4_small_worlds(spark: SparkSession, folder: str, shard_rows: int = 8_192) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    place = workspace.new_folder(spark, "vector-index")
    small_worlds.build_index(rows, shard_rows).write.parquet(place)
    index = spark.read.schema(small_worlds.INDEX).parquet(place)
    shards = vectors.parts_of(rows, shard_rows)
    return small_worlds.nearest(index, rows.where("vec_id % 50 = 0"), shards)


def op5_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    rows = _table(spark, folder, "embeddings")
    return exact_top_k.exact_top_k(rows, rows.where("vec_id % 50 = 0"))


def op6_pack_documents(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(_table(spark, folder, "documents"))


def op7_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    cache = workspace.new_folder(spark, "token-counts")
    return token_counts.token_counts(_table(spark, folder, "documents"), cache)


def op8_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.main_texts(_table(spark, folder, "pages"))


def op9_repeated_windows(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_windows.remove_repeated(
        _table(spark, folder, "documents"), content=None
    ).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op10_sentence_pieces(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: ids counted and hashed, parity with the original, and the way back."""
    return sentence_pieces.round_trips(_table(spark, folder, "documents")).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_hash"),
        "parity",
        "round_trip",
    )


def op11_bag_search(spark: SparkSession, folder: str) -> DataFrame:
    place = workspace.new_folder(spark, "bags")
    items = _table(spark, folder, "benchmark")
    return lexical_search.search(_table(spark, folder, "documents"), items, place)


def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    place = workspace.new_folder(spark, "license-blocks")
    return license_scan.scan(_table(spark, folder, "documents"), place)


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    place = workspace.new_folder(spark, "spelling")
    return spelling_variants.spelling_variants(_table(spark, folder, "documents"), place)


def _prepared(query):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(prepare(spark), folder)

    return run


QUERIES = {
    query.__name__: _prepared(query)
    for query in (
        op1_web_archives,
        op2_language_profiles,
        op3_fuzzy_hashing,
        op4_small_worlds,
        op5_exact_top_k,
        op6_pack_documents,
        op7_token_counts,
        op8_main_text,
        op9_repeated_windows,
        op10_sentence_pieces,
        op11_bag_search,
        op12_license_scan,
        op13_spelling_variants,
    )
}

ORACLE: dict[str, str] = {
    "op11_bag_search": oracle_sql.LEXICAL_SEARCH,
    "op12_license_scan": oracle_sql.LICENSE_SCAN,
    "op13_spelling_variants": oracle_sql.SPELLING_VARIANTS,
    "op1_web_archives": """
        WITH payloads AS (
          SELECT page_id, url, coalesce(html, '') AS payload,
                 octet_length(encode(coalesce(html, ''))) AS payload_bytes
          FROM pages),
        digests AS (
          SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
                 sha1(payload) AS payload_digest, url,
                 CASE WHEN payload_bytes >= 1000
                      THEN max(page_id) OVER (PARTITION BY payload) END AS original
          FROM payloads),
        ids AS (
          SELECT *, md5(concat_ws('|', CAST(page_id AS VARCHAR), url, payload_digest)) AS id
          FROM digests)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN original <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN original <> page_id THEN original END AS refers_to,
               url,
               '<urn:uuid:' || id[1:8] || '-' || id[9:12] || '-' || id[13:16] || '-'
                 || id[17:20] || '-' || id[21:32] || '>' AS record_id
        FROM ids
    """,
    "op5_exact_top_k": """
        WITH whole AS (
          SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
          FROM embeddings
          WHERE embedding IS NOT NULL
            AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        scored AS (
          SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
          FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
          WHERE q.vec_id % 50 = 0),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
          FROM scored)
        SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 5
    """,
}
