"""Token counts through a cache of content digests."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import workspace
from tierline.llm.vocabularies import chunk_codes, path_of, version_digest

CACHE_SCHEMA = "content_digest binary, tokenizer_digest string, n_tokens bigint"
DEFAULT_VOCABULARY = "word_bpe_49k.json"


def content_digest(text):
    """SHA-256 of the normalised content: null is empty, ASCII white space runs are one space.

    The vocabulary drops white space, so texts of one digest have the same tokens. Letter case
    stays: special strings are matched before the vocabulary lower-cases.
    """
    spaced = F.regexp_replace(F.coalesce(text, F.lit("")), r"[ \t\n\x0B\f\r]+", " ")
    return F.unhex(F.sha2(F.trim(spaced).cast("binary"), 256))


def _counter(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = chunk_codes(path)
        for batch in batches:
            counts = codes.count(batch.column("text"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("content_digest"), pa.array(counts, pa.int64())],
                names=["content_digest", "n_tokens"],
            )

    return count


def token_counts(
    documents: DataFrame,
    cache: str,
    vocabulary: str | None = None,
    limit: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The number of tokens of every text: `doc_id, n_bytes, n_tokens, over_limit`.

    `cache` is a Parquet folder of counts by content and tokenizer digest. Contents it lacks are
    encoded once each, appended to it, and all counts are then looked up in it. Jobs that share a
    cache may append at the same time; a count stored twice is read once. The table is scanned
    again if a digest is missing, and the misses are digested again; the digests, what is missing, and the counts are stored
    in a folder of the workspace, so that Spark knows their sizes before it joins.

    One row comes out for each row that goes in. Null texts are empty and have no tokens; null and
    repeated ids are kept as they are; other columns are ignored. No rows give no rows, and append
    nothing. Texts of any length are counted whole. A path that executors can read is needed for
    `vocabulary`, a file of the tokenizers library.
    """
    spark: SparkSession = documents.sparkSession
    path = vocabulary or path_of(DEFAULT_VOCABULARY)
    version = version_digest(path)
    text = F.col(text_col)
    place = workspace.new_folder(spark, "digests")

    def kept(frame: DataFrame, name: str) -> DataFrame:
        frame.write.parquet(f"{place}/{name}")
        return spark.read.schema(frame.schema).parquet(f"{place}/{name}")

    def stored() -> DataFrame:
        if not workspace.exists(spark, cache):
            return spark.createDataFrame([], CACHE_SCHEMA)
        return spark.read.schema(CACHE_SCHEMA).parquet(cache).where(F.col("tokenizer_digest") == version)

    rows = kept(
        documents.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
            F.xxhash64(text).alias("mark"),
            content_digest(text).alias("content_digest"),
        ),
        "rows",
    )
    # One row stands for each missing digest; it is found by its id and a mark of its text, so that
    # only digests, ids and marks are grouped, and the texts of a digest that many rows share do not
    # meet in one task.
    missing = kept(
        rows.groupBy("content_digest")
        .agg(F.min(F.struct("doc_id", "mark")).alias("row"))
        .join(stored().select("content_digest"), "content_digest", "left_anti")
        .select("content_digest", F.col("row.doc_id").alias("id"), F.col("row.mark").alias("mark")),
        "missing",
    )
    if not missing.isEmpty():
        texts = documents.select(
            F.col(id_col).alias("doc_id"),
            F.coalesce(text, F.lit("")).alias("text"),
            F.xxhash64(text).alias("text_mark"),
        )
        # Only the texts found are digested again, lest one of an equal mark is taken for another.
        chosen = texts.join(
            missing,
            F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_mark") == F.col("mark")),
        ).where(content_digest(F.col("text")) == F.col("content_digest"))
        (
            chosen.select("content_digest", "text")
            .mapInArrow(_counter(path), "content_digest binary, n_tokens bigint")
            .withColumn("tokenizer_digest", F.lit(version))
            .select("content_digest", "tokenizer_digest", "n_tokens")
            .write.mode("append")
            .parquet(cache)
        )
    # Stored, so that the join reads two shuffles and AQE can split a digest that many rows share.
    counts = kept(
        stored().groupBy("content_digest").agg(F.min("n_tokens").alias("n_tokens")), "counts"
    )
    return rows.join(counts, "content_digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
