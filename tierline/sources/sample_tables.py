"""Raw retail events derived from the `events` and `part` sample tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import timegrid
from tierline.schema import MONEY

# Sample times start here, and categories are numbered from here.
SAMPLE_START_EPOCH = 1704067200
CATEGORY_BASE = 2053013550000000000
# Stated, so that no job has to read file footers before the query.
EVENTS_SCHEMA = (
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
)
PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int"


def product_events(events: DataFrame, part: DataFrame, factor: int = 30) -> DataFrame:
    """Join events to their product and shape both like raw retail events.

    No hint on the join: Spark broadcasts `part` only below its size threshold, and beyond
    it sorts and merges, where AQE splits the partition of a hot product.
    """
    key = F.regexp_extract("props", "([0-9]+)", 1).try_cast("bigint")
    joined = events.withColumn("k", key).join(part, F.col("k") == F.col("p_partkey"))
    kind = F.lower("p_type")
    dotted = F.replace("p_name", F.lit(" "), F.lit("."))
    depth = F.pmod("k", F.lit(5))
    code = (
        F.when(depth == 1, kind)
        .when(depth == 2, dotted)
        .when(depth == 3, F.concat_ws(".", kind, dotted))
        .when(depth == 4, F.concat_ws(".", kind, dotted, F.lit("x")))
    )
    time = F.col("ts").cast("timestamp")
    return joined.select(
        F.col("event_id").alias("row_idx"),
        timegrid.concentrate(time, factor, SAMPLE_START_EPOCH).alias("event_time"),
        "event_type",
        F.col("k").alias("product_id"),
        (F.lit(CATEGORY_BASE) + F.col("p_size")).alias("category_id"),
        code.alias("category_code"),
        F.when(F.pmod("k", F.lit(7)) != 0, F.col("p_brand")).alias("brand"),
        F.when(F.pmod("event_id", F.lit(50)) != 0, F.col("value")).cast(MONEY).alias("price"),
        F.when(
            F.pmod("user_id", F.lit(11)) != 0,
            F.concat(F.lit("s"), F.pmod("user_id", F.lit(40)).cast("string")),
        ).alias("user_session"),
    )


def sample_events(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(EVENTS_SCHEMA).parquet(f"{folder}/events.parquet")


def sample_parts(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(PART_SCHEMA).parquet(f"{folder}/part.parquet")


def retail_events(spark: SparkSession, folder: str, factor: int = 30) -> DataFrame:
    """Raw typed events of a sample folder."""
    return product_events(sample_events(spark, folder), sample_parts(spark, folder), factor)


def arrives_late(row_idx: Column) -> Column:
    """True for events whose file arrives after the live ones."""
    return F.pmod(row_idx, F.lit(37)) == 0


def retail_event_stream(
    spark: SparkSession, folder: str, factor: int = 30, bytes_per_batch: str | None = None
) -> DataFrame:
    """The same events as a stream; each carries its minute as `file_time`."""
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    if bytes_per_batch:
        reader = reader.option("maxBytesPerTrigger", bytes_per_batch)
    # A glob: the stream source takes a single file only this way.
    events = reader.parquet(f"{folder}/events.parque[t]")
    return product_events(events, sample_parts(spark, folder), factor).withColumn(
        "file_time", timegrid.bucket_start(F.col("event_time"), 60)
    )
