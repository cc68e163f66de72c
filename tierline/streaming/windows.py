"""Windowed and stateful streams without foreachBatch."""

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.functions import measures

# Settings for state that outgrows executor memory. It is kept on local disk
# and its changes are saved to the checkpoint folder, so a lost executor loses nothing.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


@contextmanager
def large_state(spark: SparkSession, **more: str):
    """Queries started inside keep these settings; the session gets its own back."""
    settings = LARGE_STATE | more
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def first_view_stream(views: DataFrame, horizon: str = "24 hours", spread: int = 64) -> DataFrame:
    """Drop repeated views of a product in a session within `horizon`.

    The first pass keeps one row per pair and salt, so a hot pair (all NULL sessions are
    one session) is spread over `spread` tasks; the second sees at most `spread` rows of it.
    """
    pair = ["user_session", "product_id"]
    salted = views.withColumn(
        "_salt", F.pmod(F.xxhash64("row_idx", "event_time"), F.lit(spread))
    )
    return (
        salted.withWatermark("event_time", horizon)
        .dropDuplicatesWithinWatermark([*pair, "_salt"])
        .drop("_salt")
        .dropDuplicatesWithinWatermark(pair)
    )


def minute_stream(events: DataFrame, dim: str, delay: str) -> DataFrame:
    """Minute sums of one dimension, emitted when the watermark closes the minute.

    Spark drops events that come more than `delay` after newer ones, and the minutes after the
    watermark are never closed at the end of the input. Where every event has to count, keep the
    minutes with `ingest.run_ingest` and take trailing hours from there.
    """
    return (
        events.withWatermark("event_time", delay)
        .groupBy(F.window("event_time", "1 minute").alias("minute"), "event_type", dim)
        .agg(measures.price_cents(), measures.priced_events())
    )


def trailing_hour_stream(events: DataFrame, dim: str, delay: str) -> DataFrame:
    """Totals of the last hour at every minute, within the limits of minute_stream().

    An event lies in 60 sliding windows, so minutes are summed first and the minute rows
    are spread over the windows.
    """
    return (
        minute_stream(events, dim, delay)
        .groupBy(
            F.window(F.window_time("minute"), "60 minutes", "1 minute").alias("hour"),
            "event_type",
            dim,
        )
        .agg(measures.merged_cents(), measures.merged_count())
        .select(
            "event_type",
            F.lit(dim).alias("dim"),
            F.col(dim).alias("dim_value"),
            F.col("hour.end").alias("bucket_end"),
            measures.money(F.col("cents")).alias("price_sum"),
            "event_count",
        )
    )
