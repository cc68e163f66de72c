"""Operators on raw events: split, de-duplicate, bucket, route, shard."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import timegrid
from tierline.schema import EVENTS, check_configuration

# Different ids of one sort group in `assign_servers`, and groups of a second for rows without id.
SHARD_CHUNK = 1 << 20
NO_ID_CHUNKS = 1 << 10
# Chunks of a block in the tree of sizes. Ids of 63 bits make 2^43 chunks, so 2^21 blocks.
SHARD_FAN = 1 << 22


def split_events(events: DataFrame, event_types=EVENTS) -> DataFrame:
    """Keep the configured event types; event_type stays a key column."""
    check_configuration(event_types, ("product_id",))
    return events.where(F.col("event_type").isin(*event_types))


def view_order(events: DataFrame) -> list[str]:
    """Columns that put repeated views in a fixed order: time, then number; files with numbers of
    their own are told apart by what follows, the servers of a second by nothing before."""
    order = ("event_time", "row_idx", "file_time", "server", "price", "brand", "category_code")
    return [name for name in order if name in events.columns]


def first_views(events: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """Keep the earliest view of a product in a session; other event types pass unchanged.

    NULL sessions count as one session. `scope` adds key columns. Only views are dealt out: Spark
    turns the row_number filter into a WindowGroupLimit on both sides of the shuffle, so a task
    sends at most one row per (session, product), however hot the pair is. The key starts with a
    hash of itself: sorts then compare numbers and rarely look at the text columns. Neither a
    missing nor a repeated `row_idx` matters to which rows are counted.
    """
    view = F.col("event_type").eqNullSafe("view")
    key = ["user_session", "product_id", *scope]
    first = Window.partitionBy(F.xxhash64(*key), *key).orderBy(*view_order(events))
    views = (
        events.where(view)
        .withColumn("_position", F.row_number().over(first))
        .where("_position = 1")
        .drop("_position")
    )
    return views.unionByName(events.where(~view))


def with_bucket(events: DataFrame, step: int) -> DataFrame:
    return events.withColumn("bucket_end", timegrid.bucket_end(F.col("event_time"), step))


def flag_late(files: DataFrame, clock: Column) -> DataFrame:
    """is_late: the file time lies before the clock. A file at the clock is live."""
    return files.withColumn(
        "is_late", F.coalesce(F.col("file_time") < clock, F.lit(False))
    )


def earlier_sizes(sizes: DataFrame, fan: int = SHARD_FAN) -> DataFrame:
    """Groups of (minute, event_time, id_chunk) with a `size`, and the rows before each in its minute.

    Sums go up a tree and offsets come down: chunks by `fan` of their numbers, those by event time,
    times by second, seconds by minute. No window holds more than `fan` chunks, the blocks of chunks
    of one time, or the times of one second, however ids and times lie in a minute.
    """
    levels = [
        ["minute", "second", "event_time", "id_block", "id_chunk"],
        ["minute", "second", "event_time", "id_block"],
        ["minute", "second", "event_time"],
        ["minute", "second"],
    ]
    rows = sizes.withColumns(
        {
            "second": F.date_trunc("second", "event_time"),
            "id_block": F.floor(F.col("id_chunk") / F.lit(fan)).cast("bigint"),
        }
    )
    tree = [rows]
    for keys in levels[1:]:
        tree.append(tree[-1].groupBy(*keys).agg(F.sum("size").alias("size")))
    above = None
    for keys, nodes in reversed(list(zip(levels, tree))):
        siblings = (
            Window.partitionBy(*keys[:-1])
            .orderBy(keys[-1])
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        before = F.coalesce(F.sum("size").over(siblings), F.lit(0))
        nodes = nodes.select(*keys, before.alias("offset"))
        if above is not None:
            upper = above.withColumnRenamed("offset", "upper")
            nodes = nodes.join(upper, keys[:-1]).select(
                *keys, (F.col("offset") + F.col("upper")).alias("offset")
            )
        above = nodes
    return above.drop("second", "id_block")


def assign_servers(events: DataFrame, servers: int = 4, chunk: int = SHARD_CHUNK) -> DataFrame:
    """Deal the rows of each minute, in (event_time, row_idx) order, to servers in turn.

    The position in the minute is an offset plus a position in a chunk of neighbouring ids of one
    time. A chunk holds at most `chunk` different ids, and offsets are summed up in a tree, so a
    minute with most of the data is sorted by many tasks, whatever its ids have to do with time.
    Rows without an id come first at their time, in chunks by a hash of the row; rows of one id are
    ordered by that hash.
    """
    keys = ["minute", "event_time", "id_chunk"]
    content = F.xxhash64(*events.columns)
    keyed = events.withColumns(
        {
            "minute": timegrid.bucket_start(F.col("event_time"), 60),
            "id_chunk": F.coalesce(
                F.floor(F.col("row_idx") / F.lit(chunk)).cast("bigint"),
                F.lit(-(1 << 62)) + F.pmod(content, F.lit(NO_ID_CHUNKS)),
            ),
            "row_hash": content,
        }
    )
    offsets = earlier_sizes(keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("size")))
    within = Window.partitionBy(*keys).orderBy("row_idx", "row_hash")
    # Numbered first: what the window has sorted is in the order that the join needs.
    numbered = keyed.withColumn("id_place", F.row_number().over(within)).drop("row_hash")
    position = F.col("offset") + F.col("id_place") - 1
    return (
        numbered.join(offsets, keys)
        .withColumn("server", F.pmod(position, F.lit(servers)).cast("int"))
        .drop("id_chunk", "offset", "id_place")
    )
