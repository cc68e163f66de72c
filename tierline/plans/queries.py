"""Every registered query: (session, sample folder) to a DataFrame over the whole tables."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline.functions import measures, timegrid
from tierline.functions.clean import clean_events
from tierline.operators import events as ev
from tierline.operators import metrics as me
from tierline.operators import tiers as ti
from tierline.operators.backlog import repaired
from tierline.plans import jobs
from tierline.schema import DAY, HOUR, MINUTE, TIER_KEYS
from tierline.sources import raw_csv, versions
from tierline.sources.sample_tables import (
    SAMPLE_START_EPOCH,
    arrives_late,
    retail_event_stream,
    retail_events,
    sample_events,
)
from tierline.sources.tier_table import read_tier, rows_of, write_rows, write_tier
from tierline.streaming import ingest as stream
from tierline.streaming.trailing import served_trailing
from tierline.streaming.windows import first_view_stream, large_state
from tierline.workspace import new_folder

CATEGORY_LEVELS = ("category_l1", "category_l2", "category_l3")
TOP_K = 10
# From January 2024 back to before October 2019.
DAYS_BACK = 2000


def _plain(rows: DataFrame) -> DataFrame:
    """Times without zone and money as double, for comparison with other engines."""
    plain = {T.TimestampType: "timestamp_ntz", T.DecimalType: "double"}
    return rows.select(
        *[
            F.col(field.name).cast(plain[type(field.dataType)]).alias(field.name)
            if type(field.dataType) in plain
            else F.col(field.name)
            for field in rows.schema.fields
        ]
    )


def _cleaned(spark: SparkSession, folder: str, factor: int = 30) -> DataFrame:
    return clean_events(retail_events(spark, folder, factor))


def _late(events: DataFrame) -> DataFrame:
    return events.where(arrives_late(F.col("row_idx")))


def _live(events: DataFrame) -> DataFrame:
    return events.where(~arrives_late(F.col("row_idx")))


def _stored_minutes(spark: SparkSession, folder: str, factor: int = 30, **options) -> str:
    """Path of a freshly written minute tier."""
    path = new_folder(spark, "minutes")
    write_tier(jobs.ingest(retail_events(spark, folder, factor), **options), path)
    return path


# Raw events and columns


def raw_events(spark, folder):
    return _plain(retail_events(spark, folder))


def concentrate_30x(spark, folder):
    events = sample_events(spark, folder)
    time = timegrid.concentrate(F.col("ts").cast("timestamp"), 30, SAMPLE_START_EPOCH)
    return _plain(events.select("event_id", "ts", time.alias("event_time")))


def server_shards(spark, folder):
    events = retail_events(spark, folder).select("row_idx", "event_time")
    dealt = ev.assign_servers(events)
    return _plain(
        dealt.withColumn("file_key", timegrid.file_key(F.col("minute"), F.col("server")))
    )


def clean_dimensions(spark, folder):
    return _cleaned(spark, folder).select("row_idx", "product_id", "brand", *CATEGORY_LEVELS)


def event_split(spark, folder):
    return _plain(
        ev.split_events(retail_events(spark, folder)).select(
            "event_type", "row_idx", "event_time", "product_id", "price"
        )
    )


def _bucketed(spark, folder, step):
    return _plain(
        ev.with_bucket(retail_events(spark, folder), step).select(
            "row_idx", "event_time", "bucket_end"
        )
    )


def bucket_minute(spark, folder):
    return _bucketed(spark, folder, MINUTE)


def bucket_hour(spark, folder):
    return _bucketed(spark, folder, HOUR)


def _sliced(spark, folder, keep):
    events = sample_events(spark, folder)
    return events.where(keep(F.col("ts"))).select("event_id", "ts", "event_type", "value")


def _moment(text):
    return F.lit(text).cast("timestamp_ntz")


def slice_half_open(spark, folder):
    start, end = _moment("2024-01-05 00:00:00"), _moment("2024-01-20 12:00:00")
    return _sliced(spark, folder, lambda ts: timegrid.half_open(ts, start, end))


def slice_look_back(spark, folder):
    return _sliced(
        spark, folder, lambda ts: timegrid.look_back(ts, _moment("2024-01-15 06:00:00"))
    )


def slice_closed(spark, folder):
    """A stored tier between two labels, both included."""
    path = _stored_minutes(spark, folder)
    return _plain(
        read_tier(spark, path, start="2024-01-01 06:00:00", end="2024-01-01 18:00:00")
    )


def view_dedup(spark, folder):
    views = ev.split_events(retail_events(spark, folder), ("view",))
    return _plain(
        ev.first_views(views).select("row_idx", "event_time", "user_session", "product_id", "price")
    )


# Minute tables


def _minute_table(event, dim):
    def query(spark, folder):
        metrics = jobs.ingest(
            retail_events(spark, folder), event_types=(event,), dimensions=(dim,)
        )
        return _plain(me.table(metrics, event, dim))

    return query


def _category_tables(event):
    def query(spark, folder):
        metrics = jobs.ingest(
            retail_events(spark, folder), event_types=(event,), dimensions=CATEGORY_LEVELS
        )
        return _plain(
            me.published(metrics).select(
                "dim", "dim_value", "bucket_end", *me.table_columns(event, "category_l3")
            )
        )

    return query


def minute_tier(spark, folder):
    return _plain(jobs.ingest(retail_events(spark, folder)))


def minute_tier_published(spark, folder):
    return _plain(me.published(jobs.ingest(retail_events(spark, folder))))


# Coarser tiers, ranks, clocks


def hour_tier(spark, folder):
    return _plain(ti.roll_up(jobs.ingest(retail_events(spark, folder)), HOUR))


def hour_tier_event_aligned(spark, folder):
    minutes = jobs.ingest(retail_events(spark, folder))
    return _plain(ti.roll_up(minutes, HOUR, source_step=MINUTE))


def day_tier(spark, folder):
    minutes = jobs.ingest(retail_events(spark, folder, factor=1))
    return _plain(ti.roll_up(ti.roll_up(minutes, HOUR), DAY))


def merge_average(spark, folder):
    """Product tables of two arrivals, merged on their stored counts and averages."""
    events = ev.with_bucket(ev.split_events(_cleaned(spark, folder), ("view",)), MINUTE)
    parts = [
        me.table(me.by_dimension(part, ("product_id",)), "view", "product_id")
        for part in (_live(events), _late(events))
    ]
    merged = me.merge_table(parts[0].unionByName(parts[1]), "view", "product_id")
    return _plain(merged.withColumn("avg_price", F.round("avg_price", 6)))


def transport_hours(spark, folder):
    """Hour tier after two transports, the first with half of the day ingested."""
    minutes, hours = new_folder(spark, "minutes"), new_folder(spark, "hours")
    events = retail_events(spark, folder)
    noon = F.lit("2024-01-01 12:00:00").cast("timestamp")
    for part in (F.col("event_time") < noon, F.col("event_time") >= noon):
        jobs.store_minutes(events.where(part), minutes)
        jobs.transport(spark, minutes, hours)
    return _plain(read_tier(spark, hours))


def rolling_hour_totals(spark, folder):
    return _plain(jobs.rank(spark, _stored_minutes(spark, folder)))


def rank_tables(spark, folder):
    """The trailing hour with the measures each rank table shows."""
    totals = jobs.rank(spark, _stored_minutes(spark, folder))
    return _plain(me.published(totals, time=None))


def rolling_hour_rank(spark, folder):
    totals = jobs.rank(spark, _stored_minutes(spark, folder))
    return _plain(ti.top(totals, TOP_K))


def rolling_hour_series(spark, folder):
    return _plain(ti.trailing_series(jobs.ingest(retail_events(spark, folder))))


def tier_clock(spark, folder):
    views = jobs.ingest(
        retail_events(spark, folder), event_types=("view",), dimensions=("category_l3",)
    )
    return _plain(
        views.agg(
            ti.clock_value(newest=False).alias("oldest"), ti.clock_value().alias("newest")
        )
    )


def retention_24h(spark, folder):
    path = _stored_minutes(spark, folder, factor=1)
    jobs.retain_tier(spark, path, 24)
    return _plain(read_tier(spark, path))


def retention_wrong_date(spark, folder):
    """Retention of a tier that one view has reached with a date far ahead: it moves nothing."""
    path = _stored_minutes(spark, folder, factor=1)
    ahead = retail_events(spark, folder, 1).where("event_type = 'view'").orderBy("row_idx").limit(1)
    ahead = ahead.withColumn("event_time", F.lit("2024-05-05 05:05:05").cast("timestamp"))
    jobs.store_minutes(ahead, path)
    jobs.retain_tier(spark, path, 24)
    return _plain(read_tier(spark, path))


def compact_after_crash(spark, folder):
    """A tier that is appended to while a compaction dies, and compacted again."""
    path = new_folder(spark, "minutes")
    events = retail_events(spark, folder)
    parts = [events.where(F.pmod("row_idx", F.lit(3)) == n) for n in range(3)]
    for part in parts[:2]:
        jobs.store_minutes(part, path, deduplicate=False)
    begun = versions.latest(spark, path)
    write_rows(rows_of(spark, path, list(begun.segments)), path)  # written, and never committed
    jobs.store_minutes(parts[2], path, deduplicate=False)
    jobs.compact_tier(spark, path)
    return _plain(read_tier(spark, path))


def late_and_live_equal(spark, folder):
    """Every purchase in a live file and again in a late one, in one batch: each counts twice."""
    landing = new_folder(spark, "landing")
    places = [new_folder(spark, name) for name in ("minutes", "hours", "rank", "ledger")]
    events = retail_events(spark, folder)
    first = events.where("event_type = 'view'").orderBy("event_time", "row_idx").limit(1)
    noon = F.lit("2024-01-01 12:00:00").cast("timestamp")
    options = dict(factor=1, base_epoch=SAMPLE_START_EPOCH, slice_seconds=DAY)
    jobs.land(first.withColumn("event_time", noon), landing, **options)
    jobs.run_batch(spark, landing, *places)
    text = raw_csv.as_text(events.where("event_type = 'purchase'"))
    for key in ("2023-12-31-00-00-00-0", "2024-01-02-00-00-00-0"):
        text.write.option("header", True).option("escape", '"').csv(f"{landing}/file_key={key}")
    jobs.run_batch(spark, landing, *places)
    return _plain(read_tier(spark, places[0], "purchase"))


def transport_brand_only(spark, folder):
    """Hours of a tier that has one dimension only, and not the one that usually times it."""
    minutes, hours = _stored_minutes(spark, folder, dimensions=("brand",)), new_folder(spark, "hours")
    jobs.transport(spark, minutes, hours)
    return _plain(read_tier(spark, hours))


def transport_before_grid(spark, folder):
    """Hours of events from before the time at which the grid of buckets is anchored."""
    minutes, hours = new_folder(spark, "minutes"), new_folder(spark, "hours")
    earlier = timegrid.shift(F.col("event_time"), -DAYS_BACK * DAY)
    jobs.store_minutes(retail_events(spark, folder).withColumn("event_time", earlier), minutes)
    jobs.transport(spark, minutes, hours)
    return _plain(read_tier(spark, hours))


def purchase_repeated_index(spark, folder):
    """Purchases whose index is missing or used again: each counts."""
    index = F.when(F.pmod("row_idx", F.lit(11)) != 0, F.pmod("row_idx", F.lit(7)))
    events = retail_events(spark, folder).withColumn("row_idx", index)
    return _plain(jobs.ingest(events, event_types=("purchase",)))


# Late data


def late_split(spark, folder):
    """Files of the second arrival against the clock that the first one set."""
    events = retail_events(spark, folder)
    files = events.select(
        "row_idx", timegrid.bucket_start(F.col("event_time"), MINUTE).alias("file_time")
    )
    live = jobs.ingest(_live(events), event_types=("view",), dimensions=("category_l3",))
    first = ev.flag_late(_live(files), F.lit(SAMPLE_START_EPOCH).cast("timestamp"))
    second = ev.flag_late(_late(files), ti.clock(live).scalar())
    return _plain(first.unionByName(second))


def backlog_repair_minute(spark, folder):
    """Live and late metric rows merged, in one plan."""
    events = retail_events(spark, folder)
    live = jobs.ingest(_live(events), deduplicate=False)
    late = jobs.ingest(_late(events), deduplicate=False)
    return _plain(repaired(live, late))


def _repaired_tiers(spark, folder):
    minutes, hours = new_folder(spark, "minutes"), new_folder(spark, "hours")
    events = retail_events(spark, folder)
    jobs.store_minutes(_live(events), minutes, deduplicate=False)
    jobs.transport(spark, minutes, hours)
    late = jobs.ingest(_late(events), deduplicate=False)
    jobs.process_backlog(spark, late, minutes, hours, "second arrival")
    jobs.transport(spark, minutes, hours)
    return minutes, hours


def backlog_repair_stored(spark, folder):
    """The stored minute tier after the affected partitions were rewritten."""
    minutes, _ = _repaired_tiers(spark, folder)
    return _plain(read_tier(spark, minutes))


def backlog_repair_hour(spark, folder):
    """The stored hour tier, whose affected hours were repaired too."""
    _, hours = _repaired_tiers(spark, folder)
    return _plain(read_tier(spark, hours))


def backlog_repair_twice(spark, folder):
    """Two late sets, one after the other, each given twice."""
    minutes, hours = new_folder(spark, "minutes"), new_folder(spark, "hours")
    events = retail_events(spark, folder)
    jobs.store_minutes(_live(events), minutes, deduplicate=False)
    even = F.pmod("row_idx", F.lit(2)) == 0
    for arrival, part in (("even", even), ("odd", ~even), ("even", even), ("odd", ~even)):
        late = jobs.ingest(_late(events).where(part), deduplicate=False)
        jobs.process_backlog(spark, late, minutes, hours, arrival)
    return _plain(read_tier(spark, minutes))


def _batches(spark, folder):
    """Landing files counted in two runs, live and late; a third run finds nothing new."""
    landing = new_folder(spark, "landing")
    places = [new_folder(spark, name) for name in ("minutes", "hours", "rank", "ledger")]
    events = retail_events(spark, folder)
    for part in (_live(events), _late(events)):
        jobs.land(part, landing, factor=1, base_epoch=SAMPLE_START_EPOCH, slice_seconds=HOUR)
        jobs.run_batch(spark, landing, *places, deduplicate=False)
    jobs.run_batch(spark, landing, *places, deduplicate=False)
    return places


def batch_pipeline(spark, folder):
    return _plain(read_tier(spark, _batches(spark, folder)[0]))


def batch_pipeline_hours(spark, folder):
    return _plain(read_tier(spark, _batches(spark, folder)[1]))


def rank_snapshot(spark, folder):
    """The stored trailing hour after the last batch."""
    return _plain(spark.read.parquet(_batches(spark, folder)[2]))


def rejected_events(spark, folder):
    """Rows without a readable time, kept apart by the batch job."""
    landing = new_folder(spark, "landing")
    places = [new_folder(spark, name) for name in ("minutes", "hours", "rank", "ledger")]
    text = raw_csv.as_text(retail_events(spark, folder))
    broken = F.when(F.pmod(F.col("row_idx").cast("long"), F.lit(41)) == 0, "no time")
    text = text.withColumn("event_time", F.coalesce(broken, "event_time"))
    text.write.option("header", True).csv(landing)
    jobs.run_batch(spark, landing, *places)
    found = jobs.read_rejects(spark, places[3])
    return _plain(found.select("row_idx", "event_type", "product_id", "price"))


def landing_mixed_headers(spark, folder):
    """Files of two layouts beside files that lack a column, counted in one run."""
    landing = new_folder(spark, "landing")
    places = [new_folder(spark, name) for name in ("minutes", "hours", "rank", "ledger")]
    text = raw_csv.as_text(retail_events(spark, folder))
    even = F.pmod(F.col("row_idx").cast("long"), F.lit(2)) == 0
    turned = ["price", "user_id", *[name for name in reversed(text.columns) if name != "price"]]
    text.where(even).write.option("header", True).csv(f"{landing}/one")
    text.where(~even).withColumn("user_id", F.lit("u")).select(*turned).write.option(
        "header", True
    ).csv(f"{landing}/other")
    text.drop("price").write.option("header", True).csv(f"{landing}/unusable")
    jobs.run_batch(spark, landing, *places, deduplicate=False)
    return _plain(read_tier(spark, places[0]))


def merge_duplicates(spark, folder):
    """A stored tier that got two partial rows for many keys, compacted."""
    path = new_folder(spark, "minutes")
    events = retail_events(spark, folder)
    for part in (_live(events), _late(events)):
        jobs.store_minutes(part, path, deduplicate=False)
    jobs.compact_tier(spark, path)
    return _plain(read_tier(spark, path))


# Files


def file_time_range(spark, folder):
    dealt = ev.assign_servers(retail_events(spark, folder).select("row_idx", "event_time"))
    key = timegrid.file_key(F.col("minute"), F.col("server"))
    names = dealt.select(F.concat(key, F.lit(".csv")).alias("name")).distinct()
    files = names.select(
        timegrid.file_time(F.col("name")).alias("file_time"),
        timegrid.file_server(F.col("name")).alias("server"),
    )
    return _plain(raw_csv.file_time_range(files))


def landing_files(spark, folder):
    """Landing files per hour and server, written and scanned back."""
    landing = new_folder(spark, "landing")
    jobs.land(
        retail_events(spark, folder, factor=1),
        landing,
        factor=30,
        base_epoch=SAMPLE_START_EPOCH,
        slice_seconds=HOUR,
    )
    return _plain(raw_csv.read_raw(spark, landing))


def landing_without_index(spark, folder):
    """Events without a row index reach their landing files all the same."""
    landing = new_folder(spark, "landing")
    events = retail_events(spark, folder).withColumn("row_idx", F.lit(None).cast("long"))
    jobs.land(events, landing, factor=1, base_epoch=SAMPLE_START_EPOCH, slice_seconds=HOUR)
    return _plain(raw_csv.read_raw(spark, landing).drop("row_idx", "server"))


def landing_with_user_id(spark, folder):
    """Files with a column more, in another order, and product ids that are no numbers."""
    landing = new_folder(spark, "landing")
    text = raw_csv.as_text(retail_events(spark, folder))
    text.select(
        "user_session",
        F.lit("u").alias("user_id"),
        F.concat(F.lit("A"), "product_id").alias("product_id"),
        *[name for name in text.columns if name not in ("user_session", "product_id")],
    ).write.option("header", True).csv(landing)
    return _plain(raw_csv.read_raw(spark, landing).drop("file_time", "server"))


def _archived(block, factor):
    def query(spark, folder):
        events = retail_events(spark, folder, factor).withColumn(
            "file_time", timegrid.bucket_start(F.col("event_time"), MINUTE)
        )
        newest = events.agg(F.max("file_time").alias("newest")).scalar()
        target = new_folder(spark, "archive")
        raw_csv.write_archive(raw_csv.finished_blocks(events, newest, block), target)
        return _plain(raw_csv.read_archive(spark, target))

    return query


def archive_landing(spark, folder):
    """Hourly landing files compacted by the archive job."""
    landing, target = new_folder(spark, "landing"), new_folder(spark, "archive")
    events = retail_events(spark, folder)
    jobs.land(events, landing, factor=1, base_epoch=SAMPLE_START_EPOCH, slice_seconds=HOUR)
    jobs.archive(spark, landing, target)
    return _plain(raw_csv.read_archive(spark, target))


def archive_late_file(spark, folder):
    """Text of the archive after a second run, which found late files of archived hours."""
    landing, target = new_folder(spark, "landing"), new_folder(spark, "archive")
    events = retail_events(spark, folder)
    for part in (_live(events), _late(events)):
        jobs.land(part, landing, factor=1, base_epoch=SAMPLE_START_EPOCH, slice_seconds=HOUR)
        jobs.archive(spark, landing, target)
    text = raw_csv.read_archive_text(spark, target)
    return text.select("row_idx", "event_time", "price", "user_session", "block")


# Streams


def stream_minute_tier(spark, folder):
    deltas = new_folder(spark, "deltas")
    events = retail_event_stream(spark, folder)
    stream.run_ingest(events, deltas, new_folder(spark, "progress")).awaitTermination()
    return _plain(stream.served_tier(spark, deltas))


def stream_view_batches(spark, folder):
    """Landing files in several batches, the late ones last: views count as if all came at once."""
    landing, deltas = new_folder(spark, "landing"), new_folder(spark, "deltas")
    progress = new_folder(spark, "progress")
    events = retail_events(spark, folder)
    for part in (_live(events), _late(events)):
        jobs.land(part, landing, factor=1, base_epoch=SAMPLE_START_EPOCH, slice_seconds=HOUR)
        stream.run_ingest(raw_csv.stream_raw(spark, landing), deltas, progress).awaitTermination()
    return _plain(stream.served_tier(spark, deltas))


def stream_hour_tier(spark, folder):
    """Hours kept by the stream itself beside its minutes."""
    minutes, hours = new_folder(spark, "deltas"), new_folder(spark, "deltas")
    stream.run_ingest(
        retail_event_stream(spark, folder),
        minutes,
        new_folder(spark, "progress"),
        hour_path=hours,
    ).awaitTermination()
    return _plain(stream.served_tier(spark, hours))


def stream_backlog(spark, folder):
    """Landing files ingested as a stream, then files from the past; both counted once."""
    landing, deltas = new_folder(spark, "landing"), new_folder(spark, "deltas")
    progress = new_folder(spark, "progress")
    events = retail_events(spark, folder)
    for part in (_live(events), _late(events)):
        jobs.land(part, landing, factor=1, base_epoch=SAMPLE_START_EPOCH, slice_seconds=HOUR)
        query = stream.run_ingest(
            raw_csv.stream_raw(spark, landing), deltas, progress, deduplicate=False
        )
        query.awaitTermination()
    late_count = F.when(F.col("is_late"), F.col("event_count")).otherwise(0)
    return _plain(
        stream.read_deltas(spark, deltas)
        .groupBy(*TIER_KEYS)
        .agg(
            measures.merged_total(),
            measures.merged_count(),
            F.sum(late_count).alias("late_count"),
        )
    )


def _to_files(rows: DataFrame, spark: SparkSession, schema) -> DataFrame:
    """Run an append-mode stream over all present input into Parquet files and read them."""
    out = new_folder(spark, "stream")
    with large_state(spark):
        query = (
            rows.writeStream.format("parquet")
            .option("checkpointLocation", new_folder(spark, "progress"))
            .option("path", out)
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()
    return spark.read.schema(schema).parquet(out)


def stream_view_dedup(spark, folder):
    """Pairs counted by the streaming dedup; which of the views survives is not fixed."""
    views = ev.split_events(retail_event_stream(spark, folder), ("view",))
    first = first_view_stream(views).select("user_session", "product_id")
    return _to_files(first, spark, first.schema)


def stream_rolling_hour(spark, folder):
    """The trailing hour at every minute, from the minutes that the stream has kept."""
    deltas = new_folder(spark, "deltas")
    events = retail_event_stream(spark, folder)
    stream.run_ingest(
        events, deltas, new_folder(spark, "progress"), deduplicate=False
    ).awaitTermination()
    return _plain(ti.trailing_hours(stream.served_tier(spark, deltas)))


def stream_trailing_hour(spark, folder):
    """The trailing hour kept by the stream itself, batch by batch; late files come first."""
    landing, deltas = new_folder(spark, "landing"), new_folder(spark, "deltas")
    progress, hour = new_folder(spark, "progress"), new_folder(spark, "hour")
    events = retail_events(spark, folder)
    for part in (_late(events), _live(events)):
        jobs.land(part, landing, factor=1, base_epoch=SAMPLE_START_EPOCH, slice_seconds=HOUR)
        stream.run_ingest(
            raw_csv.stream_raw(spark, landing),
            deltas,
            progress,
            deduplicate=False,
            trailing_path=hour,
        ).awaitTermination()
    return _plain(served_trailing(spark, hour))


def stream_folded(spark, folder):
    """Landing files in several batches, folded after each but the first."""
    landing, deltas = new_folder(spark, "landing"), new_folder(spark, "deltas")
    progress = new_folder(spark, "progress")
    events = retail_events(spark, folder)
    for part in (_live(events), _late(events)):
        jobs.land(part, landing, factor=1, base_epoch=SAMPLE_START_EPOCH, slice_seconds=HOUR)
        stream.run_ingest(
            raw_csv.stream_raw(spark, landing), deltas, progress, fold_every=1
        ).awaitTermination()
    return _plain(stream.served_tier(spark, deltas))


QUERIES = {
    "retail_events": raw_events,
    "concentrate_30x": concentrate_30x,
    "server_shards": server_shards,
    "clean_dimensions": clean_dimensions,
    "event_split": event_split,
    "bucket_minute": bucket_minute,
    "bucket_hour": bucket_hour,
    "slice_half_open": slice_half_open,
    "slice_look_back": slice_look_back,
    "slice_closed": slice_closed,
    "view_dedup": view_dedup,
    "view_product_minute": _minute_table("view", "product_id"),
    "purchase_product_minute": _minute_table("purchase", "product_id"),
    "view_brand_minute": _minute_table("view", "brand"),
    "purchase_brand_minute": _minute_table("purchase", "brand"),
    "view_category_minute": _category_tables("view"),
    "purchase_category_minute": _category_tables("purchase"),
    "minute_tier": minute_tier,
    "minute_tier_published": minute_tier_published,
    "hour_tier": hour_tier,
    "hour_tier_event_aligned": hour_tier_event_aligned,
    "day_tier": day_tier,
    "merge_average": merge_average,
    "transport_hours": transport_hours,
    "rolling_hour_totals": rolling_hour_totals,
    "rank_tables": rank_tables,
    "rolling_hour_rank": rolling_hour_rank,
    "rolling_hour_series": rolling_hour_series,
    "tier_clock": tier_clock,
    "retention_24h": retention_24h,
    "stream_view_batches": stream_view_batches,
    "stream_folded": stream_folded,
    "transport_brand_only": transport_brand_only,
    "transport_before_grid": transport_before_grid,
    "purchase_repeated_index": purchase_repeated_index,
    "backlog_repair_twice": backlog_repair_twice,
    "batch_pipeline": batch_pipeline,
    "batch_pipeline_hours": batch_pipeline_hours,
    "landing_mixed_headers": landing_mixed_headers,
    "rank_snapshot": rank_snapshot,
    "rejected_events": rejected_events,
    "landing_without_index": landing_without_index,
    "landing_with_user_id": landing_with_user_id,
    "archive_late_file": archive_late_file,
    "late_split": late_split,
    "backlog_repair_minute": backlog_repair_minute,
    "backlog_repair_stored": backlog_repair_stored,
    "backlog_repair_hour": backlog_repair_hour,
    "merge_duplicates": merge_duplicates,
    "retention_wrong_date": retention_wrong_date,
    "compact_after_crash": compact_after_crash,
    "late_and_live_equal": late_and_live_equal,
    "file_time_range": file_time_range,
    "landing_files": landing_files,
    "archive_block_hour": _archived("hour", 30),
    "archive_block_day": _archived("day", 1),
    "archive_landing": archive_landing,
    "stream_minute_tier": stream_minute_tier,
    "stream_hour_tier": stream_hour_tier,
    "stream_backlog": stream_backlog,
    "stream_view_dedup": stream_view_dedup,
    "stream_rolling_hour": stream_rolling_hour,
    "stream_trailing_hour": stream_trailing_hour,
}
