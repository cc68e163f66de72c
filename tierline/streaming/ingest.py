"""Event streams to minute metric rows, late files included.

Every micro-batch adds its own metric rows to a delta table. Rows are additive, so live
and late files are written alike and a reader merges them. A batch owns the partitions
with its batch_id: running it again replaces them and counts nothing twice.

Repeated views count once over all batches, the earliest, in whatever order and batches their files
come: the stream keeps the first view of every pair as state. A batch that brings an earlier view of
a counted pair adds that one and takes the other back, as a row with negative sums.
"""

from contextlib import nullcontext
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from tierline import workspace
from tierline.functions import measures, timegrid
from tierline.functions.clean import valid
from tierline.operators.backlog import with_bucket_date
from tierline.operators.clock import trusted_clock
from tierline.operators.events import first_views, flag_late, split_events
from tierline.operators.metrics import minute_metrics
from tierline.operators.tiers import read_clock, retention_cutoff
from tierline.schema import (
    DIMENSIONS,
    EVENTS,
    HOUR,
    PARTITIONS,
    STORED_TIER,
    TIER_COLUMNS,
    TIER_KEYS,
)
from tierline.streaming.first_views import first_view_changes
from tierline.streaming.windows import large_state
from tierline.workspace import check_utc

DELTA = StructType(
    [
        *STORED_TIER.fields,
        StructField("event_rows", LongType()),
        StructField("batch_id", LongType()),
        StructField("is_late", BooleanType()),
    ]
)
# Below the delta table; readers of a table skip names that begin so.
_FOLDS = "_folds"


def _valid(spark: SparkSession, path: str) -> Column:
    """Which rows of a delta table count: batches after the newest fold, and that fold itself."""
    folds = workspace.matching(spark, f"{path}/{_FOLDS}/*")
    newest = max((int(name.rsplit("/", 1)[1]) for name in folds), default=None)
    if newest is None:
        return F.col("batch_id") >= 0
    return (F.col("batch_id") > newest) | (F.col("batch_id") == -1 - newest)


def read_deltas(spark: SparkSession, path: str) -> DataFrame:
    if not workspace.exists(spark, path):
        return spark.createDataFrame([], DELTA)
    return spark.read.schema(DELTA).parquet(path).where(_valid(spark, path))


def delta_dates(spark: SparkSession, path: str, event: str = "*") -> list[date]:
    """Dates that a delta table has folders for, in order. Reads names only."""
    folders = workspace.matching(spark, f"{path}/event_type={event}/dim=*/bucket_date=*")
    return sorted({date.fromisoformat(name.rsplit("=", 1)[1]) for name in folders})


def delta_clock(spark: SparkSession, path: str, event: str = "view") -> Column | None:
    """The newest label that the mass of events supports, as a literal; None if there are no rows.

    Counted per hour over the kept dates; only these counts reach the driver.
    """
    rows = read_deltas(spark, path)
    second = F.unix_seconds("bucket_end")
    counts = (
        rows.groupBy("event_type", "dim", F.floor(second / HOUR).alias("hour"))
        .agg(F.sum("event_rows").alias("events"), F.max(second).alias("last"))
        .collect()
    )
    label = trusted_clock(counts, event)
    return None if label is None else F.timestamp_seconds(F.lit(label))


def fold(spark: SparkSession, path: str, upto: int) -> None:
    """Merge all rows of batches up to `upto` into one set of folders, so that their number stays.

    The merged rows have the id -1 - upto and count from the moment that a mark names them; the
    batches they stand for do not count from then on, even if one is repeated. Their folders are
    deleted last, and a fold that died is repeated by the next. Readers that began before may miss
    files then, so folds leave the last batches alone: fold what no reader is still at.
    """
    if workspace.exists(spark, f"{path}/{_FOLDS}/{upto}"):
        return
    rows = read_deltas(spark, path).where(F.col("batch_id") <= upto)
    merged = rows.groupBy(*TIER_KEYS, "is_late").agg(
        measures.merged_total(), measures.merged_count(), F.sum("event_rows").alias("event_rows")
    )
    _write_deltas(merged, -1 - upto, path)
    workspace.mark(spark, f"{path}/{_FOLDS}/{upto}")
    for folder in workspace.matching(spark, f"{path}/event_type=*/dim=*/bucket_date=*/batch_id=*"):
        batch = int(folder.rsplit("=", 1)[1])
        if (0 <= batch <= upto) or (batch < 0 and batch != -1 - upto):
            workspace.remove(spark, folder)


def _merged(rows: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """One row per key that has any events left; one without prices has no sum."""
    counted = rows.groupBy(*TIER_KEYS, *scope).agg(
        measures.merged_total(), measures.merged_count(), F.sum("event_rows").alias("event_rows")
    )
    return counted.where("event_rows <> 0").withColumn(
        "price_sum", F.when(F.col("event_count") != 0, F.col("price_sum"))
    )


def served_tier(spark: SparkSession, path: str) -> DataFrame:
    """The tier behind a delta table."""
    return _merged(read_deltas(spark, path)).select(*TIER_COLUMNS)


def high_water(spark: SparkSession, path: str, before_batch: int) -> Column:
    """Newest view label stored by earlier batches, as a literal; only the newest dates are listed.

    Without views, any event's labels count.
    """
    for event in ("view", "*"):
        for day in reversed(delta_dates(spark, path, event)):
            rows = (
                spark.read.schema(DELTA)
                .option("basePath", path)
                .parquet(f"{path}/event_type={event}/dim=*/bucket_date={day}")
                .where(_valid(spark, path))
                .where((F.col("batch_id") < before_batch) & (F.col("event_rows") > 0))
            )
            if not rows.isEmpty():
                return read_clock(rows, event=None)
    return read_clock(spark.createDataFrame([], DELTA))


def _write_deltas(metrics: DataFrame, batch_id: int, path: str) -> None:
    (
        with_bucket_date(metrics)
        .withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        .hint("rebalance", *PARTITIONS)
        .sortWithinPartitions(*PARTITIONS, "batch_id", "bucket_end")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS, "batch_id")
        .parquet(path)
    )


def write_batch(
    events: DataFrame,
    batch_id: int,
    path: str,
    hour_path: str | None = None,
    deduplicate: bool = True,
    event_types=EVENTS,
    **metric_options,
) -> None:
    """Flag, aggregate and store one micro-batch, and its share of the hours if asked.

    Events with a `sign` are those that a batch counts or takes back, see first_view_changes();
    others are counted, repeated views once within the batch if `deduplicate`.

    The hours of a batch are the roll-up of its own minutes, so a late file corrects them
    just as it corrects the minutes.
    """
    spark = events.sparkSession
    options = dict(event_types=event_types, deduplicate=False, count_rows=True, **metric_options)
    clock = high_water(spark, path, batch_id)
    if "sign" in events.columns:
        # The batch is read once: its state would be computed by every plan that names it.
        timed = flag_late(events.withColumn("file_time", F.col("cause_time")), clock)
        signed = minute_metrics(timed, scope=("is_late", "sign"), **options).withColumns(
            {n: F.col(n) * F.col("sign") for n in ("event_count", "event_rows")}
            | {"price_sum": F.when(F.col("sign") < 0, -F.col("price_sum")).otherwise(F.col("price_sum"))}
        )
        metrics = signed.groupBy(*TIER_KEYS, "is_late").agg(
            measures.merged_total(), measures.merged_count(), F.sum("event_rows").alias("event_rows")
        )
    else:
        chosen = split_events(valid(events), event_types)
        if deduplicate:
            chosen = first_views(chosen)
        metrics = minute_metrics(flag_late(chosen, clock), scope=("is_late",), **options)
    _write_deltas(metrics, batch_id, path)
    if hour_path:
        own = read_deltas(spark, path).where(F.col("batch_id") == batch_id)
        hours = own.withColumn("bucket_end", _hour_label()).groupBy(*TIER_KEYS, "is_late")
        hours = hours.agg(
            measures.merged_total(), measures.merged_count(), F.sum("event_rows").alias("event_rows")
        )
        _write_deltas(hours, batch_id, hour_path)


def _hour_label() -> Column:
    return timegrid.bucket_end(F.col("bucket_end"), HOUR)


def run_ingest(
    events: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    hour_path: str | None = None,
    event_types=EVENTS,
    dimensions=DIMENSIONS,
    deduplicate: bool = True,
    fold_every: int | None = None,
    remember_hours: int = 48,
    trailing_path: str | None = None,
) -> StreamingQuery:
    """Start ingesting an event stream that has a `file_time` column.

    `every` is a processing interval such as "60 seconds"; without it the query handles
    all files present and stops. With `deduplicate` the result does not depend on how files are
    dealt out to batches: the first view of each pair is kept as state, and forgotten when it has
    not changed for `remember_hours`. `fold_every` batches, all but the newest are folded, see fold().
    `trailing_path` keeps the totals of the trailing hour too, see trailing.served_trailing().
    """
    from tierline.streaming.trailing import keep_trailing  # which reads the deltas of this module

    spark = events.sparkSession
    check_utc(spark)
    options = dict(
        hour_path=hour_path,
        event_types=event_types,
        dimensions=dimensions,
        deduplicate=deduplicate,
    )

    def store(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch, batch_id, path, **options)
        if trailing_path:
            keep_trailing(batch.sparkSession, path, trailing_path, batch_id)
        if fold_every and batch_id % fold_every == fold_every - 1:
            for place in filter(None, (path, hour_path)):
                fold(batch.sparkSession, place, batch_id - 1)

    stateful = deduplicate and "view" in event_types
    if stateful:
        chosen = split_events(valid(events), event_types)
        view = F.col("event_type") == "view"
        others = chosen.where(~view).withColumns(
            {"sign": F.lit(1).cast("long"), "cause_time": F.col("file_time")}
        )
        events = first_view_changes(chosen.where(view), remember_hours).unionByName(others)
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(store)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    # A store with time limits would ask for batches without data for ever.
    own = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
    with large_state(spark, **own) if stateful else nullcontext():
        return writer.trigger(**trigger).start()


def trim(spark: SparkSession, path: str, hours: int = 24, now: Column | None = None) -> None:
    """Delete the dates of a delta table that lie wholly before its clock minus `hours`.

    The clock is the newest view label that other events support (see trusted_clock), so a few events
    of a wrong date delete nothing.
    """
    if now is None:
        now = delta_clock(spark, path)
    if now is None:
        return
    day = spark.range(1).select(F.to_date(retention_cutoff(now, hours)).alias("day")).first().day
    for folder in workspace.matching(spark, f"{path}/event_type=*/dim=*/bucket_date=*"):
        if date.fromisoformat(folder.rsplit("=", 1)[1]) < day:
            workspace.remove(spark, folder)


def late_deltas(spark: SparkSession, path: str, after_batch: int = -1) -> DataFrame:
    """Metric rows of late files stored after a batch; `isEmpty()` tells if there is a backlog."""
    late = read_deltas(spark, path).where(F.col("is_late") & (F.col("batch_id") > after_batch))
    return _merged(late).select(*TIER_COLUMNS)
