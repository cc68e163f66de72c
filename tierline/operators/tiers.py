"""Operators on metric rows: merge, roll up, rank, trail, clock, retain."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierline.functions import measures, timegrid
from tierline.schema import GRID_START, MONEY_SUM, TIER_COLUMNS, TIER_KEYS


def merge(metrics: DataFrame, scope: tuple[str, ...] = ()) -> DataFrame:
    """One row per key; sums and counts are kept, so any split merges to the same result."""
    return (
        metrics.groupBy(*TIER_KEYS, *scope)
        .agg(measures.merged_total(), measures.merged_count())
        .select(*TIER_COLUMNS, *scope)
    )


def roll_up(
    metrics: DataFrame, step: int, source_step: int = 0, scope: tuple[str, ...] = ()
) -> DataFrame:
    """Coarser tier. Labels are bucketed like event times: hour 10:00 holds labels 09:00-09:59.

    `source_step` moves labels back by one source bucket first, which aligns the coarse
    buckets with event time instead. `scope` adds key columns.
    """
    label = F.col("bucket_end")
    if source_step:
        label = timegrid.shift(label, -source_step)
    return merge(metrics.withColumn("bucket_end", timegrid.bucket_end(label, step)), scope)


def clock_value(newest: bool = True) -> Column:
    """Aggregate: newest (or oldest) label; the start of the grid when there is none."""
    edge = F.max("bucket_end") if newest else F.min("bucket_end")
    return F.coalesce(edge, F.lit(GRID_START).cast("timestamp"))


def clock(
    metrics: DataFrame,
    event: str | None = "view",
    dim: str | None = None,
    newest: bool = True,
) -> DataFrame:
    """One row: the newest (or oldest) label of an event type, of any event if it has no rows.

    `dim` restricts it to one dimension; every dimension of a tier has the same labels.
    """
    if dim:
        metrics = metrics.where(F.col("dim") == dim)
    edge = F.max if newest else F.min
    timed = [edge(F.when(F.col("event_type") == event, F.col("bucket_end")))] if event else []
    start = F.lit(GRID_START).cast("timestamp")
    return metrics.agg(F.coalesce(*timed, edge("bucket_end"), start).alias("clock"))


def read_clock(
    metrics: DataFrame, event: str | None = "view", dim: str | None = None
) -> Column:
    """Run `clock` now and return its value as a literal, which prunes what it is compared to."""
    seconds = clock(metrics, event, dim).select(F.unix_seconds("clock").alias("s")).first().s
    return F.timestamp_seconds(F.lit(seconds))


def trailing_totals(metrics: DataFrame, now: Column, minutes: int = 60) -> DataFrame:
    """Totals per dimension value over the last `minutes` labels up to `now`, whole tables."""
    recent = timegrid.half_open(
        F.col("bucket_end"),
        timegrid.shift(now, -60 * (minutes - 1)),
        timegrid.shift(now, 60),
    )
    return (
        metrics.where(recent)
        .groupBy("event_type", "dim", "dim_value")
        .agg(measures.merged_total(), measures.merged_count())
    )


def top(totals: DataFrame, k: int) -> DataFrame:
    """The k leading values of each (event, dimension): by sales for purchases, else by count.

    `position` breaks ties by value, `rank` shares them. Spark limits each task to k rows
    per group before the shuffle, so no task sees all products.
    """
    score = F.when(
        F.col("event_type") == "purchase", F.col("price_sum")
    ).otherwise(F.col("event_count"))
    group = Window.partitionBy("event_type", "dim")
    leaders = (
        totals.withColumn("score", score)
        .withColumn(
            "position",
            F.row_number().over(
                group.orderBy(F.desc_nulls_last("score"), F.asc_nulls_last("dim_value"))
            ),
        )
        .where(F.col("position") <= k)
    )
    return leaders.withColumn(
        "rank", F.rank().over(group.orderBy(F.desc_nulls_last("score")))
    ).drop("score")


def trailing_series(metrics: DataFrame, minutes: int = 60) -> DataFrame:
    """Trailing totals at every stored label. A group is one value's labels, at most one a minute."""
    trail = (
        Window.partitionBy("event_type", "dim", "dim_value")
        .orderBy(F.unix_seconds("bucket_end"))
        .rangeBetween(-60 * (minutes - 1), 0)
    )
    return metrics.select(
        "event_type",
        "dim",
        "dim_value",
        "bucket_end",
        F.sum("price_sum").over(trail).alias("price_sum"),
        F.sum("event_count").over(trail).alias("event_count"),
    )


def trailing_hours(metrics: DataFrame, minutes: int = 60) -> DataFrame:
    """Trailing totals at every minute whose window holds a stored label, up to the last one's end.

    Totals change only where a label enters the window or leaves it, so they are summed at those
    two points and spread over the minutes up to the next; a group has two rows a label at most.
    """
    keys = ["event_type", "dim", "dim_value"]
    second = F.unix_seconds("bucket_end")
    enters = merge(metrics).select(
        *keys, second.alias("at"), "price_sum", "event_count", F.lit(1).alias("labels")
    )
    leaves = enters.select(
        *keys,
        (F.col("at") + 60 * minutes).alias("at"),
        F.lit(None).cast("decimal(28,2)").alias("price_sum"),
        F.lit(0).cast("long").alias("event_count"),
        F.lit(0).alias("labels"),
    )
    points = enters.unionByName(leaves).groupBy(*keys, "at").agg(
        F.sum("price_sum").alias("price_sum"),
        F.sum("event_count").alias("event_count"),
        F.sum("labels").alias("labels"),
    )
    ordered = Window.partitionBy(*keys).orderBy("at")
    trail = ordered.rangeBetween(-60 * (minutes - 1), 0)
    totals = points.select(
        *keys,
        "at",
        F.lead("at").over(ordered).alias("until"),
        F.sum("price_sum").over(trail).cast(MONEY_SUM).alias("price_sum"),
        F.sum("event_count").over(trail).alias("event_count"),
        F.sum("labels").over(trail).alias("labels"),
    ).where("labels > 0")
    each = F.explode(F.sequence(F.col("at"), F.col("until") - 60, F.lit(60).cast("long")))
    return totals.select(*keys, each.alias("second"), "price_sum", "event_count").select(
        *keys, F.timestamp_seconds("second").alias("bucket_end"), "price_sum", "event_count"
    )


def retention_cutoff(now: Column, hours: int) -> Column:
    return timegrid.shift(now, -3600 * hours)


def retain(metrics: DataFrame, now: Column, hours: int = 24) -> DataFrame:
    """Rows at or after `now` minus `hours`."""
    return metrics.where(F.col("bucket_end") >= retention_cutoff(now, hours))


def finished_until(last_coarse: Column, newest_fine: Column) -> Column:
    """End of the newest complete hour: the last hour label plus the whole hours since."""
    hours = timegrid.whole_hours(last_coarse, newest_fine)
    return F.timestamp_seconds(F.unix_seconds(last_coarse) + hours * 3600)
