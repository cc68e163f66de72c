"""Stored tiers: versioned Parquet, partitioned by event type, dimension and bucket date.

Rows of a key are additive, so an arrival, live or late, is one more set of segments, and a reader
merges the partitions that have several. Compaction and retention put new segments in the place of
the ones they read; whatever others added meanwhile stays.
"""

import uuid
from collections.abc import Callable
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.backlog import with_bucket_date
from tierline.operators.clock import trusted_clock
from tierline.operators.tiers import merge, retention_cutoff
from tierline.schema import PARTITIONS, STORED_TIER, TIER_COLUMNS
from tierline.sources import versions
from tierline.sources.versions import Conflict, Segment, Version


def _laid_out(metrics: DataFrame) -> DataFrame:
    """Rows gathered by partition; AQE splits large partitions over tasks and joins small ones."""
    return (
        with_bucket_date(metrics.select(*TIER_COLUMNS))
        .hint("rebalance", *PARTITIONS)
        .sortWithinPartitions(*PARTITIONS, "bucket_end", "dim_value")
    )


def write_rows(metrics: DataFrame, path: str) -> list[Segment]:
    """Write rows, one for each key, that no version of the tier has yet."""
    return versions.write_segments(metrics.sparkSession, _laid_out(metrics), path)


def write_tier(metrics: DataFrame, path: str, arrival: str | None = None) -> int | None:
    """Add the rows of an arrival, one for each key; returns the version that has them.

    An arrival is added once, however often it is given: nothing is computed for one that the tier
    has. Without a name the rows are an arrival of their own. None if there are no rows.
    """
    spark = metrics.sparkSession
    arrival = arrival or uuid.uuid4().hex
    done = versions.applied(spark, path, arrival)
    if done is not None:
        return done
    added = write_rows(metrics, path)
    return versions.commit(spark, path, arrival, lambda _: (added, (), {}) if added else None)


def _second(moment) -> int | None:
    """Seconds of a time given in seconds, as text (UTC) or as a literal Column."""
    if moment is None or isinstance(moment, int):
        return moment
    if isinstance(moment, str):
        return int(datetime.fromisoformat(moment).replace(tzinfo=timezone.utc).timestamp())
    spark = SparkSession.active()
    return spark.range(1).select(F.unix_seconds(moment.cast("timestamp")).alias("s")).first().s


def _literal(second: int) -> Column:
    return F.timestamp_seconds(F.lit(second))


def rows_of(spark: SparkSession, path: str, segments: list[Segment]) -> DataFrame:
    """One row a key of some segments of a tier; only partitions with several are merged."""
    by_partition: dict[tuple, list[Segment]] = {}
    for segment in segments:
        by_partition.setdefault(segment.partition, []).append(segment)
    single = [own[0] for own in by_partition.values() if len(own) == 1]
    several = [segment for own in by_partition.values() if len(own) > 1 for segment in own]
    parts = []
    if single or not several:
        parts.append(versions.read_segments(spark, path, single))
    if several:
        parts.append(with_bucket_date(merge(versions.read_segments(spark, path, several))))
    return reduce(DataFrame.unionByName, [part.select(*STORED_TIER.fieldNames()) for part in parts])


def read_tier(
    spark: SparkSession,
    path: str,
    event=None,
    dim=None,
    start=None,
    end=None,
    version: Version | None = None,
) -> DataFrame:
    """Rows with start <= bucket_end <= end, one a key, of the newest version or of a given one.

    `start` and `end` are text, seconds or literal timestamp Columns. Segments without such rows are not read,
    by what the version tells of them.
    """
    version = version or versions.latest(spark, path)
    low, high = _second(start), _second(end)
    chosen = [
        s
        for s in version.segments
        if (event is None or s.event_type == event)
        and (dim is None or s.dim == dim)
        and (low is None or s.last >= low)
        and (high is None or s.first <= high)
    ]
    rows = rows_of(spark, path, chosen)
    if low is not None:
        start = _literal(low)
        rows = rows.where(
            (F.col("bucket_end") >= start) & (F.col("bucket_date") >= F.to_date(start))
        )
    if high is not None:
        end = _literal(high)
        rows = rows.where((F.col("bucket_end") <= end) & (F.col("bucket_date") <= F.to_date(end)))
    return rows.select(*TIER_COLUMNS)


def replace_rows(
    spark: SparkSession,
    path: str,
    choose: Callable[[Version], list[Segment]],
    make: Callable[[DataFrame], DataFrame] | None,
    drop: Callable[[Version], list[Segment]] = lambda _: [],
) -> bool:
    """Put `make` of the rows of chosen segments in their place, and drop others, in one version.

    Other writers may add segments meanwhile. If one of those read is gone, it starts anew. False if
    there was nothing to do.
    """
    for _ in range(versions.TRIES):
        version = versions.latest(spark, path)
        chosen, dropped = choose(version), drop(version)
        if not chosen and not dropped:
            return False
        added = write_rows(make(rows_of(spark, path, chosen)), path) if chosen else []
        try:
            change = (added, (*chosen, *dropped), {})
            versions.commit(spark, path, uuid.uuid4().hex, lambda _, change=change: change)
            return True
        except Conflict:
            continue
    raise Conflict(f"{path}: other writers came first {versions.TRIES} times")


def merge_duplicates(spark: SparkSession, path: str, least: int = 2) -> bool:
    """Merge partitions that have at least `least` segments into one segment each."""

    def several(version: Version) -> list[Segment]:
        counts: dict[tuple, int] = {}
        for segment in version.segments:
            counts[segment.partition] = counts.get(segment.partition, 0) + 1
        return [s for s in version.segments if counts[s.partition] >= max(least, 2)]

    return replace_rows(spark, path, several, lambda rows: rows)


def stored_dates(spark: SparkSession, path: str, event: str | None = None) -> list[date]:
    """Dates that a tier has rows for, in order."""
    segments = versions.latest(spark, path).segments
    kept = {s.bucket_date for s in segments if event in (None, s.event_type)}
    return sorted(date.fromisoformat(day) for day in kept)


def _of_event(version: Version, event: str | None) -> list[Segment]:
    """Segments of an event type, or all where it has none."""
    own = [s for s in version.segments if event in (None, s.event_type)]
    return own or list(version.segments)


def edge_label(
    spark: SparkSession, path: str, newest: bool = True, event: str | None = None
) -> Column | None:
    """The newest (or oldest) stored label as a literal, from the version alone; None if empty.

    Where `event` has no rows at all, any event's labels count.
    """
    own = _of_event(versions.latest(spark, path), event)
    if not own:
        return None
    return _literal(max(s.last for s in own) if newest else min(s.first for s in own))


def clock_second(version: Version, event: str | None = None) -> int | None:
    """The newest label that the mass of events supports, see trusted_clock(); None if empty."""
    return trusted_clock(
        ((s.event_type, s.dim, *hour) for s in version.segments for hour in s.hours), event
    )


def clock_label(spark: SparkSession, path: str, event: str | None = None) -> Column | None:
    """clock_second() of the newest version as a literal."""
    second = clock_second(versions.latest(spark, path), event)
    return None if second is None else _literal(second)


def keep_window(spark: SparkSession, path: str, now: Column, hours: int) -> None:
    """Drop rows older than `now` minus `hours`, in one version: segments that lie before the cutoff
    are dropped unread, only those that it cuts are rewritten."""
    cutoff = _second(retention_cutoff(now, hours))
    replace_rows(
        spark,
        path,
        lambda version: [s for s in version.segments if s.first < cutoff <= s.last],
        lambda rows: rows.where(F.col("bucket_end") >= _literal(cutoff)),
        lambda version: [s for s in version.segments if s.last < cutoff],
    )
