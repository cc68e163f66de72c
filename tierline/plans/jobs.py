"""The recurring jobs: ingest, transport, rank, backlog, retention, archive, landing files."""

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline import workspace
from tierline.workspace import check_utc
from tierline.functions import timegrid
from tierline.functions.clean import rejects, valid
from tierline.operators.events import assign_servers, flag_late
from tierline.operators.metrics import minute_metrics
from tierline.operators.tiers import finished_until, read_clock, roll_up, trailing_totals  # noqa: F401
from tierline.schema import GRID_START_EPOCH, HOUR
from tierline.sources import raw_csv, versions
from tierline.sources.tier_table import (
    clock_label,
    clock_second,
    keep_window,
    merge_duplicates,
    read_tier,
    write_rows,
    write_tier,
)
from tierline.sources.versions import Conflict, Version


def ingest(events: DataFrame, **metric_options) -> DataFrame:
    """Raw typed events to minute metric rows."""
    return minute_metrics(events, **metric_options)


def store_minutes(
    events: DataFrame,
    minute_path: str,
    rejects_path: str | None = None,
    arrival: str | None = None,
    **metric_options,
) -> None:
    """Add the metric rows of a batch of raw events to the minute tier.

    A batch with an `arrival` name is added once, however often the job is repeated. Events without a
    readable time are in no minute; `rejects_path` collects them, by arrival too.
    """
    check_utc(events.sparkSession)
    arrival = arrival or uuid.uuid4().hex
    if rejects_path:
        rejects(events).write.mode("overwrite").parquet(f"{rejects_path}/arrival={arrival}")
    write_tier(ingest(events, **metric_options), minute_path, arrival)


def finished_hours(minutes: DataFrame, last_hour: Column, newest_minute: Column) -> DataFrame:
    """Hour rows for the hours after `last_hour` that the minutes have completed."""
    until = finished_until(last_hour, newest_minute)
    ready = timegrid.half_open(F.col("bucket_end"), last_hour, until)
    return roll_up(minutes.where(ready), HOUR)


#: Spans of hours that an hour tier remembers, with the version of the minutes they were made from.
SPANS = 1000


def _transported(hours: Version) -> int | None:
    """The end of the last hour transported, in seconds; None if nothing was."""
    if "until" in hours.notes or not hours.segments:
        return hours.notes.get("until")
    return max(segment.last for segment in hours.segments)


def transport(
    spark: SparkSession, minute_path: str, hour_path: str, event: str | None = "view"
) -> None:
    """Add the hours completed since the last run to the hour tier, each once.

    The first run starts at the oldest stored minute. `event` is the event type that tells how far
    the minutes have come (see trusted_clock); without any of it, all events do. The hour tier notes
    how far it has come and from which version of the minutes. A run that finds that another one, or
    late rows, came between starts anew, so that no hour is added twice or without its late rows.
    """
    check_utc(spark)
    for _ in range(versions.TRIES):
        minutes, hours = versions.latest(spark, minute_path), versions.latest(spark, hour_path)
        newest, start = clock_second(minutes, event), _transported(hours)
        if start is None and minutes.segments:
            start = min(segment.first for segment in minutes.segments) // HOUR * HOUR
        if newest is None or newest - start < HOUR:
            return
        until = start + (newest - start) // HOUR * HOUR
        fresh = read_tier(spark, minute_path, start=start, end=until - 1, version=minutes)
        ends = [F.timestamp_seconds(F.lit(second)) for second in (start, newest)]
        added = write_rows(finished_hours(fresh, *ends), hour_path)
        spans = [*hours.notes.get("spans", []), [until, minutes.number]][-SPANS:]
        notes = {"until": until, "spans": spans}

        def change(now: Version, start=start, read=minutes.number, added=added, notes=notes):
            if _transported(now) not in (start, None) or now.notes.get("late", 0) > read:
                raise Conflict("the hour tier has changed")
            return added, (), notes

        try:
            versions.commit(spark, hour_path, f"hours-until-{until}", change)
            return
        except Conflict:
            continue


def rank(spark: SparkSession, minute_path: str, event: str | None = "view") -> DataFrame:
    """Totals of the trailing hour, whatever the state of the hour tier."""
    check_utc(spark)
    now = clock_label(spark, minute_path, event=event)
    if now is None:
        return trailing_totals(read_tier(spark, minute_path), F.current_timestamp())
    start = timegrid.shift(now, -59 * 60)
    return trailing_totals(read_tier(spark, minute_path, start=start, end=now), now)


def store_rank(
    spark: SparkSession, minute_path: str, rank_path: str, event: str | None = "view"
) -> None:
    """Overwrite the stored snapshot of the trailing hour."""
    rank(spark, minute_path, event).write.mode("overwrite").parquet(rank_path)


def process_backlog(
    spark: SparkSession, late: DataFrame, minute_path: str, hour_path: str, arrival: str
) -> bool:
    """Add late metric rows to the minute tier, and to the hours already transported without them.

    `arrival` names the rows. The job may be repeated with the same name and rows, after a failure
    or not, and whatever ran meanwhile: they count once in both tiers. Rows that look alike but came
    in another arrival count on their own. What is written is the late rows and their hours; readers
    merge them, and compact_tier does so for good. False if nothing was late.

    Hours that were transported from minutes that had the rows already do not get them again, and
    a transport that began before it knew of them begins anew.
    """
    check_utc(spark)
    version = versions.applied(spark, minute_path, arrival)
    if version is None:
        added = write_rows(late, minute_path)
        if not added:
            return False
        late = versions.read_segments(spark, minute_path, added)
        versions.commit(spark, minute_path, arrival, lambda _: (added, (), {}))
        version = versions.applied(spark, minute_path, arrival)
    for _ in range(versions.TRIES):
        if versions.applied(spark, hour_path, arrival) is not None:
            return True
        before = _hours_without(versions.latest(spark, hour_path), version)
        missed = []
        if before is not None:
            done = F.col("bucket_end") <= F.timestamp_seconds(F.lit(before))
            missed = write_rows(roll_up(late, HOUR).where(done), hour_path)

        def change(now: Version, before=before, missed=missed):
            if _hours_without(now, version) != before:
                raise Conflict("the hour tier has changed")
            return missed, (), {"late": max(version, now.notes.get("late", 0))}

        try:
            versions.commit(spark, hour_path, arrival, change)
            return True
        except Conflict:
            continue
    raise Conflict(f"{hour_path}: other writers came first {versions.TRIES} times")


def _hours_without(hours: Version, minutes: int) -> int | None:
    """The end of the hours that were made from minutes before their version `minutes`."""
    if "spans" not in hours.notes:
        return _transported(hours)
    return max((until for until, read in hours.notes["spans"] if read < minutes), default=None)


def retain_tier(
    spark: SparkSession,
    path: str,
    hours: int,
    now: Column | None = None,
    event: str | None = "view",
) -> None:
    """Drop what is older than `now` minus `hours`, in one version.

    By default now is the newest label of `event` that other events support: a few events of a wrong
    date drop nothing (see trusted_clock, which refuses what it cannot judge; pass `now` then).
    """
    check_utc(spark)
    if now is None:
        now = clock_label(spark, path, event=event)
    if now is not None:
        keep_window(spark, path, now, hours)
        versions.vacuum(spark, path)


def compact_tier(spark: SparkSession, path: str, least: int = 2) -> None:
    """Merge the partitions of a tier that have at least `least` segments."""
    merge_duplicates(spark, path, least)
    versions.vacuum(spark, path)


def pending_files(spark: SparkSession, landing: str, target: str, block: str) -> DataFrame:
    """Files of finished blocks that no archive run has taken: path, length, modified, block.

    They come from the files present, so an hour without files holds nothing up, and a late file of
    an archived block is pending like any other.
    """
    files = raw_csv.inventory(spark, landing).withColumn(
        "modified", F.unix_millis("modificationTime")
    )
    finished = raw_csv.finished_blocks(files, raw_csv.newest_file_time(files), block)
    taken = raw_csv.claims(spark, target).select("path", "length", "modified")
    return finished.select("path", "length", "modified", "block").join(
        taken, ["path", "length", "modified"], "left_anti"
    )


def archive(
    spark: SparkSession,
    landing: str,
    target: str,
    block: str = "hour",
    remove_sources: bool = False,
) -> list[str]:
    """Compact the raw files of every finished block, as they are, with all columns.

    A run first notes exactly which files it takes, by path, length and time; these are what it
    reads, and what it removes if they are unchanged. A run that died is repeated with its own list
    before new files are taken, and replaces what it had written. Late files of a block are added to
    it. Files of several layouts are archived side by side, each with its own header; a file that
    cannot be used is set aside (see raw_csv.files_set_aside), not removed, and holds nothing up.
    The driver holds the paths of the files of a run.
    """
    check_utc(spark)
    timegrid.check_block(block)
    raw_csv.claim(pending_files(spark, landing, target, block), target, uuid.uuid4().hex)
    keys: set[str] = set()
    for run in raw_csv.unfinished_runs(spark, target):
        taken = raw_csv.claims(spark, target, run).collect()
        if not taken:
            raw_csv.finish_run(spark, target, run)
            continue
        layouts, aside = raw_csv.usable_layouts(
            spark, target, run, sorted({f.path for f in taken}), reserved=("block", "run")
        )
        for header, paths in layouts.items():
            text = raw_csv.layout_text(spark, header, paths)
            day = timegrid.block_key(timegrid.file_time(F.col("_path")), block)
            part = f"{run}-{raw_csv.layout_name(header)}"
            raw_csv.write_archive(text.withColumn("block", day).drop("_path"), target, part)
        raw_csv.finish_run(spark, target, run)
        archived = [f for f in taken if f.path not in aside]
        keys |= {f.block for f in archived}
        if remove_sources:
            for f in archived:
                workspace.remove_unchanged(spark, f.path, f.length, f.modified)
    raw_csv.compact_claims(spark, target)
    return sorted(keys)


def run_batch(
    spark: SparkSession,
    landing: str,
    minute_path: str,
    hour_path: str,
    rank_path: str,
    ledger: str,
    **metric_options,
) -> int:
    """From landing files to tiers: count new files, live and late, roll up hours, store the rank.

    Returns how many files were counted. The files of a run are noted in `ledger` before it begins,
    so that a run that died is finished with its own files, each counted once, and files that land
    meanwhile wait for the next. Late files, older than the newest label, are aggregated apart from
    live ones, as another arrival; both are merged into the stored tiers. Rows without a readable
    time are kept under `ledger` (see read_rejects). Repeated views count once within an arrival.

    Files may have different headers: they are sorted by header, scanned once a header, and counted
    as one arrival. Files that cannot be used (broken, empty, vanished, a column missing) are set
    aside with the reason (see raw_csv.files_set_aside) and hold no run up; a file that replaces one
    is new.
    """
    check_utc(spark)
    clock = clock_label(spark, minute_path, event="view")
    clock = F.lit(None).cast("timestamp") if clock is None else clock
    files = flag_late(raw_csv.inventory(spark, landing), clock).select(
        "path",
        "length",
        F.unix_millis("modificationTime").alias("modified"),
        F.when(F.col("is_late"), "late").otherwise("live").alias("block"),
    )
    taken = raw_csv.claims(spark, ledger).select("path", "length", "modified")
    new = files.join(taken, ["path", "length", "modified"], "left_anti")
    raw_csv.claim(new, ledger, uuid.uuid4().hex)
    counted = 0
    for run in raw_csv.unfinished_runs(spark, ledger):
        own = raw_csv.claims(spark, ledger, run).collect()
        if not own:
            raw_csv.finish_run(spark, ledger, run)
            continue
        kinds = {f.path: f.block for f in own}
        layouts, aside = raw_csv.usable_layouts(spark, ledger, run, sorted(kinds))
        for kind in sorted({kind for path, kind in kinds.items() if path not in aside}):
            events = raw_csv.read_layouts(
                spark,
                {
                    header: of_kind
                    for header, paths in layouts.items()
                    if (of_kind := [path for path in paths if kinds[path] == kind])
                },
            )
            rejects(events).write.mode("overwrite").parquet(f"{ledger}/rejects/{run}-{kind}")
            rows = ingest(events, **metric_options)
            process_backlog(spark, rows, minute_path, hour_path, f"{run}-{kind}")
        raw_csv.finish_run(spark, ledger, run)
        counted += len(own) - len(aside)
    raw_csv.compact_claims(spark, ledger)
    transport(spark, minute_path, hour_path)
    store_rank(spark, minute_path, rank_path)
    return counted


def read_rejects(spark: SparkSession, ledger: str) -> DataFrame | None:
    """Rows that batch runs could not count, as read; None if there were no runs."""
    folders = workspace.matching(spark, f"{ledger}/rejects/*")
    return spark.read.parquet(*folders) if folders else None


def land(
    events: DataFrame,
    folder: str,
    factor: int = 30,
    base_epoch: int = GRID_START_EPOCH,
    servers: int = 4,
    slice_seconds: int = 60,
) -> None:
    """Concentrate event times and write landing files per slice and server."""
    check_utc(events.sparkSession)
    squeezed = valid(events).withColumn(
        "event_time", timegrid.concentrate(F.col("event_time"), factor, base_epoch)
    )
    raw_csv.write_landing(assign_servers(squeezed, servers), folder, slice_seconds)
