"""The trailing hour of a stream, kept by what enters and leaves its window.

Behind a delta table (see ingest) stand additive rows of minutes. The totals of the last hour before
the clock change by three sets of them: rows of the new batch that lie in the new window, rows of
earlier batches whose minute has entered it, and, taken back, those whose minute has left it. A batch
reads these and nothing else, so its cost follows its own rows and the minutes that the clock passed.
Late rows count as soon as they come, and the clock may also go back.
"""

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tierline import workspace
from tierline.functions import measures
from tierline.operators.clock import trusted_clock
from tierline.schema import HOUR, STORED_TIER
from tierline.streaming.ingest import read_deltas

_KEYS = ("event_type", "dim", "dim_value")
CHANGES = StructType(
    [
        *[field for field in STORED_TIER.fields if field.name in (*_KEYS, "price_sum", "event_count")],
        StructField("event_rows", LongType()),
        StructField("batch_id", LongType()),
    ]
)
#: Hours before the clock whose event counts are remembered to judge the next labels by.
HOURS_JUDGED = 240
#: Batches after which the changes are summed up anew.
SNAPSHOT_EVERY = 20
_START = {"clock": None, "hours": [], "snapshot": -1, "batch": -1}


def _state(spark: SparkSession, path: str, before: int | None = None) -> dict:
    """What the newest batch (of those before a given one) has left behind."""
    names = workspace.matching(spark, f"{path}/_clocks/*[0-9]")
    done = [int(name.rsplit("/", 1)[1]) for name in names]
    done = [batch for batch in done if before is None or batch < before]
    if not done:
        return _START
    return json.loads(workspace.read_text(spark, f"{path}/_clocks/{max(done)}"))


def _mass(own: DataFrame, state: dict) -> list[list]:
    """Events by type, dimension and hour, with the newest label of each: the known ones and a batch's."""
    second = F.unix_seconds("bucket_end")
    counts = (
        own.groupBy("event_type", "dim", F.floor(second / HOUR).alias("hour"))
        .agg(F.sum("event_rows").alias("events"), F.max(second).alias("last"))
        .collect()
    )
    mass = {tuple(entry[:3]): entry[3:] for entry in state["hours"]}
    for row in counts:
        events, last = mass.get(key := (row.event_type, row.dim, row.hour), (0, row["last"]))
        mass[key] = [events + row.events, max(last, row["last"])]
    return [[*key, *value] for key, value in sorted(mass.items())]


def _clock(hours: list[list], event: str, before: int | None) -> int | None:
    """The newest label that the mass of events supports; the one before where nothing can be told."""
    try:
        return trusted_clock(hours, event)
    except ValueError:
        return before


def _inside(clock: int | None, minutes: int) -> Column:
    """Whether a label lies in the window that ends with the clock."""
    if clock is None:
        return F.lit(False)
    first, last = [F.timestamp_seconds(F.lit(s)) for s in (clock - 60 * (minutes - 1), clock)]
    return F.col("bucket_end").between(first, last)


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*_KEYS).agg(
        measures.merged_total(), measures.merged_count(), F.sum("event_rows").alias("event_rows")
    )


def keep_trailing(
    spark: SparkSession,
    deltas: str,
    path: str,
    batch_id: int,
    minutes: int = 60,
    event: str = "view",
) -> None:
    """Bring the totals below `path` up to a batch that was written to the delta table.

    The clock is the newest label of `event` supported by the mass of events, counted batch by batch;
    a single wrong date does not move it. A batch that was taken in is not taken in again; one that
    died is repeated from its start, since it counts only when its clock is written, which comes last.
    """
    state = _state(spark, path, before=batch_id)
    if _state(spark, path)["batch"] >= batch_id:
        return
    rows = read_deltas(spark, deltas)
    own, earlier = rows.where(F.col("batch_id") == batch_id), rows.where(F.col("batch_id") < batch_id)
    hours = _mass(own, state)
    before = state["clock"]
    clock = _clock(hours, event, before)
    old, new = _inside(before, minutes), _inside(clock, minutes)
    entered = earlier.where(new & ~old)
    left = earlier.where(old & ~new).withColumns(
        {name: -F.col(name) for name in ("price_sum", "event_count", "event_rows")}
    )
    changes = _summed(own.where(new).unionByName(entered).unionByName(left))
    _write(changes, f"{path}/changes/batch_id={batch_id}")
    snapshot = state["snapshot"]
    if batch_id - snapshot >= SNAPSHOT_EVERY:
        _write(_totals(spark, path, snapshot, batch_id), f"{path}/totals/{batch_id}")
        _forget(spark, path, snapshot)
        snapshot = batch_id
    oldest = 0 if clock is None else clock // HOUR - HOURS_JUDGED
    kept = [entry for entry in hours if entry[2] >= oldest]
    note = {"clock": clock, "hours": kept, "snapshot": snapshot, "batch": batch_id}
    workspace.create_once(spark, f"{path}/_clocks/{batch_id}", json.dumps(note))


def _write(rows: DataFrame, folder: str) -> None:
    rows.write.mode("overwrite").parquet(folder)


def _totals(spark: SparkSession, path: str, snapshot: int, upto: int) -> DataFrame:
    """The sums of a snapshot and of the changes after it."""
    changes = (
        spark.read.schema(CHANGES)
        .parquet(f"{path}/changes")
        .where((F.col("batch_id") > snapshot) & (F.col("batch_id") <= upto))
        .drop("batch_id")
    )
    if snapshot >= 0:
        known = spark.read.schema(CHANGES).parquet(f"{path}/totals/{snapshot}").drop("batch_id")
        changes = changes.unionByName(known)
    return _summed(changes).where("event_rows <> 0")


def _forget(spark: SparkSession, path: str, snapshot: int) -> None:
    """Delete what a snapshot stands for; readers are at it or at newer ones."""
    for place in ("changes/batch_id=", "_clocks/", "totals/"):
        for name in workspace.matching(spark, f"{path}/{place}*[0-9]"):
            number = int(name.rsplit("/", 1)[1].rpartition("=")[2])
            if number < snapshot or (number == snapshot and place.startswith("changes")):
                workspace.remove(spark, name)


def trailing_clock(spark: SparkSession, path: str) -> Column | None:
    """The label that the kept window ends with, as a literal; None before any event."""
    clock = _state(spark, path)["clock"]
    return None if clock is None else F.timestamp_seconds(F.lit(clock))


def served_trailing(spark: SparkSession, path: str) -> DataFrame:
    """The totals of the trailing hour after the newest batch; a value without prices has no sum."""
    state = _state(spark, path)
    if state["batch"] < 0:
        return spark.createDataFrame([], CHANGES).drop("batch_id", "event_rows")
    totals = _totals(spark, path, state["snapshot"], state["batch"])
    price = F.when(F.col("event_count") != 0, F.col("price_sum"))
    return totals.select(*_KEYS, price.alias("price_sum"), "event_count")


def trailing_changes(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """What a batch changed in the totals of the trailing hour, as additive rows."""
    folder = f"{path}/changes/batch_id={batch_id}"
    return spark.read.schema(CHANGES).parquet(folder).drop("batch_id").where("event_rows <> 0")
