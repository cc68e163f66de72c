"""The first view of every (session, product) pair over all batches of a stream, as keyed state.

The state of a pair is the earliest view seen, in a RocksDB store dealt out by pair. A batch looks up
the pairs it has and no others, so its cost does not grow with what was seen before.
"""

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType, TimestampType

from tierline.operators.events import view_order

PAIR = ("user_session", "product_id")
_KEYS = ["_session", "_product"]
_CODED = "_session string, _product string, place string, view string"
_CHANGES = "_session string, _product string, view string, sign int, cause string"
#: Numbers in places are written with this many digits; the offset makes them all positive.
_DIGITS, _OFFSET = 40, 10**39


def _place(column: Column, kind) -> Column:
    """Text that sorts like the column, nulls first; parts end with a character before all others."""
    if isinstance(kind, StringType):
        text = column
    else:
        if isinstance(kind, TimestampType):
            column = F.unix_micros(column)
        scale = kind.scale if isinstance(kind, DecimalType) else 0
        whole = (column.cast(f"decimal({38 - scale},{scale})") * F.lit(10**scale)).cast("decimal(38,0)")
        # Negative numbers are written from the top down, so that digits sort.
        digits = F.lpad(F.abs(whole).cast("string"), _DIGITS, "0")
        text = F.when(whole < 0, F.concat(F.lit("-"), F.translate(digits, "0123456789", "9876543210")))
        text = text.otherwise(F.concat(F.lit("0"), digits))
    return F.concat(F.when(column.isNull(), "0").otherwise("1"), F.coalesce(text, F.lit("")), F.lit("\x00"))


def _coded(views: DataFrame) -> DataFrame:
    """Pairs as text, with the place of a view in view_order() and the whole view as JSON."""
    kinds = {field.name: field.dataType for field in views.schema}
    order = [_place(F.col(name), kinds[name]) for name in view_order(views)]
    whole = F.struct(*[F.col(name).cast("string").alias(name) for name in views.columns])
    return views.select(
        *[F.col(name).cast("string").alias(key) for key, name in zip(_KEYS, PAIR, strict=True)],
        F.concat(*order).alias("place"),
        F.to_json(whole).alias("view"),
    )


def _functions(remember_hours: int | None):
    """What runs in Python workers. Made here, so that it is sent as it is and workers do not need
    this package."""
    keys, fields = list(_KEYS), [field.split()[0] for field in _CHANGES.split(", ")]

    def earliest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """One row a pair of each batch of a task, so that no task sends much of a hot pair."""
        for views in batches:
            yield views.sort_values("place", kind="stable").drop_duplicates(keys)

    def changed(key, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        """Adds the earliest view of a pair, and takes back the one that was added before."""
        if state.hasTimedOut:
            state.remove()
            return
        place, view = min(min(zip(part["place"], part["view"], strict=True)) for part in parts)
        before = state.get if state.exists else None
        changes = []
        if before is None or place < before[0]:
            state.update((place, view))
            changes.append((*key, view, 1, view))
            if before is not None:
                changes.append((*key, before[1], -1, view))
        if remember_hours:
            state.setTimeoutDuration(remember_hours * 3_600_000)
        yield pd.DataFrame(changes, columns=fields)

    return earliest, changed


def first_view_changes(views: DataFrame, remember_hours: int | None) -> DataFrame:
    """A stream of views to those it counts: the columns of a view, `sign` and `cause_time`.

    `sign` is 1 for the earliest view of its pair so far and -1 for one that an earlier view, which
    came later, takes the place of; `cause_time` is the `file_time` of the view that makes the change.
    Null sessions are one session. A pair that has had no view for `remember_hours` is forgotten
    (None: never).
    The query needs the RocksDB store (see windows.large_state).
    """
    kinds = views.schema
    text = StructType([StructField(name, StringType()) for name in kinds.fieldNames()])
    earliest, changed = _functions(remember_hours)
    timeout = GroupStateTimeout.ProcessingTimeTimeout if remember_hours else GroupStateTimeout.NoTimeout
    changes = (
        _coded(views)
        .mapInPandas(earliest, _CODED)
        .groupBy(*_KEYS)
        .applyInPandasWithState(changed, _CHANGES, "place string, view string", "append", timeout)
    )
    read = changes.select(
        F.from_json("view", text).alias("view"), "sign", F.from_json("cause", text).alias("cause")
    )
    return read.select(
        *[F.col(f"view.{f.name}").cast(f.dataType).alias(f.name) for f in kinds],
        F.col("sign").cast(LongType()).alias("sign"),
        F.col("cause.file_time").cast("timestamp").alias("cause_time"),
    )
