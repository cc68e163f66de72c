import pytest
from comparing import rows, same

from tierline import workspace
from tierline.functions import timegrid
from tierline.operators.tiers import trailing_totals
from tierline.streaming import ingest as stream
from tierline.streaming import trailing

DAY = "2019-10-01"
# Out of order: late rows inside and outside the window, minutes that leave it, a jump of hours, a
# wrong date, an empty batch, purchases ahead of all views.
BATCHES = (
    [(f"{DAY} 09:00:10", "view", 1, 1), (f"{DAY} 09:30:10", "view", 1, 2), (f"{DAY} 10:10:00", "purchase", 2, 3)],
    [(f"{DAY} 09:05:10", "view", 1, 4), (f"{DAY} 08:00:10", "view", 1, 5)],
    [(f"{DAY} 10:04:00", "view", 2, None), (f"{DAY} 10:04:01", "view", 1, 6), (f"{DAY} 09:30:20", "view", 1, 7)],
    [],
    [("2019-10-20 10:04:00", "view", 9, 1), (f"{DAY} 09:50:00", "purchase", 2, 8)],
    [(f"{DAY} 14:00:00", "view", 1, 9), (f"{DAY} 14:01:00", "view", 1, 9), (f"{DAY} 10:30:00", "view", 1, 9)],
)


def test_what_enters_and_leaves_adds_up_to_the_window(spark, raw, tmp_path, monkeypatch):
    """Against the whole window after every batch, each of them lost once before its clock is noted."""
    deltas, hour = str(tmp_path / "deltas"), str(tmp_path / "hour")
    assert trailing.served_trailing(spark, hour).isEmpty()
    monkeypatch.setattr(trailing, "SNAPSHOT_EVERY", 2)
    clocks = []
    for number, batch in enumerate(BATCHES):
        events = raw(*(batch or [(f"{DAY} 09:00:00", "view", 1, 1)]))
        events = events.withColumn("file_time", events.event_time)
        if not batch:
            events = events.where("false")
        stream.write_batch(events, number, deltas, deduplicate=False)

        def dies(*_):
            raise RuntimeError("lost")

        with monkeypatch.context() as patch:
            patch.setattr(workspace, "create_once", dies)
            with pytest.raises(RuntimeError):
                trailing.keep_trailing(spark, deltas, hour, number)
        for _ in range(2):  # the second finds it done
            trailing.keep_trailing(spark, deltas, hour, number)
        if number == 2:
            stream.fold(spark, deltas, 1)
        now = trailing.trailing_clock(spark, hour)
        label = spark.range(1).select(timegrid.shift(now, 0).cast("string")).first()[0]
        clocks.append(label[11:16] if label.startswith(DAY) else label)
        whole = trailing_totals(stream.served_tier(spark, deltas), now)
        assert same(trailing.served_trailing(spark, hour), whole), number
    assert clocks == ["09:31", "09:31", "10:05", "10:05", "10:05", "14:02"]
    last = trailing.trailing_changes(spark, hour, 5).where("dim = 'product_id'")
    assert rows(last, "event_type", "dim_value", "event_count", "event_rows") == [
        ("purchase", "2", -1, -1),
        ("view", "1", -2, -2),  # labels 09:06, 09:31 (twice) and 10:05 left, 14:01 and 14:02 entered
        ("view", "2", 0, -1),
    ]
