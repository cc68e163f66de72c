import pytest
from comparing import rows
from pyspark.sql import functions as F

from tierline.functions import timegrid


def evaluate(spark, column, *values):
    """One expression over a one-column frame of text values, as text."""
    frame = spark.createDataFrame([(v,) for v in values], "x string")
    out = frame.select("x", column(F.col("x")).cast("string").alias("y")).collect()
    return [row.y for row in out]


def moment(x):
    return x.cast("timestamp")


@pytest.mark.parametrize(
    "time, step, label",
    [
        ("2019-10-05 10:15:26", 60, "2019-10-05 10:16:00"),
        ("2019-10-05 10:15:26", 3600, "2019-10-05 11:00:00"),
        ("2019-10-05 10:15:00", 60, "2019-10-05 10:16:00"),
        ("2019-10-05 10:59:59", 60, "2019-10-05 11:00:00"),
        ("2019-10-05 10:59:59", 3600, "2019-10-05 11:00:00"),
        ("2019-09-30 23:59:30", 60, "2019-10-01 00:00:00"),
        ("1969-12-31 23:59:30", 60, "1970-01-01 00:00:00"),
        ("2019-10-05 23:59:59", 86400, "2019-10-06 00:00:00"),
    ],
)
def test_bucket_end(spark, time, step, label):
    assert evaluate(spark, lambda x: timegrid.bucket_end(moment(x), step), time) == [label]


@pytest.mark.parametrize("step", [60, 900, 3600, 86400])
def test_bucket_end_equals_spark_window(spark, step):
    times = spark.range(0, 4_000_000, 977).select(
        F.timestamp_seconds(F.lit(1569800000) + F.col("id")).alias("t")
    )
    windowed = times.select(
        timegrid.bucket_end(F.col("t"), step).alias("ours"),
        F.window("t", f"{step} seconds")["end"].alias("spark"),
    )
    assert windowed.where("ours <> spark").isEmpty()


def test_odd_steps_start_at_the_grid_start(spark):
    label = evaluate(
        spark, lambda x: timegrid.bucket_end(moment(x), 420), "2019-10-01 00:00:00"
    )
    assert label == ["2019-10-01 00:07:00"]


def test_slices(spark):
    frame = spark.createDataFrame([(n,) for n in (0, 1, 2, 3, 4)], "t int")
    t = F.col("t")
    assert rows(frame.where(timegrid.half_open(t, 1, 3))) == [(1,), (2,)]
    assert rows(frame.where(timegrid.closed(t, 1, 3))) == [(1,), (2,), (3,)]


def test_look_back_defaults_to_a_day(spark):
    end = F.lit("2019-10-02 10:00:00").cast("timestamp")
    inside = evaluate(
        spark,
        lambda x: timegrid.look_back(moment(x), end),
        "2019-10-01 09:59:59",
        "2019-10-01 10:00:00",
        "2019-10-02 09:59:59",
        "2019-10-02 10:00:00",
    )
    assert inside == ["false", "true", "true", "false"]


@pytest.mark.parametrize(
    "text, parsed",
    [
        ("2019-10-01 10:15:26", "2019-10-01 10:15:26"),
        ("2019-10-01 10:15:26 UTC", "2019-10-01 10:15:26"),
        ("2019-10-01", None),
        ("x", None),
        ("2019-13-01 00:00:00", None),
        (None, None),
    ],
)
def test_parse_event_time(spark, text, parsed):
    assert evaluate(spark, timegrid.parse_event_time, text) == [parsed]


@pytest.mark.parametrize(
    "name, time, server",
    [
        ("2019-10-01-01-00-00-3.csv", "2019-10-01 01:00:00", "3"),
        ("temp/2019-10-01-01-00-00-3.csv", "2019-10-01 01:00:00", "3"),
        ("2019-10-01-01-00-00.csv.gzip", "2019-10-01 01:00:00", None),
        ("s3a://b/2020-01-01-00-00-00/x/2019-10-01-01-00-00-12.csv", "2019-10-01 01:00:00", "12"),
        ("f/file_key=2019-10-01-01-00-00-2/part-0-aa.csv", "2019-10-01 01:00:00", "2"),
        ("notes.csv", None, None),
        ("2019-99-01-01-00-00-3.csv", None, "3"),
    ],
)
def test_file_names(spark, name, time, server):
    assert evaluate(spark, timegrid.file_time, name) == [time]
    assert evaluate(spark, timegrid.file_server, name) == [server]


def test_file_key_is_read_back(spark):
    key = evaluate(
        spark, lambda x: timegrid.file_key(moment(x), F.lit(3)), "2019-10-01 01:02:00"
    )
    assert key == ["2019-10-01-01-02-00-3"]
    assert evaluate(spark, timegrid.file_time, key[0] + ".csv") == ["2019-10-01 01:02:00"]


def test_block_keys(spark):
    hour = evaluate(spark, lambda x: timegrid.block_key(moment(x), "hour"), "2019-10-01 13:59:00")
    day = evaluate(spark, lambda x: timegrid.block_key(moment(x), "day"), "2019-10-01 13:59:00")
    assert (hour, day) == (["2019-10-01-13"], ["2019-10-01"])
    with pytest.raises(ValueError):
        timegrid.block_key(F.col("x"), "week")


@pytest.mark.parametrize(
    "earlier, later, hours",
    [
        ("2019-10-01 08:00:00", "2019-10-01 10:01:00", "2"),
        ("2019-10-01 08:00:00", "2019-10-03 10:01:00", "50"),
        ("2019-10-01 08:00:00", "2019-10-01 07:30:00", "0"),
        ("2019-10-01 23:00:00", "2019-10-02 01:00:00", "2"),
    ],
)
def test_whole_hours(spark, earlier, later, hours):
    later = F.lit(later).cast("timestamp")
    assert evaluate(spark, lambda x: timegrid.whole_hours(moment(x), later), earlier) == [hours]


def test_concentrate(spark):
    squeezed = evaluate(
        spark,
        lambda x: timegrid.concentrate(moment(x), 30),
        "2019-10-01 00:00:29",
        "2019-10-01 00:00:30",
        "2019-10-31 00:00:00",
        "2019-09-30 23:59:59",
    )
    assert squeezed == [
        "2019-10-01 00:00:00",
        "2019-10-01 00:00:01",
        "2019-10-02 00:00:00",
        "2019-09-30 23:59:59",
    ]
