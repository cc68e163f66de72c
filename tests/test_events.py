import pytest
from comparing import rows
from pyspark.sql import functions as F

from tierline.functions.clean import category_levels, clean_events, rejects, type_raw, valid
from tierline.operators import events as ev
from tierline.schema import RAW_TEXT


@pytest.mark.parametrize(
    "code, number, levels",
    [
        ("a", 7, ("a", "a", "a")),
        ("a.b", 7, ("a", "b", "b")),
        ("a.b.c", 7, ("a", "b", "c")),
        ("a.b.c.d", 7, (None, None, None)),
        (None, 7, ("7", "7", "7")),
        (None, None, (None, None, None)),
    ],
)
def test_category_levels(spark, code, number, levels):
    frame = spark.createDataFrame([(code, number)], "code string, number bigint")
    assert tuple(frame.select(*category_levels(F.col("code"), F.col("number"))).first()) == levels


def test_brand_is_filled_with_the_product(raw):
    events = raw(("2019-10-01 10:00:00", "view", 5, 1), ("2019-10-01 10:00:00", "view", 6, 1, None, "acme"))
    assert rows(clean_events(events), "product_id", "brand") == [("5", "5"), ("6", "acme")]


def test_unreadable_text(spark):
    good = ("1", "2019-10-01 10:00:00", "view", "5", "7", "a.b", "acme", "1.50", "s1")
    events = type_raw(
        spark.createDataFrame(
            [good, (*good[:7], "x", "s1"), ("2", "x", *good[2:]), (None,) * 9], RAW_TEXT
        )
    )
    assert rows(valid(events), "price") == [(1.5,), (None,)]
    assert rejects(events).count() == 2


def test_first_views(raw):
    t1, t2 = "2019-10-01 10:00:00", "2019-10-01 10:00:30"
    events = raw(
        (t2, "view", 1, 1, "s1"),
        (t1, "view", 1, 1, "s1"),
        (t1, "view", 1, 1, "s2"),
        (t1, "view", 1, 1, None),
        (t2, "view", 1, 1, None),
        (t1, "view", 2, 1, "s1"),
        (t1, "view", 2, 1, "s1"),
        (t2, "purchase", 1, 1, "s1"),
        (t1, "purchase", 1, 1, "s1"),
    )
    kept = [row[0] for row in rows(ev.first_views(events), "row_idx")]
    # The first of two views in one second is the one with the lower id.
    assert kept == [1, 2, 3, 5, 7, 8]


def test_first_views_within_a_scope(raw):
    t = "2019-10-01 10:00:00"
    events = raw((t, "view", 1, 1, "s1"), (t, "view", 1, 1, "s1")).withColumn(
        "is_late", F.col("row_idx") == 1
    )
    assert ev.first_views(events).count() == 1
    assert ev.first_views(events, ("is_late",)).count() == 2


def test_split_events(raw):
    t = "2019-10-01 10:00:00"
    events = raw((t, "view", 1, 1), (t, "purchase", 1, 1), (t, "cart", 1, 1), (t, None, 1, 1))
    assert rows(ev.split_events(events), "event_type") == [("purchase",), ("view",)]
    assert rows(ev.split_events(events, ("view",)), "event_type") == [("view",)]
    with pytest.raises(ValueError):
        ev.split_events(events, ("cart",))
    with pytest.raises(ValueError):
        ev.split_events(events, ())


def test_late_files(spark):
    clock = F.lit("2019-10-01 10:16:00").cast("timestamp")
    files = spark.createDataFrame(
        [("2019-10-01 10:15:00",), ("2019-10-01 10:16:00",), ("2019-10-01 10:17:00",), (None,)],
        "file_time string",
    ).withColumn("file_time", F.col("file_time").cast("timestamp"))
    flags = {row.file_time: row.is_late for row in ev.flag_late(files, clock).collect()}
    assert list(flags.values()) == [True, False, False, False]


@pytest.mark.parametrize("chunk", [1, 3, 1 << 20])
def test_servers_take_turns_in_time_order(spark, chunk):
    """Against a plain sort of every minute; one minute and one second hold most rows."""
    events = spark.range(600).select(
        F.col("id").alias("row_idx"),
        F.timestamp_seconds(
            F.lit(1569888000)
            + F.when(F.col("id") % 3 == 0, F.lit(30)).otherwise(F.pmod(F.col("id") * 7919, F.lit(180)))
        ).alias("event_time"),
    )
    dealt = ev.assign_servers(events, servers=4, chunk=chunk).collect()
    assert len(dealt) == 600
    minutes = {}
    for row in dealt:
        minutes.setdefault(row.minute, []).append((row.event_time, row.row_idx, row.server))
    for members in minutes.values():
        assert [m[2] for m in sorted(members)] == [i % 4 for i in range(len(members))]


def test_offsets_of_ids_that_have_nothing_to_do_with_time(spark):
    """A minute with all rows, a chunk for nearly each of them, small blocks, parts of a second."""
    events = spark.range(400).select(
        F.expr("shiftright(xxhash64(id), 1 + cast(id % 40 as int))").alias("row_idx"),
        F.timestamp_micros(F.lit(1569888000_000000) + F.pmod(F.col("id"), F.lit(7)) * 400_000).alias("event_time"),
    )
    chunks = events.withColumn("id_chunk", F.floor(F.col("row_idx") / 16).cast("bigint")).withColumn(
        "minute", F.date_trunc("minute", "event_time")
    )
    sizes = chunks.groupBy("minute", "event_time", "id_chunk").agg(F.count("*").alias("size"))
    got = {(r.event_time, r.id_chunk): r.offset for r in ev.earlier_sizes(sizes, fan=4).collect()}
    expected, before = {}, 0
    for row in sorted(sizes.collect(), key=lambda r: (r.event_time, r.id_chunk)):
        expected[row.event_time, row.id_chunk] = before
        before += row["size"]
    assert got == expected and before == 400
    dealt = sorted(ev.assign_servers(events, chunk=16).collect(), key=lambda r: (r.event_time, r.row_idx))
    assert sum(r.server == n % 4 for n, r in enumerate(dealt)) == 400


def test_purchases_without_an_index_of_their_own_are_all_kept(raw):
    events = raw(
        ("2019-10-01 09:00:00", "purchase", 1, 1),
        ("2019-10-01 09:00:01", "purchase", 1, 2),
        ("2019-10-01 10:00:00", "purchase", 1, 3),
        ("2019-10-01 10:00:00", "view", 1, 3, "s"),
        ("2019-10-01 10:00:01", "view", 1, 3, "s"),
    )
    for index in (F.lit(None).cast("bigint"), F.lit(17).cast("bigint")):
        kept = ev.first_views(events.withColumn("row_idx", index))
        assert rows(kept, "event_type", "price") == [
            ("purchase", 1.0),
            ("purchase", 2.0),
            ("purchase", 3.0),
            ("view", 3.0),
        ]


def test_rows_without_index_get_servers(raw):
    events = raw(*[("2019-10-01 09:00:00", "view", 1, n) for n in range(10)])
    for index in (F.lit(None).cast("bigint"), F.lit(3).cast("bigint")):
        dealt = ev.assign_servers(events.withColumn("row_idx", index))
        assert sorted(r.server for r in dealt.collect()) == [0, 0, 0, 1, 1, 1, 2, 2, 3, 3]
