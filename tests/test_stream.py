import os
import time

import pytest
from comparing import rows, same
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from test_files import line, put
from test_tiers import spread_events

from tierline.operators.tiers import roll_up
from tierline.plans import jobs
from tierline.schema import HOUR, TIER_COLUMNS
from tierline.sources.raw_csv import read_raw, stream_raw
from tierline.streaming import ingest as stream
from tierline.streaming.windows import first_view_stream, minute_stream


def drop(folder, *names):
    """Put minute files in order of arrival; one view and one purchase each."""
    for n, name in enumerate(names):
        clock = name.replace("-", ":")[:5]
        put(folder, f"2019-10-01-{name}.csv", line(2 * n, f"{clock}:10", session=f"s{n}"), line(2 * n + 1, f"{clock}:20", "purchase"))
        moment = time.time() - 1000 + n
        os.utime(folder / f"2019-10-01-{name}.csv", (moment, moment))


ARRIVALS = ("10-15-00-0", "10-16-00-0", "10-18-00-0", "10-15-00-3", "10-20-00-0")


def run(spark, tmp_path, **options):
    deltas = str(tmp_path / "deltas")
    source = stream_raw(spark, str(tmp_path / "in"), files_per_batch=1, **options)
    stream.run_ingest(source, deltas, str(tmp_path / "progress")).awaitTermination()
    return deltas


def test_the_file_out_of_order_is_late_and_counted(spark, tmp_path):
    drop(tmp_path / "in", *ARRIVALS)
    deltas = run(spark, tmp_path)
    flags = stream.read_deltas(spark, deltas).select("batch_id", "is_late").distinct()
    assert rows(flags) == [(0, False), (1, False), (2, False), (3, True), (4, False)]
    batch = jobs.ingest(read_raw(spark, str(tmp_path / "in"))).select(*TIER_COLUMNS)
    assert same(stream.served_tier(spark, deltas), batch)
    assert not stream.late_deltas(spark, deltas).isEmpty()
    assert stream.late_deltas(spark, deltas, after_batch=3).isEmpty()
    label = stream.late_deltas(spark, deltas).select("bucket_end").distinct()
    assert rows(label) == [("2019-10-01 10:16:00",)]


def test_hours_are_kept_beside_the_minutes(spark, tmp_path):
    drop(tmp_path / "in", *ARRIVALS, "11-00-00-0")
    deltas, hours = str(tmp_path / "deltas"), str(tmp_path / "hours")
    source = stream_raw(spark, str(tmp_path / "in"), files_per_batch=1)
    query = stream.run_ingest(source, deltas, str(tmp_path / "progress"), hour_path=hours)
    query.awaitTermination()
    assert same(stream.served_tier(spark, hours), roll_up(stream.served_tier(spark, deltas), HOUR))
    assert rows(stream.late_deltas(spark, hours).select("bucket_end").distinct()) == [
        ("2019-10-01 11:00:00",)
    ]


def test_a_repeated_batch_counts_nothing_twice(spark, tmp_path):
    drop(tmp_path / "in", *ARRIVALS)
    deltas = run(spark, tmp_path)
    before = rows(stream.served_tier(spark, deltas))
    again = read_raw(spark, str(tmp_path / "in")).where("file_time = '2019-10-01 10:15:00' and server = 3")
    stream.write_batch(again, 3, deltas)
    assert rows(stream.served_tier(spark, deltas)) == before
    flags = stream.read_deltas(spark, deltas).where("batch_id = 3").select("is_late").distinct()
    assert rows(flags) == [(True,)]


def test_a_stream_continues_where_it_stopped_and_archives_files(spark, tmp_path):
    drop(tmp_path / "in", *ARRIVALS[:3])
    run(spark, tmp_path, archive_to=str(tmp_path / "processed"))
    drop(tmp_path / "in", *ARRIVALS[3:])
    deltas = run(spark, tmp_path, archive_to=str(tmp_path / "processed"))
    assert stream.read_deltas(spark, deltas).select("batch_id").distinct().count() == 5
    archived = [name for _, _, names in os.walk(tmp_path / "processed") for name in names]
    assert "2019-10-01-10-15-00-0.csv" in archived


def test_late_deltas_feed_the_backlog_job(spark, tmp_path):
    drop(tmp_path / "in", *ARRIVALS)
    deltas = run(spark, tmp_path)
    minutes, hours = str(tmp_path / "minutes"), str(tmp_path / "hours")
    late = stream.late_deltas(spark, deltas)
    live = stream.read_deltas(spark, deltas).where("not is_late").select(*TIER_COLUMNS)
    from tierline.sources.tier_table import read_tier, write_tier

    write_tier(live, minutes)
    assert jobs.process_backlog(spark, late, minutes, hours, "late files")
    assert same(read_tier(spark, minutes), stream.served_tier(spark, deltas))


def test_bad_times_do_not_reach_a_tier(spark, tmp_path):
    put(tmp_path / "in", "2019-10-01-10-15-00-0.csv", line(1, "10:15:10"), line(2, "x"))
    deltas = run(spark, tmp_path)
    assert stream.served_tier(spark, deltas).where("bucket_end is null").isEmpty()


def test_trim_deletes_whole_dates(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "2019-10-01-10-15-00-0.csv", "1,2019-10-01 10:15:10,view,5,7,a,,1,s")
    put(source, "2019-10-03-10-15-00-0.csv", "2,2019-10-03 10:15:10,view,5,7,a,,1,s2")
    deltas = run(spark, tmp_path)
    stream.trim(spark, deltas, 24)
    assert rows(stream.served_tier(spark, deltas).select("bucket_end").distinct()) == [
        ("2019-10-03 10:16:00",)
    ]


def files_stream(spark, tmp_path, events, parts=3):
    """Events as a stream over a few Parquet files."""
    path = str(tmp_path / "events")
    events.repartition(parts).write.parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(path)


def collected(spark, tmp_path, streamed):
    out = str(tmp_path / "out")
    (
        streamed.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "progress"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(streamed.schema).parquet(out)


def test_streaming_dedup_counts_each_pair_once_over_batches(spark, tmp_path):
    views = spread_events(spark).where("event_type = 'view'")
    first = first_view_stream(files_stream(spark, tmp_path, views), horizon="30 days", spread=4)
    got = collected(spark, tmp_path, first.select("user_session", "product_id"))
    expected = views.select("user_session", "product_id").distinct()
    assert got.count() == expected.count()
    assert same(got.distinct(), expected)


def test_minute_stream_equals_batch_up_to_the_watermark(spark, tmp_path):
    from tierline.functions.clean import clean_events
    from tierline.operators.events import with_bucket
    from tierline.operators.metrics import by_dimension

    events = clean_events(spread_events(spark))
    closing = events.agg(F.max("event_time").alias("t")).scalar()
    source = files_stream(spark, tmp_path, events, parts=1)
    got = collected(spark, tmp_path, minute_stream(source, "brand", "0 seconds"))
    flat = got.select(
        "event_type", F.col("brand").alias("dim_value"), F.col("minute.end").alias("bucket_end"), "cents", "event_count"
    )
    batch = by_dimension(with_bucket(events, 60), ("brand",)).where(F.col("bucket_end") <= closing)
    batch = batch.select("event_type", "dim_value", "bucket_end", (F.col("price_sum") * 100).cast("bigint").alias("cents"), "event_count")
    assert same(flat, batch)


def test_counts_do_not_depend_on_the_batches(spark, tmp_path):
    """Views of one pair come in several files, the earliest of them late and last."""
    names = ("10-15-00-0", "10-16-00-0", "10-18-00-0", "10-14-00-3")
    for n, name in enumerate(names):
        clock = name.replace("-", ":")[:5]
        price = ("1.50", "x", "2.50", "3.50")[n]
        put(
            tmp_path / "in",
            f"2019-10-01-{name}.csv",
            line(1, f"{clock}:10", price=price),
            line(1, f"{clock}:20", "purchase", price=price),
            line(2, f"{clock}:30", session="", product=9),
            line(3, f"{clock}:30", session=f"own{n}", product=8, price="x"),
        )
        moment = time.time() - 1000 + n
        os.utime(tmp_path / "in" / f"2019-10-01-{name}.csv", (moment, moment))
    expected = jobs.ingest(read_raw(spark, str(tmp_path / "in"))).select(*TIER_COLUMNS)
    for files in (1, 2, 4):
        deltas = str(tmp_path / f"deltas{files}")
        source = stream_raw(spark, str(tmp_path / "in"), files_per_batch=files)
        stream.run_ingest(source, deltas, str(tmp_path / f"progress{files}")).awaitTermination()
        assert same(stream.served_tier(spark, deltas), expected)


def test_a_batch_that_died_is_repeated_with_its_state(spark, tmp_path, monkeypatch):
    """The third file has an earlier view of the pair; its batch is lost after it was written."""
    for n, minute in enumerate((15, 16, 14)):
        name = f"2019-10-01-10-{minute}-00-0.csv"
        put(tmp_path / "in", name, line(1, f"10:{minute}:10", price=f"{n}.25"), line(2, f"10:{minute}:20", session=""))
        os.utime(tmp_path / "in" / name, (time.time() - 1000 + n,) * 2)
    expected = jobs.ingest(read_raw(spark, str(tmp_path / "in"))).select(*TIER_COLUMNS)
    write_batch = stream.write_batch

    def dies(events, batch_id, *args, **options):
        write_batch(events, batch_id, *args, **options)
        if batch_id == 2:
            raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(stream, "write_batch", dies)
        with pytest.raises(StreamingQueryException):
            run(spark, tmp_path)
    deltas = run(spark, tmp_path)
    assert same(stream.served_tier(spark, deltas), expected)
    assert not os.path.exists(f"{deltas}/_views")


def test_places_sort_like_views(spark):
    from tierline.streaming.first_views import _coded

    moments = ["2019-10-01 10:15:26.5", "1969-12-31 23:59:59", None]
    views = spark.sql(
        "select 's' user_session, 1L product_id, timestamp(t) event_time, i row_idx,"
        " cast(p as decimal(18,2)) price, b brand from values "
        + ", ".join(
            f"({'null' if t is None else repr(t)}, {i}L, {p}, {b})"
            for t in moments
            for i in ("10", "-2", "-10", "cast(null as bigint)")
            for p in ("1.5", "-0.01", "-9999999999999999.99", "null")
            for b in ("null", "''", "'a'", "'a b'", "'é'")
        )
        + " as t(t, i, p, b)"
    )
    order = ["event_time", "row_idx", "price", "brand"]
    coded = _coded(views).select("place", F.from_json("view", "row_idx string, price string, brand string, event_time string").alias("v"))
    by_place = [tuple(r.v) for r in coded.orderBy("place").collect()]
    named = views.orderBy(*order).select(*[F.col(c).cast("string") for c in ("row_idx", "price", "brand", "event_time")])
    assert by_place == [tuple(r) for r in named.collect()]


def test_trim_is_not_moved_by_one_date(spark, tmp_path):
    source = tmp_path / "in"
    put(source, "2019-10-01-10-10-00-0.csv", *[f"{k},2019-10-01 10:10:{k + 10},view,5,7,a,,1,s{k}" for k in range(24)])
    put(source, "2019-10-01-10-20-00-0.csv", "9,2091-10-03 10:15:10,view,5,7,a,,1,other")
    deltas = run(spark, tmp_path)
    before = rows(stream.served_tier(spark, deltas))
    stream.trim(spark, deltas, 24)
    assert rows(stream.served_tier(spark, deltas)) == before


def batch_folders(path):
    return [d for base, folders, _ in os.walk(path) for d in folders if d.startswith("batch_id=") and "_views" not in base]


def test_folds_keep_the_number_of_folders(spark, tmp_path):
    names = [f"10-{minute}-00-0" for minute in range(15, 21)]
    drop(tmp_path / "in", *names)
    counts = {}
    for every in (None, 3):
        deltas, hours = str(tmp_path / f"deltas{every}"), str(tmp_path / f"hours{every}")
        source = stream_raw(spark, str(tmp_path / "in"), files_per_batch=1)
        stream.run_ingest(
            source, deltas, str(tmp_path / f"progress{every}"), hour_path=hours, fold_every=every
        ).awaitTermination()
        counts[every] = len(batch_folders(deltas))
    assert counts[None] == 6 * 6 and counts[3] <= 2 * 6
    whole = str(tmp_path / "deltasNone")
    assert same(stream.served_tier(spark, deltas), stream.served_tier(spark, whole))
    assert same(stream.served_tier(spark, hours), roll_up(stream.served_tier(spark, whole), HOUR))
    # Batches on either side of the last fold, once more.
    for batch, minute in ((4, 19), (5, 20)):
        again = read_raw(spark, str(tmp_path / "in")).where(f"minute(file_time) = {minute}")
        stream.write_batch(again, batch, deltas)
        assert same(stream.served_tier(spark, deltas), stream.served_tier(spark, whole))


def test_a_fold_that_died_is_invisible_and_repeated(spark, tmp_path, monkeypatch):
    from tierline import workspace

    drop(tmp_path / "in", *ARRIVALS)
    deltas = run(spark, tmp_path)
    before = rows(stream.served_tier(spark, deltas))

    def dies(*_):
        raise RuntimeError("lost")

    for step in ("mark", "remove"):
        with monkeypatch.context() as patch:
            patch.setattr(workspace, step, dies)
            with pytest.raises(RuntimeError):
                stream.fold(spark, deltas, 2)
        assert rows(stream.served_tier(spark, deltas)) == before
    stream.fold(spark, deltas, 3)
    assert rows(stream.served_tier(spark, deltas)) == before
    assert len(batch_folders(deltas)) == 2 * 6


def test_of_views_in_one_second_the_lower_number_counts_whatever_its_server(spark, tmp_path):
    """Three files of one minute and a late one; each has a view of the pair in the same second."""
    names = ("10-15-00-0", "10-15-00-2", "10-15-00-3", "10-15-00-1")
    for n, name in enumerate(names):
        number, price = ((7, "7.50"), (5, "5.50"), (6, "6.50"), (4, "4.50"))[n]
        put(tmp_path / "in", f"2019-10-01-{name}.csv", line(number, "10:15:10", price=price))
        os.utime(tmp_path / "in" / f"2019-10-01-{name}.csv", (time.time() - 1000 + n,) * 2)
    found = jobs.ingest(read_raw(spark, str(tmp_path / "in"))).select(*TIER_COLUMNS)
    assert {str(price) for _, price in rows(found, "event_count", "price_sum")} == {"4.5"}
    assert same(stream.served_tier(spark, run(spark, tmp_path)), found)
