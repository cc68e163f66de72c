import gzip
import os

import pytest
from comparing import rows, same
from pyspark.sql import functions as F
from test_tiers import at

from tierline.plans import jobs
from tierline.sources import raw_csv
from tierline.sources.tier_table import read_tier

HEADER = ",event_time,event_type,product_id,category_id,category_code,brand,price,user_session\n"


def put(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(HEADER + "".join(line + "\n" for line in lines))


def line(index, time, kind="view", product=5, price="1.50", session="s1"):
    return f"{index},2019-10-01 {time},{kind},{product},7,a.b,,{price},{session}"


def test_read_raw(spark, tmp_path):
    put(tmp_path / "in", "2019-10-01-10-15-00-3.csv", line(17, "10:15:26"), line(18, "10:15:27 UTC", price="x"))
    put(tmp_path / "in", "readme.txt", "not an event")
    got = raw_csv.read_raw(spark, str(tmp_path / "in"))
    assert rows(got, "row_idx", "event_time", "product_id", "brand", "price", "file_time", "server") == [
        (17, "2019-10-01 10:15:26", "5", None, 1.5, "2019-10-01 10:15:00", 3),
        (18, "2019-10-01 10:15:27", "5", None, None, "2019-10-01 10:15:00", 3),
    ]


def test_columns_go_by_their_names(spark, tmp_path):
    (tmp_path / "in").mkdir()
    name = tmp_path / "in" / "2019-10-01-10-15-00-0.csv"
    name.write_text(
        ",event_time,event_type,category_id,product_id,category_code,brand,price,user_id,user_session\n"
        "1,2019-10-01 10:15:26,view,7,A55,,acme,2,99,s1\n"
    )
    got = raw_csv.read_raw(spark, str(tmp_path / "in"))
    assert rows(got, "user_session", "category_code", "category_id", "product_id") == [
        ("s1", None, "7", "A55")
    ]
    stream = raw_csv.stream_raw(spark, str(tmp_path / "in"))
    assert stream.columns == got.columns
    put(tmp_path / "in", "2019-10-01-10-16-00-0.csv", line(1, "10:16:00"))
    with pytest.raises(Exception):  # the headers differ
        raw_csv.read_raw(spark, str(tmp_path / "in")).collect()
    (tmp_path / "short").mkdir()
    (tmp_path / "short" / "a.csv").write_text(",event_time\n1,x\n")
    with pytest.raises(ValueError, match="lacks"):
        raw_csv.read_raw(spark, str(tmp_path / "short"))


OTHER = "user_session,price,user_id,event_type,brand,category_code,category_id,product_id,event_time,row_idx\n"


def mixed(landing):
    """Two usable layouts, and files that cannot be used for several reasons; their names."""
    put(landing, "2019-10-01-09-00-00-0.csv", line(1, "09:00:01"), line(2, "09:00:02", "purchase", 6))
    (landing / "2019-10-01-09-01-00-1.csv").write_text(
        "\n" + OTHER + "s2,2.50,u,purchase,acme,a.b,7,A6,2019-10-01 09:01:01,1\n"
        "s1,9,u,view,,a.b,7,5,2019-10-01 09:01:02,2\n"  # the view of the first file again
    )
    put(landing, "2019-10-01-11-00-00-0.csv", line(1, "11:00:01", "purchase", 8))
    bad = {
        "2019-10-01-09-02-00-0.csv": "\n \n",
        "2019-10-01-09-03-00-0.csv": ",event_time\n1,x\n",
        "2019-10-01-09-04-00-0.csv": line(3, "09:04:00") + "\n" + OTHER,
        "2019-10-01-09-05-00-0.csv": OTHER.replace("user_id", "Price") + "s,1,1,view,,,7,5,2019-10-01 09:05:01,1\n",
        "2019-10-01-09-06-00-0.csv": HEADER.replace(",event_time", "event_time"),
    }
    for name, text in bad.items():
        (landing / name).write_text(text)
    whole = gzip.compress((HEADER + "".join(line(n, "09:07:00") + "\n" for n in range(20000))).encode())
    (landing / "2019-10-01-09-07-00 0.csv.gz").write_bytes(whole[: len(whole) // 2])
    return sorted([*bad, "2019-10-01-09-07-00 0.csv.gz"])


def names(frame):
    return sorted(row.path.rsplit("/", 1)[1].replace("%20", " ") for row in frame.collect())


def test_a_batch_counts_files_of_several_layouts_and_sets_others_aside(spark, tmp_path, monkeypatch):
    landing, places = tmp_path / "in", [str(tmp_path / n) for n in ("minutes", "hours", "rank", "ledger")]
    bad = mixed(landing)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(raw_csv, "finish_run", dies)
        with pytest.raises(RuntimeError):
            jobs.run_batch(spark, str(landing), *places)
    # The repeated run counts nothing twice; a file it had not taken, and a mended one, come after.
    put(landing, "2019-10-01-11-01-00-0.csv", line(1, "11:01:01", "purchase", 8))
    (landing / "2019-10-01-09-03-00-0.csv").write_text(HEADER + line(1, "09:03:01", "purchase", 9) + "\n")
    assert jobs.run_batch(spark, str(landing), *places) == 5
    assert jobs.run_batch(spark, str(landing), *places) == 0
    assert names(raw_csv.files_set_aside(spark, places[3])) == bad
    found = read_tier(spark, places[0]).where("dim = 'product_id'")
    assert rows(found, "event_type", "dim_value", "bucket_end", "event_count") == [
        ("purchase", "6", "2019-10-01 09:01:00", 1),
        ("purchase", "8", "2019-10-01 11:01:00", 1),
        ("purchase", "8", "2019-10-01 11:02:00", 1),
        ("purchase", "9", "2019-10-01 09:04:00", 1),
        ("purchase", "A6", "2019-10-01 09:02:00", 1),
        ("view", "5", "2019-10-01 09:01:00", 1),
    ]


def test_a_vanished_file_holds_nothing_up(spark, tmp_path, monkeypatch):
    landing, places = tmp_path / "in", [str(tmp_path / n) for n in ("minutes", "hours", "rank", "ledger")]
    put(landing, "2019-10-01-09-00-00-0.csv", line(1, "09:00:01"))
    put(landing, "2019-10-01-09-01-00-0.csv", line(1, "09:01:01", product=6))
    note = raw_csv.claim

    def then_vanishes(*args):
        note(*args)
        (landing / "2019-10-01-09-01-00-0.csv").unlink()

    monkeypatch.setattr(raw_csv, "claim", then_vanishes)
    assert jobs.run_batch(spark, str(landing), *places) == 1
    assert rows(raw_csv.files_set_aside(spark, places[3]), "reason") == [("not there",)]
    assert read_tier(spark, places[0]).where("dim = 'product_id'").count() == 1


def test_claims_are_merged_and_kept(spark, tmp_path, monkeypatch):
    """Merging that is lost before it removes anything, and a run that is still open, lose no claim."""
    folder = str(tmp_path)
    files = spark.createDataFrame([(f"f{n}", n, n, "b") for n in range(6)], "path string, length long, modified long, block string")
    for n in range(6):
        raw_csv.claim(files.where(f"length = {n}"), folder, f"r{n}")
        if n < 5:
            raw_csv.finish_run(spark, folder, f"r{n}")
    assert not raw_csv.compact_claims(spark, folder, least=6)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(raw_csv.workspace, "remove", dies)
        with pytest.raises(RuntimeError):
            raw_csv.compact_claims(spark, folder, least=5)
    assert raw_csv.compact_claims(spark, folder, least=5)
    assert rows(raw_csv.claims(spark, folder), "path") == [(f"f{n}",) for n in range(6)]
    assert raw_csv.unfinished_runs(spark, folder) == ["r5"]
    assert rows(raw_csv.claims(spark, folder, "r5"), "path", "run") == [("f5", "r5")]
    assert len(os.listdir(tmp_path / "_archived" / "files")) == 2


def test_an_archive_of_several_layouts(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "archive")
    bad = mixed(landing)
    assert jobs.archive(spark, str(landing), target, remove_sources=True) == ["2019-10-01-09"]
    assert sorted(os.listdir(landing)) == [*bad, "2019-10-01-11-00-00-0.csv"]
    assert names(raw_csv.files_set_aside(spark, target)) == bad
    text = raw_csv.read_archive_text(spark, target)
    got = sorted((r.row_idx, r.product_id, r.price, r.user_id, r.block) for r in text.collect())
    assert got == [
        ("1", "5", "1.50", None, "2019-10-01-09"),
        ("1", "A6", "2.50", "u", "2019-10-01-09"),
        ("2", "5", "9", "u", "2019-10-01-09"),
        ("2", "6", "1.50", None, "2019-10-01-09"),
    ]
    assert jobs.archive(spark, str(landing), target) == []


def test_missing_folder_is_empty(spark, tmp_path):
    empty = raw_csv.read_raw(spark, str(tmp_path / "none"))
    assert empty.isEmpty() and "file_time" in empty.columns
    files = raw_csv.inventory(spark, str(tmp_path / "none"))
    assert rows(raw_csv.file_time_range(files)) == [("2019-09-30 23:00:00", "2019-09-30 23:00:00")]


def test_inventory(spark, tmp_path):
    folder = tmp_path / "in"
    put(folder, "2019-10-01-10-15-00-3.csv", line(1, "10:15:26"))
    put(folder, "2019-10-01-09-00-00-0.csv", line(1, "09:00:26"))
    put(folder, "odd.csv", line(1, "09:00:26"))
    put(folder, "2019-10-09-09-00-00-0.txt", line(1, "09:00:26"))
    files = raw_csv.inventory(spark, str(folder))
    assert files.count() == 3
    assert rows(raw_csv.file_time_range(files)) == [("2019-10-01 09:00:00", "2019-10-01 10:15:00")]


@pytest.mark.parametrize("newest, done", [("2019-10-01 01:00:00", 0), ("2019-10-01 01:01:00", 1)])
def test_a_block_is_finished_when_passed_by_more_than_a_block(spark, newest, done):
    files = spark.createDataFrame([("2019-10-01 00:00:00",)], "t string").select(
        F.col("t").cast("timestamp").alias("file_time")
    )
    assert raw_csv.finished_blocks(files, at(newest), "hour").count() == done


def test_archive(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "archive")
    for n, name in enumerate(("09-00-00-0", "09-59-00-1", "11-00-00-0", "12-01-00-0")):
        put(landing, f"2019-10-01-{name}.csv", line(10 - n, f"{name[:2]}:00:01"), line(100 + n, f"{name[:2]}:00:02"))
    # Ten o'clock has no files; twelve is not over.
    assert jobs.archive(spark, str(landing), target) == ["2019-10-01-09", "2019-10-01-11"]
    stored = raw_csv.read_archive(spark, target)
    assert rows(stored, "block", "row_idx") == [
        ("2019-10-01-09", 10),
        ("2019-10-01-09", 100),
        ("2019-10-01-09", 101),
        ("2019-10-01-09", 9),
        ("2019-10-01-11", 102),
        ("2019-10-01-11", 8),
    ]
    parts = sorted((tmp_path / "archive" / "block=2019-10-01-09").glob("run=*/*.csv.gz"))
    lines = [row for part in parts for row in gzip.open(part, "rt").read().splitlines()[1:]]
    assert [int(row.split(",")[0]) for row in lines] == [9, 10, 100, 101]
    assert jobs.archive(spark, str(landing), target) == []

    put(landing, "2019-10-01-13-30-00-0.csv", line(200, "13:30:00"))
    assert jobs.archive(spark, str(landing), target, remove_sources=True) == ["2019-10-01-12"]
    assert raw_csv.read_archive(spark, target).count() == 8
    assert "2019-10-01-12-01-00-0.csv" not in os.listdir(landing)
    assert "2019-10-01-13-30-00-0.csv" in os.listdir(landing)


def test_archive_repeats_a_run_that_did_not_end(spark, tmp_path, monkeypatch):
    landing, target = tmp_path / "in", str(tmp_path / "archive")
    put(landing, "2019-10-01-09-00-00-0.csv", line(1, "09:00:01"))
    put(landing, "2019-10-01-11-00-00-0.csv", line(2, "11:00:01"))

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(raw_csv, "finish_run", dies)
        with pytest.raises(RuntimeError):
            jobs.archive(spark, str(landing), target)
    # Meanwhile a late file of the block has come; it is a run of its own.
    put(landing, "2019-10-01-09-30-00-0.csv", line(3, "09:30:01"))
    assert jobs.archive(spark, str(landing), target) == ["2019-10-01-09"]
    assert rows(raw_csv.read_archive(spark, target), "row_idx") == [(1,), (3,)]
    assert jobs.archive(spark, str(landing), target) == []


def test_archive_keeps_text_and_unread_files(spark, tmp_path, monkeypatch):
    """All columns and characters come back; what lands after the listing is neither read nor removed."""
    landing, target = tmp_path / "in", str(tmp_path / "archive")
    landing.mkdir()
    header = ",event_time,event_type,product_id,category_id,category_code,brand,price,user_id,user_session"
    odd = '7,2019-10-01 09:00:01 UTC,view,A55,x,a.b," b ""q"", c",12.345,99,s1'
    bad = "8,no time,view,5,7,,acme,no price,98,"
    (landing / "2019-10-01-09-00-00-0.csv").write_text("\n".join([header, odd, bad]) + "\n")
    (landing / "2019-10-01-11-00-00-0.csv").write_text(f"{header}\n9,2019-10-01 11:00:01,view,5,7,,,1,1,s\n")
    write = raw_csv.write_archive

    def write_while_files_land(*args, **options):
        write(*args, **options)
        (landing / "2019-10-01-09-01-00-0.csv").write_text(f"{header}\n{odd}\n")

    with monkeypatch.context() as patch:
        patch.setattr(raw_csv, "write_archive", write_while_files_land)
        jobs.archive(spark, str(landing), target, remove_sources=True)
    assert sorted(os.listdir(landing)) == ["2019-10-01-09-01-00-0.csv", "2019-10-01-11-00-00-0.csv"]
    text = raw_csv.read_archive_text(spark, target)
    assert text.columns == ["row_idx", *header.split(",")[1:], "block"]
    assert sorted(tuple(r) for r in text.collect()) == [
        ("7", "2019-10-01 09:00:01 UTC", "view", "A55", "x", "a.b", ' b "q", c', "12.345", "99", "s1", "2019-10-01-09"),
        ("8", "no time", "view", "5", "7", None, "acme", "no price", "98", None, "2019-10-01-09"),
    ]
    jobs.archive(spark, str(landing), target, remove_sources=True)
    assert raw_csv.read_archive_text(spark, target).count() == 3


def test_archive_by_day_and_wrong_block(spark, tmp_path):
    landing, target = tmp_path / "in", str(tmp_path / "archive")
    put(landing, "2019-10-01-09-00-00-0.csv", line(1, "09:00:01"))
    put(landing, "2019-10-02-00-01-00-0.csv", line(2, "00:01:01"))
    assert jobs.archive(spark, str(landing), target, "day") == ["2019-10-01"]
    with pytest.raises(ValueError):
        jobs.archive(spark, str(landing), target, "week")


def test_landing_files_round_trip(spark, tmp_path, raw):
    events = raw(
        ("2019-10-01 00:00:00", "view", 1, 1, "s1", "acme", "a.b"),
        ("2019-10-01 00:29:30", "view", 2, None, None),
        ("2019-10-01 00:30:00", "purchase", 3, "2.50", "s2"),
    )
    folder = str(tmp_path / "landing")
    jobs.land(events, folder, factor=30)
    got = raw_csv.read_raw(spark, folder)
    assert rows(got, "row_idx", "event_time", "price", "user_session", "file_time", "server") == [
        (0, "2019-10-01 00:00:00", 1.0, "s1", "2019-10-01 00:00:00", 0),
        (1, "2019-10-01 00:00:59", None, None, "2019-10-01 00:00:00", 1),
        (2, "2019-10-01 00:01:00", 2.5, "s2", "2019-10-01 00:01:00", 0),
    ]
    assert sorted(p for p in os.listdir(folder) if p.startswith("file")) == [
        "file_key=2019-10-01-00-00-00-0",
        "file_key=2019-10-01-00-00-00-1",
        "file_key=2019-10-01-00-01-00-0",
    ]
    ids = {name: events[name].cast("string") for name in ("product_id", "category_id")}
    assert same(got.select(*events.columns).drop("event_time"), events.withColumns(ids).drop("event_time"))
