"""Changes of stored tiers that die at any step, and writers beside each other."""

import pytest
from comparing import rows, same
from test_tiers import at

from tierline import workspace
from tierline.operators.clock import trusted_clock, trusted_label
from tierline.operators.tiers import merge, roll_up
from tierline.plans import jobs
from tierline.schema import HOUR
from tierline.sources import tier_table, versions
from tierline.sources.tier_table import read_tier, write_tier


class Lost(Exception):
    pass


def labels(*hours, day=1, count=1):
    return [("view", "brand", "b", f"2019-10-0{day} {h:02}:{m:02}:00", 1, count) for h in hours for m in (0, 20, 40)]


@pytest.fixture
def dies(monkeypatch):
    """Run a job that is lost at its n-th step, before the step or after it; False once it ends."""

    def run(job, lost_at, after):
        steps = [0]

        def counted(step):
            def call(*args, **options):
                steps[0] += 1
                if steps[0] == lost_at and not after:
                    raise Lost
                result = step(*args, **options)
                if steps[0] == lost_at:
                    raise Lost
                return result

            return call

        with monkeypatch.context() as patch:
            patch.setattr(workspace, "create_once", counted(workspace.create_once))
            patch.setattr(versions, "write_segments", counted(versions.write_segments))
            try:
                job()
            except Lost:
                return True
        return False

    return run


def minutes_and_hours(spark, tier, tmp_path, n):
    places = str(tmp_path / f"minutes-{n}"), str(tmp_path / f"hours-{n}")
    write_tier(tier(*labels(8, 9, 10)), places[0], "first")
    write_tier(tier(*labels(10, 11, 12)), places[0], "second")
    return places


LATE = [("view", "brand", "b", "2019-10-01 08:20:00", 5, 5), ("view", "brand", None, "2019-10-01 09:00:00", 1, 1)]


@pytest.mark.parametrize("name", ["store", "transport", "backlog", "compact", "retain"])
def test_a_job_lost_at_any_step_is_repeated(spark, tmp_path, tier, dies, name):
    whole = [*labels(8, 9, 10), *labels(10, 11, 12), *labels(12, 13)]

    def lost_at(n, after):
        minutes, hours = minutes_and_hours(spark, tier, tmp_path, f"{n}-{after}")
        late = tier(*LATE)
        if name == "backlog":
            jobs.transport(spark, minutes, hours)
        job = {
            "store": lambda: write_tier(late, minutes, "late files"),
            "transport": lambda: jobs.transport(spark, minutes, hours),
            "backlog": lambda: jobs.process_backlog(spark, late, minutes, hours, "late files"),
            "compact": lambda: jobs.compact_tier(spark, minutes),
            "retain": lambda: jobs.retain_tier(spark, minutes, 24, now=at("2019-10-02 09:00:00")),
        }[name]
        lost = dies(job, n, after)
        write_tier(tier(*labels(12, 13)), minutes, "between")  # others go on meanwhile
        if name == "backlog":
            jobs.transport(spark, minutes, hours)
        job()
        job()
        expected = tier(*whole, *(LATE if name in ("store", "backlog") else []))
        if name == "retain":
            expected = expected.where("bucket_end >= timestamp'2019-10-01 09:00:00'")
        assert same(read_tier(spark, minutes), merge(expected))
        if name in ("transport", "backlog"):
            done = expected.where("bucket_end < timestamp'2019-10-01 13:00:00'")
            assert same(read_tier(spark, hours), roll_up(done, HOUR))
        return lost

    steps = {"store": 3, "transport": 3, "backlog": 6, "compact": 3, "retain": 3}[name]
    assert all(lost_at(n, after=n % 2 == 0) for n in range(1, steps + 1))


def test_a_transport_that_missed_late_rows_begins_anew(spark, tmp_path, tier, monkeypatch):
    minutes, hours = minutes_and_hours(spark, tier, tmp_path, 0)
    late, write_rows = tier(*LATE), jobs.write_rows
    between = [lambda: jobs.process_backlog(spark, late, minutes, hours, "late files")]

    def written(rows, path):
        added = write_rows(rows, path)
        if path == hours and between:
            between.pop()()
        return added

    monkeypatch.setattr(jobs, "write_rows", written)
    jobs.transport(spark, minutes, hours)
    done = tier(*labels(8, 9, 10), *labels(10, 11), *LATE)
    assert same(read_tier(spark, hours), roll_up(done, HOUR))


def test_late_rows_reach_hours_transported_meanwhile(spark, tmp_path, tier, monkeypatch):
    """A transport comes between the late minutes and their hours."""
    minutes, hours = minutes_and_hours(spark, tier, tmp_path, 0)
    late, write_rows = tier(*LATE), jobs.write_rows
    between = [lambda: jobs.transport(spark, minutes, hours)]

    def written(rows, path):
        if path == minutes and between:
            between.pop()()  # the transport reads the minutes without the late rows
        return write_rows(rows, path)

    monkeypatch.setattr(jobs, "write_rows", written)
    jobs.process_backlog(spark, late, minutes, hours, "late files")
    done = tier(*labels(8, 9, 10), *labels(10, 11), *LATE)
    assert same(read_tier(spark, hours), roll_up(done, HOUR))


def test_compactions_beside_each_other(spark, tmp_path, tier, monkeypatch):
    minutes, _ = minutes_and_hours(spark, tier, tmp_path, 0)
    write_rows = tier_table.write_rows
    between = [lambda: jobs.compact_tier(spark, minutes), lambda: write_tier(tier(*labels(12)), minutes)]

    def written(rows, path):
        if between:
            between.pop()()
        return write_rows(rows, path)

    monkeypatch.setattr(tier_table, "write_rows", written)
    jobs.compact_tier(spark, minutes)
    assert same(read_tier(spark, minutes), merge(tier(*labels(8, 9, 10), *labels(10, 11, 12), *labels(12))))


def test_only_one_writer_makes_a_version(spark, tmp_path):
    path = str(tmp_path / "file")
    assert workspace.create_once(spark, path, "one") and not workspace.create_once(spark, path, "two")
    assert workspace.read_text(spark, path) == "one"
    assert [p.name for p in tmp_path.iterdir() if p.suffix == ".draft"] == []


def test_vacuum_leaves_what_readers_may_need(spark, tmp_path, tier):
    minutes, _ = minutes_and_hours(spark, tier, tmp_path, 0)
    before = read_tier(spark, minutes)
    died = tier_table.write_rows(tier(*labels(12)), minutes)
    jobs.compact_tier(spark, minutes)
    after = rows(read_tier(spark, minutes))
    assert rows(before) == after  # replaced segments stay for a while
    versions.vacuum(spark, minutes, grace=-1, attempt=-1)
    assert rows(read_tier(spark, minutes)) == after
    folders = {f.name for f in (tmp_path / "minutes-0" / "data").iterdir() if f.is_dir()}
    assert folders == {f"commit={versions.latest(spark, minutes).segments[0].commit}"}
    assert died[0].commit not in str(folders)
    assert versions.applied(spark, minutes, "first") == 1


def test_clock_by_mass():
    day = [(hour, 100, hour * HOUR) for hour in range(48)]
    assert trusted_label(day) == 47 * HOUR
    assert trusted_label([*day, (5000, 19, 5000 * HOUR)]) == 47 * HOUR
    assert trusted_label([*day, (49, 9, 49 * HOUR)]) == 47 * HOUR
    assert trusted_label([*day, (48, 1, 48 * HOUR)]) == 48 * HOUR  # the start of an hour
    assert trusted_label([*day, (5000, 30, 5000 * HOUR), (5001, 60, 5001 * HOUR)]) == 5001 * HOUR
    assert trusted_label([(7, 1, 7)]) == 7 and trusted_label([]) is None
    with pytest.raises(ValueError):
        trusted_label([(7, 1, 7), (7 + 24 * 40, 1, 9)])


def test_other_events_support_the_clock_of_views_that_run_dry(spark, tmp_path, tier):
    """Views count once a pair, so few are left when all pairs have been seen; the shop goes on."""
    views = {hour: 400 >> 2 * hour for hour in range(5)}  # 400, 100, 25, 6, 1
    rows_of = [(e, "brand", h, n, h * HOUR) for e, own in (("view", views), ("purchase", dict.fromkeys(range(5), 30))) for h, n in own.items()]
    assert trusted_clock(rows_of, "view") == 4 * HOUR
    assert trusted_clock([r for r in rows_of if r[0] == "view"], "view") == 2 * HOUR
    # One view of a wrong date, and purchases too few to judge by, move nothing.
    ahead = [("view", "brand", 900, 1, 900 * HOUR), ("click", "brand", 900, 3, 900 * HOUR)]
    assert trusted_clock([*rows_of, *ahead], "view") == 4 * HOUR
    # Purchases ahead of the views support no label of theirs.
    assert trusted_clock([*rows_of, ("purchase", "brand", 5, 30, 5 * HOUR)], "view") == 4 * HOUR
    minutes, hours = str(tmp_path / "minutes"), str(tmp_path / "hours")
    write_tier(
        tier(
            *[("view", "brand", "b", f"2019-10-01 0{h}:30:00", 1, n) for h, n in views.items()],
            *[("purchase", "brand", "b", f"2019-10-01 0{h}:40:00", 1, 30) for h in range(5)],
        ),
        minutes,
    )
    assert rows(jobs.rank(spark, minutes), "event_type", "event_count") == [("purchase", 30), ("view", 1)]
    jobs.transport(spark, minutes, hours)
    assert read_tier(spark, hours, "view").count() == 4
