from comparing import rows, same
from pyspark.sql import functions as F

from tierline.functions import measures
from tierline.operators import tiers as ti
from tierline.plans.jobs import finished_hours, ingest
from tierline.schema import DAY, HOUR, MINUTE, TIER_COLUMNS


def at(text):
    return F.lit(text).cast("timestamp")


def spread_events(spark, n=3000):
    """Events over two days with a hot product, NULL sessions, NULL prices and NULL categories."""
    hot = F.col("id") % 3 == 0
    return spark.range(n).select(
        F.col("id").alias("row_idx"),
        F.timestamp_seconds(F.lit(1569888000) + F.pmod(F.col("id") * 7919, F.lit(2 * DAY))).alias("event_time"),
        F.when(F.col("id") % 2 == 0, F.lit("view")).otherwise(F.lit("purchase")).alias("event_type"),
        F.when(hot, F.lit(1)).otherwise(F.col("id") % 40).cast("bigint").alias("product_id"),
        (F.col("id") % 9).alias("category_id"),
        F.when(F.col("id") % 5 == 0, F.lit("a.b.c.d")).when(F.col("id") % 5 == 1, F.lit("a.b")).alias("category_code"),
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("b"), F.col("id") % 4)).alias("brand"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 500) / 100).cast("decimal(18,2)").alias("price"),
        F.when(~hot, F.concat(F.lit("s"), F.col("id") % 13)).alias("user_session"),
    )


def test_hour_label_from_minute_labels(tier):
    minutes = tier(
        *[("view", "brand", "b", f"2019-10-01 {t}:00", 1, 1) for t in ("09:00", "09:59", "10:00")]
    )
    assert rows(ti.roll_up(minutes, HOUR), "bucket_end", "event_count") == [
        ("2019-10-01 10:00:00", 2),
        ("2019-10-01 11:00:00", 1),
    ]
    aligned = ti.roll_up(minutes, HOUR, source_step=MINUTE)
    assert rows(aligned, "bucket_end", "event_count") == [
        ("2019-10-01 09:00:00", 1),
        ("2019-10-01 10:00:00", 2),
    ]


def test_any_split_merges_to_the_same_tier(spark):
    events = spread_events(spark)
    whole = ingest(events, deduplicate=False)
    parts = [
        ingest(events.where(F.pmod(F.hash("row_idx"), F.lit(3)) == n), deduplicate=False)
        for n in range(3)
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    assert same(ti.merge(union), whole)


def test_roll_up_is_associative(spark):
    minutes = ingest(spread_events(spark))
    quarter = ti.roll_up(minutes, 900, MINUTE)
    assert same(ti.roll_up(quarter, HOUR, 900), ti.roll_up(minutes, HOUR, MINUTE))
    days = ti.roll_up(ti.roll_up(minutes, HOUR, MINUTE), DAY, HOUR)
    assert same(days, ti.roll_up(minutes, DAY, MINUTE))


def test_event_aligned_hours_equal_direct_aggregation(spark):
    events = spread_events(spark)
    assert same(
        ti.roll_up(ingest(events), HOUR, MINUTE), ingest(events, step=HOUR).select(*TIER_COLUMNS)
    )


def test_finished_hours(tier):
    minutes = tier(
        *[
            ("view", "category_l3", "c", f"2019-10-01 {t}:00", 1, 1)
            for t in ("07:59", "08:00", "08:59", "09:00", "09:59", "10:00", "10:01")
        ]
    )
    ready = finished_hours(minutes, at("2019-10-01 08:00:00"), at("2019-10-01 10:01:00"))
    assert rows(ready, "bucket_end", "event_count") == [
        ("2019-10-01 09:00:00", 2),
        ("2019-10-01 10:00:00", 2),
    ]
    early = finished_hours(minutes, at("2019-10-01 08:00:00"), at("2019-10-01 07:30:00"))
    assert early.isEmpty()


def test_clock(tier):
    rows_ = tier(
        ("view", "category_l3", "c", "2019-10-01 09:00:00", 1, 1),
        ("view", "category_l3", "c", "2019-10-01 11:00:00", 1, 1),
        ("view", "category_l3", "c", None, 1, 1),
        ("purchase", "brand", "c", "2019-10-01 12:00:00", 1, 1),
    )
    assert rows(ti.clock(rows_)) == [("2019-10-01 11:00:00",)]
    assert rows(ti.clock(rows_, newest=False)) == [("2019-10-01 09:00:00",)]
    assert rows(ti.clock(rows_, event=None, dim=None)) == [("2019-10-01 12:00:00",)]
    assert rows(ti.clock(rows_.limit(0))) == [("2019-10-01 00:00:00",)]


def test_read_clock_is_the_same_instant_in_any_session_zone(spark, tier):
    metrics = tier(("view", "category_l3", "c", "2019-10-27 01:30:00", 1, 1)).cache()
    metrics.count()
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        value = spark.range(1).select(F.unix_seconds(ti.read_clock(metrics))).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        metrics.unpersist()
    assert value == 1572139800


def test_trailing_hour_holds_sixty_labels(tier):
    minutes = tier(
        *[("view", "brand", "b", f"2019-10-01 {t}:00", 1, 1) for t in ("09:00", "09:01", "10:00", "10:01")]
    )
    totals = ti.trailing_totals(minutes, at("2019-10-01 10:00:00"))
    assert rows(totals) == [("view", "brand", "b", 2.0, 2)]


def test_trailing_series_against_a_plain_loop(spark):
    minutes = ingest(spread_events(spark), dimensions=("category_l3",))
    stored = [
        (r.event_type, r.dim_value, r.s, r.event_count)
        for r in minutes.select("*", F.unix_seconds("bucket_end").alias("s")).collect()
    ]
    expected = sorted(
        (e, str(v), s, sum(c for e2, v2, s2, c in stored if (e2, v2) == (e, v) and 0 <= s - s2 <= 3540))
        for e, v, s, _ in stored
    )
    series = ti.trailing_series(minutes).select("*", F.unix_seconds("bucket_end").alias("s"))
    got = sorted((r.event_type, str(r.dim_value), r.s, r.event_count) for r in series.collect())
    assert got == expected


def test_top_breaks_ties_by_value_and_shares_ranks(tier):
    metrics = tier(
        *[("view", "brand", v, "2019-10-01 10:00:00", 1, c) for v, c in zip("dcbae", (5, 7, 5, 5, 1))],
        ("purchase", "brand", "x", "2019-10-01 10:00:00", None, 0),
        ("purchase", "brand", "y", "2019-10-01 10:00:00", 3, 1),
    )
    totals = ti.trailing_totals(metrics, at("2019-10-01 10:00:00"))
    assert rows(ti.top(totals, 3), "event_type", "dim_value", "position", "rank") == [
        ("purchase", "x", 2, 2),
        ("purchase", "y", 1, 1),
        ("view", "a", 2, 2),
        ("view", "b", 3, 2),
        ("view", "c", 1, 1),
    ]


def test_retention_keeps_the_cutoff_and_is_idempotent(tier):
    now = at("2019-10-02 10:00:00")
    metrics = tier(
        *[
            ("view", "brand", "b", f"2019-10-0{t}:00", 1, 1)
            for t in ("1 09:59", "1 10:00", "2 10:00")
        ]
    )
    kept = ti.retain(metrics, now)
    assert rows(kept, "bucket_end") == [("2019-10-01 10:00:00",), ("2019-10-02 10:00:00",)]
    assert same(ti.retain(kept, now), kept)


def test_cents_become_money(spark):
    cents = spark.createDataFrame([(105,), (-5,), (None,)], "cents bigint")
    assert rows(cents.select(measures.money(F.col("cents")).alias("m"))) == [(-0.05,), (1.05,), (None,)]
