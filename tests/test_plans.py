"""The shape of the plans, and what they do with hot keys."""

import re

import pytest
from comparing import plan, rows, same
from pyspark.sql import functions as F
from test_tiers import at, spread_events

from tierline.functions.timegrid import half_open
from tierline.operators import tiers as ti
from tierline.operators.events import assign_servers, first_views
from tierline.plans.jobs import ingest
from tierline.plans.queries import QUERIES
from tierline.sources.sample_tables import product_events, sample_events

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def stored_events(spark, tmp_path):
    path = str(tmp_path / "events")
    spread_events(spark).write.parquet(path)
    return spark.read.parquet(path)


def test_flagship_reads_once_and_stays_in_the_jvm(stored_events):
    text = plan(ingest(stored_events))
    tree = text.split("\n\n")[0]
    # Views and purchases are read apart, each by a filter on its event type.
    assert tree.count("Scan parquet") == 2
    assert text.count("EqualNullSafe(event_type,view)") == 2
    assert tree.count("Expand") == 1
    assert tree.count("Exchange") == 3  # dedup, combinations, dimensions
    assert "SinglePartition" not in text
    assert "Python" not in text


def test_event_type_filter_reaches_the_scan(stored_events):
    text = plan(ingest(stored_events, event_types=("view",), dimensions=("brand",)))
    assert re.search(r"PushedFilters: \[[^\n]*event_type", text)


def test_scan_reads_needed_columns_only(stored_events):
    text = plan(ingest(stored_events, deduplicate=False, dimensions=("product_id",)))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(re.findall(r"(\w+):", schema)) == {"event_time", "event_type", "product_id", "price"}


def test_time_slice_reaches_the_scan(stored_events):
    cut = half_open(F.col("event_time"), at("2019-10-01 01:00:00"), at("2019-10-01 02:00:00"))
    assert re.search(r"PushedFilters: \[[^\n]*event_time", plan(stored_events.where(cut)))


def test_dedup_limits_groups_before_the_shuffle(stored_events):
    text = plan(first_views(stored_events))
    tree = text.split("\n\n")[0]
    assert tree.count("WindowGroupLimit") == 2
    first, last = (m.start() for m in re.finditer("WindowGroupLimit", tree))
    assert first < tree.index("Exchange") < last


def test_top_limits_groups_before_the_shuffle(stored_events):
    minutes = ingest(stored_events, deduplicate=False)
    text = plan(ti.top(ti.trailing_totals(minutes, at("2019-10-01 10:00:00")), 5))
    assert text.split("\n\n")[0].count("WindowGroupLimit") == 2


def test_no_python_in_any_batch_query(spark):
    for name in ("server_shards", "hour_tier", "rolling_hour_series", "late_split", "clean_dimensions"):
        text = plan(QUERIES[name](spark, FOLDER))
        assert "Python" not in text, name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_hot_product_is_split_when_the_product_table_cannot_be_broadcast(spark):
    """Four fifths of the events on one product, and a product side above every threshold."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    many = spark.range(200_000, numPartitions=8).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp_ntz'2024-01-01 00:00:00'").alias("ts"),
        (F.col("id") % 50).alias("user_id"),
        F.lit("view").alias("event_type"),
        F.lit(1.5).alias("value"),
        F.concat(F.lit('{"k": '), F.when(F.col("id") % 5 > 0, F.lit(3)).otherwise(F.col("id") % 100), F.lit("}")).alias("props"),
    )
    part = spark.range(100).select(
        F.col("id").alias("p_partkey"),
        F.lit("red bolt").alias("p_name"),
        F.lit("Brand").alias("p_brand"),
        F.lit("SMALL").alias("p_type"),
        F.lit(1).alias("p_size"),
    )
    assert many.columns == sample_events(spark, FOLDER).columns
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = product_events(many, part).agg(
            F.count("*").alias("n"), F.sum("row_idx").alias("ids"), F.max("brand").alias("brand")
        )
        total = joined.collect()[0]
        text = plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    assert (total.n, total.ids) == (200_000, 200_000 * 199_999 // 2)
    assert "SortMergeJoin(skew=true)" in text


def test_hot_groups_give_the_same_result_as_small_ones(spark):
    """A third of all views are one product without a session."""
    hot = spread_events(spark, 9000).where("event_type = 'view'")
    kept = first_views(hot)
    expected = hot.groupBy("user_session", "product_id").agg(
        F.min(F.struct("event_time", "row_idx"))["row_idx"].alias("row_idx")
    )
    assert same(kept.select("row_idx"), expected.select("row_idx"))


def test_chunked_ranking_never_sorts_a_whole_minute(spark):
    dealt = assign_servers(spread_events(spark).select("row_idx", "event_time"))
    windows = re.findall(r"row_number\(\) windowspecdefinition\(([^)]*?)specified", plan(dealt))
    assert windows and all("id_chunk" in window for window in windows)
    assert len(rows(dealt, "row_idx")) == 3000


def test_servers_are_dealt_with_one_sort_of_the_rows(spark):
    """The window's sort serves the join with the offsets, where that is not broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = plan(assign_servers(spread_events(spark)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    wide = [line for line in re.findall(r"\n\(\d+\) Sort[^\n]*\nInput \[\d+\]: \[([^\n]*)\]", text) if "user_session" in line]
    assert len(wide) == 1
