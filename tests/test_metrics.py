import pytest
from comparing import rows
from pyspark.sql import functions as F

from tierline.operators import metrics as me
from tierline.plans.jobs import ingest

T = "2019-10-01 10:15:00"


def test_one_pass_over_all_dimensions(raw):
    events = raw(
        (T, "purchase", 1, "10.50", "s1", "acme", "a.b.c"),
        ("2019-10-01 10:15:59", "purchase", 1, "0.25", "s1", "acme", "a.b.c"),
        (T, "view", 2, 3, "s1", "acme", "a.b.c.d"),
        ("2019-10-01 10:16:00", "view", 3, 4, "s1", "acme", "a"),
    )
    label, later = "2019-10-01 10:16:00", "2019-10-01 10:17:00"
    assert rows(ingest(events)) == sorted(
        [
            ("purchase", "product_id", "1", label, 10.75, 2),
            ("purchase", "brand", "acme", label, 10.75, 2),
            ("purchase", "category_l3", "c", label, 10.75, 2),
            ("view", "product_id", "2", label, 3.0, 1),
            ("view", "brand", "acme", label, 3.0, 1),
            ("view", "category_l3", None, label, 3.0, 1),
            ("view", "product_id", "3", later, 4.0, 1),
            ("view", "brand", "acme", later, 4.0, 1),
            ("view", "category_l3", "a", later, 4.0, 1),
        ],
        key=str,
    )


def test_null_prices_leave_an_empty_group(raw):
    metrics = ingest(raw((T, "purchase", 1, None)), dimensions=("product_id",))
    assert rows(metrics, "price_sum", "event_count") == [(None, 0)]
    shown = me.table(metrics, "purchase", "product_id")
    assert rows(shown, "gmv", "event_count", "avg_price") == [(None, 0, None)]


def test_large_sums_are_exact(raw):
    price = "9999999999999.99"
    events = raw(*[(T, "purchase", 1, price)] * 100)
    metrics = ingest(events, dimensions=("product_id",))
    assert str(metrics.first().price_sum) == "999999999999999.00"


@pytest.mark.parametrize(
    "event, dim, columns",
    [
        ("view", "product_id", ["product_id", "bucket_end", "event_count", "avg_price"]),
        ("purchase", "product_id", ["product_id", "bucket_end", "gmv", "event_count", "avg_price"]),
        ("view", "brand", ["brand", "bucket_end", "event_count"]),
        ("purchase", "category_l3", ["category_l3", "bucket_end", "gmv"]),
    ],
)
def test_tables_show_their_own_measures(raw, event, dim, columns):
    metrics = ingest(raw((T, event, 1, 2)))
    assert me.table(metrics, event, dim).columns == columns
    rank = me.table(metrics, event, dim, time=None)
    assert rank.columns == [name for name in columns if name != "bucket_end"]


@pytest.mark.parametrize("bad", [("cart",), ()])
def test_unknown_events_are_refused(raw, bad):
    with pytest.raises(ValueError):
        ingest(raw((T, "view", 1, 1)), event_types=bad)
    with pytest.raises(ValueError):
        ingest(raw((T, "view", 1, 1)), dimensions=bad)


def test_average_merge(spark):
    stored = spark.createDataFrame(
        [("p", 1, 10.0), ("p", 3, 2.0), ("q", 0, None)],
        "product_id string, event_count bigint, avg_price double",
    ).withColumn("bucket_end", F.lit(T).cast("timestamp"))
    for rank in (False, True):
        merged = me.merge_table(stored, "view", "product_id", rank)
        assert rows(merged, "product_id", "event_count", "avg_price") == [
            ("p", 4, 4.0),
            ("q", 0, None),
        ]


def test_merge_of_each_table_shape(spark):
    at = F.lit(T).cast("timestamp")
    sales = spark.createDataFrame(
        [("p", 6.0, 2, 3.0), ("p", 3.0, 1, 3.0)],
        "product_id string, gmv double, event_count bigint, avg_price double",
    ).withColumn("bucket_end", at)
    assert rows(me.merge_table(sales, "purchase", "product_id"), "gmv", "event_count", "avg_price") == [
        (9.0, 3, 3.0)
    ]
    views = spark.createDataFrame([("b", 2), ("b", 5)], "brand string, event_count bigint")
    assert rows(me.merge_table(views.withColumn("bucket_end", at), "view", "brand", rank=True)) == [("b", 7)]
    brand = spark.createDataFrame([("b", 2.5), ("b", 5.0)], "brand string, gmv double")
    assert rows(me.merge_table(brand.withColumn("bucket_end", at), "purchase", "brand", rank=True)) == [("b", 7.5)]


@pytest.mark.parametrize("event", ["view", "purchase"])
@pytest.mark.parametrize("dim", ["product_id", "brand"])
def test_tables_convert_back_to_metric_rows(raw, event, dim):
    metrics = ingest(
        raw((T, event, 1, 2.5, "s1", "acme"), (T, event, 2, 4, "s1", "acme")), dimensions=(dim,)
    )
    back = me.from_table(me.table(metrics, event, dim), event, dim)
    shown = me.table_columns(event, dim)
    again = me.table(back, event, dim)
    assert rows(again) == rows(me.table(metrics, event, dim))
    assert back.columns == metrics.columns and shown
