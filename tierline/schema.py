"""Column layouts and fixed values shared by every module."""

from pyspark.sql import types as T

# Event types and dimensions that have metrics.
EVENTS = ("purchase", "view")
DIMENSIONS = ("product_id", "brand", "category_l3")
ALL_DIMENSIONS = ("product_id", "brand", "category_l1", "category_l2", "category_l3")

# Bucket widths in seconds.
MINUTE = 60
HOUR = 3600
DAY = 86400

# The bucket grid starts here, and an empty tier reports it as its clock.
GRID_START = "2019-10-01 00:00:00"
GRID_START_EPOCH = 1569888000
# Fixed value: newest and oldest time of a folder without dated files.
EMPTY_FOLDER_TIME = "2019-09-30 23:00:00"

MONEY = T.DecimalType(18, 2)
MONEY_SUM = T.DecimalType(28, 2)

# A raw event as text, in file column order; the first header cell is blank.
RAW_TEXT = T.StructType(
    [
        T.StructField(name, T.StringType())
        for name in (
            "row_idx",
            "event_time",
            "event_type",
            "product_id",
            "category_id",
            "category_code",
            "brand",
            "price",
            "user_session",
        )
    ]
)

# One metric row, the same in every tier.
TIER = T.StructType(
    [
        T.StructField("event_type", T.StringType()),
        T.StructField("dim", T.StringType()),
        T.StructField("dim_value", T.StringType()),
        T.StructField("bucket_end", T.TimestampType()),
        T.StructField("price_sum", MONEY_SUM),
        T.StructField("event_count", T.LongType()),
    ]
)
TIER_KEYS = ("event_type", "dim", "dim_value", "bucket_end")
TIER_COLUMNS = tuple(TIER.fieldNames())

# Directory levels of a stored tier.
PARTITIONS = ("event_type", "dim", "bucket_date")
STORED_TIER = T.StructType([*TIER.fields, T.StructField("bucket_date", T.DateType())])


def check_configuration(events, dimensions):
    """Refuse event types and dimensions that have no defined metrics."""
    for given, known, what in (
        (events, EVENTS, "event types"),
        (dimensions, ALL_DIMENSIONS, "dimensions"),
    ):
        unknown = sorted(set(given) - set(known))
        if unknown or not given:
            raise ValueError(f"{what} must come from {list(known)}, got {list(given)}")
