import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tierline-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


RAW_SCHEMA = (
    "row_idx bigint, event_time string, event_type string, product_id bigint, category_id bigint,"
    " category_code string, brand string, price decimal(18,2), user_session string"
)


@pytest.fixture
def raw(spark):
    """Raw typed events from short tuples: (time, type, product, price, session, brand, code)."""
    from pyspark.sql import functions as F

    def make(*rows):
        full = []
        for index, row in enumerate(rows):
            time, kind, product, price, session, brand, code = (
                *row,
                *(None,) * (7 - len(row)),
            )
            money = None if price is None else Decimal(str(price))
            full.append((index, time, kind, product, 900 + product, code, brand, money, session))
        frame = spark.createDataFrame(full, RAW_SCHEMA)
        return frame.withColumn("event_time", F.col("event_time").cast("timestamp"))

    return make


@pytest.fixture
def tier(spark):
    """Metric rows from tuples: (event, dim, value, label, sum, count)."""
    from pyspark.sql import functions as F

    from tierline.schema import TIER_COLUMNS

    def make(*rows):
        frame = spark.createDataFrame(
            [(e, d, v, t, None if s is None else str(s), c) for e, d, v, t, s, c in rows],
            "event_type string, dim string, dim_value string, bucket_end string,"
            " price_sum string, event_count bigint",
        )
        return frame.withColumns(
            {
                "bucket_end": F.col("bucket_end").cast("timestamp"),
                "price_sum": F.col("price_sum").cast("decimal(28,2)"),
            }
        ).select(*TIER_COLUMNS)

    return make
