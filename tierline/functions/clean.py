"""Typing, null filling and category levels."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.timegrid import parse_event_time
from tierline.schema import MONEY


def type_raw(text: DataFrame) -> DataFrame:
    """Raw text columns to typed ones; bad numbers and times become NULL.

    Ids of products and categories need not be numbers and stay text, as do other columns.
    """
    return text.withColumns(
        {
            "row_idx": F.col("row_idx").try_cast("bigint"),
            "event_time": parse_event_time(F.col("event_time")),
            "price": F.col("price").try_cast(MONEY),
        }
    )


def valid(events: DataFrame) -> DataFrame:
    """Rows that may enter a tier."""
    return events.where(F.col("event_time").isNotNull())


def rejects(events: DataFrame) -> DataFrame:
    """Rows without a readable time."""
    return events.where(F.col("event_time").isNull())


def fill_brand(brand: Column, product_id: Column) -> Column:
    return F.coalesce(brand, product_id.cast("string"))


def category_levels(code: Column, category_id: Column) -> list[Column]:
    """Three levels; a short path repeats its last part, a path of four or more has none."""
    parts = F.split(F.coalesce(code, category_id.cast("string")), "[.]")
    depth = F.size(parts)
    return [
        F.when(depth <= 3, F.get(parts, F.least(F.lit(level), depth - 1)))
        for level in range(3)
    ]


def clean_events(events: DataFrame) -> DataFrame:
    """Dimensions as text: product, filled brand, three category levels."""
    l1, l2, l3 = category_levels(F.col("category_code"), F.col("category_id"))
    return events.withColumns(
        {
            "brand": fill_brand(F.col("brand"), F.col("product_id")),
            "product_id": F.col("product_id").cast("string"),
            "category_l1": l1,
            "category_l2": l2,
            "category_l3": l3,
        }
    ).drop("category_id", "category_code")
