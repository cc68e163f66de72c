"""Measures of a metric row."""

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from tierline.schema import MONEY_SUM

CENTS = "decimal(30,0)"


def price_cents() -> Column:
    """Exact sum of raw prices in cents: integer sums cost a fraction of decimal ones.

    The cents of one price fit 64 bits with room for less than a dozen of the largest, so they are
    summed in two halves, either of which takes four billion prices, and put together as decimals.
    """
    cents = (F.col("price") * 100).cast("bigint")
    high = F.sum(F.shiftright(cents, 32))
    low = F.sum(cents.bitwiseAND(F.lit((1 << 32) - 1)))
    wide = high.cast("decimal(20,0)") * F.lit(Decimal(1 << 32)) + low.cast("decimal(20,0)")
    return wide.cast(CENTS).alias("cents")


def merged_cents() -> Column:
    return F.sum("cents").cast(CENTS).alias("cents")


def money(cents: Column) -> Column:
    """Cents as the money type of a tier."""
    return (cents * F.lit(Decimal("0.01"))).cast(MONEY_SUM)


def priced_events() -> Column:
    """Events with a price; a group without any has 0."""
    return F.count("price").alias("event_count")


def merged_total() -> Column:
    return F.sum("price_sum").cast(MONEY_SUM).alias("price_sum")


def merged_count() -> Column:
    return F.sum("event_count").alias("event_count")


def amount(total: Column) -> Column:
    return total.cast("double")


def average(total: Column, count: Column) -> Column:
    """total / count, NULL for a count of 0."""
    return F.try_divide(total.cast("double"), count.cast("double"))


def weighted_average(averages: Column, counts: Column) -> Column:
    """Aggregate: the average of all events behind stored (count, average) pairs."""
    return F.try_divide(F.sum(counts * averages), F.sum(counts).cast("double"))
