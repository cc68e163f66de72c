"""Aggregation of events to metric rows, and the per-table shapes."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.functions import measures
from tierline.functions.clean import clean_events, valid
from tierline.operators.events import first_views, split_events, with_bucket
from tierline.schema import (
    DIMENSIONS,
    EVENTS,
    MINUTE,
    MONEY_SUM,
    TIER_COLUMNS,
    check_configuration,
)


def by_dimension(
    events: DataFrame,
    dimensions=DIMENSIONS,
    scope: tuple[str, ...] = (),
    count_rows: bool = False,
) -> DataFrame:
    """Metric rows of every dimension from one pass over bucketed events.

    `count_rows` adds `event_rows`, the number of events with or without a price.

    Events are first summed for each combination of dimension values, so the fan-out to
    grouping sets multiplies those sums and not the events. All sums have map-side
    partial aggregation, which absorbs hot products, brands and minutes.
    """
    check_configuration(EVENTS, dimensions)
    keys = [*scope, "event_type", "bucket_end"]
    combined = events.groupBy(*keys, *dimensions).agg(
        measures.price_cents(), measures.priced_events(), F.count("*").alias("event_rows")
    )
    fanned = combined.groupingSets(
        [[*keys, dim] for dim in dimensions], *keys, *dimensions
    ).agg(
        measures.merged_cents(),
        measures.merged_count(),
        F.sum("event_rows").alias("event_rows"),
        *[F.grouping(dim).alias(f"_no_{dim}") for dim in dimensions],
    )
    # A NULL value is a real group (deep category paths), so ask grouping(), not IS NULL.
    name = F.coalesce(*[F.when(F.col(f"_no_{dim}") == 0, F.lit(dim)) for dim in dimensions])
    value = F.coalesce(*[F.when(F.col(f"_no_{dim}") == 0, F.col(dim)) for dim in dimensions])
    return fanned.select(
        *scope,
        "event_type",
        name.alias("dim"),
        value.alias("dim_value"),
        "bucket_end",
        measures.money(F.col("cents")).alias("price_sum"),
        "event_count",
        *["event_rows"] * count_rows,
    )


def minute_metrics(
    events: DataFrame,
    event_types=EVENTS,
    dimensions=DIMENSIONS,
    step: int = MINUTE,
    deduplicate: bool = True,
    scope: tuple[str, ...] = (),
    count_rows: bool = False,
) -> DataFrame:
    """Raw typed events to minute metric rows.

    Repeated views go first, so that the rest is done for counted events only.
    """
    chosen = split_events(valid(events), event_types)
    if deduplicate:
        chosen = first_views(chosen, scope)
    return by_dimension(with_bucket(clean_events(chosen), step), dimensions, scope, count_rows)


def published(metrics: DataFrame, time: str | None = "bucket_end") -> DataFrame:
    """Metric rows with the measures that the (event, dimension) pair shows, others NULL."""
    product = F.col("dim") == "product_id"
    purchase = F.col("event_type") == "purchase"
    return metrics.select(
        "event_type",
        "dim",
        "dim_value",
        *([time] if time else []),
        F.when(purchase, measures.amount(F.col("price_sum"))).alias("gmv"),
        F.when(product | ~purchase, F.col("event_count")).alias("event_count"),
        F.when(
            product, measures.average(F.col("price_sum"), F.col("event_count"))
        ).alias("avg_price"),
    )


def table_columns(event: str, dim: str) -> list[str]:
    """Measures of one (event, dimension) table."""
    check_configuration((event,), (dim,))
    columns = ["gmv"] if event == "purchase" else []
    if event == "view" or dim == "product_id":
        columns.append("event_count")
    if dim == "product_id":
        columns.append("avg_price")
    return columns


def table(metrics: DataFrame, event: str, dim: str, time: str | None = "bucket_end") -> DataFrame:
    """One (event, dimension) table of a tier; `time=None` for a rank table."""
    chosen = metrics.where((F.col("event_type") == event) & (F.col("dim") == dim))
    return published(chosen, time).select(
        F.col("dim_value").alias(dim),
        *([time] if time else []),
        *table_columns(event, dim),
    )


def from_table(rows: DataFrame, event: str, dim: str) -> DataFrame:
    """Metric rows from one (event, dimension) table; measures it lacks are NULL."""
    present = table_columns(event, dim)
    if "gmv" in present:
        total = F.col("gmv")
    elif "avg_price" in present:
        total = F.col("avg_price") * F.col("event_count")
    else:
        total = F.lit(None)
    count = F.col("event_count") if "event_count" in present else F.lit(None)
    return rows.select(
        F.lit(event).alias("event_type"),
        F.lit(dim).alias("dim"),
        F.col(dim).alias("dim_value"),
        "bucket_end",
        total.cast(MONEY_SUM).alias("price_sum"),
        count.cast("bigint").alias("event_count"),
    ).select(*TIER_COLUMNS)


def merge_table(rows: DataFrame, event: str, dim: str, rank: bool = False) -> DataFrame:
    """Merge duplicate rows of one (event, dimension) table on its own columns."""
    measure = {
        "gmv": F.sum("gmv"),
        "event_count": F.sum("event_count"),
        "avg_price": (
            F.try_divide(F.sum("gmv"), F.sum("event_count").cast("double"))
            if event == "purchase"
            else measures.weighted_average(F.col("avg_price"), F.col("event_count"))
        ),
    }
    keys = [dim] if rank else [dim, "bucket_end"]
    return rows.groupBy(*keys).agg(
        *[measure[name].alias(name) for name in table_columns(event, dim)]
    )
