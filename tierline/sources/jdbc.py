"""Serving tables over JDBC, one per (event, dimension) and tier."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierline.operators.metrics import from_table, table


def table_name(event: str, dim: str, suffix: str) -> str:
    return f"{event}_{dim}_{suffix}"


def read_options(url: str, event: str, dim: str, suffix: str, start: str, end: str, tasks: int) -> dict:
    """Reader options; the time range is read by `tasks` parallel queries."""
    return {
        "url": url,
        "dbtable": table_name(event, dim, suffix),
        "partitionColumn": "bucket_end",
        "lowerBound": start,
        "upperBound": end,
        "numPartitions": str(tasks),
        "fetchsize": "10000",
    }


def write_options(url: str, event: str, dim: str, suffix: str, tasks: int) -> dict:
    return {
        "url": url,
        "dbtable": table_name(event, dim, suffix),
        "numPartitions": str(tasks),
        "batchsize": "10000",
        "truncate": "true",
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    event: str,
    dim: str,
    suffix: str,
    start: str,
    end: str,
    tasks: int = 16,
    **connection: str,
) -> DataFrame:
    """Metric rows of one table with start <= bucket_end <= end, filtered by the database."""
    rows = (
        spark.read.format("jdbc")
        .options(**read_options(url, event, dim, suffix, start, end, tasks), **connection)
        .load()
        .where(F.col("bucket_end").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    )
    return from_table(rows, event, dim)


def write_jdbc(
    metrics: DataFrame,
    url: str,
    event: str,
    dim: str,
    suffix: str,
    mode: str = "append",
    tasks: int = 16,
    **connection: str,
) -> None:
    """Publish one (event, dimension) table; a rank table has no time column."""
    rows = table(metrics, event, dim, time=None if suffix == "rank" else "bucket_end")
    (
        rows.write.format("jdbc")
        .options(**write_options(url, event, dim, suffix, tasks), **connection)
        .mode(mode)
        .save()
    )
