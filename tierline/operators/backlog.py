"""Late metric rows against stored ones."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.operators.tiers import merge


def with_bucket_date(metrics: DataFrame) -> DataFrame:
    return metrics.withColumn("bucket_date", F.to_date("bucket_end"))


def repaired(stored: DataFrame, late: DataFrame) -> DataFrame:
    """Stored and late rows as one tier. Sums are additive, so no bucket needs its events."""
    return merge(stored.unionByName(late))
