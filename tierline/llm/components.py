"""Connected components of a graph that is a table of edges."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline import workspace

EDGES = "a bigint, b bigint"


def _stored(frame: DataFrame, schema: str = EDGES) -> DataFrame:
    """Written out, so that no round hangs on the ones before it."""
    spark = frame.sparkSession
    place = workspace.new_folder(spark, "edges")
    frame.write.parquet(place)
    return spark.read.schema(schema).parquet(place)


def _least(edges: DataFrame) -> DataFrame:
    """The smallest neighbour of each node. Stored: its join with the edges then has no aggregate in
    the way, so that Spark sees its size, and splits the edges of a node that has most of them."""
    return _stored(edges.groupBy("a").agg(F.min("b").alias("least")), "a bigint, least bigint")


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """`node, root` of every node with an edge; the root is the smallest node it is linked to.

    `edges` has bigint columns a and b. Alternates the large-star and small-star steps of Kiveris
    et al. until nothing changes, which takes a number of rounds that grows with the logarithm of
    the longest path. Rounds are shuffles of edges; the driver sees a count and a checksum.
    """
    current = _stored(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct()
    )
    before = _state(current)
    while True:
        both = current.union(current.select("b", "a"))
        large = _stored(
            both.join(_least(both), "a")
            .where(F.col("b") > F.col("a"))
            .select(F.col("b").alias("a"), F.least("a", "least").alias("b"))
            .distinct()
        )
        small = (
            large.join(_least(large), "a")
            .select(
                F.inline(
                    F.array(
                        F.struct(F.col("b").alias("a"), F.col("least").alias("b")),
                        F.struct(F.col("a"), F.col("least").alias("b")),
                    )
                )
            )
            .where("a <> b")
            .distinct()
        )
        current = _stored(small)
        after = _state(current)
        if after == before:
            roots = current.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
            return current.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
        before = after
