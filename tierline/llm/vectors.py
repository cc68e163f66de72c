"""Vectors in tiles: rows dealt out to shards, queries to blocks, and merging of top lists."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def usable(rows: DataFrame, id_col: str, vector_col: str, zero: bool = True) -> DataFrame:
    """`vec_id, vector array<double>, copies` of distinct rows whose vectors can be compared.

    Vectors that are null, empty, or hold a null or non-finite component take no part; all-zero
    ones neither if `zero` is false. A row repeated with id and vector is one row with its count,
    so that repetition never fills a shard.
    """
    vector = F.col("vector")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    chosen = rows.select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
    ).where(vector.isNotNull() & (F.size(vector) > 0) & finite)
    if not zero:
        chosen = chosen.where(F.exists(vector, lambda x: x != 0.0))
    return chosen.groupBy("vec_id", "vector").agg(F.count("*").alias("copies"))


def parts_of(rows: DataFrame, most: int) -> int:
    """Into how many parts rows are to be dealt so that a part has some `most` rows."""
    return max(1, -(-rows.count() // most))


def dealt(rows: DataFrame, parts: int, name: str) -> DataFrame:
    """Each row gets a part by a hash of id and vector, the same whenever it is computed."""
    return rows.withColumn(name, F.pmod(F.xxhash64("vec_id", "vector"), F.lit(parts)).cast("int"))


def beside(rows: DataFrame, parts: int, name: str) -> DataFrame:
    """Each row once for every part of the other side: the tiles it belongs to."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))


def matrices(rows: pa.Table) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By number of components: the positions of the rows that have it, and their matrix."""
    column = rows.column("vector").combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    places = np.asarray(column.offsets)
    values = np.asarray(column.values, np.float64)
    sizes = np.diff(places)
    found = {}
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        found[int(size)] = (at, values[places[at][:, None] + np.arange(size)])
    return found


def best_of(
    scores: np.ndarray, ids: np.ndarray, own: np.ndarray, copies: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Partial selection in a tile: query number, candidate position and score of the k best.

    `ids` rise. A candidate whose id is the query's own is left out; one that stands for several
    rows counts as often. Ties go to the smaller id.
    """
    if not scores.shape[1]:
        return np.zeros(0, int), np.zeros(0, int), scores[:0].ravel()
    mine = ids[None, :] == own[:, None]
    # One more than k so that the query's own row may be among them, however often it occurs.
    need = min(scores.shape[1], k + int(mine.sum(axis=1).max(initial=0)))
    floor = np.partition(scores, scores.shape[1] - need, axis=1)[:, scores.shape[1] - need]
    query, at = np.nonzero((scores >= floor[:, None]) & ~mine)
    value = scores[query, at]
    order = np.lexsort((ids[at], -value, query))
    query, at, value = query[order], at[order], value[order]
    times = np.minimum(copies[at], k)
    query, at, value = (np.repeat(x, times) for x in (query, at, value))
    first = np.searchsorted(query, query)
    kept = np.arange(len(query)) - first < k
    return query[kept], at[kept], value[kept]


def merge_top(lists: DataFrame, parts: int, k: int, fan: int = 16) -> DataFrame:
    """Merge the top lists of `parts` shards, `fan` at a time, until each query has one.

    `lists` has `query_id, query_hash, part, vec_id, score`; returns `query_id, rank, vec_id, score`.
    """
    order = [F.col("score").desc(), F.col("vec_id").asc_nulls_last()]
    while True:
        parts = -(-parts // fan)
        lists = lists.withColumn("part", F.floor(F.col("part") / fan).cast("int"))
        window = Window.partitionBy("query_hash", "query_id", "part").orderBy(*order)
        lists = lists.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)
        if parts == 1:
            return lists.select("query_id", "rank", "vec_id", "score")
