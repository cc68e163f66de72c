"""Exact search by tiled matrix products."""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.vectors import beside, best_of, dealt, matrices, merge_top, parts_of, usable

LISTS = "query_id bigint, query_hash bigint, part int, vec_id bigint, score bigint"
LONGEST = (1 << 63) - 1


def integer_products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers that are stored as float64.

    The narrowest arithmetic that cannot round is taken: float32 below 2^24, float64 below 2^53,
    and Python integers beyond.
    """
    bound = np.abs(queries).max(initial=0) * np.abs(rows).max(initial=0) * max(1, rows.shape[1])
    if bound < 1 << 24:
        return queries.astype(np.float32) @ rows.astype(np.float32).T
    if bound < 1 << 53:
        return queries @ rows.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(queries) @ whole(rows).T


def _tile(k: int, scale: float, at_once: int):
    def best(key: tuple, base: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        if base.num_rows and queries.num_rows:
            base = base.sort_by("vec_id")
            ids = base.column("vec_id").to_numpy()
            copies = base.column("copies").to_numpy()
            own = queries.column("vec_id").to_numpy()
            hashes = queries.column("query_hash").to_numpy()
            theirs = matrices(base)
            for size, (asking, matrix) in matrices(queries).items():
                at, rows = theirs.get(size, (np.zeros(0, int), np.zeros((0, size))))
                rows = np.floor(scale * rows)
                for low in range(0, len(asking), at_once):
                    part = asking[low : low + at_once]
                    scores = integer_products(np.floor(scale * matrix[low : low + at_once]), rows)
                    q, c, score = best_of(scores, ids[at], own[part], copies[at], k)
                    found += zip(
                        own[part][q].tolist(),
                        hashes[part][q].tolist(),
                        ids[at][c].tolist(),
                        (max(-LONGEST - 1, min(LONGEST, int(s))) for s in score),
                        strict=True,
                    )
        columns = list(zip(*found, strict=True)) or [()] * 4
        part = [key[0].as_py()] * len(columns[0])
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
        columns = [columns[0], columns[1], part, columns[2], columns[3]]
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
            names=[field.split()[0] for field in LISTS.split(", ")],
        )

    return best


def exact_top_k(
    base: DataFrame,
    queries: DataFrame,
    k: int = 5,
    scale: float = 256.0,
    shard_rows: int = 16_384,
    block_rows: int = 4_096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k rows with the largest integer inner product: `query_id, rank, vec_id, score`.

    A component x counts as floor(scale * x), x as double. Rows are dealt out to shards and queries
    to blocks; a task multiplies one block with one shard, some 256 queries at a time, and keeps k
    candidates a query. Lists of 16 shards are merged at a time.

    A query's own row, that is every row with its id, is no candidate; ties go to the smaller id.
    Null, empty and non-finite vectors take no part, nor do pairs with different numbers of
    components; zero vectors do. A row repeated with id and vector counts as often as it occurs,
    while a repeated query is answered once. Rows without an id take no part. Scores beyond 64 bits
    become the nearest 64-bit number. Other columns are ignored; without queries or candidates
    there are no rows.
    """
    shards, blocks = parts_of(base, shard_rows), parts_of(queries, block_rows)
    rows = usable(base, id_col, vector_col).where("vec_id IS NOT NULL")
    asked = usable(queries, id_col, vector_col).where("vec_id IS NOT NULL")
    asked = asked.withColumn("query_hash", F.xxhash64("vec_id", "vector"))
    left = beside(dealt(rows, shards, "shard"), blocks, "block").groupBy("shard", "block")
    right = beside(dealt(asked, blocks, "block"), shards, "shard").groupBy("shard", "block")
    lists = left.cogroup(right).applyInArrow(_tile(k, scale, 256), LISTS)
    return merge_top(lists, shards, k)
