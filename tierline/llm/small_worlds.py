"""Approximate nearest neighbours: a hierarchical navigable small-world graph for each shard."""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierline.llm.columns import spread
from tierline.llm.vectors import beside, dealt, matrices, merge_top, parts_of, usable

INDEX = (
    "shard int, size int, vectors binary, levels binary, neighbours array<binary>,"
    " ids binary, id_starts binary"
)
LISTS = "query_id bigint, query_hash bigint, part int, vec_id bigint, score double"


@dataclass
class Graph:
    """`neighbours[l]` holds, as one flat array a layer, each node's neighbours; -1 is no node."""

    vectors: np.ndarray  # unit length, float32
    levels: np.ndarray
    neighbours: list[np.ndarray]


def unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def levels_of(ids: np.ndarray, links: int) -> np.ndarray:
    """A layer for each node: layer l and up with probability links^-l, by a hash of the id."""
    x = ids.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    share = ((x >> np.uint64(11)).astype(np.float64) + 1) / (1 << 53)
    return np.floor(-np.log(share) / np.log(links)).astype(np.int32)


def _diverse(near: np.ndarray, among: np.ndarray, links: int) -> np.ndarray:
    """Which candidates (in falling nearness) are linked: those nearer to the node than to any
    candidate linked before, and the nearest of the others while there is room."""
    chosen = np.zeros(near.shape, bool)
    shadow = np.full(near.shape, -np.inf, np.float32)
    for c in range(near.shape[1]):
        take = (near[:, c] > shadow[:, c]) & (chosen.sum(axis=1) < links) & np.isfinite(near[:, c])
        chosen[:, c] = take
        shadow = np.where(take[:, None], np.maximum(shadow, among[:, c]), shadow)
    order = np.argsort(~chosen, axis=1, kind="stable")[:, :links]
    kept = np.zeros(near.shape, bool)
    np.put_along_axis(kept, order, True, axis=1)
    return kept & np.isfinite(near)


def _layer(vectors: np.ndarray, links: int, most: int, candidates: int) -> np.ndarray:
    """Neighbours of every vector of one layer, `most` at most, as positions in the layer."""
    count = len(vectors)
    pool = min(candidates, count - 1)
    if pool < 1:
        return np.full((count, most), -1, np.int32)
    origin, target, nearness = [], [], []
    for low in range(0, count, 256):
        rows = np.arange(low, min(count, low + 256))
        scores = vectors[rows] @ vectors.T
        scores[np.arange(len(rows)), rows] = -np.inf
        near = np.argpartition(-scores, pool - 1, axis=1)[:, :pool]
        value = np.take_along_axis(scores, near, axis=1)
        order = np.argsort(-value, axis=1, kind="stable")
        near, value = (np.take_along_axis(x, order, axis=1) for x in (near, value))
        group = vectors[near]
        kept = _diverse(value, group @ group.transpose(0, 2, 1), links)
        row, column = np.nonzero(kept)
        origin.append(rows[row])
        target.append(near[row, column])
        nearness.append(value[row, column])
    a, b, value = (np.concatenate(x) for x in (origin, target, nearness))
    # Links go both ways; a node with too many keeps its own first, then the nearest.
    one, other = np.concatenate([a, b]), np.concatenate([b, a])
    back = np.repeat([0, 1], len(a))
    value = np.concatenate([value, value])
    order = np.lexsort((back, other, one))
    one, other, back, value = one[order], other[order], back[order], value[order]
    new = np.append(True, (one[1:] != one[:-1]) | (other[1:] != other[:-1]))
    one, other, back, value = one[new], other[new], back[new], value[new]
    order = np.lexsort((other, -value, back, one))
    one, other = one[order], other[order]
    place = np.arange(len(one)) - np.searchsorted(one, one)
    links_of = np.full((count, most), -1, np.int32)
    links_of[one[place < most], place[place < most]] = other[place < most]
    return links_of


def build(ids: np.ndarray, vectors: np.ndarray, links: int = 16, candidates: int = 64) -> Graph:
    """The graph of all nodes at once: each layer takes its candidates from a tiled product.

    That is what insertion one by one approximates by searching; the shard is bounded, so that it
    costs less than its searches here. `links` a layer, twice as many in the lowest.
    """
    levels = levels_of(ids, links)
    neighbours = []
    for level in range(int(levels.max()) + 1):
        members = np.flatnonzero(levels >= level).astype(np.int32)
        most = links * (2 if level == 0 else 1)
        own = _layer(vectors[members], links, most, candidates)
        whole = np.full((len(ids), most), -1, np.int32)
        whole[members] = np.where(own >= 0, members[own], -1)
        neighbours.append(whole)
    return Graph(vectors, levels, neighbours)


def search(graph: Graph, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The nodes found for each query and their nearness, best first; -1 where there are fewer.

    All queries of a block walk in step: each opens its best few unopened nodes, and keeps the
    `beam` best it has seen, until it has none to open.
    """
    count, width = len(queries), 1
    start = int(np.argmax(graph.levels))
    found = np.full((count, 1), start, np.int64)
    value = (queries @ graph.vectors[start])[:, None]
    for level in range(len(graph.neighbours) - 1, -1, -1):
        width = beam if level == 0 else 4
        links = graph.neighbours[level]
        grown = np.full((count, width), -1, np.int64)
        score = np.full((count, width), -np.inf, np.float32)
        had = min(width, found.shape[1])
        grown[:, :had], score[:, :had] = found[:, :had], value[:, :had]
        found, value, opened = grown, score, np.zeros((count, width), bool)
        seen = np.zeros((count, len(graph.vectors)), bool)
        query, place = np.nonzero(found >= 0)
        seen[query, found[query, place]] = True
        walking = np.arange(count)
        while len(walking):
            waiting = np.where(opened[walking] | (found[walking] < 0), -np.inf, value[walking])
            step = min(4, width)
            best = np.argpartition(-waiting, step - 1, axis=1)[:, :step]
            live = np.isfinite(np.take_along_axis(waiting, best, axis=1))
            going = live.any(axis=1)
            walking, best, live = walking[going], best[going], live[going]
            if not len(walking):
                break
            rows = walking[:, None]
            opened[rows, best] |= live
            nodes = np.where(live, found[rows, best], -1)
            near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(walking), -1)
            near = np.where(seen[rows, near] & (near >= 0), -1, near)
            near.sort(axis=1)  # a node reached twice in one step counts once
            near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
            gained = np.einsum("qd,qnd->qn", queries[walking], graph.vectors[near])
            gained = np.where(near >= 0, gained, -np.inf)
            query, place = np.nonzero(near >= 0)
            seen[walking[query], near[query, place]] = True
            nodes = np.concatenate([found[walking], near], axis=1)
            values = np.concatenate([value[walking], gained], axis=1)
            open_ = np.concatenate([opened[walking], np.zeros(near.shape, bool)], axis=1)
            order = np.argsort(-values, axis=1, kind="stable")[:, :width]
            found[walking] = np.take_along_axis(nodes, order, axis=1)
            value[walking] = np.take_along_axis(values, order, axis=1)
            opened[walking] = np.take_along_axis(open_, order, axis=1)
        found = np.where(np.isfinite(value), found, -1)
    return found, value


def _names(schema: str) -> list[str]:
    return [field.split()[0] for field in schema.split(", ")]


def _builder(links: int, candidates: int):
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 2, pa.list_(pa.binary()), *[pa.binary()] * 2]

    def index(key: tuple, rows: pa.Table) -> pa.Table:
        """One index for each number of components in the shard.

        Equal vectors are one node, with all their ids in rising order.
        """
        out = []
        ids = rows.column("vec_id").to_numpy()
        copies = rows.column("copies").to_numpy()
        for size, (at, matrix) in matrices(rows).items():
            distinct, node = np.unique(matrix, axis=0, return_inverse=True)
            node = np.repeat(node.ravel(), copies[at])
            own = np.repeat(ids[at], copies[at])
            order = np.lexsort((own, node))
            own = own[order]
            starts = np.searchsorted(node[order], np.arange(len(distinct) + 1))
            graph = build(own[starts[:-1]], unit(distinct), links, candidates)
            out.append(
                (
                    key[0].as_py(),
                    size,
                    distinct.astype(np.float64).tobytes(),
                    graph.levels.tobytes(),
                    [layer.tobytes() for layer in graph.neighbours],
                    own.astype(np.int64).tobytes(),
                    starts.astype(np.int64).tobytes(),
                )
            )
        columns = list(zip(*out, strict=True)) or [()] * len(types)
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_names(INDEX)
        )

    return index


def build_index(
    base: DataFrame,
    shard_rows: int = 8_192,
    links: int = 16,
    candidates: int = 64,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Shards of some `shard_rows` rows, each one graph in flat arrays; a row per shard.

    Every usable row is indexed. Null, empty, zero and non-finite vectors take no part, nor do
    rows without id; repeated rows count as often as they occur; other columns are ignored; an
    empty table has an empty index. Vectors with other numbers of components have their own graphs.
    """
    rows = usable(base, id_col, vector_col, zero=False).where("vec_id IS NOT NULL")
    shards = parts_of(base, shard_rows)
    return dealt(rows, shards, "shard").groupBy("shard").applyInArrow(
        _builder(links, candidates), INDEX
    )


def _searcher(k: int, beam: int):
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.float64()]

    def best(key: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        found: list[tuple] = []
        asked = matrices(queries) if queries.num_rows else {}
        for shard in index.to_pylist():
            asking, matrix = asked.get(shard["size"], (np.zeros(0, int), None))
            if not len(asking):
                continue
            vectors = np.frombuffer(shard["vectors"]).reshape(-1, shard["size"])
            layers = [np.frombuffer(x, np.int32) for x in shard["neighbours"]]
            graph = Graph(
                unit(vectors),
                np.frombuffer(shard["levels"], np.int32),
                [x.reshape(len(vectors), -1) for x in layers],
            )
            ids = np.frombuffer(shard["ids"], np.int64)
            starts = np.frombuffer(shard["id_starts"], np.int64)
            own = queries.column("vec_id").to_numpy()[asking]
            hashes = queries.column("query_hash").to_numpy()[asking]
            for low in range(0, len(asking), 512):
                part = slice(low, low + 512)
                nodes, _ = search(graph, unit(matrix[part]), beam)
                query, place = np.nonzero(nodes >= 0)
                node = nodes[query, place]
                score = cosine(matrix[part][query], vectors[node])
                # Only the smallest ids of equal vectors can be among the best, besides the own.
                times = np.minimum(starts[node + 1] - starts[node], k + _most_own(queries))
                at = spread(starts[node], times)
                query, score = np.repeat(query, times), np.repeat(score, times)
                other = ids[at] != own[part][query]
                query, score, at = query[other], score[other], at[other]
                order = np.lexsort((ids[at], -score, query))
                query, score, at = query[order], score[order], at[order]
                kept = np.arange(len(query)) - np.searchsorted(query, query) < k
                query, score, at = query[kept], score[kept], at[kept]
                found += zip(
                    own[part][query].tolist(),
                    hashes[part][query].tolist(),
                    [key[0].as_py()] * len(query),
                    ids[at].tolist(),
                    score.tolist(),
                    strict=True,
                )
        columns = list(zip(*found, strict=True)) or [()] * len(types)
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_names(LISTS)
        )

    return best


def _most_own(queries: pa.Table) -> int:
    return int(queries.column("copies").to_numpy().max(initial=1))


def cosine(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Of the rows of two float64 matrices; rows so long or short that squares fail are scaled."""
    with np.errstate(over="ignore", under="ignore", invalid="ignore", divide="ignore"):
        norms = (one * one).sum(axis=1) ** 0.5, (other * other).sum(axis=1) ** 0.5
        value = (one * other).sum(axis=1) / (norms[0] * norms[1])
    odd = ~np.isfinite(value) | (np.minimum(*norms) < 1e-140)
    if odd.any():
        a, b = (x[odd] / np.abs(x[odd]).max(axis=1, keepdims=True) for x in (one, other))
        value[odd] = (a * b).sum(axis=1) / ((a * a).sum(axis=1) ** 0.5 * (b * b).sum(axis=1) ** 0.5)
    return value


def nearest(
    index: DataFrame,
    queries: DataFrame,
    shards: int,
    k: int = 5,
    beam: int = 256,
    block_rows: int = 4_096,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """The k nearest found by cosine: `query_id, rank, vec_id, score`, nearest first.

    `index` comes from build_index() (`shards`: its number of shards). A task walks one graph with
    one block of queries; the lists of 16 shards are merged at a time. The score is computed in
    double precision from the vectors as given. `beam` trades time for recall.

    A query's own row, that is every row with its id, is no candidate; ties go to the smaller id. A
    repeated query is answered once. Queries without id or with an unusable vector have no rows.
    """
    blocks = parts_of(queries, block_rows)
    asked = usable(queries, id_col, vector_col, zero=False).where("vec_id IS NOT NULL")
    asked = asked.withColumn("query_hash", F.xxhash64("vec_id", "vector"))
    left = beside(index, blocks, "block").groupBy("shard", "block")
    right = beside(dealt(asked, blocks, "block"), shards, "shard").groupBy("shard", "block")
    lists = left.cogroup(right).applyInArrow(_searcher(k, beam), LISTS)
    return merge_top(lists, shards, k)
