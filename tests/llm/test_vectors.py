import math
import random

import numpy as np

from tierline.llm import exact_top_k as et
from tierline.llm import small_worlds as sw
from tierline.llm.vectors import best_of, parts_of

SCHEMA = "vec_id bigint, embedding array<float>, vector string, copies int, rank int"


def frame_of(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(i, v, "c", 5, 6) for i, v in rows], schema).repartition(3)


def brute(rows, k, score, usable):
    rows = [(i, v) for i, v in rows if i is not None and v and usable(v)]
    out = []
    for query in sorted({(i, tuple(v)) for i, v in rows if i % 50 == 0}):
        found = [(score(query[1], v), i) for i, v in rows if i != query[0] and len(v) == len(query[1])]
        found.sort(key=lambda x: (-x[0], x[1]))
        out += [(query[0], r + 1, i, s) for r, (s, i) in enumerate(found[:k])]
    return sorted(out, key=str)


def finite(v):
    return all(x is not None and math.isfinite(x) for x in v)


def whole(a, b):
    a, b = ([math.floor(256 * x) for x in v] for v in (a, b))
    return sum(x * y for x, y in zip(a, b, strict=True))


def random_rows(n, size, seed):
    draw = random.Random(seed)
    return [(i, [float(np.float32(draw.gauss(0, 1))) for _ in range(size)]) for i in range(n)]


def exact(frame, **options):
    return et.exact_top_k(frame, frame.where("vec_id % 50 = 0"), **options)


def test_exact_equals_brute_force(spark):
    rows = random_rows(260, 6, 1)
    rows += [(1000 + i, [1.0] * 6) for i in range(40)] + [rows[3], rows[3], rows[50]]
    rows += [(300, None), (301, []), (302, [1.0, None] * 3), (303, [math.nan] * 6), (None, [1.0] * 6)]
    rows += [(350, [math.inf] * 6), (400, [0.0] * 6), (450, [2.0, 1.0]), (451, [1.0, 1.0])]
    frame = frame_of(spark, rows)
    expected = brute(rows, 5, whole, finite)
    for options in ({}, {"shard_rows": 20, "block_rows": 3}):
        found = exact(frame, **options).collect()
        assert sorted((tuple(r) for r in found), key=str) == expected


def test_scores_do_not_round(spark):
    rows = [(0, [3e6, 1.0]), (1, [3e6, 1.0]), (2, [3e6, 1.00390625]), (50, [1e30, -1e30]), (3, [1e30, 0])]
    rows = [(i, [float(x) for x in v]) for i, v in rows]
    schema = SCHEMA.replace("array<float>", "array<double>")
    found = {(r[0], r[2]): r[3] for r in exact(frame_of(spark, rows, schema)).collect()}
    assert found[0, 2] == whole(rows[0][1], rows[2][1])
    assert found[0, 2] - found[0, 1] == 256
    assert found[50, 3] == (1 << 63) - 1


def test_partial_selection_keeps_ties():
    scores = np.array([[3.0, 1, 3, 3, 0], [0, 0, 0, 0, 0]])
    ids = np.array([1, 2, 3, 4, 5])
    query, at, value = best_of(scores, ids, np.array([1, 9]), np.array([1, 1, 1, 2, 1]), 3)
    assert list(zip(query, ids[at], value, strict=True)) == [
        (0, 3, 3), (0, 4, 3), (0, 4, 3), (1, 1, 0), (1, 2, 0), (1, 3, 0),
    ]


def nearest(spark, rows, shard_rows, beam=64):
    frame = frame_of(spark, rows)
    index = sw.build_index(frame, shard_rows)
    shards = parts_of(frame, shard_rows)
    return sw.nearest(index, frame.where("vec_id % 50 = 0"), shards, beam=beam, block_rows=3)


def cosine(a, b):
    length = math.sqrt(sum(x * x for x in a)) * math.sqrt(sum(x * x for x in b))
    return sum(x * y for x, y in zip(a, b, strict=True)) / length


def test_graphs_find_the_nearest(spark):
    rows = random_rows(900, 8, 2)
    expected = {(r[0], r[2]) for r in brute(rows, 5, cosine, finite)}
    found = nearest(spark, rows, 300).collect()
    assert len(found) == len(expected)
    assert len({(r[0], r[2]) for r in found} & expected) >= 0.95 * len(expected)
    vectors = dict(rows)
    assert all(abs(r[3] - cosine(vectors[r[0]], vectors[r[2]])) < 1e-12 for r in found)
    for query in {r[0] for r in found}:
        scores = [r[3] for r in sorted(found, key=lambda r: r[1]) if r[0] == query]
        assert scores == sorted(scores, reverse=True) and len(scores) == 5


def test_many_equal_vectors_and_odd_rows(spark):
    rows = random_rows(60, 4, 3) + [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(60)]
    rows += [(201, None), (202, [0.0] * 4), (203, [math.nan] * 4), (204, [None] * 4), (None, [1.0] * 4)]
    rows += [(250, [1.0, 2.0]), (251, [2.0, 4.0]), (300, [5.0]), rows[0], (100, [1.0, 2.0, 3.0, 4.0])]
    usable = lambda v: finite(v) and any(v)
    expected = brute(rows, 5, cosine, usable)
    found = nearest(spark, rows, 40).collect()
    assert sorted(tuple(r)[:3] for r in found) == sorted(r[:3] for r in expected)


def test_no_vectors(spark):
    frame = frame_of(spark, [(1, [1.0])]).limit(0)
    assert exact(frame).collect() == []
    assert nearest(spark, [(1, [0.0])], 10).collect() == []


def test_one_vector_has_no_neighbours(spark):
    assert exact(frame_of(spark, [(50, [1.0])])).collect() == []
    assert nearest(spark, [(50, [1.0])], 10).collect() == []
