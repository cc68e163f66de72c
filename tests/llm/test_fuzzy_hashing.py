import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tierline.llm import fuzzy_hashing as fh
from tierline.llm import golay
from tierline.llm.components import components

FOLDER = "/root/testdata/sf0.001"


def slow_fingerprint(text):
    words = [w for w in re.split("[ \t\n\x0b\x0c\r]+", text or "") if w]
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in " ".join(words)).split(" ")
    low = [w for w in low if w]
    if not low:
        return 0
    shingles = [" ".join(low[i : i + 4]) for i in range(max(1, len(low) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """Components of (id, fingerprint) by comparing all pairs."""
    label = list(range(len(rows)))

    def find(n):
        while label[n] != n:
            n = label[n]
        return n

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= 4:
                one, other = find(a), find(b)
                label[max(one, other)] = min(one, other)
    names = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            names[find(n)] = min(doc_id, names.get(find(n), doc_id))
    return [names.get(find(n)) for n in range(len(rows))]


def test_fingerprints():
    texts = [None, "", " \t\n", "One", "a b", "A b C d", "É ü Ü ÀB c\x0bd\x1ce f g h i"]
    texts += ["x y z w " * 9, " a b c d e f", "w%d " * 3]
    for text in texts:
        assert fh.fingerprint(text) == slow_fingerprint(text), text
    long = " ".join(f"w{n}" for n in range(66_000))  # hashed in more than one step
    assert fh.fingerprint(long) == slow_fingerprint(long)


def test_code_is_perfect():
    assert np.array_equal(np.bincount(golay.indices()), np.full(4096, 2048))
    words = np.array([0, 0b111, 0b1011, (1 << 23) - 1])
    assert (golay.near(words, 23) >= 0).sum(axis=1).tolist() == [1, 6, 6, 1]


def test_four_bits_apart_share_a_key():
    random = np.random.default_rng(5)
    a = random.integers(0, 1 << 64, 4000, dtype=np.uint64)
    b = a.copy()
    for n in range(len(a)):
        for bit in random.choice(64, n % 5, replace=False):
            b[n] ^= np.uint64(1 << int(bit))
    one, other = (set(zip(*(x.tolist() for x in fh.keys_of(v)), strict=True)) for v in (a, b))
    assert {row for _, row in one & other} == set(range(len(a)))


def test_forest_joins_all_links():
    random = np.random.default_rng(6)
    values = np.uint64(0) ^ (np.uint64(1) << random.integers(0, 12, (300, 3)).astype(np.uint64)).sum(
        axis=1, dtype=np.uint64
    )
    group = np.sort(random.integers(0, 4, 300))
    for room in (1 << 21, 50):
        a, b = fh.links(group, values, 2, room)
        assert (group[a] == group[b]).all()
        label = fh.roots(300, a, b)
        for g in range(4):
            rows = np.flatnonzero(group == g)
            near = np.bitwise_count(values[rows][:, None] ^ values[rows]) <= 2
            one, other = (rows[x] for x in np.nonzero(near))
            assert np.array_equal(label, fh.roots(300, np.append(a, one), np.append(b, other)))


def test_components_of_paths_and_stars(spark):
    edges = [(n, n + 1) for n in range(10, 90)] + [(500, n) for n in range(400, 440)] + [(7, 7)]
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r.node: r.root for r in components(frame).collect()}
    assert found == {n: 10 for n in range(10, 91)} | {n: 400 for n in [*range(400, 440), 500]}
    assert components(frame.limit(0)).collect() == []


def test_the_edges_of_a_hub_can_be_split(spark):
    """Sort merge joins with small limits: Spark splits the hub's partition, and nothing is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        star = spark.range(1, 20_001).selectExpr("id * 10 AS a", "5L AS b")
        pairs = spark.range(0, 500).selectExpr("id * 10 + 1 AS a", "id * 10 + 3 AS b")
        found = components(star.union(pairs))
        roots = {r.root: r.n for r in found.groupBy("root").agg(F.count("*").alias("n")).collect()}
        assert roots.pop(5) == 20_001
        assert roots == {n * 10 + 1: 2 for n in range(500)}
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_link_blocks_lose_nothing(spark):
    """A dense group far larger than a block: all within few bits of one centre."""
    random = np.random.default_rng(8)
    centre = random.integers(0, 1 << 62)
    values = {int(centre)}
    while len(values) < 120:
        value = int(centre)
        for bit in random.choice(30, 3, replace=False):
            value ^= 1 << int(bit)
        values.add(value)
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint bigint")
    expected = {n for n in brute([(v, v) for v in sorted(values)])}
    for rows_at_once in (1, 25, 1 << 16):
        edges = fh.link_fingerprints(frame, block_rows=10, rows_at_once=rows_at_once)
        assert {r.root for r in components(edges).collect()} == expected


def test_components_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows += [(None, None), (900_001, ""), (900_002, " "), (None, "quite alone in here, no id"), rows[0]]
    found = fh.near_duplicates(documents(*rows)).collect()
    marks = [(i, fh.fingerprint(t)) for i, t in rows]
    expected = {(i, f"{m:016x}", c) for (i, m), c in zip(marks, brute(marks), strict=True)}
    assert {tuple(r) for r in found} == expected and len(found) == len(rows)


def test_no_documents(documents):
    assert fh.near_duplicates(documents((1, "a")).limit(0)).collect() == []
