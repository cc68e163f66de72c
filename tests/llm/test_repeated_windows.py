import hashlib
import random

import numpy as np
import pytest

from tierline.llm import repeated_windows as rw

FOLDER = "/root/testdata/sf0.001"


def brute(rows):
    seen, found = set(), []
    for doc_id, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - rw.WIDTH + 1):
            window = data[at : at + rw.WIDTH]
            if window in seen:
                gone[at : at + rw.WIDTH] = True
            seen.add(window)
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        spans = int((gone & ~np.append(False, gone)[:-1]).sum())
        found.append((doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept))
    return sorted(found, key=str)


def removed(frame, **options):
    found = rw.remove_repeated(frame, **options).collect()
    return sorted(
        ((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256, bytes(r.kept)) for r in found),
        key=str,
    )


def odd_texts(seed, count):
    draw = random.Random(seed)
    base = ["".join(draw.choices("ab é", k=k)) for k in (30, 120, 400, 700)]
    parts = [
        lambda: draw.choice(base),
        lambda: draw.choice(base)[draw.randint(0, 50) :],
        lambda: f"x{draw.randint(0, 3)}",
        lambda: "ab" * draw.randint(0, 120),
        lambda: "".join(draw.choices("abcdef", k=draw.randint(0, 90))),
    ]
    return ["".join(draw.choice(parts)() for _ in range(draw.randint(0, 6))) for _ in range(count)]


def test_every_window_is_in_one_run():
    random_ = np.random.default_rng(4)
    texts = [random_.integers(97, 100, n).astype(np.uint8) for n in (0, 99, 100, 350, 5, 6000, 101, 100)]
    data, starts = np.concatenate(texts), np.cumsum([0, *map(len, texts)])
    before = rw.PIECE
    try:
        for rw.PIECE in (1000, 1 << 20):
            seen = []
            for text, offset, own, begins in rw.pieces(data, starts):
                number, at, count, _ = rw.runs(own, begins)
                assert count.max(initial=1) <= rw.WIDTH - rw.GRAM + 1
                for n, a, c in zip(number, at, count, strict=True):
                    seen += [(text + n, a - begins[n] + offset + x) for x in range(c)]
    finally:
        rw.PIECE = before
    assert sorted(seen) == [(n, a) for n, t in enumerate(texts) for a in range(len(t) - 99)]


def test_equal_windows_have_equal_anchors():
    text = np.frombuffer(b"the quick brown fox jumps over it " * 9, np.uint8)
    other = np.concatenate([np.frombuffer(b"0123456789" * 30, np.uint8), text])
    keys = []
    for data in (text, other):
        _, at, count, key = rw.runs(data, np.array([0, len(data)]))
        keys.append({data[a + x : a + x + 100].tobytes(): k for a, c, k in zip(at, count, key, strict=True) for x in range(c)})
    shared = set(keys[0]) & set(keys[1])
    assert len(shared) == len(keys[0]) and all(keys[0][w] == keys[1][w] for w in shared)


@pytest.mark.parametrize("seed", range(3))
def test_equals_brute_force(documents, seed):
    rows = [(3 * n, t) for n, t in enumerate(odd_texts(seed, 45))]
    assert removed(documents(*rows)) == brute(rows)


def test_sample_documents(spark):
    frame = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    expected = brute([tuple(r) for r in frame.collect()])
    assert sum(r[2] for r in expected) > 10_000 and removed(frame) == expected


def test_a_common_line_in_many_contexts(documents):
    """More than a third of the documents share a line; batches and tasks each see a part."""
    draw = random.Random(9)
    line = "".join(draw.choices("abcdefgh ", k=130))
    rows = []
    for n in range(150):
        own = ["".join(draw.choices("ijklmnop ", k=draw.randint(0, 200))) for _ in range(2)]
        rows.append((n, own[0] + line * (n % 3 != 0) + own[1]))
    assert removed(documents(*rows)) == brute(rows)


def test_nulls_and_repeated_rows(documents):
    text = "".join(random.Random(1).choices("abc ", k=150))
    rows = [(4, text), (2, None), (3, ""), (5, text), (5, text), (None, text + "x")]
    found = removed(documents(*rows))
    assert {(r[0], r[1], r[2]) for r in found} == {
        (None, 151, 0),
        (2, 0, 0),
        (3, 0, 0),
        (4, 150, 150),
        (5, 150, 150),
    }
    assert len(found) == 6
    alone = removed(documents((5, text), (5, text)))
    assert [r[2] for r in alone] == [0, 0]  # one document does not repeat itself by being there twice
    assert removed(documents((1, "a")).limit(0)) == []


def test_text_loses_half_characters(documents):
    letters = "".join(chr(0xC0 + n) for n in range(60))
    rows = [(1, "é" + letters), (2, "xũ" + letters + "ü")]  # é and ũ end with the same byte
    found = rw.remove_repeated(documents(*rows), content="text", carry=True)
    assert {r.doc_id: r.kept for r in found.collect()} == {1: "é" + letters, 2: "xü"}
    assert found.first().row.lang == "x"


def test_columns_named_like_those_of_the_joins(spark):
    from pyspark.sql import functions as F

    text = "a passage that is long enough to be found again in another document of this small table, and then some more"
    rows = spark.createDataFrame([(1, text), (2, text + "!"), (2, "x")], "doc_id bigint, text string")
    names = ["twice", "doc", "digest", "hashed", "row", "first", "node", "root", "mark", "key", "kept"]
    more = rows.withColumns({name: F.lit("own") for name in names})
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    found = [
        sorted(map(tuple, rw.remove_repeated(frame, content=None).select(*columns).collect()))
        for frame in (rows, more)
    ]
    assert found[0] == found[1] and any(row[2] for row in found[0])
