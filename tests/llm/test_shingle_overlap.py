import random

import corpus_pipeline
import numpy as np

from tierline.llm import shingle_overlap as so
from tierline.llm.fuzzy_hashing import near_duplicates

FOLDER = "/root/testdata/sf0.001"


def text(seed, count):
    draw = random.Random(seed)
    return ["".join(draw.choices("abcdefghij", k=draw.randint(3, 8))) for _ in range(count)]


def slow(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def jaccard(a, b):
    return len(a & b) / len(a | b)


def brute(rows):
    """The smallest id of each group, by comparing all pairs."""
    sets, label = [slow(t) for _, t in rows], list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if jaccard(sets[a], sets[b]) >= 0.8:
                label = [label[b] if x == label[a] else x for x in label]
    groups = {n: [i for (i, _), x in zip(rows, label, strict=True) if x == n] for n in set(label)}
    return {min(i for i in g if i is not None) for g in groups.values() if any(i is not None for i in g)}


def changed(words, places, seed):
    new = list(words)
    for n, at in enumerate(places):
        new[at] = f"z{seed}q{n}"
    return new


def test_sets_and_links():
    texts = [None, " ", "One", "a b c d", "A b  C d e", "x y " * 9, "É ü c\x0bd e f g"]
    for one in texts:
        assert len(so.shingles(one)) == len(slow(one))
    sets = [np.arange(0, 10), np.arange(0, 8), np.arange(1, 8), np.arange(50, 60), np.arange(0, 10)]
    a, b = so.links(sets)
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == {(0, 1), (0, 2), (0, 4)}


def test_similarity_of_four_fifths_is_enough(spark, documents):
    """Four words of 200 changed: Jaccard 0.81, some ten bits of 64 apart. Six: Jaccard 0.73."""
    base = text(1, 200)
    near, far = changed(base, (20, 60, 100, 140), 1), changed(base, range(20, 200, 30), 2)
    assert 0.8 <= jaccard(slow(" ".join(base)), slow(" ".join(near))) < 0.83
    assert 0.7 < jaccard(slow(" ".join(base)), slow(" ".join(far))) < 0.8
    frame = documents((1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far)), (None, "a"))
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, "").collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "None"]


def test_groups_equal_brute_force(spark, documents):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    rows += [(None, None), (900_001, ""), (900_002, " "), (None, "alone"), rows[0], (-5, rows[0][1])]
    for n in range(40):  # chains of texts and a dense group, in blocks of a few rows
        base = text(n % 3, 150)
        rows.append((1000 + n, " ".join(changed(base, random.Random(n).sample(range(150), n % 6), n))))
    frame = documents(*rows)
    expected = brute(rows)
    for block_rows in (4, 500):
        found = [r.first for r in so.first_of_similar(frame, block_rows=block_rows).collect()]
        assert len(found) == len(set(found)) and set(found) == expected
    assert so.first_of_similar(frame.limit(0)).collect() == []


def test_fingerprints_say_what_to_compare_too(spark, documents, monkeypatch):
    """Without any MinHash key: near texts are linked by their fingerprints, unless too few shingles agree."""
    base = text(3, 3000)
    near = changed(base, (1500,), 1)  # one word of 3,000
    short = ["one two", "one two  ", "three four"]
    frame = documents((1, " ".join(base)), (2, " ".join(near)), *((n + 3, t) for n, t in enumerate(short)))
    bits = {r.doc_id: int(r.fingerprint, 16) for r in near_duplicates(frame).collect()}
    assert (bits[1] ^ bits[2]).bit_count() <= 4 and bits[3] == bits[4]
    empty = spark.createDataFrame([], "key bigint, mark bigint")
    monkeypatch.setattr(so, "_keyed", lambda texts: empty)
    found = {r.first for r in so.first_of_similar(frame).collect()}
    assert found == {1, 3, 5}
    # A fingerprint alone links nothing: the whole sets decide.
    assert {r.first for r in so.first_of_similar(frame, least=0.9999).collect()} == {1, 2, 3, 5}
