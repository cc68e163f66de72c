"""Ranked search against brute force."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tierline.llm import lexical_search
from tierline.llm.byte_words import found_words, steps

WORDS = "and the Rat rat cat Čat été 1984 x a-b b_c ÷".split()


def terms_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(lexical_search.TERM, lowered)


def expected(documents, items, k=10):
    bags = [(i, terms_of(t)) for i, t in documents]
    bags = [(i, b) for i, b in bags if b]
    docs, length = len(bags), sum(len(b) for _, b in bags)
    rows = []
    asked = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms_of(text))
    for item, terms in asked.items():
        scores = []
        for doc_id, bag in bags:
            m = 10 + 90 * len(bag) * docs // length
            score = 0
            for term in terms & set(bag):
                df = sum(term in b for _, b in bags)
                w = math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))
                tf = bag.count(term)
                score += w * (10**9 * tf // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scores)[:k], 1):
            rows.append((item, rank, doc_id, -score))
    return sorted(rows, key=str)


@pytest.fixture
def corpus():
    random.seed(5)
    texts = [" ".join(random.choices(WORDS, k=random.randint(1, 9))) for _ in range(60)]
    texts += texts[:20] + [texts[0]] * 40 + ["", None, " .,;-", "Rat " * 3000]
    rows = list(enumerate(texts))
    return [*rows, (None, texts[3]), (7, texts[3]), (7, "cat cat 1984")]


ITEMS = [(1, "The cat!"), (2, "RAT, été; ÷"), (3, None), (4, "..."), (5, "cat cat 1984"), (1, "x"), (None, "and")]


def found(spark, documents, items, place, **options):
    asked = spark.createDataFrame(items, "item_id bigint, text string")
    frame = lexical_search.search(documents, asked, str(place), **options)
    assert [f"{n} {t}" for n, t in frame.dtypes] == ["item_id bigint", "rank int", "doc_id bigint", "score bigint"]
    return sorted((tuple(row) for row in frame.collect()), key=str)


def test_equals_brute_force(spark, documents, corpus, tmp_path):
    assert found(spark, documents(*corpus), ITEMS, tmp_path) == expected(corpus, ITEMS)


def test_blocks_of_items_give_the_same(spark, documents, corpus, tmp_path):
    for n, blocks in enumerate(({"most_terms": 2}, {"most_items": 1}, {"most_bytes": 6})):
        got = found(spark, documents(*corpus), ITEMS, tmp_path / str(n), k=3, blocks=blocks)
        assert got == expected(corpus, ITEMS, 3)


def test_a_class_is_one_row(spark):
    rows = [(i, 50, [0, 3], [1, 1 + i % 2]) for i in range(40)]
    bags = spark.createDataFrame(rows, "doc_id bigint, m bigint, codes array<int>, counts array<int>")
    classes = lexical_search.classes_of(bags, 3).collect()
    assert sorted(sorted(row.members) for row in classes) == [[0, 2, 4], [1, 3, 5]]


def test_nothing_to_search_or_to_ask(spark, documents, tmp_path):
    assert found(spark, documents((1, "a")).limit(0), ITEMS, tmp_path / "a") == []
    assert found(spark, documents((1, None), (2, "")), ITEMS, tmp_path / "b") == []
    assert found(spark, documents((1, "a")), [(1, None)], tmp_path / "c") == []


def test_words_end_with_their_text():
    kept = np.arange(256, dtype=np.uint8)
    kept[list(b" .")] = 0
    texts = ["ab", "", "cd e", None, ".f", "g."]
    data, places, rows = found_words(pa.array(texts), kept)
    words = [data[a:b].tobytes().decode() for a, b in zip(places, places[1:], strict=False)]
    assert list(zip(rows.tolist(), words, strict=True)) == [(0, "ab"), (2, "cd"), (2, "e"), (4, "f"), (5, "g")]
    assert len(found_words(pa.array([None, ""]), kept)[2]) == 0


def test_steps_hold_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["abc", None, "", "abcdefgh", "z"])], names=["text"])
    parts = [part.column("text").to_pylist() for part in steps(batch, most=4)]
    assert parts == [["abc", None, ""], ["abcdefgh"], ["z"]]
