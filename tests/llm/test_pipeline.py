import random

import corpus_pipeline
import pytest

FOLDER = "/root/testdata/sf0.001"


def words(seed, count):
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefghij", k=draw.randint(2, 8))) for _ in range(count))


@pytest.fixture
def docs(spark):
    passage = words(1, 60)
    rows = [
        (1, words(2, 200), "en", "s"),
        (2, words(2, 200), "en", "s"),  # an exact copy
        (3, words(2, 199) + " changed", None, "s"),  # a near copy
        (4, f"{words(3, 80)} {passage} {words(4, 80)}", "en", "s"),
        (5, f"{words(5, 90)} {passage} {words(6, 90)}", "en", None),
        (6, "1234 -- !!", "en", "s"),
        (7, None, "en", "s"),
        (8, "", None, "s"),
        (9, words(7, 3), None, "t"),
    ]
    rows = [(*r, len(r[1] or ""), 1) for r in rows]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score int"
    ).repartition(2)


def kept(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_stages(spark, docs):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "near_duplicates", "repeated_text", "packing"]
    known = stages["language"](spark, docs, "")
    assert known.dtypes == docs.dtypes and set(kept(known)) == {1, 2, 3, 4, 5, 9}
    assert kept(known)[9].lang == "en" and kept(known)[5].source is None
    single = stages["near_duplicates"](spark, known, "")
    assert single.dtypes == docs.dtypes and set(kept(single)) == {1, 4, 5, 9}
    clean = stages["repeated_text"](spark, single, "")
    assert clean.dtypes == docs.dtypes and set(kept(clean)) == {1, 4, 5, 9}
    before, after = kept(single), kept(clean)
    assert all(after[n] == before[n] for n in (1, 4, 9))
    assert words(1, 60) not in after[5].text and after[5].text.startswith(words(5, 90))
    assert after[5].n_chars == len(after[5].text)
    packed = stages["packing"](spark, clean, "")
    assert {r.doc_id for r in packed.collect()} == {1, 4, 5, 9}


def test_columns_named_like_those_of_the_stages(spark, docs):
    from pyspark.sql import functions as F

    names = ["first", "twice", "node", "root", "mark", "key", "row", "kept", "digest", "lang_pred"]
    more = docs.withColumns({name: F.lit("own") for name in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs, more = stage(spark, docs, ""), stage(spark, more, "")
        assert more.columns == [*docs.columns, *names]
        assert sorted(map(str, more.drop(*names).collect())) == sorted(map(str, docs.collect()))
        assert more.select(*names).distinct().collect() == [("own",) * len(names)]


def test_no_language_is_known_without_labels(spark, docs):
    stage = dict(corpus_pipeline.STAGES)["language"]
    assert stage(spark, docs.drop("lang"), "").collect() == []


def test_stages_without_documents(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), "").collect() == []


def test_run_equals_its_stages(spark):
    found = corpus_pipeline.run(spark, FOLDER)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, FOLDER)
    left = {r.doc_id for r in docs.select("doc_id").collect()}
    rows = found.collect()
    assert {r.doc_id for r in rows} == left and 0 < len(left) < 200
    tokens = {r.doc_id: r.doc_tokens for r in rows}
    assert sum(r.length for r in rows) == sum(tokens.values())
