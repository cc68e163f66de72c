"""Registered queries: SQL where there is some, and what each returns."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from tierline.llm.registry import ORACLE, QUERIES

FOLDER = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": "page_id payload_bytes payload_digest record_type refers_to",
    "op2": "doc_id held_out lang_pred score",
    "op3": "doc_id fingerprint component_id",
    "op4": "query_id rank vec_id score",
    "op5": "query_id rank vec_id score",
    "op6": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op7": "doc_id n_bytes n_tokens over_limit",
    "op8": "page_id url text n_chars",
    "op9": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op10": "doc_id n_tokens",
    "op11": "item_id rank doc_id score",
    "op12": "doc_id n_words n_base first_word last_word base_labels labels score",
    "op13": "word form root n n_near form_n",
}


def test_all_are_registered():
    names = set(entry_points.queries())
    assert {n.split("_")[0] for n in QUERIES} == set(COLUMNS)
    assert set(QUERIES) | {"pipeline"} <= names
    assert set(ORACLE) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_sql(spark, name):
    frame = entry_points.queries()[name](spark, FOLDER)
    assert set(COLUMNS[name.split("_")[0]].split()) <= set(frame.columns)
    rows = [tuple(r) for r in frame.collect()]
    assert rows
    if name in ORACLE:
        duck = duckdb.connect()
        for table in ("pages", "embeddings", "documents", "benchmark"):
            duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
        answer = duck.execute(ORACLE[name])
        order = [frame.columns.index(c[0]) for c in answer.description]
        assert len(order) == len(frame.columns)
        got = sorted((tuple(r[n] for n in order) for r in rows), key=str)
        assert got == sorted(answer.fetchall(), key=str)
