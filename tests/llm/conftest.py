import pytest

from tierline.llm.session import prepare


@pytest.fixture(autouse=True, scope="session")
def prepared(spark):
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # batches have edges


@pytest.fixture
def documents(spark):
    """Documents from (id, text) pairs, with columns whose names the operators use themselves."""

    def make(*rows):
        full = [(i, t, "x", 1, 2, "k", 0.5, "row") for i, t in rows]
        return spark.createDataFrame(
            full,
            "doc_id bigint, text string, lang string, n_tokens int, key int, fingerprint string,"
            " score double, `row` string",
        ).repartition(3)

    return make
