import pytest

from tallyloom.llm.queries import reachable


@pytest.fixture(autouse=True)
def workers(spark):
    reachable(spark)


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) pairs, with further columns whose names operators use themselves."""

    def make(*rows, lang="en", source="s"):
        frame = spark.createDataFrame(
            [(k, t, lang, source, 7, "x", 1, True, "h") for k, t in rows],
            "doc_id bigint, text string, lang string, source string, n_words int, kept string, n int, items boolean, h string",
        )
        return frame.repartition(3)

    return make
