import pytest

from lexmill.llm.common import shared_dir


@pytest.fixture(scope="session", autouse=True)
def shared(spark):
    return shared_dir(spark)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) rows, with columns whose names operators use themselves."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", None, "x", 1) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, h int")

    return make
