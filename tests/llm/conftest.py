import pytest

from codeweft.llm.common import prepare

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture(scope="session")
def docs_of(llm):
    """Documents from (id, text) or (id, text, source); other columns are filled."""

    def make(*rows):
        full = [(i, t, "en", rest[0] if rest else "s", len(t or "")) for i, t, *rest in rows]
        return llm.createDataFrame(full, DOC)

    return make
