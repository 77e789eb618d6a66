import pytest

from tests.conftest import TESTDATA  # noqa: F401


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) rows, with columns that clash with the
    operators' own names."""
    def build(rows, lang=None):
        return spark.createDataFrame(
            [(i, t, lang, "s", 0, "x", "y") for i, t in rows],
            "doc_id long, text string, lang string, source string, n_chars long, kept string, fp string")
    return build


EDGE_ROWS = [(1, None), (2, ""), (3, "  \n\t "), (4, "one"), (5, "Two words"), (6, "a b c d e f g"), (6, "a b c d e f g"),
             (None, "a b c d e f g"), (7, "word " * 30000), (8, "x" * 100000), (9, "éß 你好 \U0001f600 ok")]


@pytest.fixture(scope="session")
def edge_docs(make_docs):
    return make_docs(EDGE_ROWS)
