import pytest

from pactframe.llm.common import ship

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def session(spark):
    ship(spark)
    return spark


@pytest.fixture(scope="session")
def docs(session):
    """(rows of id and text) to a DataFrame with columns whose names clash with inner ones."""

    def make(rows):
        clash = "digest string, kept boolean, `text body` int, row long, size long"
        full = [(i, t, "d", True, 1, 2, 3) for i, t in rows]
        return session.createDataFrame(full, f"doc_id long, text string, {clash}")

    return make


ODD_ROWS = [
    (1, None), (2, ""), (3, " "), (4, "one"), (None, "a row without an id has words too"),
    (None, None), (5, "word " * 30_000), (6, "the same text here twice over"), (6, "the same text here twice over"),
    (7, "the same text here twice over"), (8, "\n\n \n"), (9, "é漢字🙂 mixed   white space"),
]
