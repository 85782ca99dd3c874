import pytest

DOCS = "doc_id long, text string, source string, lang string, k_id string, n int, node string, votes string, found string"


@pytest.fixture()
def frame(spark):
    """Documents from (doc_id, text) rows, with further columns whose names the operators use inside."""

    def make(rows):
        full = [(i, t, "s", "en", "x", 1, "y", "z", "f") for i, t in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture()
def rows():
    """Sorted tuples of a frame's columns, null first."""

    def of(df, *columns):
        got = [tuple(r) for r in df.select(*columns).collect()]
        return sorted(got, key=lambda r: [(x is not None, x) for x in r])

    return of
