import pytest


@pytest.fixture
def documents(spark):
    """(doc_id, text) pairs to a table with the columns of documents and some that clash with inner names."""
    def build(*pairs):
        rows = [(i, t, "en", "s", len(t or ""), -1, 0.5, True, "x") for i, t in pairs]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, "
                                           "print long, score double, kept boolean, anchor string")
    return build


def by_id(df, *columns):
    """Rows as sorted tuples."""
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)
