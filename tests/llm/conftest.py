import pytest


@pytest.fixture()
def documents(spark):
    """A frame of documents from ``(doc_id, text)`` or ``(doc_id, text, lang)`` rows."""
    def make(rows, extra=False):
        rows = [(i, t, *(more or [None]), "src", len(t) if t is not None else None) for i, t, *more in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        if extra:      # columns that clash with names used inside
            for name in ("th", "w", "fp", "k1", "pos", "root", "kind", "item", "n", "part", "spans", "score"):
                df = df.selectExpr("*", f"1 AS {name}")
        return df

    return make
