import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Rows of (doc_id, text, source), with columns whose names the operators use themselves."""

    def build(rows, extra=True):
        docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], DOCS)
        if not extra:
            return docs
        names = ["score", "text_key", "size", "spans", "kept", "decided", "position", "_Order"]
        return docs.selectExpr("*", *[f"'x' AS {n}" for n in names])

    return build
