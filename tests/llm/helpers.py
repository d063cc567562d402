"""Small tables for the operators' tests."""

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, **columns):
    """A table of documents from texts, or from (doc_id, text) pairs."""
    rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
    return spark.createDataFrame(
        [(i, t, columns.get("lang", "en"), columns.get("source", "src"), None if t is None else len(t)) for i, t in rows],
        DOCUMENTS,
    )
