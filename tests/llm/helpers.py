"""Small odd tables shared by the operator tests."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 613}" for i in range(60_000))


def odd_docs(spark):
    """Nulls in every column, empty and very long texts, ties and repeated rows."""
    rows = [(1, "Alpha beta gamma", "en", "a", 16), (2, "alpha BETA gamma", "en", "b", 16), (3, None, None, None, None),
            (None, "alpha beta gamma", "en", "a", 16), (4, "", "de", "b", 0), (4, "", "de", "b", 0), (5, " \t\n", "de", None, 3),
            (6, LONG, "en", "c", len(LONG)), (7, "é Ünicode Text", "fr", "a", 14), (8, "É ünicode text", "fr", "a", 14),
            (None, None, None, None, None), (9, "x", "es", "", 1)]
    return spark.createDataFrame(rows, DOCS)


def empty_docs(spark):
    return spark.createDataFrame([], DOCS)
