"""Small tables for the tests of the corpus operators."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, /, **more):
    """Documents with the given texts; further columns by keyword, each a constant string."""
    ids = range(len(texts)) if ids is None else ids
    rows = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in zip(ids, texts)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name, value in more.items():
        from pyspark.sql import functions as F

        frame = frame.withColumn(name, F.lit(value))
    return frame


# Columns named as inner ones of the operators.
CLASHES = {c: "x" for c in ("id", "ids", "sid", "n", "tokens", "row", "slice", "value", "words", "score", "label", "size", "bin")}
