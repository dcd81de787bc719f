"""Small document tables for the tests."""

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(spark, texts, ids=None, sources=None):
    ids = ids if ids is not None else range(len(texts))
    sources = sources if sources is not None else ["s"] * len(texts)
    rows = [(i, t, "en", s, len(t or "")) for i, t, s in zip(ids, texts, sources, strict=True)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
