"""Small fixtures for the operator tests."""

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score double, data string, word string, band string"


def docs(spark, rows):
    """Documents with further columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, 1.0, "x", None, "b") for i, t in rows], DOCS)


def by_id(frame, key="doc_id"):
    return {r[key]: r for r in frame.collect()}
