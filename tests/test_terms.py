"""Terms of documents, counted where the documents lie."""

from pyspark.sql import functions as F

from kiln.operators.vectorise import document_terms


def test_document_terms_are_counted_in_their_task(spark):
    """Only the rows of repeated ids are brought together; null ids are one document."""
    df = spark.createDataFrame([(1, "a b a b".split()), (2, ["a"]), (2, ["a", "c"]), (None, ["d"]), (None, ["d", "d"]), (3, None), (4, [])],
                               "id long, t array<string>")
    got = {(r.id, r.n, r.term): r["count"] for r in document_terms(df, "id", F.col("t"), 1, 2).collect()}
    assert got == {(1, 1, "a"): 2, (1, 1, "b"): 2, (1, 2, "a b"): 2, (1, 2, "b a"): 1, (2, 1, "a"): 2, (2, 1, "c"): 1, (2, 2, "a c"): 1,
                   (None, 1, "d"): 3, (None, 2, "d d"): 1}
    plan = document_terms(df.where("id = 1"), "id", F.col("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") <= 1
