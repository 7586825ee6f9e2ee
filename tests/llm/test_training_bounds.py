"""The rows a classifier is fitted on stay within their bound when an id holds very many rows."""

from starling.llm import quality_fm


def test_quality_rows_of_a_repeated_id(spark, monkeypatch):
    docs = spark.range(6000).selectExpr(
        "IF(id % 2 = 0, 7, id) AS doc_id", "concat('word', id % 50, ' and some more text ', id) AS text", "CAST(40 AS INT) AS n_chars")
    # Exact copies of one text under the id, as well.
    docs = docs.unionByName(spark.range(3000).selectExpr("CAST(7 AS BIGINT) AS doc_id", "'the same text' AS text", "CAST(13 AS INT) AS n_chars"))
    labels = spark.range(6000).selectExpr("id AS doc_id", "CAST(id % 3 = 0 AS INT) AS quality")
    seen = []
    plain = quality_fm.fit
    monkeypatch.setattr(quality_fm, "fit", lambda rows, y, *more: seen.append(len(y)) or plain(rows, y, *more))
    from pyspark.sql import functions as F
    machine = quality_fm.learn(docs, labels, F.lit(True), rows=200)
    # The id 7 may not be among the chosen labels; with all labels chosen it is.
    machine = quality_fm.learn(docs, labels.filter("doc_id = 7 OR doc_id < 200"), F.lit(True), rows=200)
    assert seen and max(seen) <= 400
    assert quality_fm.score(docs.limit(20), machine).count() == 20
