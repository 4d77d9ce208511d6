"""The pipeline's joins are the same at every size."""

from canopyspark.llm.ngram_join import near_duplicates_removed


def test_near_duplicates_go_by_the_same_join_at_every_size(spark):
    docs = spark.createDataFrame([(k, f"some words that are said again {k // 2} times in all") for k in range(8)], "doc_id long, text string")
    out = near_duplicates_removed(docs)
    assert {r["doc_id"] for r in out.collect()} == {0, 2, 4, 6}
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
