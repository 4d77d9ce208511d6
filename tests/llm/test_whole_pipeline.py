"""The corpus pipeline as a whole on empty tables, nulls, repeats and extra columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def _tables(spark, folder, rows):
    docs = spark.createDataFrame(rows, DOCUMENTS).withColumns({c: F.lit("clash") for c in ("n", "kept", "line", "f1", "tile", "__gone", "text_key")})
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 0, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "an item of several plain words that nobody should learn from by heart"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def _prose(k, n=120):
    return "\n".join(" ".join(f"w{(k * 7919 + i * 31 + j * j) % 997}" for j in range(12)) for i in range(n // 12))


@pytest.mark.parametrize("empty", [True, False])
def test_pipeline_on_odd_tables(spark, tmp_path, empty):
    # so many pages of one source that a line of three of them is no boilerplate
    rows = [(k, _prose(k), "en", "s", 1) for k in [1, 2, 3, 4, *range(1000, 1100)]]
    rows += [(5, _prose(1), "en", "s", 1), (1, _prose(1), "en", "s", 1), (6, None, None, None, None), (None, _prose(9), None, None, None), (7, "", "", "", 0)]
    rows += [(8, _prose(8) + " an item of several plain words that nobody should learn from by heart", "en", "s", 1)]
    found = corpus_pipeline.run(spark, _tables(spark, tmp_path, [] if empty else rows))
    assert set(found.columns) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
    got = sorted(r["doc_id"] or 0 for r in found.collect() if (r["doc_id"] or 0) < 1000)
    # repeated rows of one document stay together, its copy under a larger id goes, and so do empty texts and the benchmark's
    assert got == ([] if empty else [0, 1, 1, 2, 3, 4])
