"""What is learned from labels is learned from all of them."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from canopyspark.llm import quality


@pytest.fixture(scope="module")
def rare(spark):
    """5,200 labelled documents; the bad ones are the last 600 by the hash of their id."""
    words = [f"word{k}{'abcdefgh'[k % 8] * (k % 7)}" for k in range(400)]
    rows = spark.range(5200).withColumn("at", F.row_number().over(Window.orderBy(F.xxhash64("id")))).collect()
    rng, texts, labels = np.random.default_rng(5), [], []
    for r in rows:
        bad = r["at"] > 4600
        picked = [words[k] for k in rng.integers(0, 400, 60)]
        texts.append((r["id"], " ".join(f"#{w}#" if bad else w for w in picked)))
        labels.append((r["id"], int(not bad)))
    return spark.createDataFrame(texts, "doc_id long, text string").repartition(4).cache(), spark.createDataFrame(labels, "doc_id long, quality int").cache()


def test_every_labelled_document_teaches(spark, rare):
    docs, labels = rare
    model = quality.train(docs, labels)
    kept = {r["doc_id"] for r in quality.quality_rules(docs, model).where("kept").collect()}
    good = {r["doc_id"] for r in labels.where("quality = 1").collect()}
    assert len(kept & good) >= 0.99 * len(good) and not kept - good


def test_trees_are_the_same_in_tasks_and_in_memory(rare, monkeypatch):
    docs, labels = rare
    some = labels.where("doc_id < 700")
    want = quality.train(docs, some)
    monkeypatch.setattr(quality, "IN_MEMORY_ROWS", -1)
    for parts in (1, 5):
        got = quality.train(docs.repartition(parts), some)
        assert got.threshold == want.threshold and all(np.array_equal(getattr(got.forest, k), getattr(want.forest, k)) for k in ("roots", "feature", "threshold", "left", "right", "value"))
