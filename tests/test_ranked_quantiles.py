"""Quantiles by rank within dealt groups, and how often the queries on point clouds shuffle."""

import pytest
from pyspark.sql import functions as F

from canopyspark.operators.quantiles import quantiles, ranked_quantiles
from canopyspark.plans import registry


def test_ranked_quantiles_equal_those_by_selection(spark):
    rows = [(k % 5, None if k % 7 == 0 else (k * 37 % 101) / 8 - 3, float("nan") if k % 50 == 3 else -0.0 if k % 3 else float(k)) for k in range(400)] + [(9, None, 2.0), (8, None, None)]
    df = spark.createDataFrame(rows, "image_key long, v double, u double")
    wanted = {"a": (F.col("v"), [0.0, 0.33, 0.5, 1.0]), "b": (F.col("u"), [0.9])}
    got, want = ({r["image_key"]: repr((r["a"], r["b"])) for r in f(df, wanted).collect()} for f in (ranked_quantiles, quantiles))
    assert got == want and set(got) == {0, 1, 2, 3, 4, 9}
    more = {r["image_key"]: r["n"] for r in ranked_quantiles(df, wanted, [F.count("*").alias("n")]).collect()}
    assert more == {0: 80, 1: 80, 2: 80, 3: 80, 4: 80, 8: 1, 9: 1}


@pytest.mark.parametrize("name", ["virtual_fov", "render_coverage"])
def test_clouds_are_dealt_by_image_few_times(spark, sf_dir, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = registry.QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    made = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(made) <= 14, len(made)
