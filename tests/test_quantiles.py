"""Quantiles by radix selection against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from canopyspark.operators.quantiles import quantiles, to_bits

HARD = [0.0, -0.0, 5e-324, -5e-324, 1e-300, 1.0, 1.0 + 2**-52, 1.0 - 2**-53, 0.1, 0.1 + 2**-56, -1.0, -1.0 - 2**-52, 1e291, 1.7e308, -1.7e308, 123456.789, 123456.7890001]


@pytest.mark.parametrize("levels", [(12, 24, 53), (4, 53), (53,), (30, 53)])
def test_quantiles_of_many_groups(spark, levels):
    rng = np.random.default_rng(1)
    groups = {1: rng.normal(size=500), 2: np.round(rng.normal(size=301), 1), 3: np.array([2.5]), 4: np.array(HARD * 3), 5: 0.5 + rng.random(400) * 1e-9, 6: np.array([1.0, 3.0])}
    rows = [(k, float(v), float(-v) if k != 3 else None) for k, values in groups.items() for v in values] + [(k, None, None) for k in (1, 7)]
    df = spark.createDataFrame(rows, "image_key long, v double, u double")
    wanted = [0.0, 0.1, 0.5, 0.77, 1.0]
    got = {r["image_key"]: r for r in quantiles(df, {"v": (F.col("v"), wanted), "u": (F.col("u"), [0.9])}, levels=levels).collect()}
    assert set(got) == set(groups)
    for k, values in groups.items():
        exact = df.where(F.col("image_key") == k).agg(F.percentile("v", wanted), F.percentile("u", 0.9)).first()
        assert got[k]["v"] == exact[0] and (got[k]["u"] or [None]) == [exact[1]]
        if k != 4:
            assert np.allclose(got[k]["v"], np.quantile(values, wanted), rtol=0, atol=1e-15)


def test_nan_is_the_largest(spark):
    df = spark.createDataFrame([(1, 1.0), (1, float("nan")), (1, 2.0), (2, float("inf")), (2, 1.0), (2, float("-inf"))], "image_key long, v double")
    got = {r["image_key"]: r["v"] for r in quantiles(df, {"v": (F.col("v"), [0.0, 0.5])}).collect()}
    assert got == {1: [1.0, 2.0], 2: [float("-inf"), 1.0]}


def test_rounding_keeps_order(spark):
    values = sorted(HARD + list(np.random.default_rng(2).normal(size=2000) * 10.0 ** np.random.default_rng(3).integers(-30, 30, 2000)))
    df = spark.createDataFrame([(k, float(v)) for k, v in enumerate(values)], "k long, v double")
    for bits in (4, 12, 24):
        forms = [r["f"] for r in df.withColumn("f", to_bits(F.col("v"), bits)).orderBy("k").collect()]
        assert all(a <= b for a, b in zip(forms, forms[1:], strict=False))


def test_counts_are_partial_and_nothing_is_buffered(spark):
    plan = quantiles(spark.range(10).selectExpr("id % 2 AS image_key", "id * 1.5D AS v"), {"v": (F.col("v"), [0.5])})._jdf.queryExecution().executedPlan().toString()
    assert "ercentile" not in plan and "ObjectHashAggregate" not in plan and "CartesianProduct" not in plan
