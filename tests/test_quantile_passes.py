"""Quantile regression: a pass per round for all quantiles, and lines where they belong."""

import math

import pytest
from pyspark.sql import functions as F

from stockweave.plans.forecast import ROUNDS, fit_quantiles, quantile_forecast


def noisy(spark):
    """Demand whose logarithm is 1 + x / 10 plus a tenth of 0 to 9; a column of ones and a copy beside x."""
    i = F.col("id")
    logged = 1 + (i % 20) / 10 + F.floor(i / 20) % 10 / 10
    rows = spark.range(8000).select(
        (i % 20).cast("int").alias("x"), (i % 20 * 3).alias("copy"), F.lit(1.0).alias("one"), F.expm1(logged).alias("quantity")
    )
    return rows


def test_passes_and_lines(spark):
    rows = noisy(spark)
    spark.sparkContext.setJobGroup("quantiles", "passes")
    try:
        fitted = fit_quantiles(rows, ("x", "copy", "one"))
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("quantiles"))
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    # The copy, the plain fit, the rounds, and twice the residuals' quantiles.
    assert jobs <= 2 * (ROUNDS + 4)
    for row in quantile_forecast(fitted, rows).distinct().collect():
        low = 1 + row["x"] / 10
        assert row["P10"] <= row["P50"] <= row["P90"]
        for name, noise in (("P10", 0.0), ("P50", 0.45), ("P90", 0.85)):
            assert abs(math.log1p(row[name]) - low - noise) < 0.11


def test_missing_feature_is_an_error(spark):
    rows = noisy(spark).withColumn("x", F.when(F.col("quantity") < 30, F.col("x")))
    with pytest.raises(ValueError):
        fit_quantiles(rows, ("x", "one"))
