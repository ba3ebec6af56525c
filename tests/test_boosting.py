"""Boosted trees whose levels are passes of sums over blocks of binned rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockweave.plans import boosting
from stockweave.plans.boosting import fit_boosted_trees


def _rows(spark, n):
    x, flag = (F.col("id") * 37 % 101).cast("double"), (F.col("id") % 50 == 0).cast("int")
    y = F.when(x <= 40, 1.0).otherwise(3.0) + flag * 2
    return spark.range(n, numPartitions=5).select("id", x.alias("x"), flag.alias("flag"), y.alias("y"))


def _plain(rows, rounds, depth):
    """Forecasts of the same trees, grown on one list of rows, every cut tried."""
    values, y = [np.array([r[c] for r in rows], dtype=float) for c in ("x", "flag")], np.array([r.y for r in rows])
    cuts = [np.unique(v) for v in values]
    forecast = np.zeros(len(y))
    for k in range(rounds):
        nodes, rest = [np.arange(len(y))], y - forecast
        for _ in range(depth):
            grown = []
            for own in nodes:
                best, parts = 1e-9, [own]
                for v, cut in ((v, c) for v, cs in zip(values, cuts) for c in cs):
                    sides = [own[v[own] <= cut], own[v[own] > cut]]
                    if all(map(len, sides)):
                        gain = sum(rest[s].sum() ** 2 / len(s) for s in sides) - rest[own].sum() ** 2 / len(own)
                        if gain > best * (1 + 1e-9):
                            best, parts = gain, sides
                grown += parts
            nodes = grown
        for own in nodes:
            forecast[own] += (0.2 if k else 1.0) * rest[own].mean()
    return forecast


def test_trees_are_those_of_all_rows(spark):
    rows = _rows(spark, 3000).where("x < 12 or x > 85").withColumn("y", F.col("y") + F.col("x") % 7)
    fitted = fit_boosted_trees(rows, ("x", "flag"), "y", rounds=4, depth=3)
    scored = fitted.transform(rows).orderBy("id").collect()
    assert np.allclose([r.prediction for r in scored], _plain(scored, 4, 3))
    assert scored[0].asDict().keys() == {"id", "x", "flag", "y", "prediction"}


def test_levels_take_no_spark_tree_and_leave_nothing_kept(spark):
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    rows = _rows(spark, 40_000)
    fitted = fit_boosted_trees(rows, ("x", "flag"), "y", rounds=3, depth=2)
    assert type(fitted).__module__ == boosting.__name__ and len(fitted.trees) == 3
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before
    far = fitted.transform(rows).where((F.abs(F.col("x") - 40) > 4) & (F.abs(F.col("prediction") - F.col("y")) > 0.3))
    assert far.count() == 0


def test_many_values_are_cut_evenly(spark, monkeypatch):
    monkeypatch.setattr(boosting, "_GATHERED", 3000)
    rows = spark.range(200_000, numPartitions=3).select(((F.col("id") * 7919) % 200_000).cast("double").alias("x"))
    cuts = boosting._cuts(rows, ["x"], 32)[0]
    assert len(cuts) == 31 and np.abs(cuts / 200_000 - np.arange(1, 32) / 32).max() < 0.004


def test_odd_tables(spark):
    ddl = "x double, y double"
    empty = fit_boosted_trees(spark.createDataFrame([], ddl), ("x",), "y", rounds=2, depth=2)
    same = fit_boosted_trees(spark.createDataFrame([(1.0, 5.0)] * 3, ddl), ("x",), "y", rounds=2, depth=2)
    one = spark.createDataFrame([(math.inf, 0.0)], ddl)
    assert empty.transform(one).first().prediction == 0.0 and same.transform(one).first().prediction == 5.0
    for row in ((None, 1.0), (1.0, None)):
        with pytest.raises(Exception, match="missing"):
            fit_boosted_trees(spark.createDataFrame([(1.0, 1.0), row], ddl), ("x",), "y", rounds=1, depth=1)
