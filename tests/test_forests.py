"""Forests over tables larger than their trees need: grown in groups, one forecast."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from stockweave.plans import forest
from stockweave.plans.forecast import TREES_PER_GROUP, fit_forest


def test_trees_of_a_large_table_grow_in_groups(spark, tmp_path):
    rows = spark.range(6000).select(
        (F.col("id") % 100).cast("double").alias("x"),
        F.rand(1).alias("noise"),
        F.when(F.col("id") % 100 < 50, 10.0).otherwise(30.0).alias("quantity"),
    )
    fitted = fit_forest(rows, ("x", "noise"), trees=25, depth=4, rows_per_tree=200)
    forests = fitted.stages[1:-1]
    assert [f.getNumTrees for f in forests] == [TREES_PER_GROUP, TREES_PER_GROUP, 5]
    # The root of a tree holds what it has drawn: about 200 of the 6000 rows.
    drawn = [t._call_java("rootNode").impurityStats().count() for f in forests for t in f.trees]
    assert all(100 <= n <= 320 for n in drawn)
    scored = fitted.transform(rows)
    assert scored.columns == ["x", "noise", "quantity", "_x", "prediction"]
    far = scored.where((F.abs(F.col("x") - 49.5) > 5) & (F.abs(F.col("prediction") - F.col("quantity")) > 6))
    assert far.count() == 0
    fitted.write().save(f"{tmp_path}/forest")
    again = PipelineModel.load(f"{tmp_path}/forest").transform(scored.drop("_x").withColumnRenamed("prediction", "_was"))
    assert again.where(F.col("prediction") != F.col("_was")).count() == 0


def test_small_table_stays_one_forest(spark):
    rows = spark.range(400).select(F.col("id").cast("double").alias("x"), F.col("id").alias("quantity"))
    fitted = fit_forest(rows, ("x",), trees=12, depth=3, rows_per_tree=100)
    assert [type(s).__name__ for s in fitted.stages] == ["VectorAssembler", "RandomForestRegressionModel"]
    assert fitted.stages[-1].getNumTrees == 12


def test_every_tree_draws_from_the_whole_table(spark, tmp_path):
    rows = spark.range(30_000, numPartitions=3).select(
        (F.col("id") * 37 % 101).cast("double").alias("x"),
        F.rand(1).alias("noise"),
        F.when(F.col("id") * 37 % 101 < 50, 10.0).otherwise(30.0).alias("quantity"),
    )
    fitted = fit_forest(rows, ("x", "noise"), trees=5, depth=3)
    assert [type(s).__name__ for s in fitted.stages] == ["VectorAssembler", "RandomForestRegressionModel"]
    trees = fitted.stages[-1].trees
    # The root of a tree holds what it has drawn, with replacement: as many as there are rows.
    drawn = [t._call_java("rootNode").impurityStats().count() for t in trees]
    assert len(set(drawn)) == 5 and all(abs(n - 30_000) < 6 * 30_000**0.5 for n in drawn)
    scored = fitted.transform(rows)
    assert scored.columns == ["x", "noise", "quantity", "_x", "prediction"]
    fitted.write().save(f"{tmp_path}/forest")
    again = PipelineModel.load(f"{tmp_path}/forest").transform(scored.drop("_x").withColumnRenamed("prediction", "_was"))
    assert again.where(F.col("prediction") != F.col("_was")).count() == 0
    figures = scored.where("x < 40 or x > 60").groupBy("quantity").agg(F.avg("prediction")).collect()
    assert {q: round(p) for q, p in figures}.keys() == {10.0, 30.0}
    assert all(abs(q - p) < 8 for q, p in figures)


def _plain(x, y, depth, least):
    """Forecasts of one tree on all rows, every cut of every column tried."""
    forecast = np.zeros(len(y))
    nodes = [(np.arange(len(y)), 0)]
    while nodes:
        own, level = nodes.pop()
        best, parts = 1e-9, None
        for v in x if level < depth else ():
            for cut in np.unique(v[own])[:-1]:
                low = v[own] <= cut
                sides = own[low], own[~low]
                gain = sum(y[s].sum() ** 2 / len(s) for s in sides) - y[own].sum() ** 2 / len(own)
                if min(map(len, sides)) >= least and gain > best * (1 + 1e-9):
                    best, parts = gain, sides
        if parts is None:
            forecast[own] = y[own].mean()
        else:
            nodes += [(p, level + 1) for p in parts]
    return forecast


@pytest.mark.parametrize("limit", [256 * 1024 * 1024, 1])
def test_trees_are_those_grown_on_one_list_of_rows(spark, monkeypatch, limit):
    # every row drawn once, every column tried: then a tree has one right form
    monkeypatch.setattr(forest, "_DRAWS", np.ones(65536, dtype=np.uint8))
    monkeypatch.setattr(forest, "_width", lambda columns: columns)
    monkeypatch.setattr(forest, "BYTES_PER_PASS", limit)
    monkeypatch.setattr(forest, "NODES_PER_ROW", 3)
    monkeypatch.setattr(forest, "LEAST_BLOCK", 100)
    rng = np.random.default_rng(5)
    x = np.array([rng.integers(0, 30, 3000), rng.integers(0, 9, 3000), rng.integers(0, 2, 3000)], dtype=float)
    y = x[0] * (x[1] > 4) + 7 * x[2] + rng.integers(0, 5, 3000)
    rows = spark.createDataFrame([(*map(float, r), float(q)) for *r, q in zip(*x, y)], "a double, b double, c double, quantity double")
    fitted = fit_forest(rows.repartition(3), ("a", "b", "c"), trees=2, depth=4)
    scored = fitted.transform(rows).collect()
    assert np.allclose([r.prediction for r in scored], _plain(x, y, 4, 10))
    nodes = [t._call_java("rootNode") for t in fitted.stages[-1].trees]
    assert all(n.impurityStats().count() == 3000 for n in nodes)
    assert np.allclose([n.impurity() for n in nodes], y.var())


def test_odd_tables_of_a_whole_forest(spark):
    ddl = "x double, quantity double"
    one = spark.createDataFrame([(1.0, 5.0)], ddl)
    # a tree that has drawn nothing draws anew
    assert fit_forest(one, ("x",), trees=8, depth=2).transform(one).first().prediction == 5.0
    same = spark.createDataFrame([(float(i), 0.1) for i in range(50)], ddl)
    assert [t.numNodes for t in fit_forest(same, ("x",), trees=3, depth=2).stages[-1].trees] == [1, 1, 1]
    with pytest.raises(ValueError, match="no rows"):
        fit_forest(one.limit(0), ("x",), trees=2, depth=2)
    for row in ((None, 1.0), (1.0, None)):
        with pytest.raises(Exception, match="missing"):
            fit_forest(spark.createDataFrame([(1.0, 1.0), row], ddl), ("x",), trees=2, depth=1)
