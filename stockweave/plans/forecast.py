"""Demand forecasts: quantiles, Poisson rate, forest; and how they are scored."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.regression import GeneralizedLinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.functions.exprs import round_half_up
from stockweave.plans.boosting import BoostedTrees, fit_boosted_trees
from stockweave.plans.features import DEMAND_FEATURES, TARGET
from stockweave.plans.forest import fit_whole_forest
from stockweave.session import materialize

SEED = 42
TEST_SHARE_OF_TEN = 2
LAMBDA_FLOOR = 0.1
MAPE_LIMIT = 25.0
# The floor of a relative error's denominator: the double epsilon.
EPSILON = 2.220446049250313e-16
# Trees that draw from the same rows, where a caller asks for fewer than the table has.
TREES_PER_GROUP = 10
LEAST_PER_LEAF = 10
QUANTILES = (0.1, 0.5, 0.9)
# Rounds of reweighting, and the residual under which weights stop growing, halved each round.
ROUNDS = 6
FIRST_REACH, LEAST_REACH = 0.25, 0.01


def split_bucket(*key: str) -> Column:
    """A bucket 0..9 from the row's key: the same rows test on any partitioning."""
    digest = F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key]))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(10))


def train_test(features: DataFrame, *key: str) -> tuple[DataFrame, DataFrame]:
    """80/20 split by key hash."""
    return by_bucket(features.withColumn("_bucket", split_bucket(*key)))


def by_bucket(bucketed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two sides of a table that has its ``_bucket``, without it."""
    test = F.col("_bucket") < TEST_SHARE_OF_TEN
    return bucketed.where(~test).drop("_bucket"), bucketed.where(test).drop("_bucket")


def _vector(columns: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol="_x", handleInvalid="error")


def _forest(trees: int, depth: int, share: float, out: str, seed: int) -> RandomForestRegressor:
    return RandomForestRegressor(
        featuresCol="_x",
        labelCol=TARGET,
        predictionCol=out,
        numTrees=trees,
        maxDepth=depth,
        minInstancesPerNode=LEAST_PER_LEAF,
        subsamplingRate=share,
        featureSubsetStrategy="onethird",
        seed=seed,
        # Node statistics of a level are grouped into passes of this size.
        maxMemoryInMB=1024,
    )


def fit_forest(
    train: DataFrame,
    columns: Sequence[str] = DEMAND_FEATURES,
    trees: int = 100,
    depth: int = 12,
    rows_per_tree: int | None = None,
) -> PipelineModel:
    """A forest over binned features; every tree grows on a draw of the whole table.

    A caller may ask for trees of ``rows_per_tree`` rows each, in the mean. Spark leads
    each row through every tree at every level, drawn by the tree or not, so that
    the time of one forest is that of trees times rows. Over a larger table such
    trees therefore grow in groups: one pass deals to every group the rows its own
    trees draw from, and the forecast is the mean of all trees.
    """
    if rows_per_tree is None:
        like = _forest(trees, depth, 1.0, "prediction", SEED)
        return PipelineModel([_vector(columns), fit_whole_forest(train, columns, like)])
    rows, dealt = max(1, train.count()), TREES_PER_GROUP * rows_per_tree
    if rows <= dealt:
        forest = _forest(trees, depth, min(1.0, rows_per_tree / rows), "prediction", SEED)
        return Pipeline(stages=[_vector(columns), forest]).fit(train)
    sizes = [min(TREES_PER_GROUP, trees - k) for k in range(0, trees, TREES_PER_GROUP)]
    draws = [F.when(F.rand(SEED + g) < dealt / rows, F.lit(g)) for g in range(len(sizes))]
    pools = train.select(*columns, TARGET, F.explode(F.array_compact(F.array(*draws))).alias("_group"))
    vector, cores = _vector(columns), train.sparkSession.sparkContext.defaultParallelism
    pools = materialize(vector.transform(pools).select("_group", "_x", TARGET).repartition(cores))
    groups = [
        _forest(size, depth, 1.0 / TREES_PER_GROUP, f"_p{g}", SEED + g).fit(pools.where(F.col("_group") == g))
        for g, size in enumerate(sizes)
    ]
    total = " + ".join(f"{size} * _p{g}" for g, size in enumerate(sizes))
    parts = ", ".join(f"_p{g}" for g in range(len(sizes)))
    mean = f"SELECT * EXCEPT ({parts}), ({total}) / {trees}D AS prediction FROM __THIS__"
    return PipelineModel([vector, *groups, SQLTransformer(statement=mean)])


def fit_poisson(train: DataFrame, columns: Sequence[str] = DEMAND_FEATURES) -> PipelineModel:
    glm = GeneralizedLinearRegression(
        family="poisson",
        link="log",
        featuresCol="_x",
        labelCol=TARGET,
        predictionCol="_rate",
        maxIter=50,
        regParam=0.01,
    )
    return Pipeline(stages=[_vector(columns), glm]).fit(train)


def poisson_lambda(fitted: PipelineModel, rows: DataFrame) -> DataFrame:
    scored = fitted.transform(rows)
    return scored.withColumn(
        "poisson_lambda", F.greatest(F.col("_rate"), F.lit(LAMBDA_FLOOR))
    ).drop("_x", "_rate")


def fit_log_trees(
    train: DataFrame, columns: Sequence[str] = DEMAND_FEATURES, rounds: int = 20
) -> BoostedTrees:
    """Boosted trees on ``log1p`` of the demand: relative errors count alike at every size."""
    return fit_boosted_trees(train.withColumn("_log", F.log1p(TARGET)), columns, "_log", rounds)


def boosted_rate(fitted: BoostedTrees, rows: DataFrame) -> DataFrame:
    """The demand rate, ``expm1`` of the boosted logarithm and never below the floor."""
    rate = F.greatest(F.expm1("_log_prediction"), F.lit(LAMBDA_FLOOR))
    scored = fitted.transform(rows, "_log_prediction").withColumn("boosted_rate", rate)
    return scored.drop("_log_prediction")


def sku_quantiles(monthly: DataFrame) -> DataFrame:
    """P10, P50, P90 of monthly quantity per product, never below zero.

    The exact percentile keeps a count per distinct value; there is one value
    per month, so the state of even the hottest product stays small.
    """
    q = F.percentile("qty", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))
    floor = F.lit(0.0)
    return (
        monthly.groupBy("product_id")
        .agg(q.alias("_q"))
        .select(
            "product_id",
            *[
                F.greatest(round_half_up(F.element_at("_q", i + 1), 4), floor).alias(name)
                for i, name in enumerate(("P10", "P50", "P90"))
            ],
        )
    )


@dataclass
class QuantileModel:
    """One linear model of the logarithm per quantile: a weight per column and, last, the intercept."""

    columns: tuple[str, ...]
    weights: list[list[float]]


def _line(columns: Sequence[str], weights: Sequence[float]) -> Column:
    terms = [F.lit(float(w)) * F.col(c).cast("double") for c, w in zip(columns, weights)]
    return reduce(add, terms, F.lit(float(weights[-1])))


def _residual_quantiles(
    rows: DataFrame, lines: Sequence[Column], quantiles: Sequence[float]
) -> list[float]:
    """The quantile of ``_y`` minus each line, one for each of ``quantiles``; one pass."""
    parts = [
        F.percentile_approx(F.col("_y") - line, q, 10_000).alias(f"_{i}")
        for i, (line, q) in enumerate(zip(lines, quantiles))
    ]
    return [0.0 if x is None else x for x in rows.agg(*parts).first()]


def _least_squares(
    rows: DataFrame, columns: Sequence[str], reweighted: Sequence[tuple[Sequence[float], float] | None], e: float
) -> list[np.ndarray]:
    """Least-squares lines of ``_y``, one for each of ``reweighted``; one pass for all of them.

    None asks for the plain fit. (weights, q) asks for the one that lowers the pinball
    loss of ``q`` from the line of these weights on. A task hands on its sums of
    products, a few kilobytes however many its rows.
    """
    p = len(columns) + 1

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(reweighted), p, p + 1))
        for batch in batches:
            values = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
            x = np.column_stack([*values, np.ones(batch.num_rows)])
            y = batch.column("_y").to_numpy(zero_copy_only=False)
            for i, old in enumerate(reweighted):
                wx, z = x, y
                if old is not None:
                    reach = np.abs(y - x @ np.asarray(old[0])) + e
                    wx, z = x / reach[:, None], y + (2 * old[1] - 1) * reach
                total[i, :, :p] += wx.T @ x
                total[i, :, p] += wx.T @ z
        yield pa.RecordBatch.from_pydict({"sums": [total.ravel().tolist()]})

    total = np.zeros((len(reweighted), p, p + 1))
    for row in rows.select(*columns, "_y").mapInArrow(sums, "sums array<double>").collect():
        total += np.reshape(row["sums"], total.shape)
    if not np.isfinite(total).all():
        raise ValueError("a feature or the demand is missing or not finite")
    fits = []
    for products in total:
        # Columns of one size; of columns that hang together the least weights count.
        size = np.sqrt(np.maximum(np.diag(products), np.finfo(float).tiny))
        scaled = products[:, :p] / np.outer(size, size)
        fits.append(np.linalg.lstsq(scaled, products[:, p] / size, rcond=1e-12)[0] / size)
    return fits


def fit_quantiles(
    train: DataFrame,
    columns: Sequence[str] = DEMAND_FEATURES,
    quantiles: Sequence[float] = QUANTILES,
    rounds: int = ROUNDS,
) -> QuantileModel:
    """Linear quantile regressions of ``log1p`` of the demand, by the pinball loss.

    Quantiles keep under a monotone transform, so the logarithm costs nothing.
    The loss of a residual r is majorised at the current fit by a parabola: with
    reach a = |r| + e a weighted least-squares fit of y + (2q - 1) a under
    weights 1 / a lowers it. A round is one pass for all quantiles, whose sums are
    added up over the tasks; e is halved from round to round. The intercept is then
    moved to the residuals' own quantile, which is the exact minimum in that direction.
    """
    seen = materialize(
        train.select(*[F.col(c).cast("double").alias(c) for c in columns], F.log1p(TARGET).alias("_y"))
    )

    def moved(fits: Sequence[np.ndarray]) -> list[list[float]]:
        shifts = _residual_quantiles(seen, [_line(columns, w) for w in fits], quantiles)
        return [[*map(float, w[:-1]), float(w[-1]) + s] for w, s in zip(fits, shifts)]

    weights = moved(_least_squares(seen, columns, [None], 0.0) * len(quantiles))
    for k in range(rounds):
        e = max(FIRST_REACH * 0.5**k, LEAST_REACH)
        weights = _least_squares(seen, columns, list(zip(weights, quantiles)), e)
    return QuantileModel(tuple(columns), moved(weights))


def quantile_forecast(fitted: QuantileModel, rows: DataFrame) -> DataFrame:
    """P10/P50/P90 of every row, in order and never below zero.

    Lines of different quantiles may cross far from the data; sorting the three
    values is the usual remedy and loses no coverage.
    """
    lines = [_line(fitted.columns, w) for w in fitted.weights]
    sized = [F.greatest(F.expm1(line), F.lit(0.0)) for line in lines]
    ordered = rows.withColumn("_q", F.array_sort(F.array(*sized)))
    names = [f"P{math.floor(100 * q + 0.5)}" for q in QUANTILES]
    return ordered.select(
        *rows.columns, *[F.element_at("_q", i + 1).alias(name) for i, name in enumerate(names)]
    )


def save_run(
    spark: SparkSession, fitted: PipelineModel, root: str, name: str, version: int, metrics: dict[str, float]
) -> None:
    """Store a fitted pipeline and, once it is whole, its line in the table of runs."""
    fitted.write().overwrite().save(f"{root}/{name}/version={version}")
    line = [(name, version, float(metrics["mape_pct"]), float(metrics["rmse"]))]
    ddl = "model string, version int, mape_pct double, rmse double"
    spark.createDataFrame(line, ddl).write.mode("append").parquet(f"{root}/runs")


def champion(spark: SparkSession, root: str, name: str, limit: float = MAPE_LIMIT) -> PipelineModel | None:
    """The stored pipeline of least MAPE among those good enough to serve, None without one."""
    runs = promotion_gate(spark.read.parquet(f"{root}/runs").where(F.col("model") == name), limit)
    best = runs.where("is_champion = 1").orderBy("mape_pct", F.desc("version")).limit(1).collect()
    return PipelineModel.load(f"{root}/{name}/version={best[0]['version']}") if best else None


def accuracy(
    scored: DataFrame, actual: str, predicted: str, *group: str, also: Sequence[Column] = ()
) -> DataFrame:
    """MAPE in percent and RMSE per group, both to two digits; ``also`` adds aggregates.

    A zero actual makes the relative error astronomically large, as the usual
    definition has it, so these means stay in floating point.
    """
    y, p = F.col(actual), F.col(predicted)
    relative = F.abs(y - p) / F.greatest(F.abs(y), F.lit(EPSILON))
    return scored.groupBy(*group).agg(
        F.count("*").alias("n_rows"),
        F.round(F.avg(relative) * 100.0, 2).alias("mape_pct"),
        F.round(F.sqrt(F.avg((y - p) * (y - p))), 2).alias("rmse"),
        *also,
    )


def baseline_forecasts(features: DataFrame) -> DataFrame:
    """Yesterday's demand and the two rolling means as forecasts, one row each."""
    methods = F.array(
        *[
            F.struct(F.lit(name).alias("method"), F.col(c).cast("double").alias("prediction"))
            for name, c in (
                ("lag_1", "lag_demand_1d"),
                ("rolling_7", "rolling_mean_demand_7d"),
                ("rolling_30", "rolling_mean_demand_30d"),
            )
        ]
    )
    return features.select(
        "product_id", "event_timestamp", TARGET, F.explode(methods).alias("m")
    ).select("product_id", "event_timestamp", TARGET, "m.method", "m.prediction")


def best_run(runs: DataFrame, metric: str, ascending: bool = True) -> DataFrame:
    order = F.col(metric).asc() if ascending else F.col(metric).desc()
    return runs.orderBy(order, "method").limit(1)


def promotion_gate(metrics: DataFrame, limit: float = MAPE_LIMIT) -> DataFrame:
    """Runs good enough to serve: MAPE below the limit."""
    return metrics.withColumn("is_champion", (F.col("mape_pct") < limit).cast("int"))


def latest_version(runs: DataFrame, name: str, version: str, ended: str) -> DataFrame:
    """The highest version and the last finished evaluation per model name."""
    return runs.groupBy(name).agg(
        F.max(version).alias("latest_version"),
        F.max_by(version, F.struct(ended, version)).alias("last_evaluated_version"),
    )
