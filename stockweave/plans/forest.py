"""Forests of regression trees over binned columns: passes of sums per level, for many trees at once.

Every tree grows on a draw of its own from all rows, as many as there are, with
replacement: a row counts in a tree as often as a Poisson number of mean one says. Rows
lie in stored blocks of bins, a byte per column. A pass leads the rows of a block
through the trees by arithmetic on arrays and hands on a count and a sum per open node,
tried column and bin; these are added up and split on executors, node by node, and the
driver gets the splits. What a pass moves follows the trees and the tasks, not the rows.
"""

from __future__ import annotations

import sys
import uuid
import zlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.plans.boosting import BINS, _binned, _cuts, _numbers
from stockweave.session import delete_folder, lean_disk, materialize, run_folder

# Functions of this module travel to executors by value, as those of ``llm`` do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows of a block, and of a task that goes over blocks.
LEAST_BLOCK, MOST_BLOCK = 4096, 65536
ROWS_PER_TASK = 4_000_000
# Nodes whose sums travel in one row, and bytes of sums a task hands on in one pass.
NODES_PER_ROW = 512
BYTES_PER_PASS = 256 * 1024 * 1024
_BLOCK = "bins binary, y binary, key bigint"
_SUMS = "tree int, part int, totals binary, counts binary, sums binary"
_SPLIT = "tree int, part int, totals binary, tried binary, last binary, gain binary"


def _poisson() -> np.ndarray:
    """How often a row is drawn for each value of sixteen random bits."""
    shares, k = [np.exp(-1.0)], 1
    while shares[-1] * 65536 > 0.1:
        shares.append(shares[-1] / k)
        k += 1
    return np.searchsorted(np.cumsum(shares) * 65536, np.arange(65536), side="right").astype(np.uint8)


_DRAWS = _poisson()


def _drawn(seed: int, tree: int, key: int, n: int) -> np.ndarray:
    """How often each row of a block counts in a tree; the same in every pass."""
    bits = np.random.Generator(np.random.SFC64([seed, tree, key]))
    return _DRAWS.take(bits.integers(0, 65536, n, dtype=np.uint16))


@dataclass
class _Tree:
    """Nodes level by level; those of the level that grows come last, from ``start`` on.

    A row goes from its node to ``left``, or one further if its bin of ``column`` is
    above ``last``. A node without a split is its own ``left`` and takes no bin as above.
    ``stats`` are count, sum and sum of squares; ``tried`` the columns of the open nodes;
    ``draw`` the number of its draw.
    """

    number: int
    draw: int
    column: np.ndarray
    last: np.ndarray
    left: np.ndarray
    gain: np.ndarray
    stats: np.ndarray
    start: int
    tried: np.ndarray

    @property
    def open(self) -> int:
        return len(self.left) - self.start

    def light(self) -> _Tree:
        """What a task needs to lead rows through the tree."""
        column, left, tried = self.column.astype(np.int16), self.left.astype(np.int32), self.tried.astype(np.int16)
        return _Tree(self.number, self.draw, column, self.last, left, np.zeros(0), np.zeros((3, 0)), self.start, tried)


def _root(number: int, draw: int, bins: int) -> _Tree:
    column, last, left = np.zeros(1, dtype=np.intp), np.full(1, bins, dtype=np.int16), np.zeros(1, dtype=np.intp)
    return _Tree(number, draw, column, last, left, np.zeros(1), np.zeros((3, 0)), 0, np.zeros((1, 0), dtype=np.intp))


def _stored(train: DataFrame, columns: Sequence[str], label: str, cuts: Sequence[np.ndarray]) -> tuple[DataFrame, int]:
    """Blocks of all rows, written once: bins, a line per column, labels and a key; and the rows."""
    spark = train.sparkSession
    cores, rows = spark.sparkContext.defaultParallelism, train.count()
    size = min(MOST_BLOCK, max(LEAST_BLOCK, rows // (4 * cores)))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, y, held = [], [], 0

        def block() -> pa.RecordBatch:
            data, labels = np.concatenate(bins, axis=1).tobytes(), np.concatenate(y).tobytes()
            key = zlib.crc32(labels, zlib.crc32(data))
            return pa.RecordBatch.from_pydict({"bins": [data], "y": [labels], "key": [key]})

        for batch in batches:
            *values, own = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not np.isfinite(own).all():
                raise ValueError("a label is missing or not finite")
            bins.append(_binned(values, cuts))
            y.append(own)
            held += len(own)
            if held >= size:
                yield block()
                bins, y, held = [], [], 0
        if held:
            yield block()

    tasks = max(cores, -(-rows // ROWS_PER_TASK))
    blocks = _numbers(train, *columns, label).mapInArrow(pack, _BLOCK)
    return materialize(blocks.repartition(tasks)), rows


def _sums_of(grown: Sequence[_Tree], level: int, seed: int, bins: int):
    """A task's part of a pass: totals of the open nodes of each tree, and sums of their tried columns."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = []
        for batch in batches:
            for own, y, key in zip(*batch.columns):
                labels = np.frombuffer(y.as_buffer())
                blocks.append((np.frombuffer(own.as_buffer(), dtype=np.uint8), labels, key.as_py()))
        for tree in grown if blocks else ():
            nodes, width = tree.open, tree.tried.shape[1]
            column, left, tried = (a.astype(np.intp) for a in (tree.column, tree.left, tree.tried))
            totals = np.zeros((3, nodes))
            counts, sums = np.zeros(nodes * width * bins), np.zeros(nodes * width * bins)
            for flat, y, key in blocks:
                n = len(y)
                times = _drawn(seed, tree.draw, key, n)
                rows = np.flatnonzero(times)
                node = np.zeros(len(rows), dtype=np.intp)
                for _ in range(level):
                    above = flat.take(column.take(node) * n + rows) > tree.last.take(node)
                    node = left.take(node) + above
                if level:
                    here = np.flatnonzero(node >= tree.start)
                    rows, node = rows.take(here), node.take(here) - tree.start
                weight, label = times.take(rows).astype(float), y.take(rows)
                weighted = weight * label
                for k, values in enumerate((weight, weighted, weighted * label)):
                    totals[k] += np.bincount(node, values, nodes)
                for k in range(width):
                    cell = flat.take(tried[:, k].take(node) * n + rows) + (node * width + k) * bins
                    counts += np.bincount(cell, weight, len(counts))
                    sums += np.bincount(cell, weighted, len(sums))
            for part in range(0, nodes, NODES_PER_ROW):
                own = slice(part, part + NODES_PER_ROW)
                cells = slice(part * width * bins, (part + NODES_PER_ROW) * width * bins)
                yield pa.RecordBatch.from_pydict(
                    {
                        "tree": pa.array([tree.number], pa.int32()),
                        "part": pa.array([part], pa.int32()),
                        "totals": [np.ascontiguousarray(totals[:, own]).tobytes()],
                        "counts": [counts[cells].astype(np.uint32).tobytes()],
                        "sums": [sums[cells].tobytes()],
                    }
                )

    return add


def _split_of(width: int, bins: int, least: int):
    """Adds up what the tasks hand on for some nodes of a tree and finds the best split of each."""

    def best(table: pa.Table) -> pa.Table:
        def added(name: str, kind: type) -> np.ndarray:
            parts = [np.frombuffer(v.as_buffer(), dtype=kind) for v in table.column(name)]
            # In the order of their bytes, so that the sum does not depend on who came first.
            return np.sum(sorted(parts, key=lambda p: p.tobytes()), axis=0, dtype=float)

        totals = added("totals", float).reshape(3, -1)
        nodes = totals.shape[1]
        tried, last, gain = np.zeros(nodes, dtype=np.int16), np.full(nodes, -1, dtype=np.int16), np.zeros(nodes)
        if width:
            left = [added(c, kind).reshape(nodes, width, bins).cumsum(axis=2) for c, kind in (("counts", np.uint32), ("sums", float))]
            n, s = totals[0][:, None, None], totals[1][:, None, None]
            right = n - left[0], s - left[1]
            with np.errstate(divide="ignore", invalid="ignore"):
                lower = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - s**2 / n
            lower = np.where((left[0] >= least) & (right[0] >= least), lower, 0.0).reshape(nodes, -1)
            at = lower.argmax(axis=1)
            found = lower[np.arange(nodes), at]
            # What is left of equal labels by rounding is no gain.
            split = found > 1e-12 * totals[2]
            tried[split], last[split] = at[split] // bins, at[split] % bins
            gain[split] = found[split] / totals[0][split]
        row = {"tree": table.column("tree")[0].as_py(), "part": table.column("part")[0].as_py()}
        arrays = {"totals": totals, "tried": tried, "last": last, "gain": gain}
        row |= {name: a.tobytes() for name, a in arrays.items()}
        kinds = {"tree": pa.int32(), "part": pa.int32()}
        return pa.table({name: pa.array([v], kinds.get(name, pa.binary())) for name, v in row.items()})

    return best


def _width(columns: int) -> int:
    """Columns a node tries: a third, as Spark's ``onethird`` does."""
    return -(-columns // 3)


def _tried(seed: int, tree: int, level: int, nodes: int, columns: int, width: int) -> np.ndarray:
    """The columns each open node may split on, drawn for the node."""
    bits = np.random.Generator(np.random.SFC64([seed, tree, level, 1]))
    return bits.random((nodes, columns)).argsort(axis=1)[:, :width].astype(np.intp)


def _pass(blocks: DataFrame, trees: Sequence[_Tree], level: int, width: int, bins: int, least: int, seed: int) -> None:
    """Take the sums of a level and split its nodes; the children are the next level's."""
    sums = blocks.mapInArrow(_sums_of([t.light() for t in trees], level, seed, bins), _SUMS)
    found = sums.groupBy("tree", "part").applyInArrow(_split_of(width, bins, least), _SPLIT).collect()
    own = {t.number: t for t in trees}
    parts: dict[int, list] = {}
    for row in sorted(found, key=lambda r: (r["tree"], r["part"])):
        parts.setdefault(row["tree"], []).append(row)
    for number, rows in parts.items():
        tree = own[number]

        def whole(name: str, kind: type, axis: int = 0) -> np.ndarray:
            arrays = [np.frombuffer(r[name], dtype=kind) for r in rows]
            return np.concatenate([a.reshape(3, -1) if axis else a for a in arrays], axis=axis)

        last, count = whole("last", np.int16), len(tree.left)
        split = np.flatnonzero(last >= 0)
        tree.stats = np.concatenate([tree.stats, whole("totals", float, 1)], axis=1)
        tree.gain[tree.start :] = whole("gain", float)
        if len(split):
            tree.column[tree.start + split] = tree.tried[split, whole("tried", np.int16)[split]]
            tree.last[tree.start + split] = last[split]
            tree.left[tree.start + split] = count + 2 * np.arange(len(split))
        grown = 2 * len(split)
        tree.column = np.append(tree.column, np.zeros(grown, dtype=np.intp))
        tree.last = np.append(tree.last, np.full(grown, bins, dtype=np.int16))
        tree.left = np.append(tree.left, count + np.arange(grown))
        tree.gain = np.append(tree.gain, np.zeros(grown))
        tree.start = count


def _grow(
    blocks: DataFrame, trees: int, depth: int, columns: int, width: int, least: int, seed: int, bins: int
) -> list[_Tree]:
    forest = [_root(t, t, bins) for t in range(trees)]
    for level in range(depth + 1):
        # Nodes of the last level are leaves: only their totals are taken.
        tries = width if level < depth else 0
        left = [t for t in forest if t.open]
        for t in left:
            t.tried = _tried(seed, t.number, level, t.open, columns, tries)
        while left:
            size, together = 0, []
            while left and (not together or size + left[0].open * (24 + 12 * tries * bins) <= BYTES_PER_PASS):
                size += left[0].open * (24 + 12 * tries * bins)
                together.append(left.pop(0))
            _pass(blocks, together, level, tries, bins, least, seed)
            for tree in together:
                # A draw of a few rows may be empty; then the tree draws anew.
                if not level and not tree.stats[0, 0]:
                    again = _root(tree.number, tree.draw + trees, bins)
                    again.tried = _tried(seed, again.draw, level, 1, columns, tries)
                    forest[tree.number] = again
                    left.append(again)
    return forest


def _model(
    spark: SparkSession, forest: Sequence[_Tree], like: RandomForestRegressor, cuts: Sequence[np.ndarray]
) -> RandomForestRegressionModel:
    """The trees as a model of Spark's, which scores and stores them.

    A model of a single row, with the same settings, is stored; its nodes are put in place.
    """
    fields = {k: [] for k in ("tree", "id", "count", "sum", "squares", "gain", "left", "column", "cut")}
    for tree in forest:
        inner = tree.left > np.arange(len(tree.left))
        fields["tree"].append(np.full(len(inner), tree.number, dtype=np.int32))
        fields["id"].append(np.arange(len(inner), dtype=np.int32))
        for name, values in zip(("count", "sum", "squares"), tree.stats):
            fields[name].append(values)
        fields["gain"].append(np.where(inner, tree.gain, -1.0))
        fields["left"].append(np.where(inner, tree.left, -1).astype(np.int32))
        fields["column"].append(np.where(inner, tree.column, -1).astype(np.int32))
        fields["cut"].append(
            np.array([cuts[c][b] if i else 0.0 for c, b, i in zip(tree.column, tree.last, inner)], dtype=float)
        )
    flat = spark.createDataFrame(pa.table({k: np.concatenate(v) for k, v in fields.items()}))
    inner, none = F.col("left") >= 0, F.lit(-1).cast("int")
    mean = F.col("sum") / F.col("count")
    spread = F.greatest(F.col("squares") / F.col("count") - mean * mean, F.lit(0.0))
    node = F.struct(
        "id",
        mean.alias("prediction"),
        spread.alias("impurity"),
        F.array("count", "sum", "squares").alias("impurityStats"),
        F.col("count").cast("bigint").alias("rawCount"),
        "gain",
        F.col("left").alias("leftChild"),
        F.when(inner, F.col("left") + 1).otherwise(none).alias("rightChild"),
        F.struct(
            F.col("column").alias("featureIndex"),
            F.when(inner, F.array("cut")).otherwise(F.array().cast("array<double>")).alias("leftCategoriesOrThreshold"),
            none.alias("numCategories"),
        ).alias("split"),
    )
    row = spark.createDataFrame(
        [(Vectors.dense([0.0] * len(cuts)), 0.0)], [like.getFeaturesCol(), like.getLabelCol()]
    )
    path = f"{run_folder(spark)}/forest-{uuid.uuid4().hex}"
    like.fit(row).write().save(path)
    flat.select(F.col("tree").alias("treeID"), node.alias("nodeData")).write.mode("overwrite").parquet(f"{path}/data")
    fitted = RandomForestRegressionModel.load(path)
    delete_folder(spark, path)
    return fitted


def fit_whole_forest(
    train: DataFrame, columns: Sequence[str], like: RandomForestRegressor, bins: int = BINS
) -> RandomForestRegressionModel:
    """The forest ``like`` describes, every tree grown on a draw of the whole table.

    Bins are laid out by all rows; trees, depth, rows per leaf and seed are those of ``like``.
    """
    spark = train.sparkSession
    cuts = _cuts(train, columns, bins)
    with lean_disk(spark):
        blocks, rows = _stored(train, columns, like.getLabelCol(), cuts)
        if not rows:
            raise ValueError("no rows to train a forest on")
        width = _width(len(columns))
        least, seed = like.getMinInstancesPerNode(), like.getSeed() % 2**32
        forest = _grow(
            blocks, like.getNumTrees(), like.getMaxDepth(), len(columns), width, least, seed, bins
        )
    return _model(spark, forest, like, cuts)
