"""Boosted regression trees over binned columns: a pass of sums per level, added up by Spark.

A row is its bins, a byte per column, and its residual. Rows lie in blocks, a binary
value for all bins and one for all residuals, which Spark keeps from round to round:
a pass is arithmetic on arrays, and nothing is done row by row. A level of a tree takes
one pass over all rows: a task hands on a count and a sum per node, column and bin,
from which the driver splits the nodes. What a task hands on follows the tree and not
the table.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Functions of this module travel to executors by value, as those of ``llm`` do.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Bins of a column; at most 256, as a bin is a byte.
BINS = 32
# Values of a batch, and of a task, that stand for all when the bins are laid out.
BATCH_PICKS, TASK_PICKS = 512, 2048
# Values a task gathers before it thins them.
_GATHERED = 16 * TASK_PICKS


@dataclass
class Tree:
    """Nodes level by level, those of a level from left to right, every level full.

    A row goes right if its bin of ``column`` is above ``last``; a node without a
    split sends all to the left. ``values`` are those of the leaves, weighted.
    """

    column: np.ndarray
    last: np.ndarray
    values: np.ndarray


@dataclass
class BoostedTrees:
    """The sum of ``trees``; a bin of a column ends with each of its ``cuts``, that value included."""

    columns: tuple[str, ...]
    cuts: list[np.ndarray]
    trees: list[Tree] = field(default_factory=list)

    def transform(self, rows: DataFrame, out: str = "prediction") -> DataFrame:
        """``rows`` with the forecast of each; a missing feature is an error."""

        @F.pandas_udf("double")
        def forecast(*values: pd.Series) -> pd.Series:
            bins = _binned([v.to_numpy() for v in values], self.cuts)
            return pd.Series(reduce(np.add, (_values(bins, t) for t in self.trees)))

        return rows.withColumn(out, forecast(*[F.col(c).cast("double") for c in self.columns]))


def _binned(values: Sequence[np.ndarray], cuts: Sequence[np.ndarray]) -> np.ndarray:
    """The bins of rows, a line per column."""
    if any(np.isnan(v).any() for v in values):
        raise ValueError("a feature is missing")
    return np.array([np.searchsorted(c, v, side="left") for v, c in zip(values, cuts)], dtype=np.uint8)


def _places(bins: np.ndarray, column: np.ndarray, last: np.ndarray, levels: int) -> np.ndarray:
    """The place of each row among the nodes of a level, from the left."""
    n = bins.shape[1]
    rows, place, flat = np.arange(n), np.zeros(n, dtype=np.intp), bins.ravel()
    for level in range(levels):
        node = place + (2**level - 1)
        place = 2 * place + (flat.take(column.take(node) * n + rows) > last.take(node))
    return place


def _values(bins: np.ndarray, tree: Tree) -> np.ndarray:
    levels = len(tree.values).bit_length() - 1
    return tree.values[_places(bins, tree.column, tree.last, levels)]


def _numbers(train: DataFrame, *columns: str) -> DataFrame:
    return train.select(*[F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(columns)])


def _thinned(values: np.ndarray, weights: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each line ``size`` values at even steps of the weight, sorted, all of one weight."""
    if values.shape[1] <= size:
        return values, weights
    order, total = values.argsort(axis=1), weights.sum()
    steps = (np.arange(size) + 0.5) * (total / size)
    at = [np.searchsorted(weights[o].cumsum(), steps) for o in order]
    picked = [v[o[np.minimum(i, len(o) - 1)]] for v, o, i in zip(values, order, at)]
    return np.array(picked), np.full(size, total / size)


def _cuts(train: DataFrame, columns: Sequence[str], bins: int) -> list[np.ndarray]:
    """The values between the bins of each column, of about as many rows each; one pass.

    Every row counts. A batch is sorted and thinned, as is what a task has gathered, so
    a bin is off by some thousandths of the rows. A column of few values has a bin for each.
    """

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        values, weights = np.zeros((len(columns), 0)), np.zeros(0)
        for batch in batches:
            own = np.sort([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            n = own.shape[1]
            picks = min(n, BATCH_PICKS)
            at = ((np.arange(picks) + 0.5) * n / max(1, picks)).astype(np.intp)
            values = np.concatenate([values, own[:, at]], axis=1)
            weights = np.append(weights, np.full(picks, n / max(1, picks)))
            if len(weights) > _GATHERED:
                values, weights = _thinned(values, weights, TASK_PICKS)
        values, weights = _thinned(values, weights, TASK_PICKS)
        yield pa.RecordBatch.from_pydict({"v": [values.tobytes()], "w": [weights.tobytes()]})

    found = _numbers(train, *columns).mapInArrow(thin, "v binary, w binary").collect()
    values = [np.frombuffer(r["v"]).reshape(len(columns), -1) for r in found]
    weights = np.concatenate([np.zeros(0), *[np.frombuffer(r["w"]) for r in found]])
    cuts = []
    for column in np.concatenate([np.zeros((len(columns), 0)), *values], axis=1):
        few = np.unique(column)
        if len(few) > bins:
            order = column.argsort()
            steps = np.arange(1, bins) * (weights.sum() / bins)
            few = np.unique(column[order[np.searchsorted(weights[order].cumsum(), steps)]])
        cuts.append(few[: bins - 1])
    return cuts


def _kept(train: DataFrame, columns: Sequence[str], label: str, cuts: Sequence[np.ndarray]) -> DataFrame:
    """Blocks of all rows: bins, a line per column, and labels."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *values, y = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not np.isfinite(y).all():
                raise ValueError("a label is missing or not finite")
            yield _block(_binned(values, cuts), y)

    return _numbers(train, *columns, label).mapInArrow(pack, _BLOCK)


_BLOCK = "bins binary, rest binary"


def _block(bins: np.ndarray, rest: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"bins": [bins.tobytes()], "rest": [rest.tobytes()]})


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bins, a line per column, and residuals of each block that is not empty."""
    for batch in batches:
        for bins, rest in zip(batch.column(0), batch.column(1)):
            own = np.frombuffer(rest.as_buffer())
            if len(own):
                yield np.frombuffer(bins.as_buffer(), dtype=np.uint8).reshape(-1, len(own)), own


def _left_over(kept: DataFrame, tree: Tree) -> DataFrame:
    """The kept rows with what one more tree leaves of their residuals."""

    def less(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bins, rest in _blocks(batches):
            yield _block(bins, rest - _values(bins, tree))

    return kept.mapInArrow(less, _BLOCK)


def _sums(kept: DataFrame, column: np.ndarray, last: np.ndarray, level: int, columns: int, bins: int) -> np.ndarray:
    """Count and sum of the residuals, (2, node of the level, column, bin); one pass."""
    cells = 2**level * bins

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, columns, cells))
        for own, rest in _blocks(batches):
            node = _places(own, column, last, level) * bins
            for k in range(columns):
                cell = node + own[k]
                total[0, k] += np.bincount(cell, minlength=cells)
                total[1, k] += np.bincount(cell, weights=rest, minlength=cells)
        yield pa.RecordBatch.from_pydict({"sums": [total.tobytes()]})

    total = np.zeros((2, columns, cells))
    for row in kept.mapInArrow(add, "sums binary").collect():
        total += np.frombuffer(row["sums"]).reshape(total.shape)
    return total.reshape(2, columns, 2**level, bins).transpose(0, 2, 1, 3)


def _splits(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Column and last bin on the left for each node, and the means left and right of it.

    The split lowers the squared error most. A node that no split makes better has
    all its rows on the left.
    """
    nodes, _, bins = sums.shape[1:]
    left = sums.cumsum(axis=3)
    whole = left[:, :, :1, -1:]
    right = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left[1] ** 2 / left[0] + right[1] ** 2 / right[0] - whole[1] ** 2 / whole[0]
        gain = np.where((left[0] > 0) & (right[0] > 0), gain, 0.0).reshape(nodes, -1)
        best = gain.argmax(axis=1)
        split = gain[np.arange(nodes), best] > 0
        column, last = np.where(split, best // bins, 0), np.where(split, best % bins, bins)
        at = np.arange(nodes), column, np.minimum(last, bins - 1)
        means = [side[1][at] / side[0][at] for side in (np.where(split[:, None, None], left, whole), right)]
    return column, last, np.nan_to_num(np.column_stack(means), nan=0.0, posinf=0.0, neginf=0.0)


def _grown(kept: DataFrame, depth: int, columns: int, bins: int, weight: float) -> Tree:
    """A tree on the residuals of the kept rows, one pass per level."""
    column, last = np.zeros(0, dtype=np.intp), np.zeros(0, dtype=np.intp)
    for level in range(depth):
        own_column, own_last, means = _splits(_sums(kept, column, last, level, columns, bins))
        column, last = np.append(column, own_column), np.append(last, own_last)
    return Tree(column, last, weight * means.ravel())


def fit_boosted_trees(
    train: DataFrame,
    columns: Sequence[str],
    label: str,
    rounds: int = 20,
    depth: int = 5,
    step: float = 0.1,
    bins: int = BINS,
) -> BoostedTrees:
    """Trees on the residuals of those before them, every one on all rows.

    Weights are those of Spark's ``GBTRegressor``: the first tree counts in full, a
    later one grows on twice the residual and counts ``step``.
    """
    fitted = BoostedTrees(tuple(columns), _cuts(train, columns, bins))
    kept, before = _kept(train, columns, label, fitted.cuts), None
    for k in range(rounds):
        # The first pass of a round fills the new blocks; then those before may go.
        kept.persist(StorageLevel.MEMORY_AND_DISK)
        fitted.trees.append(_grown(kept, depth, len(columns), bins, 2 * step if k else 1.0))
        if before is not None:
            before.unpersist()
        before, kept = kept, _left_over(kept, fitted.trees[-1])
    if before is not None:
        before.unpersist()
    return fitted
