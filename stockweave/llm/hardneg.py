"""Hard negatives by Fagin's threshold algorithm over per-dimension sorted lists.

Rows are dealt to shards by their id and anchors to blocks; a task holds one block
and one shard. In a shard every dimension has a list of the rows in order of that
component. An anchor reads each list from the end its own sign prefers, in steps
of growing depth; rows met for the first time are looked up and scored. What the
lists show at the current depth bounds the score of every row not met yet: once
that threshold is strictly below the k-th score of each of its windows (so that no
tie can be lost), the anchor is done with the shard. The best of the shards are
merged per anchor.

Positives are found first, over the lists of the anchor's own label; their scores
give the windows for the negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.session import materialize

# Rows of a shard and anchors of a block. Copies of rows grow with rows x anchors.
SHARD_ROWS = 16384
BLOCK_ANCHORS = 4096
# Small tables are still dealt to this many shards, so that many tasks share the work.
LEAST_SHARDS = 32
FIRST_DEPTH = 16
_LONG = (-(2**63), 2**63 - 1)


def quantized(
    df: DataFrame,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 256,
) -> DataFrame:
    """(id, label, vector): the rows that take part, components as floor(scale * x).

    Rows with a NULL id, label or vector, or with a NULL or non-finite component
    take no part. Of rows that share an id, the one of least (label, vector)
    counts, so repeated rows are one.
    """
    x = F.transform(f"`{vector_col}`", lambda v: v.cast("double"))
    usable = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), x.alias("x"))
    odd = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    usable = usable.where("id is not null and label is not null and x is not null").where(~odd)
    whole = usable.select("id", "label", F.transform("x", lambda v: F.floor(v * scale)).alias("vector"))
    first = whole.groupBy("id").agg(F.min(F.struct("label", "vector")).alias("r"))
    return first.select("id", "r.label", "r.vector")


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of integers; shorter ones end in zeros."""
    flat = column.combine_chunks()
    lengths = np.diff(flat.offsets.to_numpy())
    values = flat.values.to_numpy(zero_copy_only=False)[flat.offsets[0].as_py() :]
    if len(lengths) and (lengths == width).all():
        return values[: len(lengths) * width].reshape(-1, width)
    out = np.zeros((len(lengths), width), dtype=np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = values[: lengths.sum()]
    return out


def _width(*tables: pa.Table) -> int:
    lists = [t.column("vector").combine_chunks() for t in tables if t.num_rows]
    return max((int(np.diff(x.offsets.to_numpy()).max(initial=0)) for x in lists), default=0)


def _exact_type(anchors: np.ndarray, rows: np.ndarray) -> type:
    """The fastest number type in which all inner products are exact."""

    def most(x: np.ndarray) -> int:
        return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))

    bound = most(anchors) * most(rows) * anchors.shape[1]
    if bound < 2**24:
        return np.float32
    if bound < 2**53:
        return np.float64
    return np.int64 if bound < 2**63 else object


class Lists:
    """Rows of a shard with one list per dimension, in ascending order of the component."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, kind: type):
        order = np.argsort(ids, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.exact = np.int64 if kind in (np.float32, np.float64) else kind
        self.rows = vectors[order].astype(kind)
        self.by = np.ascontiguousarray(np.argsort(vectors[order], axis=0, kind="stable").T)
        self.values = np.take_along_axis(vectors[order].T, self.by, axis=1).astype(self.exact)

    def scores(self, at: np.ndarray, anchor: np.ndarray) -> np.ndarray:
        """Random access: inner products of the rows ``at`` with the anchor."""
        rows = self.rows if len(at) * 2 > len(self.rows) else self.rows[at]
        found = rows @ anchor
        if rows is self.rows:
            found = found[at]
        return np.rint(found).astype(np.int64) if found.dtype.kind == "f" else np.clip(found, *_LONG)


def _best(scores: np.ndarray, at: np.ndarray, k: int) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Which k have the highest score, ties by smaller id (places follow the ids), and of what."""
    if len(at) > k and scores.dtype != object:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        keep = scores >= kth
        scores, at = scores[keep], at[keep]
    order = sorted(range(len(at)), key=lambda i: (-scores[i], at[i]))[:k]
    return order, scores, at


def threshold_search(
    lists: Lists, anchor: np.ndarray, usable: np.ndarray, windows: list[tuple[int, int]] | None, k: int
) -> list[list[tuple[int, int]]]:
    """For each window the k best (score, id) of the usable rows, by threshold search.

    A window is (low, high): 100 * score must lie within. ``None`` is one window
    without bounds. ``anchor`` has the number type of the lists.
    """
    n, width = len(lists.ids), len(anchor)
    whole = anchor.astype(lists.exact)
    up, down = np.flatnonzero(whole > 0), np.flatnonzero(whole < 0)
    seen = np.zeros(n, dtype=bool)
    places, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    found: list = []
    depth, before = min(FIRST_DEPTH, n), 0
    if not n:
        return [[] for _ in windows or [None]]
    while True:
        # sorted access, from the end each sign prefers
        seen_now = np.zeros(n, dtype=bool)
        seen_now[lists.by[up, n - depth : n - before].ravel()] = True
        seen_now[lists.by[down, before:depth].ravel()] = True
        if depth == n:
            seen_now[:] = True  # also the rows an all-zero anchor reads from no list
        new = np.flatnonzero(seen_now & ~seen & usable)
        seen |= seen_now
        if len(new):
            places = np.concatenate([places, new])
            got = lists.scores(new, anchor)
            scores = got if not len(scores) else np.concatenate([scores, got])
        bound = (whole[up] * lists.values[up, n - depth]).sum() + (whole[down] * lists.values[down, depth - 1]).sum()
        found, done = [], True
        for window in windows if windows is not None else [None]:
            if window is None:
                inside, least = slice(None), None
            else:
                low, high = window
                inside = np.flatnonzero((scores >= -(-low // 100)) & (scores <= high // 100))
                least = low
            order, s, at = _best(scores[inside], places[inside], k)
            found.append((order, s, at))
            enough = len(order) == k and min(max(bound, _LONG[0]), _LONG[1]) < s[order[-1]]
            beyond = least is not None and 100 * int(bound) < least
            done = done and (enough or beyond)
        if done or depth == n:
            break
        before, depth = depth, min(n, depth * 2)
    return [[(int(s[i]), int(lists.ids[at[i]])) for i in order] for order, s, at in found]


def _shards(rows: DataFrame, anchors: DataFrame) -> tuple[int, int]:
    n, a = rows.count(), anchors.count()
    return max(LEAST_SHARDS, -(-n // SHARD_ROWS)), max(1, -(-a // BLOCK_ANCHORS))


def _met(anchors: DataFrame, rows: DataFrame, shards: int, blocks: int, search, schema: str) -> DataFrame:
    """``search(anchors, rows)`` for every block of anchors and every shard of rows."""

    def copies(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    # Shards by the whole id, blocks as well: neither depends on labels or on vectors.
    left = anchors.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    left = left.withColumn("shard", copies(shards)).groupBy("block", "shard")
    right = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int"))
    right = right.withColumn("block", copies(blocks)).groupBy("block", "shard")
    return left.cogroup(right).applyInArrow(search, schema)


def _numpy(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy()


def _loaded(anchors: pa.Table, rows: pa.Table):
    width = _width(anchors, rows)
    a, r = _matrix(anchors.column("vector"), width), _matrix(rows.column("vector"), width)
    kind = _exact_type(a, r)
    return a.astype(kind), r, kind


def _table(found: Iterator[tuple], names: list[str]) -> pa.Table:
    columns = list(zip(*found)) or [()] * len(names)
    return pa.table({n: pa.array(c, type=pa.int64()) for n, c in zip(names, columns)})


def positives_of(anchors: DataFrame, rows: DataFrame, shards: int, blocks: int, k: int) -> DataFrame:
    """(anchor, positive, score): the first ``k`` other rows of the anchor's label."""
    names = ["anchor", "positive", "score"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _table(_same_label(left, right, k), names)

    found = _met(anchors, rows, shards, blocks, search, ", ".join(f"{n} long" for n in names))
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "positive")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _same_label(left: pa.Table, right: pa.Table, k: int) -> Iterator[tuple]:
    if not left.num_rows or not right.num_rows:
        return
    anchors, rows, kind = _loaded(left, right)
    ids, labels = _numpy(right, "id"), _numpy(right, "label")
    own, wanted = _numpy(left, "id"), _numpy(left, "label")
    for label in np.unique(wanted):
        at = np.flatnonzero(labels == label)
        lists = Lists(ids[at], labels[at], rows[at], kind)
        for i in np.flatnonzero(wanted == label):
            for score, other in threshold_search(lists, anchors[i], lists.ids != own[i], None, k)[0]:
                yield int(own[i]), other, score


def _other_label(left: pa.Table, right: pa.Table, k: int, low: int, high: int) -> Iterator[tuple]:
    if not left.num_rows or not right.num_rows:
        return
    anchors, rows, kind = _loaded(left, right)
    lists = Lists(_numpy(right, "id"), _numpy(right, "label"), rows, kind)
    own, labels = _numpy(left, "id"), _numpy(left, "label")
    usable: dict[int, np.ndarray] = {}
    for i, pairs in enumerate(left.column("pairs").to_pylist()):
        label = int(labels[i])
        if label not in usable:
            usable[label] = lists.labels != label
        windows = [(low * p["score"], high * p["score"]) for p in pairs]
        found = threshold_search(lists, anchors[i], usable[label], windows, k)
        for p, hits in zip(pairs, found):
            for score, negative in hits:
                yield int(own[i]), p["positive"], p["score"], negative, score


def mine(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
) -> DataFrame:
    """Negatives of every anchor and positive: (anchor_id, positive_id, rank, negative_id, scores).

    ``rows`` is what ``quantized`` returns. A score is the integer inner product
    with the anchor, ties go to the smaller id. Positives are the first
    ``positives`` other rows of the anchor's label, all if there are fewer.
    Negatives are the first ``negatives`` rows of another label with
    low * positive <= 100 * negative <= high * positive; a positive without one
    has no row. A positive with a negative score has an empty window. Vectors of
    different length meet on the components both have. A score beyond a long is
    that end of it, and ties there go by id. An empty table gives an empty one.
    """
    rows = materialize(rows)
    anchors = materialize(rows.where(is_anchor))
    shards, blocks = _shards(rows, anchors)
    near = materialize(positives_of(anchors, rows, shards, blocks, positives))
    pairs = near.groupBy("anchor").agg(
        F.sort_array(F.collect_list(F.struct("rank", "positive", "score"))).alias("pairs")
    )  # at most ``positives`` a group
    asked = materialize(anchors.join(pairs.withColumnRenamed("anchor", "id"), "id"))
    names = ["anchor", "positive", "positive_score", "negative", "negative_score"]

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        return _table(_other_label(left, right, negatives, low, high), names)

    found = _met(asked, rows, shards, blocks, search, ", ".join(f"{n} long" for n in names))
    order = Window.partitionBy("anchor", "positive").orderBy(F.desc("negative_score"), "negative")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= negatives)
        .select(
            F.col("anchor").alias("anchor_id"),
            F.col("positive").alias("positive_id"),
            "rank",
            F.col("negative").alias("negative_id"),
            "positive_score",
            "negative_score",
        )
    )
