import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockweave.llm import hardneg
from stockweave.llm.catalog import QUERIES


def plain(rows, every=100, positives=5, negatives=10, low=30, high=90):
    """Hard negatives of (id, label, vector) rows by scoring all of them."""
    out = []
    for a, label, u in rows:
        if a % every:
            continue
        scored = [(min(max(sum(x * y for x, y in zip(u, v)), -(2**63)), 2**63 - 1), i, other) for i, other, v in rows if i != a]
        scored.sort(key=lambda r: (-r[0], r[1]))
        for p, positive, _ in [r for r in scored if r[2] == label][:positives]:
            fit = [r for r in scored if r[2] != label and low * p <= 100 * r[0] <= high * p]
            for rank, (n, negative, _) in enumerate(fit[:negatives], 1):
                out.append((a, positive, rank, negative, p, n))
    return sorted(out)


def quantized(rows):
    """What takes part, as the contract has it."""
    out = {}
    for i, label, v in rows:
        if None in (i, label, v) or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        own = (label, [math.floor(256 * x) for x in v])
        out[i] = min(out.get(i, own), own)
    return [(i, label, v) for i, (label, v) in out.items()]


def mined(spark, rows, every=100):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, label int, embedding array<float>, id int, rank int")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return sorted(map(tuple, hardneg.mine(hardneg.quantized(df, label), F.col("id") % every == 0).collect()))


def float32(v):
    return None if v is None else [None if x is None else float(np.float32(x)) for x in v]


@pytest.mark.parametrize("kind", ["spread", "ties", "one vector"])
def test_against_all_scores(spark, kind):
    rng = random.Random(kind)
    rows = []
    for k in range(700):
        v = [rng.gauss(0, 0.2) for _ in range(8)]
        if kind == "ties":
            v = [rng.choice([-0.25, 0.0, 0.25]) for _ in range(8)]
        if kind == "one vector" and k % 3:
            v = [0.5, -0.25, 0.0, 0.125, 0.0, 0.0, 0.0, 0.5]
        rows.append((k, rng.choice([0, 0, 0, 1, 2, 3]), float32(v)))
    assert mined(spark, rows, 50) == plain(quantized(rows), 50)


def test_odd_rows(spark):
    good = [(k, k % 2, [0.1 * (k % 5), 0.3, -0.2]) for k in range(1, 40)]
    odd = [
        (0, 1, [0.5, 0.5, 0.5]), (0, 1, [0.5, 0.5, 0.5]), (100, 1, [0.0, 0.0, 0.0]), (200, 0, [-0.5, -0.9, 0.4]),
        (300, 5, [0.1, 0.1, 0.1]), (400, 1, []), (500, 0, [0.5]), (600, 0, [0.1, 0.2, 0.3, 0.4]),
        (700, None, [1.0, 1.0, 1.0]), (None, 1, [1.0, 1.0, 1.0]), (800, 1, None), (900, 1, [1.0, None, 1.0]),
        (1000, 1, [float("nan"), 1.0, 1.0]), (1100, 1, [float("inf"), 1.0, 1.0]), (3, 1, [9.0, 9.0, 9.0]),
    ]
    rows = [(i, label, float32(v)) for i, label, v in good + odd]
    assert mined(spark, rows) == plain(quantized(rows))
    assert mined(spark, []) == [] and mined(spark, rows[:3]) == []


def test_large_components(spark):
    rng = random.Random(2)
    for scale in (1e3, 1e7, 1e12):
        rows = [(k, k % 3, float32([rng.gauss(0, scale) for _ in range(4)])) for k in range(60)]
        assert mined(spark, rows, 10) == plain(quantized(rows), 10)


def test_search_stops_before_the_end():
    """Where one direction leads, the threshold falls below the window long before all rows are met."""
    rng = np.random.default_rng(1)
    vectors = rng.integers(-3, 4, (4000, 6))
    vectors[:50, 0] += 200
    lists = hardneg.Lists(np.arange(4000), np.zeros(4000), vectors, np.float32)
    looked_up = []
    scores = lists.scores
    lists.scores = lambda at, anchor: looked_up.extend(at) or scores(at, anchor)
    anchor = np.array([7, 1, -1, 0, 1, 1], dtype=np.float32)
    (found,) = hardneg.threshold_search(lists, anchor, np.ones(4000, dtype=bool), None, 10)
    exact = vectors @ anchor.astype(int)
    assert found == [(int(exact[i]), int(i)) for i in sorted(range(4000), key=lambda i: (-exact[i], i))[:10]]
    assert len(looked_up) == len(set(looked_up)) < 1000


def test_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding").collect()]
    found = QUERIES["op12_hard_negatives"](spark, sf_dir)
    assert dict(found.dtypes)["rank"] == "int"
    assert sorted(map(tuple, found.collect())) == plain(quantized(rows))
