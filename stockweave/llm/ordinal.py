"""Quality classifier: ordinal regression with cumulative links on hashed words.

A text has one index: shared weights of its hashed words plus a few measures of
its shape. Ordered thresholds cut the index into grades,
P(grade <= k) = sigmoid(threshold_k - index), which gives the expected grade and
the tail probability P(grade >= k) that selection uses.

Grades come from the labels: 0 for low quality, 1 for good quality that is
toxic, 2 for good quality that is not.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The most labelled rows the model is fitted on: those of least hashed id.
SAMPLE_ROWS = 6000
BUCKETS = 1 << 16
# Buckets carry a weight if some grade has them more or less often than by chance:
# by so many standard deviations, over so many documents of the sample at least.
MIN_DOCS = 4
MIN_DEVIATION = 6.0
GRADES = 3
STEPS = 500
RATE = 0.1
RIDGE = 2e-5
KEEP_GRADE = 2
KEEP_PROBABILITY = 0.4

_MARKS = ".,;:!?()[]\"'«»…"
_SYMBOLS = "#*$%&|<>!"
# Weights are integers of this unit, so a sum does not depend on its order.
_UNIT = 1 << 20
_CACHED = 200_000


def bucket(word: str) -> int:
    """Bucket of a lower-case word, marks at its ends left out."""
    return xxhash.xxh32_intdigest(word.strip(_MARKS).encode("utf-8", "surrogatepass")) % BUCKETS


def shape(text: str, words: list[str]) -> list[float]:
    """Measures of the whole text, each roughly between 0 and 3."""
    n = max(1, len(words))
    lines = [x for x in text.split("\n") if x]
    symbols = sum(text.count(c) for c in _SYMBOLS) / n
    return [
        math.log1p(len(words)) / 4,
        len(set(words)) / n,
        sum(map(str.isupper, words)) / n,
        min(3.0, math.sqrt(symbols)),
        min(3.0, text.count("|") / n * 3),
        1 - len(set(lines)) / max(1, len(lines)),
        min(3.0, len(text) / n / 10),
        1.0 if len(words) < 20 else 0.0,
    ]


def features(text: str | None) -> tuple[list[int], list[float]]:
    """Buckets of the distinct lower-case words, and the shape."""
    text = text or ""
    words = text.split()
    return [bucket(w) for w in set(text.lower().split())], shape(text, words)


@dataclass
class Model:
    """Integer weights by bucket, weights of the shape, and the thresholds."""

    weights: np.ndarray
    shape_weights: list[float]
    thresholds: list[float]
    _cache: dict = field(default_factory=dict, repr=False)

    def index(self, text: str | None) -> float:
        text = text or ""
        cache = self._cache
        total = 0
        for w in set(text.lower().split()):
            x = cache.get(w)
            if x is None:
                if len(cache) >= _CACHED:
                    cache.clear()
                x = cache[w] = int(self.weights[bucket(w)])
            total += x
        measures = shape(text, text.split())
        return total / _UNIT + sum(a * b for a, b in zip(self.shape_weights, measures))

    def tails(self, index: float) -> list[float]:
        """P(grade >= k) for k = 1, 2, ..."""
        return [1 / (1 + math.exp(min(60.0, max(-60.0, t - index)))) for t in self.thresholds]


def _cumulative(thresholds: np.ndarray, index: np.ndarray) -> np.ndarray:
    """P(grade <= k) with 0 in front and 1 behind, one row per document."""
    inner = 1 / (1 + np.exp(-np.clip(thresholds[None, :] - index[:, None], -60, 60)))
    n = len(index)
    return np.hstack([np.zeros((n, 1)), inner, np.ones((n, 1))])


def _telling(grades: np.ndarray, cols: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """Which buckets deviate from chance in some grade; one entry per document and bucket."""
    seen = np.bincount(cols, minlength=BUCKETS)
    most = np.zeros(BUCKETS)
    for g, share in enumerate(shares):
        own = np.bincount(cols[grades == g], minlength=BUCKETS)
        spread = np.sqrt(np.maximum(seen * share * (1 - share), 1e-9))
        most = np.maximum(most, np.abs(own - seen * share) / spread)
    return (seen >= MIN_DOCS) & (most >= MIN_DEVIATION)


def fit(rows: list[tuple[list[int], list[float], int]]) -> Model | None:
    """Fit by Adam on the penalised likelihood; None unless two grades occur.

    ``rows`` are (buckets, shape, grade).
    """
    grades = np.array([g for _, _, g in rows], dtype=np.int64)
    if len(set(grades.tolist())) < 2:
        return None
    owner = np.repeat(np.arange(len(rows)), [len(b) for b, _, _ in rows])
    cols = np.array([x for b, _, _ in rows for x in b], dtype=np.int64)
    used = _telling(grades[owner], cols, np.bincount(grades, minlength=GRADES) / len(rows))[cols]
    owner, cols = owner[used], cols[used]
    dense = np.array([s for _, s, _ in rows], dtype=np.float64)
    n, at = len(rows), np.arange(len(rows))

    shares = (np.bincount(grades, minlength=GRADES) + 1.0) / (n + GRADES)
    below = np.cumsum(shares)[:-1]
    first = np.log(below / (1 - below))
    # thresholds = first, then steps of exp(.): ordered whatever the parameters
    free = np.concatenate([[first[0]], np.log(np.maximum(np.diff(first), 1e-3))])
    params = [np.zeros(BUCKETS), np.zeros(dense.shape[1]), free]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    for step in range(1, STEPS + 1):
        w, v, free = params
        thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
        index = np.bincount(owner, weights=w[cols], minlength=n) + dense @ v
        c = _cumulative(thresholds, index)
        low, high = c[at, grades], c[at, grades + 1]
        p = np.maximum(high - low, 1e-12)
        d_high, d_low = high * (1 - high) / p, low * (1 - low) / p
        d_index = (d_high - d_low) / n  # of the negative log likelihood
        d_thresholds = np.zeros(GRADES - 1)
        for k in range(GRADES - 1):
            d_thresholds[k] = (-d_high[grades == k].sum() + d_low[grades == k + 1].sum()) / n
        tails = np.cumsum(d_thresholds[::-1])[::-1]
        gradients = [
            np.bincount(cols, weights=d_index[owner], minlength=BUCKETS) + RIDGE * w,
            dense.T @ d_index + RIDGE * v,
            np.concatenate([tails[:1], tails[1:] * np.exp(free[1:])]),
        ]
        for i, g in enumerate(gradients):
            a, b = moments[i]
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            rate = RATE * (1 - 0.9 * step / STEPS)
            params[i] = params[i] - rate * (a / (1 - 0.9**step)) / (
                np.sqrt(b / (1 - 0.99**step)) + 1e-8
            )
    w, v, free = params
    thresholds = np.cumsum(np.concatenate([free[:1], np.exp(free[1:])]))
    return Model(np.rint(w * _UNIT).astype(np.int64), v.tolist(), thresholds.tolist())


def grade_of(quality: Column, toxic: Column) -> Column:
    """Grade 0, 1 or 2; NULL where the quality is."""
    good = (quality > 0).cast("int")
    return good + good * (F.coalesce(toxic, F.lit(0)) <= 0).cast("int")


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample_rows: int = SAMPLE_ROWS,
) -> Model | None:
    """The model for the labels of ``docs``, fitted on at most ``sample_rows`` of them.

    Labels without a quality or an id are not used; of several labels of one id
    the least grade counts. Returns None without rows of two different grades.
    Only the sampled rows reach the driver, as buckets and measures.
    """
    graded = (
        labels.select(
            F.col(f"`{id_col}`").alias("id"), grade_of(F.col("quality"), F.col("toxic")).alias("grade")
        )
        .where("id is not null and grade is not null")
        .groupBy("id")
        .agg(F.min("grade").alias("grade"))
    )
    chosen = graded.orderBy(F.xxhash64("id"), "id").limit(sample_rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    texts = texts.join(F.broadcast(chosen), "id")  # at most sample_rows rows

    def measured(batches):
        for batch in batches:
            for i, t, g in zip(batch["id"], batch["text"], batch["grade"]):
                b, s = features(t)
                yield pd.DataFrame({"id": [i], "b": [sorted(b)], "s": [s], "g": [g]})

    kind = dict(texts.dtypes)["id"]
    rows = texts.mapInPandas(measured, f"id {kind}, b array<int>, s array<double>, g int")
    first = rows.groupBy("id").agg(F.min(F.struct("g", "s", "b")).alias("r"))  # repeated rows once
    found = first.orderBy("id").collect()
    return fit([(r.r.b, r.r.s, r.r.g) for r in found])


def scored(
    docs: DataFrame, model: Model | None, text_col: str = "text", keep: float = KEEP_PROBABILITY
) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, with ``grade``, ``p_top`` and ``kept``.

    ``grade`` is the expected grade and ``p_top`` the probability of the best
    one; a document is kept if that reaches ``keep``. NULL counts as an empty
    text. Without a model both are NULL and every document is kept. Each row is
    scored by itself: repeated rows alike, an empty table gives an empty one.
    """
    rows = docs.select(F.struct("*").alias("row"))
    if model is None:
        nothing = F.lit(None).cast("double")
        return rows.select(
            "row", nothing.alias("grade"), nothing.alias("p_top"), F.lit(True).alias("kept")
        )
    @F.pandas_udf("grade double, p_top double")
    def score(texts: pd.Series) -> pd.DataFrame:
        tails = [model.tails(model.index(t)) for t in texts]
        return pd.DataFrame(
            {"grade": [sum(t) for t in tails], "p_top": [t[KEEP_GRADE - 1] for t in tails]},
            dtype="float64",
        )

    out = rows.withColumn("s", score(F.col(f"row.`{text_col}`").cast("string")))
    return out.select("row", "s.grade", "s.p_top", (F.col("s.p_top") >= keep).alias("kept"))
