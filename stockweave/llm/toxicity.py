"""Toxic passages: maximum-scoring segments of token log-odds, with extreme-value calibration.

Every token has the log-odds of occurring in a toxic text over a clean one. The
counts of a word are smoothed by a Dirichlet prior whose mean is the share of its
stem (the first letters), and the stem's by the share of all tokens, so that a word
never seen follows its kin and an unknown kin tells nothing. A token's score is
its log-odds less a drift, so that clean text loses and only passages gain. One
pass over a text lists all maximal segments: those that no longer or shorter
stretch beside them beats.

Scores of the best segment of clean texts follow an extreme-value law,
P(score >= x) = 1 - exp(-K n exp(-lambda x)) for n tokens. It turns segments into
significances; a document's evidence is the least chance of its r best segments
together, over all r. A logistic link fitted on the training documents (each scored
without its own counts) turns evidence into the probability of the label.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import picked, rows_of
from stockweave.session import materialize

# The most labelled rows the model is fitted on: those of least hashed id.
SAMPLE_ROWS = 40_000
BUCKETS = 1 << 18
STEM = 5
# Strength of the priors, in documents.
WORD_PRIOR = 8.0
STEM_PRIOR = 32.0
DRIFT = 1.0
# Words of the shingles by which copies among the labelled rows are found.
FAMILY_WORDS = 5
# Segments at least this significant are passages: the chance in a clean text.
PASSAGE_CHANCE = 0.01
CUT = 0.7
FOLDS, HELD_OUT = 3, 1
_CACHED = 200_000
# Where the law -log(-log q) has its median and its 99th percentile.
_REDUCED = tuple(-math.log(-math.log(q)) for q in (0.5, 0.99))
_TOKEN = re.compile(r"[^\W_]+")


def tokens(text: str) -> list[str]:
    """Runs of letters and digits in lower case."""
    return _TOKEN.findall(text.lower())


def bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) & (BUCKETS - 1)


def stem_bucket(word: str) -> int:
    """Bucket of the first letters, in the upper half of the buckets."""
    return BUCKETS + bucket(word[:STEM] + "*")


def fold(id_col: Column) -> Column:
    """Remainder of the id's CRC-32 that says which rows are held out."""
    return F.crc32(id_col.cast("string").cast("binary")) % FOLDS


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end, score), in order, in linear time.

    Each positive score starts as a segment of its own. A new segment is joined
    with the last one to its left that begins lower, provided the sum at its end is
    higher; ``lower`` keeps for each open segment where that search goes on.
    """
    total = 0.0
    found: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum at the end
    lower: list[int] = []  # the nearest one to the left that begins lower, -1 for none
    for i, x in enumerate(scores):
        before = total
        total += x
        if x <= 0:
            continue
        start, begin = i, before
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= begin:
                j = lower[j]
            if j < 0 or found[j][3] >= total:
                found.append((start, i + 1, begin, total))
                lower.append(j)
                break
            start, begin = found[j][0], found[j][2]
            del found[j:], lower[j:]
    return [(a, b, end - begin) for a, b, begin, end in found]


@dataclass
class Model:
    """Counts of toxic and clean documents by bucket, and the calibration."""

    toxic: np.ndarray
    clean: np.ndarray
    documents: tuple[int, int]
    rate: float = 1.0  # lambda
    log_k: float = 0.0
    link: tuple[float, float] = (0.0, 0.0)
    _cache: dict = field(default_factory=dict, repr=False)

    def log_odds(self, word: str, own: int | None = None) -> float:
        """Log-odds of a word; ``own`` is the label of a document whose counts do not count."""
        t, c = self.documents
        less_t, less_c = (own == 1), (own == 0)
        base = (t - less_t + 0.5) / (t + c - less_t - less_c + 1.0)

        def share(b: int, prior: float, mean: float) -> float:
            x, y = max(0.0, self.toxic[b] - less_t), max(0.0, self.clean[b] - less_c)
            return (x + prior * mean) / (x + y + prior)

        p = share(bucket(word), WORD_PRIOR, share(stem_bucket(word), STEM_PRIOR, base))
        return math.log(p / (1 - p)) - math.log(base / (1 - base))

    def score(self, word: str) -> float:
        found = self._cache.get(word)
        if found is None:
            if len(self._cache) >= _CACHED:
                self._cache.clear()
            found = self._cache[word] = self.log_odds(word) - DRIFT
        return found

    def scores(self, words: list[str], own: int | None = None) -> list[float]:
        if own is None:
            return [self.score(w) for w in words]
        known: dict[str, float] = {}
        for w in words:
            if w not in known:
                known[w] = self.log_odds(w, own) - DRIFT
        return [known[w] for w in words]

    def log_expected(self, score: float, n: int) -> float:
        """Log of the number of segments this good expected in a clean text of n tokens."""
        return self.log_k + math.log(max(1, n)) - self.rate * score

    def evidence(self, scores: list[float], n: int) -> float:
        """-log of the least chance of the r best segments together, over all r.

        The chance of r segments with sum T of normalised scores is about
        exp(-T) T^(r-1) / (r! (r-1)!).
        """
        total, best = 0.0, 0.0
        for r, s in enumerate(sorted(scores, reverse=True), 1):
            x = -self.log_expected(s, n)
            if x <= 0:
                break
            total += x
            chance = -total + (r - 1) * math.log(total) - math.lgamma(r + 1) - math.lgamma(r)
            best = max(best, -chance)
        return best

    def probability(self, evidence: float) -> float:
        a, b = self.link
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, a + b * evidence))))

    def best(self, words: list[str], own: int | None = None) -> list[float]:
        """Scores of the segments, each wording once: repeated lines are one passage."""
        found = {tuple(words[a:b]): s for a, b, s in segments(self.scores(words, own))}
        return sorted(found.values(), reverse=True)

    def judge(self, text: str | None) -> tuple[float, list[tuple[int, int, float]]]:
        """(probability, significant segments as tokens) of a text."""
        words = tokens(text or "")
        found = segments(self.scores(words))
        wordings = {tuple(words[a:b]): s for a, b, s in found}
        p = self.probability(self.evidence(list(wordings.values()), len(words)))
        limit = math.log(PASSAGE_CHANCE)
        return p, [x for x in found if self.log_expected(x[2], len(words)) <= limit]


def passages(text: str, found: list[tuple[int, int, float]]) -> list[tuple[int, int, float]]:
    """Segments of tokens as (start, end, score) in code points of the text."""
    if not found:
        return []
    low = text.lower()
    if len(low) != len(text):  # some letters have a longer lower case
        at = [k for k, c in enumerate(text) for _ in c.lower()] + [len(text)]
    else:
        at = range(len(text) + 1)
    places = [(m.start(), m.end()) for m in _TOKEN.finditer(low)]
    return [(at[places[a][0]], at[places[b - 1][1] - 1] + 1, s) for a, b, s in found]


def _fit_law(best: np.ndarray, sizes: np.ndarray) -> tuple[float, float]:
    """(lambda, log K) from the median and the 99th percentile of the clean texts.

    Both quantiles of the law are known, and a few clean-labelled texts that are
    toxic do not move them.
    """
    middle, far = (float(x) for x in np.quantile(best, [0.5, 0.99]))
    rate = (_REDUCED[1] - _REDUCED[0]) / max(far - middle, 0.5)
    log_n = float(np.log(np.maximum(1, sizes)).mean())
    return rate, rate * middle - log_n - _REDUCED[0]


def _fit_link(evidence: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the evidence, by Newton steps."""
    x = np.minimum(evidence, 50.0)
    design = np.column_stack([np.ones(len(x)), x])
    params = np.array([math.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5)), 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ params, -30, 30)))
        slope = design.T @ (labels - p) - 1e-3 * params
        bend = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(bend, slope)
        params = params + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(params[0]), max(0.0, float(params[1]))


def family(words: list[str]) -> int:
    """A key that near copies share: the least hash of the five-word shingles."""
    n = max(1, len(words) - FAMILY_WORDS + 1)
    digest = xxhash.xxh64_intdigest
    spans = (" ".join(words[i : i + FAMILY_WORDS]) for i in range(n))
    return min(digest(x.encode("utf-8", "surrogatepass")) for x in spans) - (1 << 63)


def _sample(
    docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int
) -> DataFrame:
    """(id, toxic, text) of the sampled labelled rows that are not held out, one per family.

    Copies of one text are one witness: a family of a thousand would teach the
    model its own words. Written once, as two passes read it.
    """
    named = labels.select(F.col(f"`{id_col}`").alias("id"), (F.col(f"`{label_col}`") > 0).cast("int").alias("toxic"))
    named = named.where("id is not null and toxic is not null").where(fold(F.col("id")) != HELD_OUT)
    one = named.groupBy("id").agg(F.max("toxic").alias("toxic"))
    chosen = one.orderBy(F.xxhash64("id"), "id").limit(rows)
    texts = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    texts = texts.join(F.broadcast(chosen), "id").select("id", "toxic", F.coalesce("text", F.lit("")).alias("text"))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in rows_of(batches):
            keys = pa.array([family(tokens(x)) for x in values], type=pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, keys], [*batch.schema.names, "family"])

    kind = dict(texts.dtypes)["id"]
    found = texts.mapInArrow(keyed, f"id {kind}, toxic int, text string, family long")
    first = found.groupBy("family").agg(F.min(F.struct("id", "toxic", "text")).alias("r"))
    return materialize(first.select("r.*"))


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
) -> Model | None:
    """The model for the labels of the rows that are not held out.

    Fitted on at most ``sample_rows`` labelled rows, those of least hashed id.
    Labels without an id or a value are not used; of several labels of one id the
    greatest counts, and of near copies the one of least id. Returns None unless
    both labels occur. The driver receives one row per bucket and, for the
    calibration, three numbers per sampled row.
    """
    sample = _sample(docs, labels, id_col, text_col, label_col, sample_rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 2 * BUCKETS + 1), dtype=np.int64)  # the last one counts documents
        for batch, texts in rows_of(batches):
            for toxic, text in zip(batch.column(1).to_pylist(), texts):
                words = set(tokens(text))
                found = {bucket(w) for w in words} | {stem_bucket(w) for w in words}
                total[toxic, list(found)] += 1
                total[toxic, -1] += 1
        at = np.flatnonzero(total.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total[0, at]), pa.array(total[1, at])], ["bucket", "clean", "toxic"]
        )

    counted = sample.mapInArrow(count, "bucket long, clean long, toxic long")
    sums = counted.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    found = sums.toPandas()  # at most 2 * BUCKETS + 1 rows
    clean, toxic = np.zeros(2 * BUCKETS + 1), np.zeros(2 * BUCKETS + 1)
    clean[found["bucket"]], toxic[found["bucket"]] = found["clean"], found["toxic"]
    if clean[-1] == 0 or toxic[-1] == 0:
        return None
    model = Model(
        toxic[:-1].astype(np.float32), clean[:-1].astype(np.float32), (int(toxic[-1]), int(clean[-1]))
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in rows_of(batches):
            labels = batch.column(1).to_pylist()
            rows = []
            for own, text in zip(labels, texts):
                words = tokens(text)
                rows.append((len(words), model.best(words, own)))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(labels, type=pa.int32()),
                    pa.array([n for n, _ in rows], type=pa.int64()),
                    pa.array([s for _, s in rows], type=pa.list_(pa.float64())),
                ],
                ["toxic", "n", "best"],
            )

    measured = sample.mapInArrow(measure, "toxic int, n long, best array<double>").toPandas()
    labels_, sizes = measured["toxic"].to_numpy(), measured["n"].to_numpy()
    top = np.array([b[0] if len(b) else 0.0 for b in measured["best"]])
    model.rate, model.log_k = _fit_law(top[labels_ == 0], sizes[labels_ == 0])
    evidence = np.array([model.evidence(list(b), n) for b, n in zip(measured["best"], sizes)])
    model.link = _fit_link(evidence, labels_.astype(np.float64))
    return model


_RESULT = "score double, passages array<struct<start:long,end:long,score:double>>"


def scored(
    docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, passages) of every row, from its whole text.

    ``score`` is the probability of the label; ``passages`` are the segments whose
    chance in a clean text of that length is at most ``PASSAGE_CHANCE``, in code
    points. NULL and blank texts have the score of no evidence and no passage.
    Without a model every score is 0. Rows are scored one by one: repeated rows
    alike, an empty table gives an empty one; other columns play no part.
    """
    texts = picked(docs, id=id_col, text=text_col).select("id", F.col("text").cast("string").alias("text"))
    kind = dict(texts.dtypes)["id"]
    place = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in rows_of(batches):
            rows = []
            for text in values:
                p, found = model.judge(text) if model is not None else (0.0, [])
                rows.append((p, [dict(zip(("start", "end", "score"), x)) for x in passages(text or "", found)]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([p for p, _ in rows], type=pa.float64()),
                    pa.array([x for _, x in rows], type=pa.list_(place)),
                ],
                ["id", "score", "passages"],
            )

    return texts.mapInArrow(run, f"id {kind}, {_RESULT}")
