"""Importance resampling towards a target corpus, with bit-sliced weights.

Texts are bags of hashed word runs. The share of every bucket in the target, over
its share in all documents, gives the bucket an integer gain. A document's weight
is the sum of the gains of its features. Its bucket counts are cut into planes of
one bit per bucket (plane j has the buckets whose count has bit j), the gains into
planes of their magnitudes, one set for positive and one for negative gains; then

    weight = sum over j, k of 2^(j+k) (popcount(C_j & P_k) - popcount(C_j & N_k))

is exact. The draw adds Gumbel noise from the hash of the id, so the documents of
highest score are a sample without replacement in proportion to exp(weight).
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import picked, rows_of
from stockweave.operators.running import ordinal
from stockweave.session import materialize

BUCKETS = 10000
ORDER = 1
SEED = "2024"
PERCENT = 10
LEAST_WORDS = 20
GAIN_UNIT = 1000
_CACHED = 200_000
_KEPT = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(128, 256))
_TO_WORDS = bytes(
    c if c in _KEPT else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text: A-Z in lower case, runs of letters, digits and all beyond ASCII."""
    return (text or b"").translate(_TO_WORDS).split()


class Buckets(dict):
    """Bucket of a feature, remembered within bounds."""

    def __init__(self, buckets: int) -> None:
        super().__init__()
        self.buckets = buckets

    def __missing__(self, feature: bytes) -> int:
        found = zlib.crc32(feature) % self.buckets
        if len(self) >= _CACHED:
            self.clear()
        self[feature] = found
        return found


def features_of(words: list[bytes], order: int = ORDER) -> list[bytes]:
    """All runs of 1 to ``order`` consecutive words, joined by one space."""
    runs = list(words)
    for n in range(2, order + 1):
        runs += [b" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]
    return runs


def bucket_counts(features: list[bytes], known: Buckets) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the features and how often each occurs."""
    counts: dict[int, int] = {}
    for feature, n in Counter(features).items():
        b = known[feature]
        counts[b] = counts.get(b, 0) + n
    size = len(counts)
    return np.fromiter(counts, np.int64, size), np.fromiter(counts.values(), np.int64, size)


def planes(buckets: np.ndarray, values: np.ndarray, width: int) -> np.ndarray:
    """Bit planes of a sparse vector of counts: plane j as 64-bit words, bit b for bucket b."""
    depth = int(values.max(initial=0)).bit_length()
    out = np.empty((depth, -(-width // 64)), dtype=np.uint64)
    for j in range(depth):
        bits = np.zeros(out.shape[1] * 64, dtype=bool)
        bits[buckets[(values >> j) & 1 == 1]] = True
        out[j] = np.packbits(bits, bitorder="little").view(np.uint64)
    return out


class Gains:
    """Integer gains of all buckets as bit planes of either sign."""

    def __init__(self, gains: np.ndarray) -> None:
        every = np.arange(len(gains))
        self.width = len(gains)
        self.signed = [
            (sign, planes(every, np.maximum(sign * gains, 0), self.width)) for sign in (1, -1)
        ]

    def weight(self, buckets: np.ndarray, counts: np.ndarray) -> int:
        """Sum of count * gain, by AND and popcount of planes."""
        if not len(buckets):
            return 0
        total = 0
        for j, plane in enumerate(planes(buckets, counts, self.width)):
            used = np.flatnonzero(plane)  # the words that have a bit
            plane = plane[used]
            for sign, gain in self.signed:
                met = np.bitwise_count(gain[:, used] & plane).sum(axis=1, dtype=np.int64)
                for k, n in enumerate(met.tolist()):
                    total += sign * n << (j + k)
        return total


def corpus_counts(
    texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS, order: int = ORDER
) -> DataFrame:
    """(bucket, n): features of all rows per bucket, added up in each task before the shuffle."""
    binary = texts.select(F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total = Buckets(buckets), np.zeros(buckets, dtype=np.int64)
        for _, values in rows_of(batches):
            for text in values:
                at, n = bucket_counts(features_of(words_of(text), order), known)
                total[at] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    found = binary.where("text is not null").mapInArrow(run, "bucket long, n long")
    return found.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains_of(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Gain of every bucket from the counts of ``corpus_counts``; at most ``buckets`` rows each."""
    s, t = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
    for found, frame in ((s, source), (t, target)):
        for row in frame.collect():
            found[row["bucket"]] = row["n"]
    all_s, all_t = float(s.sum() + buckets), float(t.sum() + buckets)

    def gain(x: float, y: float) -> int:
        return math.floor(GAIN_UNIT * math.log((y + 1) * all_s / ((x + 1) * all_t)))

    return np.array([gain(float(x), float(y)) for x, y in zip(s, t)], dtype=np.int64)


def weighed(
    docs: DataFrame,
    gains: np.ndarray,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: int = ORDER,
) -> DataFrame:
    """(id, n_words, n_features, weight) of every row; NULL is an empty text of weight 0."""
    texts = picked(docs, id=id_col, text=text_col).select(
        "id", F.col("text").cast("string").cast("binary").alias("text")
    )
    kind = dict(texts.dtypes)["id"]
    names = ["id", "n_words", "n_features", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sliced, known = Gains(gains), Buckets(len(gains))
        for batch, values in rows_of(batches):
            rows = []
            for text in values:
                words = words_of(text)
                found = features_of(words, order)
                rows.append((len(words), len(found), sliced.weight(*bucket_counts(found, known))))
            columns = [pa.array(c, type=pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    return texts.mapInArrow(run, f"id {kind}, n_words long, n_features long, weight long")


def gumbel(id_col: Column, seed: str = SEED) -> Column:
    """Integer Gumbel noise from the hash of the id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), id_col.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-GAIN_UNIT * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = BUCKETS,
    order: int = ORDER,
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    seed: str = SEED,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row; ``rank`` is NULL where not drawn.

    Of the N rows with an id and at least ``least_words`` words, the
    floor(percent * N / 100) of highest score are drawn, ties to the smaller id,
    then to fewer features. A row without an id has no score and is not drawn.
    Repeated rows are weighed and drawn one by one and have ranks of their own.
    NULL and blank texts weigh 0. An empty ``docs`` gives an empty table; an empty
    ``target`` still gives every bucket a gain. Other columns play no part.
    """
    gains = gains_of(
        corpus_counts(docs, text_col, buckets, order),
        corpus_counts(target, text_col, buckets, order),
        buckets,
    )
    found = weighed(docs, gains, id_col, text_col, order)
    found = materialize(found.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)))
    able = F.col("score").isNotNull() & (F.col("n_words") >= least_words)
    drawn = found.where(able).count() * percent // 100
    by = [F.desc("score"), F.col("id"), F.col("n_features"), F.col("n_words")]
    placed = ordinal(found.where(able), by, "place")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    out = ["id", "n_features", "weight", "score"]
    rest = found.where(~able).select(*out, F.lit(None).cast("long").alias("rank"))
    return placed.select(*out, rank.alias("rank")).unionByName(rest)
