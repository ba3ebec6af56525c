"""Components of near copies: texts that share at least 0.8 of their five-word shingles.

Words are hashed once, shingles are combinations of their words' hashes. A text is
known by one permutation: every shingle's hash has a slot out of 100 and each slot
keeps the least hash; an empty slot takes that of the next filled one. The slots
are cut into 20 bands of five. Two texts with a share s of their shingles in common
agree on a band with probability about s^5, so of pairs at 0.8 one in some thousand
is missed and above that fewer.

Texts that agree on a band are candidates of a few pivots: the least of all of them
and the least of the half and of the eighth they fall into, which differ from band to
band. No pairs of a band are listed, so a band that many share makes few candidates
a text. Every candidate pair is compared shingle by shingle before it is a link.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import rows_of
from stockweave.llm.components import stars
from stockweave.session import materialize

WORDS = 5
SIMILARITY = 0.8
BANDS = 20
BAND_ROWS = 5
SLOTS = BANDS * BAND_ROWS
# Parts of a band's texts that have a pivot of their own.
PARTS = (2, 8)
_CACHED = 200_000
_SEEN = 500_000
# Odd multipliers that combine the words of a shingle, and one that mixes the sum.
_FACTORS = np.random.default_rng(7).integers(0, 2**64, WORDS + 1, dtype=np.uint64) | np.uint64(1)
_EMPTY = np.uint64(2**64 - 1)


class WordHashes(dict):
    """Hash of a word, remembered within bounds."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return found


def word_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    """Hashes of the words of a text in order; case and white space play no part."""
    words = (text or "").lower().split()
    return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of the five-word shingles, repeats included; fewer words are one shingle."""
    if not len(words):
        return words
    width = min(WORDS, len(words))
    n = len(words) - width + 1
    total = np.zeros(n, dtype=np.uint64)
    for j in range(width):
        total += words[j : j + n] * _FACTORS[j]
    total ^= total >> np.uint64(31)
    return total * _FACTORS[WORDS]


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """A signed 64-bit key per band of the shingles; none without a shingle."""
    if not len(hashes):
        return np.zeros(0, dtype=np.int64)
    least = np.full(SLOTS, _EMPTY, dtype=np.uint64)
    high = hashes >> np.uint64(32)
    np.minimum.at(least, (high * np.uint64(SLOTS) >> np.uint64(32)).astype(np.int64), hashes)
    filled = np.flatnonzero(least != _EMPTY)
    at = filled[np.searchsorted(filled, np.arange(SLOTS)) % len(filled)]
    rows = least[at].reshape(BANDS, BAND_ROWS)
    digest = xxhash.xxh64_intdigest
    keys = np.array([digest(row.tobytes(), k) for k, row in enumerate(rows)], dtype=np.uint64)
    return keys.view(np.int64)


def sketched(rows: DataFrame) -> DataFrame:
    """``rows`` with ``node`` and ``bands`` in place of its last column, a text.

    ``node`` is a hash of the words, equal for copies, NULL for NULL. ``bands``
    are the band keys; they are NULL where a task has met the node before.
    """
    *others, last = rows.schema.fields
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, seen = WordHashes(), set()
        for batch, texts in rows_of(batches):
            nodes, bands = [], []
            for text in texts:
                if text is None:
                    nodes.append(None)
                    bands.append(None)
                    continue
                words = word_hashes(text, known)
                node = xxhash.xxh64_intdigest(words.tobytes()) - (1 << 63)
                nodes.append(node)
                if node in seen:
                    bands.append(None)
                    continue
                if len(seen) >= _SEEN:
                    seen.clear()
                seen.add(node)
                bands.append(band_keys(shingles(words)))
            columns = [*batch.columns[:-1], pa.array(nodes, type=pa.int64()), pa.array(bands, type=pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "node", "bands"])

    return rows.mapInArrow(run, f"{kept}, node long, bands array<long>")


def candidates(found: DataFrame) -> DataFrame:
    """(a, b), a < b: each text with its pivots, from the (node, bands) of ``sketched``."""
    keyed = found.where("bands is not null").select("node", F.explode("bands").alias("key")).distinct()
    keyed = materialize(keyed)
    least = keyed.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("most"))
    met = keyed.join(least.where("pivot <> most").select("key", "pivot"), "key")
    met = materialize(met)
    pairs = met.select("node", "pivot")
    for parts in PARTS:
        part = F.pmod(F.xxhash64("node", "key"), F.lit(parts)).alias("part")
        dealt = met.select("key", "node", part)
        first = dealt.groupBy("key", "part").agg(F.min("node").alias("pivot"))
        pairs = pairs.unionByName(dealt.join(first, ["key", "part"]).select("node", "pivot"))
    return (
        pairs.where("node <> pivot")
        .select(F.least("node", "pivot").alias("a"), F.greatest("node", "pivot").alias("b"))
        .distinct()
    )


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) with the share of the shingles that both have, from their texts."""
    known = WordHashes()
    for batch in batches:
        if not batch.num_rows:
            continue
        last, mine, shares = None, None, []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            if x is not last:
                if x != last:
                    mine = np.unique(shingles(word_hashes(x, known)))
                last = x
            other = np.unique(shingles(word_hashes(y, known)))
            both = len(np.intersect1d(mine, other, assume_unique=True))
            shares.append(both / max(1, len(mine) + len(other) - both))
        columns = [batch.column(0), batch.column(1), pa.array(shares, type=pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "share"])


def near_copies(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """(node, component): the texts with near copies and the least node among them.

    ``found`` has a row with ``raw``, the hash of the text as it stands in
    ``docs``, ``node`` and ``bands`` for every row of ``docs`` (see ``sketched``).
    Texts without a near copy, NULL and blank ones do not appear.
    """
    pairs = materialize(candidates(found))
    nodes = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    # one spelling per node, then one text per spelling
    spelled = found.groupBy("node").agg(F.min("raw").alias("raw")).join(nodes, "node")
    text = F.col(f"`{text_col}`").cast("string")
    texts = docs.select(F.xxhash64(text).alias("raw"), text.alias("text")).join(spelled, "raw")
    texts = materialize(texts.groupBy("node").agg(F.min("text").alias("text")))
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("x"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("y"))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    shares = both.mapInArrow(_shares, "a long, b long, share double")
    links = shares.where(F.col("share") >= SIMILARITY)
    linked = stars(links.select(F.col("b").alias("child"), F.col("a").alias("root")))
    roots = linked.select(F.col("root").alias("node"), F.col("root").alias("component")).distinct()
    return linked.select(F.col("child").alias("node"), F.col("root").alias("component")).unionByName(roots)
