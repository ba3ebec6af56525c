"""Benchmark decontamination: BM25 over the test items, block-max WAND per passage.

The test items are the index and every passage of every training document is a
query. Impacts are divided by the item's own BM25 score, so a score is the
weighted share of the item's words that the passage has, and one threshold holds
for all items. Passages are two segments long and start at every segment; a
segment is as long as the longest item, so each occurrence lies in a passage.

A passage is scored in three steps that lose nothing above the threshold:
frequent terms, which together cannot reach half of it for any item, are left
out and bounded by a constant per block of items; the block maxima of the other
terms are summed for all passages of a batch at once, and a block whose bound
stays below the threshold is skipped; in the blocks that are left WAND finds the
items by pivoting on the terms' upper bounds. Then runs of words of the question
and of the answer are looked for in the passage.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections import Counter
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockweave.session import materialize

THRESHOLD = 0.6
OVERLAP = 0.7
NGRAM = 3
K1, B = 1.2, 0.75
BLOCK = 8
MIN_SEGMENT = 64
# Text bytes of the items in one index; more items are searched in further passes.
INDEX_BYTES = 8 * 1024 * 1024
_CACHED = 200_000
_MARKS = ".,;:!?()[]{}\"'«»…#*$%&|<>-"
_EPS = 1e-9


def normal(word: str) -> str:
    """A lower-case word without marks at its ends; words of marks only stay."""
    return word.strip(_MARKS) or word


def split_item(text: str) -> tuple[list[str], list[str]]:
    """Words of question and answer: the answer is the last sentence or line.

    An item of one sentence is question and answer in one.
    """
    words = text.lower().split()
    ends = [i + 1 for i, w in enumerate(words[:-1]) if w[-1] in ".?!:"]
    lines = text.lower().strip().split("\n")
    if len(lines) > 1:
        ends.append(sum(len(x.split()) for x in lines[:-1]))
    cut = max([e for e in ends if 0 < e < len(words)], default=0)
    plain = [normal(w) for w in words]
    return (plain[:cut], plain[cut:]) if cut else (plain, plain)


def ngrams(ids: list[int], n: int) -> set:
    n = max(1, min(n, len(ids)))
    return {tuple(ids[i : i + n]) for i in range(len(ids) - n + 1)} if ids else set()


class Vocabulary(dict):
    """Raw lower-case word -> term number, -1 if no item has it; keeps what it met."""

    def __init__(self, terms: dict[str, int]) -> None:
        super().__init__()
        self.terms = terms

    def __missing__(self, word: str) -> int:
        found = self.terms.get(normal(word), -1)
        if len(self) < _CACHED:
            self[word] = found
        return found


@dataclass
class Index:
    """Items in a fixed order; ``postings[t]`` is (items, impacts), both by item."""

    ids: list
    terms: dict[str, int]
    postings: list[tuple[list[int], list[float]]]
    questions: list[set]
    answers: list[set]
    segment: int
    threshold: float
    overlap: float
    essential: np.ndarray
    block_start: np.ndarray
    block_of: np.ndarray
    block_max: np.ndarray
    rest: np.ndarray

    def __post_init__(self) -> None:
        self.vocabulary = Vocabulary(self.terms)
        self.upper = [max(w) for _, w in self.postings]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("vocabulary", "upper")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()


@dataclass
class Statistics:
    """Of all items: number, mean length, words of the longest, items with each term."""

    n: int
    mean: float
    longest: int
    spread: dict[str, int]


def build(
    items: list[tuple[object, str]],
    threshold: float,
    overlap: float,
    of_all: Statistics | None = None,
) -> Index | None:
    """The index of (id, text) items; items without a word are left out.

    ``of_all`` are the statistics of the benchmark that ``items`` is a part of;
    without it they are a whole benchmark.
    """
    parts = [(i, *split_item(t)) for i, t in items if t and t.split()]
    if not parts:
        return None
    words = [q if q is a else q + a for _, q, a in parts]
    order = sorted(range(len(parts)), key=lambda k: (words[k], str(parts[k][0])))
    parts, words = [parts[k] for k in order], [words[k] for k in order]
    n = len(parts)
    spread = Counter(t for w in words for t in set(w))
    terms = {t: k for k, t in enumerate(sorted(spread))}
    if of_all is None:
        of_all = Statistics(n, sum(map(len, words)) / n, max(map(len, words)), spread)
    mean, counts = of_all.mean, {t: of_all.spread[t] for t in spread}
    idf = {t: math.log(1 + (of_all.n - c + 0.5) / (c + 0.5)) for t, c in counts.items()}
    postings = [([], []) for _ in terms]
    frequent = sorted(terms, key=lambda t: (-spread[t], t))
    for k, w in enumerate(words):
        weight = {
            t: idf[t] * f * (K1 + 1) / (f + K1 * (1 - B + B * len(w) / mean))
            for t, f in Counter(w).items()
        }
        own = sum(weight.values())
        for t, x in weight.items():
            postings[terms[t]][0].append(k)
            postings[terms[t]][1].append(x / own)
    # Frequent terms are left to the constant while no item gets half the threshold from them.
    rest, essential = np.zeros(n), np.ones(len(terms), dtype=bool)
    for t in frequent:
        at, weight = postings[terms[t]]
        if (rest[at] + weight > threshold / 2).any():
            break
        rest[at] += weight
        essential[terms[t]] = False
    blocks = -(-n // BLOCK)
    start, of, most = [0], [], []
    for t, (at, weight) in enumerate(postings):
        if essential[t]:
            best: dict[int, float] = {}
            for k, x in zip(at, weight):
                best[k // BLOCK] = max(x, best.get(k // BLOCK, 0.0))
            of.extend(best)
            most.extend(best.values())
        start.append(len(of))
    padded = np.zeros(blocks * BLOCK)
    padded[:n] = rest

    def numbered(w: list[str]) -> set:
        return ngrams([terms[t] for t in w], NGRAM)

    return Index(
        ids=[i for i, _, _ in parts],
        terms=terms,
        postings=postings,
        questions=[numbered(q) for _, q, _ in parts],
        answers=[numbered(a) for _, _, a in parts],
        segment=max(MIN_SEGMENT, of_all.longest),
        threshold=threshold,
        overlap=overlap,
        essential=essential,
        block_start=np.array(start, dtype=np.int64),
        block_of=np.array(of, dtype=np.int64),
        block_max=np.array(most, dtype=np.float64),
        rest=padded.reshape(blocks, BLOCK).max(axis=1),
    )


def wand(index: Index, terms: list[int], first: int, last: int) -> list[tuple[int, float]]:
    """Items from ``first`` up to ``last`` whose score for these distinct terms reaches the threshold."""
    cursors = []
    for t in terms:
        at, weight = index.postings[t]
        lo = bisect_left(at, first)
        if lo < len(at) and at[lo] < last:
            cursors.append([at[lo], lo, at, weight, index.upper[t]])
    found = []
    while cursors:
        cursors.sort(key=lambda c: c[0])
        bound, pivot = 0.0, None
        for c in cursors:
            bound += c[4]
            if bound >= index.threshold - _EPS:
                pivot = c[0]
                break
        if pivot is None:
            break
        if cursors[0][0] == pivot:
            score = sum(c[3][c[1]] for c in cursors if c[0] == pivot)
            if score >= index.threshold - _EPS:
                found.append((pivot, score))
            target = pivot + 1
        else:
            target = pivot
        for c in cursors:
            if c[0] < target:
                c[1] = bisect_left(c[2], target, c[1])
                c[0] = c[2][c[1]] if c[1] < len(c[2]) else last
        cursors = [c for c in cursors if c[0] < last]
    return found


def _open_blocks(index: Index, ids: np.ndarray, segments: np.ndarray, firsts: np.ndarray):
    """(passage, block) pairs whose bound reaches the threshold, for tokens of many texts.

    A passage has the number of its first segment; ``firsts`` marks segments that
    begin a text, which belong to no passage begun before them.
    """
    useful = ids >= 0
    useful[useful] = index.essential[ids[useful]]
    if not useful.any():
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    n_terms = len(index.postings)
    pair = np.unique(segments[useful] * n_terms + ids[useful])
    segment, term = pair // n_terms, pair % n_terms
    count = index.block_start[term + 1] - index.block_start[term]
    begin = np.cumsum(count) - count
    at = np.arange(count.sum()) - np.repeat(begin - index.block_start[term], count)
    blocks = len(index.rest)
    key = np.repeat(segment, count) * blocks + index.block_of[at]
    weight = index.block_max[at]
    back = ~firsts[key // blocks]
    key = np.concatenate([key, key[back] - blocks])
    weight = np.concatenate([weight, weight[back]])
    keys, own = np.unique(key, return_inverse=True)
    bound = np.bincount(own, weights=weight)
    passage, block = keys // blocks, keys % blocks
    live = bound + index.rest[block] >= index.threshold - _EPS
    return passage[live], block[live]


def search(index: Index, texts: list[str | None]) -> list[list[dict]]:
    """For every text its items: the best passage of each, by score."""
    look = index.vocabulary.__getitem__
    tokens = [list(map(look, (t or "").lower().split())) for t in texts]
    size = index.segment
    n_segments = np.array([-(-len(t) // size) for t in tokens], dtype=np.int64)
    base = np.cumsum(n_segments) - n_segments
    if not n_segments.sum():
        return [[] for _ in texts]
    ids = np.fromiter((x for t in tokens for x in t), dtype=np.int64, count=sum(map(len, tokens)))
    segments = np.concatenate(
        [b + np.arange(len(t)) // size for b, t in zip(base.tolist(), tokens)]
    )
    firsts = np.zeros(int(n_segments.sum()) + 1, dtype=bool)
    firsts[base[n_segments > 0]] = True
    owner = np.repeat(np.arange(len(texts)), n_segments)
    best: list[dict] = [{} for _ in texts]
    for p, block in zip(*(x.tolist() for x in _open_blocks(index, ids, segments, firsts))):
        text = int(owner[p])
        start = (p - int(base[text])) * size
        window = tokens[text][start : start + 2 * size]
        terms = sorted({t for t in window if t >= 0})
        grams: dict[int, set] = {}

        def share(wanted: set) -> float:
            n = len(next(iter(wanted)))
            if n not in grams:
                grams[n] = ngrams(window, n) if len(window) >= n else set()
            return len(wanted & grams[n]) / len(wanted)

        for item, score in wand(index, terms, block * BLOCK, (block + 1) * BLOCK):
            question, answer = share(index.questions[item]), share(index.answers[item])
            if min(question, answer) < index.overlap - _EPS:
                continue
            hit = {
                "item_id": index.ids[item],
                "score": round(min(score, 1.0), 6),
                "question_overlap": round(question, 6),
                "answer_overlap": round(answer, 6),
                "first_word": start,
            }
            old = best[text].get(item)
            if old is None or hit["score"] > old["score"]:
                best[text][item] = hit
    return [[b[k] for k in sorted(b)] for b in best]


def _parts(items: DataFrame, id_col: str, text_col: str, index_bytes: int) -> tuple[DataFrame, int]:
    """(id, text, part) of the items, in parts of about ``index_bytes`` of text, and their number."""
    items = items.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / index_bytes))
    return items.withColumn("part", F.pmod(F.xxhash64("id", "text"), F.lit(parts))), parts


def _spread(items: DataFrame) -> tuple[Statistics, DataFrame]:
    """Statistics of all items, without the terms, and (part, term, n): all items with a part's terms."""

    @F.pandas_udf("array<string>")
    def words(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [normal(w) for w in (t or "").lower().split()])

    worded = materialize(items.select("part", words("text").alias("words")).where(F.size("words") > 0))
    size = F.size("words")
    n, total, longest = worded.agg(F.count(size), F.sum(size), F.max(size)).first()
    each = worded.select("part", F.explode(F.array_distinct("words")).alias("term"))
    by_part = each.groupBy("part", "term").agg(F.count(F.lit(1)).alias("own"))
    by_term = by_part.groupBy("term").agg(F.sum("own").alias("n"))
    counts = materialize(by_part.join(by_term, "term").select("part", "term", "n"))
    return Statistics(n, total / n if n else 0.0, longest or 0, {}), counts


def matches(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
    index_bytes: int = INDEX_BYTES,
) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, with ``hits``: the test items found in the text.

    A hit is (item_id, score, question_overlap, answer_overlap, first_word): a
    passage whose score reaches ``threshold`` and that has at least ``overlap``
    of the runs of three words of the question and of the answer. NULL and blank
    texts and items match nothing; repeated items are found each; repeated rows
    give repeated rows. Empty documents give an empty table, an empty benchmark
    empty hits. An index holds ``index_bytes`` of item text; a larger benchmark
    takes a pass for each part, one after the other, with the BM25 statistics and
    the passage length of all items, so hits do not depend on ``index_bytes``.
    """
    item_type = dict(items.dtypes)[item_id_col]
    schema = (
        f"array<struct<item_id:{item_type},score:double,question_overlap:double,"
        "answer_overlap:double,first_word:int>>"
    )

    def searcher(index: Index, text: Column) -> Column:
        @F.pandas_udf(schema)
        def hits(texts: pd.Series) -> pd.Series:
            return pd.Series(search(index, texts.tolist()), dtype=object)

        return hits(text.cast("string"))

    def index_of(part: DataFrame, of_all: Statistics | None = None) -> Index | None:
        rows = sorted(((r.id, r.text) for r in part.collect() if r.text), key=lambda r: (str(r[0]), r[1]))
        return build(rows, threshold, overlap, of_all)

    none = F.array().cast(schema)
    out = docs.select(F.struct("*").alias("row"))
    text = F.col(f"row.`{text_col}`")
    rows, parts = _parts(items, item_id_col, item_text_col, index_bytes)
    if parts == 1:
        index = index_of(rows)
        return out.withColumn("hits", none if index is None else searcher(index, text))
    # Hits depend on the text only: each pass writes those it finds, by the hash of the text.
    of_all, counts = _spread(rows)
    key = F.sha2(text.cast("string"), 256)
    found = None
    for k in range(parts):
        terms = {r.term: r.n for r in counts.where(F.col("part") == k).collect()}
        index = index_of(rows.where(F.col("part") == k), replace(of_all, spread=terms))
        if index is None:
            continue
        hits = out.select(key.alias("key"), searcher(index, text).alias("hits"))
        hits = materialize(hits.where(F.size("hits") > 0))
        own = hits.groupBy("key").agg(F.first("hits").alias("hits"))
        found = own if found is None else found.unionByName(own)
    if found is None:
        return out.withColumn("hits", none)
    found = found.groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    joined = out.withColumn("key", key).join(found, "key", "left")
    return joined.select("row", F.coalesce("hits", none).alias("hits"))
