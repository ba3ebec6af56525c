"""License scans: winnowed fingerprints pick candidates, a banded alignment measures them.

Every template is a sequence of plain words. Of its runs of three words the
winnowed ones (the least hash in each window of two runs) form an inverted
index; of a short template all runs of two do, as one changed word leaves few
runs of it whole. A text's runs are looked up; hits of one template on nearby
diagonals are one piece, which is aligned with the template in a band around
them. Pieces that follow each other are chained as well, where words were put
between them, over a stretch of at most ``STRETCH`` times the template, and
aligned through the bands of all. The matches give the coverage of the template, and
the span of the text from the first matched word to the last.
"""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.license_texts import TEMPLATES

RUN = 3
WINNOW = 2
# Templates under so many words are indexed by all their runs of two.
SHORT_WORDS = 40
SHORT_RUN = 2
# Words that may be put in or left out within a piece. More of them at one place split it in two.
BAND = 12
# Pieces a chain looks back on for the one before; a place has fewer.
MAX_LOOK = 64
# Longest stretch of text that is one place, as a multiple of the template's words.
STRETCH = 2
MIN_COVERAGE = 0.75
_CACHED = 200_000
_MARKS = ".,;:!?()[]{}\"'«»“”‘’…#*$%&|<>/-"
_WORD = re.compile(r"\S+")


def plain(word: str) -> str:
    """A lower-case word without marks at its ends; empty for marks only."""
    return word.strip(_MARKS)


def winnowed(words: list[str], run: int = RUN, window: int = WINNOW) -> list[int]:
    """Positions of the runs kept: in each window the least hash, the last of equals."""
    hashes = [
        xxhash.xxh64_intdigest("\x1f".join(words[i : i + run])) for i in range(len(words) - run + 1)
    ]
    kept = set()
    for at in range(max(1, len(hashes) - window + 1)):
        own = hashes[at : at + window]
        if own:
            kept.add(at + max(i for i, h in enumerate(own) if h == min(own)))
    return sorted(kept)


class Words(dict):
    """Raw lower-case word -> number, -1 if no template has it; keeps what it met."""

    def __init__(self, known: dict[str, int]) -> None:
        super().__init__()
        self.known = known

    def __missing__(self, word: str) -> int:
        found = self.known.get(plain(word), -1)
        if len(self) < _CACHED:
            self[word] = found
        return found


@dataclass
class Index:
    """Templates as word numbers; ``runs`` has the sorted fingerprints of each run length.

    An entry of ``runs`` is (keys, template of each, position of each in it).
    """

    names: list[str]
    templates: list[list[int]]
    known: dict[str, int]
    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]
    min_coverage: float

    def __post_init__(self) -> None:
        self.words = Words(self.known)
        self.places: list[dict[int, list[int]]] = [{} for _ in self.templates]
        for own, template in zip(self.places, self.templates):
            for i, word in enumerate(template):
                own.setdefault(word, []).append(i)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("words", "places")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.__post_init__()

    def least_hits(self, template: int) -> int:
        """Positions of a template that a place with its coverage has at least among the hits.

        Of n words m may be missing, and each breaks two runs of two; half of the
        rest may be broken by words put in. A long template needs one run.
        """
        n = len(self.templates[template])
        if n >= SHORT_WORDS:
            return 1
        missing = n - int(np.ceil(self.min_coverage * n))
        return max(1, (n - 1 - 2 * missing) // 2)


def _run_keys(ids: np.ndarray, n_words: int, run: int) -> np.ndarray:
    """A number for each run of words, -1 where a word is unknown."""
    n = max(0, len(ids) - run + 1)
    keys, known = np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
    for k in range(run):
        own = ids[k : k + n]
        keys = keys * n_words + own
        known &= own >= 0
    keys[~known] = -1
    return keys


def build(templates: dict[str, str], min_coverage: float = MIN_COVERAGE) -> Index:
    """The index; templates of fewer than three plain words cannot be found and are refused."""
    split = {n: [w for w in map(plain, t.lower().split()) if w] for n, t in sorted(templates.items())}
    short = [n for n, w in split.items() if len(w) < RUN]
    if short:
        raise ValueError(f"templates under {RUN} words: {short}")
    known = {w: k for k, w in enumerate(sorted({w for ws in split.values() for w in ws}))}
    entries: dict[int, list] = {SHORT_RUN: [], RUN: []}
    numbered = [[known[w] for w in ws] for ws in split.values()]
    for t, ws in enumerate(split.values()):
        run = SHORT_RUN if len(ws) < SHORT_WORDS else RUN
        keys = _run_keys(np.array(numbered[t], dtype=np.int64), len(known), run)
        places = range(len(keys)) if run == SHORT_RUN else winnowed(ws)
        entries[run] += [(int(keys[p]), t, p) for p in places]
    runs = {
        run: tuple(np.array(sorted(own), dtype=np.int64).reshape(-1, 3).T.copy())
        for run, own in entries.items()
    }
    return Index(list(split), numbered, known, runs, min_coverage)


def cells(
    places: dict[int, list[int]], ids: list[int], offset: int, diagonal: int, band: int
) -> list[tuple[int, int]]:
    """(position in the text, in the template) of all equal words in a band.

    ``ids`` begins at ``offset`` of the text; ``places`` lists where the template
    has a word. A cell lies in the band if position less place is within ``band`` of
    ``diagonal``.
    """
    out = []
    for j, word in enumerate(ids, offset):
        for i in places.get(word, ()):
            if -band <= j - i - diagonal <= band:
                out.append((j, i))
    return out


def band_of(length: int) -> int:
    """Words that may be missing or inserted before an alignment leaves its band."""
    return min(BAND, max(2, length // 3))


@dataclass
class Piece:
    """Hits close in the text and on diagonals within half the band."""

    first: int  # in the text
    last: int
    diagonal: int
    places: list[int]  # in the template

    @property
    def hits(self) -> int:
        return len(self.places)

    @cached_property
    def centre(self) -> float:
        """The middle place: a few hits of common words at its ends do not move it."""
        return sorted(self.places)[len(self.places) // 2]


def _pieces(positions: list[int], places: list[int], length: int) -> list[Piece]:
    """The pieces of hits given in order of the text."""
    near = band_of(length) // 2
    out: list[Piece] = []
    for p, place in zip(positions, places):
        d = p - place
        for own in out[: -5 : -1]:
            if p - own.last <= length and abs(d - own.diagonal) <= near:
                own.last = p
                own.places.append(place)
                break
        else:
            out.append(Piece(p, p, d, [place]))
    return out


def _chains(pieces: list[Piece], length: int) -> list[list[Piece]]:
    """Pieces that follow each other in the text and in the template, with the most hits.

    Two copies of a template have their centres at the same place, so they are no chain.
    """
    stretch, apart = STRETCH * length, length / 8
    best: list[tuple[int, int, int]] = []  # hits, piece before, first word of the chain
    followed = set()
    for k, own in enumerate(pieces):
        hits, before, first = own.hits, -1, own.first
        for j in range(k - 1, max(-1, k - 1 - MAX_LOOK), -1):
            other, (n, _, begin) = pieces[j], best[j]
            follows = other.centre + apart <= own.centre and other.first < own.last
            if follows and own.last - begin <= stretch and n + own.hits > hits:
                hits, before, first = n + own.hits, j, begin
        best.append((hits, before, first))
        followed.add(before)
    out = []
    for k in range(len(pieces)):
        if k not in followed and best[k][1] >= 0:
            chain = [k]
            while best[chain[-1]][1] >= 0:
                chain.append(best[chain[-1]][1])
            out.append([pieces[i] for i in reversed(chain)])
    return out


def align(matches: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The most (position in the text, in the template) that rise in both.

    The longest common subsequence through the given cells. Of equal ones it is a
    short stretch of the text: it begins late, and goes on with the next cell.
    """
    matches = sorted(set(matches), key=lambda m: (m[0], -m[1]))
    ends: list[int] = []  # least template position that ends a chain of each length
    owner: list[int] = []
    before = [-1] * len(matches)
    for k, (_, at) in enumerate(matches):
        n = bisect.bisect_left(ends, at)
        before[k] = owner[n - 1] if n else -1
        ends[n : n + 1], owner[n : n + 1] = [at], [k]
    chain, k = [], owner[-1] if owner else -1
    while k >= 0:
        chain.append(matches[k])
        k = before[k]
    chain.reverse()
    spots: dict[int, list[int]] = {}
    for j, i in matches:
        spots.setdefault(i, []).append(j)
    for k in range(1, len(chain)):
        own = spots[chain[k][1]]
        chain[k] = own[bisect.bisect_right(own, chain[k - 1][0])], chain[k][1]
    return chain


def _hits(index: Index, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place in the text, template, place in it) of all runs of the text in the index."""
    out = []
    for run, (keys, templates, places) in index.runs.items():
        own = _run_keys(ids, len(index.known), run)
        at = np.flatnonzero(own >= 0)
        low = np.searchsorted(keys, own[at], "left")
        count = np.searchsorted(keys, own[at], "right") - low
        entry = np.repeat(low, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        out.append((np.repeat(at, count), templates[entry], places[entry]))
    return tuple(np.concatenate(x) for x in zip(*out))


def _places(index: Index, t: int, ids: np.ndarray, position: np.ndarray, place: np.ndarray):
    """Matches of each place of template ``t``, from its hits."""
    words, length = index.places[t], len(index.templates[t])
    least, need = index.min_coverage * length, index.least_hits(t)
    band = band_of(length)
    # Hits further apart than a stretch belong to different places.
    order = np.argsort(position, kind="stable")
    position, place = position[order], place[order]
    cuts = np.flatnonzero(np.diff(position) > STRETCH * length) + 1
    for own, of in zip(np.split(position, cuts), np.split(place, cuts)):
        if len(set(of.tolist())) < need:
            continue
        pieces = _pieces(own.tolist(), of.tolist(), length)
        known: dict[int, list[tuple[int, int]]] = {}

        def of_piece(piece: Piece) -> list[tuple[int, int]]:
            found = known.get(id(piece))
            if found is None:
                d = piece.diagonal
                lo = max(0, min(piece.first, d) - band)
                hi = min(len(ids), max(piece.last + RUN, d + length) + band)
                found = known[id(piece)] = cells(words, ids[lo:hi].tolist(), lo, d, band)
            return found

        for chain in [*[[x] for x in pieces], *_chains(pieces, length)]:
            if sum(x.hits for x in chain) >= need:
                matched = align([cell for piece in chain for cell in of_piece(piece)])
                if len(matched) >= least:
                    yield matched


def scan_ids(index: Index, ids: np.ndarray) -> list[tuple[int, int, int, int]]:
    """(template, matched words, first word, last word) of one text, covered ones left out."""
    position, template, place = _hits(index, ids)
    found = set()
    for t in np.unique(template).tolist():
        own = template == t
        for matched in _places(index, t, ids, position[own], place[own]):
            found.add((t, len(matched), matched[0][0], matched[-1][0]))
    # The most words first; what lies inside a better match is part of it.
    ordered = sorted(found, key=lambda x: (-x[1], x[3] - x[2], index.names[x[0]], x[2]))
    kept: list[tuple[int, int, int, int]] = []
    for x in ordered:
        inside = any(k[2] <= x[2] and x[3] <= k[3] for k in kept)
        # a chain over a better match of its own template is that match once more
        again = any(k[0] == x[0] and k[1] >= x[1] and k[2] <= x[3] and x[2] <= k[3] for k in kept)
        if not inside and not again:
            kept.append(x)
    return sorted(kept, key=lambda x: (x[2], x[3], x[0]))


def scan(index: Index, texts: list[str | None]) -> list[list[dict]]:
    """The licenses of every text with coverage and span in code points."""
    look = index.words.__getitem__
    out = []
    for text in texts:
        ids = np.fromiter(map(look, (text or "").lower().split()), dtype=np.int64)
        found = scan_ids(index, ids) if len(ids) >= SHORT_RUN else []
        places = [m.span() for m in _WORD.finditer(text)] if found else []
        out.append(
            [
                {
                    "license": index.names[t],
                    "coverage": round(n / len(index.templates[t]), 6),
                    "matched_words": n,
                    "start": places[first][0],
                    "end": places[last][1],
                }
                for t, n, first, last in found
            ]
        )
    return out


def matches(
    docs: DataFrame,
    text_col: str = "text",
    templates: dict[str, str] | None = None,
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """All columns of ``docs`` in a struct ``row``, with ``licenses`` found in the whole text.

    A license is (license, coverage, matched_words, start, end), by start; one is
    listed for each place where at least ``min_coverage`` of the template's words
    stand in order, unless a match of more words covers the place. A place is at
    most ``STRETCH`` times as long as the template; within a piece of it up to
    ``BAND`` words may be put in or left out, and any number between pieces. It needs
    one run of words unbroken: three of a template of ``SHORT_WORDS`` or more, two
    of a shorter one. NULL, blank and short texts have none. Repeated rows give repeated rows, an empty table
    an empty one.
    """
    index = build(templates or TEMPLATES, min_coverage)

    @F.pandas_udf(
        "array<struct<license:string,coverage:double,matched_words:int,start:int,end:int>>"
    )
    def found(texts: pd.Series) -> pd.Series:
        return pd.Series(scan(index, texts.tolist()), dtype=object)

    rows = docs.select(F.struct("*").alias("row"))
    # Named so, it is not copied into filters on its result: a second scan, in a second worker of each task.
    found = found.asNondeterministic()
    return rows.withColumn("licenses", found(F.col(f"row.`{text_col}`").cast("string")))
