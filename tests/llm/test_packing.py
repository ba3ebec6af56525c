import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from stockweave.llm import packing
from stockweave.llm.catalog import QUERIES


def plain_best_fit(pieces, capacity):
    """The residual every piece is put into, by looking at all open bins."""
    bins, residuals = [], []
    for size, source, cluster in pieces:
        fit = [
            b for b in bins
            if b[0] >= max(1, size) and (source < 0 or source not in b[1]) and (cluster < 0 or cluster not in b[2])
        ]
        if size >= capacity or not fit:
            own = [capacity, set(), set()]
            bins.append(own)
        else:
            own = min(fit, key=lambda b: b[0])
        residuals.append(own[0])
        own[0] -= max(1, size)
        own[1].add(source)
        own[2].add(cluster)
    return residuals


@pytest.mark.parametrize("seed", range(6))
def test_tightest_compatible_bin(seed):
    rng = random.Random(seed)
    capacity = 100
    # every source and cluster combination its own, so the choice among equal bins cannot matter
    pieces = [(rng.randrange(0, 101), k if seed % 2 else -1, -1) for k in range(300)]
    bins = packing.best_fit(pieces, capacity)
    left, residuals = {}, []
    for b, (size, _, _) in zip(bins, pieces):
        residuals.append(left.get(b, capacity))
        left[b] = residuals[-1] - max(1, size)
    assert residuals == plain_best_fit(pieces, capacity) and min(left.values()) >= 0


def test_conflicts_and_successors():
    # 40: the tightest bin has its source, the successor takes it; 5: both bins have its cluster
    pieces = [(60, 0, -1), (50, 1, 7), (40, 0, -1), (35, 1, 7), (5, 2, 7), (100, 0, -1)]
    assert packing.best_fit(pieces, 100) == [0, 1, 1, 0, 2, 3]
    rng = random.Random(9)
    pieces = [(rng.randrange(1, 60), rng.choice([0, 0, 1, 2, 3]), rng.choice([-1, 0, 1, 2])) for _ in range(2000)]
    used = {}
    for b, (size, source, cluster) in zip(packing.best_fit(pieces, 100), pieces):
        own = used.setdefault(b, [0, [], []])
        own[0] += size
        own[1].append(source)
        own[2] += [cluster] if cluster >= 0 else []
    for total, sources, clusters in used.values():
        assert total <= 100 and len(set(sources)) == len(sources) and len(set(clusters)) == len(clusters)


@pytest.mark.parametrize("seed", range(8))
def test_tightest_bin_under_conflicts(seed):
    """Each choice is the tightest of all compatible bins as they stand, whichever of equal ones."""
    rng, capacity = random.Random(seed), 100
    sources, clusters = [-1, 0, 0, 0, 1, 2, 3], [-1, -1, 0, 1, 2]
    pieces = [(rng.randrange(1, 70), rng.choice(sources), rng.choice(clusters)) for _ in range(600)]
    bins = {}
    for b, (size, source, cluster) in zip(packing.best_fit(pieces, capacity), pieces):
        fit = [
            left for left, s, c in bins.values()
            if left >= size and left > 0 and (source < 0 or source not in s) and (cluster < 0 or cluster not in c)
        ]
        if b in bins:
            assert bins[b][0] == min(fit)
        else:
            assert not fit
        left, s, c = bins.setdefault(b, (capacity, set(), set()))
        assert left >= size and not (source >= 0 and source in s) and not (cluster >= 0 and cluster in c)
        bins[b] = (left - size, s | {source}, c | {cluster})


def checked(docs, packed, capacity):
    """Every piece once, parts as long as the text, no bin over capacity or in conflict."""
    rows = packed.collect()
    by_bin, by_doc = {}, Counter()
    for r in rows:
        by_bin.setdefault((r.shard, r.bin), []).append(r)
        by_doc[r.id] += r.size
    for own in by_bin.values():
        assert sum(max(1, r.size) for r in own) <= capacity
        for column in ("source", "cluster"):
            values = [r[column] for r in own if r[column] is not None]
            assert len(values) == len(set(values))
    want = Counter()
    for r in docs.select("doc_id", packing.token_estimate(F.col("text")).alias("n")).collect():
        want[r.doc_id] += r.n or 0
    assert by_doc == want
    return rows, by_bin


def test_rows(spark):
    rows = [(k, "same text again", "a", 1) for k in range(30)] + [(40, "same  TEXT again", "b", 1)] * 2
    rows += [(50, None, None, 1), (51, "", "c", 1), (52, "é" * 20000, "c", 1), (None, "w " * 999, "d", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, bin int")
    packed = packing.pack(docs, capacity=64, shard_docs=7)
    got, by_bin = checked(docs, packed, 64)
    assert len({r.shard for r in got}) > 2
    bins = packing.bins_of(packed).collect()
    assert sum(r.n_pieces for r in bins) == len(got) and len(bins) == len(by_bin)
    assert packing.pack(docs.limit(0)).collect() == []


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    _, by_bin = checked(docs, packing.pack(docs), packing.CAPACITY)
    bins = QUERIES["op9_best_fit_packing"](spark, sf_dir).collect()
    assert sorted(sorted(r.doc_ids) for r in bins) == sorted(sorted(x.id for x in own) for own in by_bin.values())


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def test_near_copies_of_other_sources_stay_apart(spark, sf_dir):
    rng = random.Random(5)
    rows = []
    for k in range(60):
        words = [f"w{rng.randrange(500)}" for _ in range(60)]
        for c in range(4):  # one word changed at the end, so at least 0.8 of the shingles are shared
            own = words[:-1] + [f"x{c}"] if c else words
            rows.append((4 * k + c, " ".join(own), f"s{k}-{c}"))
    rows += [(1000 + k, None, None) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    packed = packing.pack(docs).collect()
    group = {r.id: r.cluster for r in packed}
    bins = {r.id: (r.shard, r.bin) for r in packed}
    for k in range(60):
        assert len({group[4 * k + c] for c in range(4)}) == 1 and len({bins[4 * k + c] for c in range(4)}) == 4
    assert len(set(group.values())) == 61 and group[1000] is None
    # the given documents: clusters are the components of all pairs at 0.8, by brute force
    given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    own = {r.id: r.cluster for r in packing.pack(given).collect()}
    sets = sorted((r.doc_id, shingles(r.text)) for r in given.collect() if r.text and r.text.split())
    root = {a: a for a, _ in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if len(x & y) >= 0.8 * len(x | y):
                root[find(a)] = find(b)
    named = {}
    for a, _ in sets:
        assert named.setdefault(find(a), own[a]) == own[a]
    assert len(set(named.values())) == len(named)


def test_clashing_columns(spark):
    ddl = "doc_id long, text string, source string, cluster long, shard long, component long, node long, raw long"
    rows = [(k, f"text number {k} of some words", "s", 1, 1, 1, 1, 1) for k in range(5)]
    got = packing.pack(spark.createDataFrame(rows, ddl)).collect()
    assert sorted(r.id for r in got) == list(range(5)) and len({r.cluster for r in got}) == 5
