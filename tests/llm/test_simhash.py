import random

import numpy as np
import pytest
import xxhash

from stockweave.llm import components, simhash, vptree
from stockweave.llm.catalog import QUERIES


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows, radius=4):
    """(id, fingerprint) rows -> component of each fingerprint, by all pairs."""
    words = sorted({f for _, f in rows})
    parent = {w: w for w in words}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if (a ^ b).bit_count() <= radius:
                parent[root(a)] = root(b)
    least = {}
    for d, f in rows:
        if d is not None:
            least[root(f)] = min(d, least.get(root(f), d))
    return {w: least.get(root(w)) for w in words}


def random_words(rng, groups, size, noise):
    out = set()
    for _ in range(groups):
        centre = rng.getrandbits(64)
        for _ in range(size):
            word = centre
            for _ in range(rng.randrange(noise)):
                word ^= 1 << rng.randrange(64)
            out.add(word)
    return sorted(out)


def test_fingerprint_as_stated():
    rng = random.Random(5)
    texts = [None, "", " \t\n", "One", "a b c", "A b C d", "é É x y z", "x y " * 400]
    texts += [" ".join(rng.choice("ab cd ef gh ij".split()) for _ in range(n)) for n in (4, 5, 9, 700)]
    for t in texts:
        got = simhash.fingerprint(None if t is None else t.encode())
        assert got % (1 << 64) == plain_fingerprint(t)


@pytest.mark.parametrize("radius", [1, 4, 5])
def test_every_pair_meets_in_a_leaf(radius):
    rng = random.Random(radius)
    words = np.array(random_words(rng, 60, 30, 9), dtype=np.uint64)
    met = set()
    for tree in [vptree.build_tree(words[::2], len(words), 40, m, radius // 3) for m in vptree.SEGMENTS]:
        assert tree.leaves > 3
        index, leaf = tree.route(words)
        for k in range(tree.leaves):
            own = words[index[leaf == k]]
            child, root = vptree.spanning_links(own, 0)
            assert not len(child)  # a word comes to a leaf once
            near = np.bitwise_count(own[:, None] ^ own[None, :]) <= radius
            met.update((int(own[i]), int(own[j])) for i, j in zip(*np.nonzero(near)))
    near = np.bitwise_count(words[:, None] ^ words[None, :]) <= radius
    assert met >= {(int(words[i]), int(words[j])) for i, j in zip(*np.nonzero(near))}


def test_links_of_hot_leaves_in_blocks(spark):
    rng = random.Random(2)
    words = random_words(rng, 40, 8, 7) + random_words(rng, 1, 400, 4)
    signed = [w - (1 << 64) if w >= 1 << 63 else w for w in words]
    unique = spark.createDataFrame([(w,) for w in signed], "fp long").distinct()
    links = components.stars(simhash.fingerprint_links(unique, leaf_size=64, block=50)).collect()
    root = {r.child: r.root for r in links}
    got = {}
    for w in set(signed):
        got.setdefault(root.get(w, w), set()).add(w % (1 << 64))
    want = {}
    for w, c in plain_components([(w, w) for w in words]).items():
        want.setdefault(c, set()).add(w)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_stars_of_a_long_chain(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 100), (7, 7)]
    rng.shuffle(edges)
    df = spark.createDataFrame([(b, a) for a, b in edges], "child long, root long")
    got = {(r.child, r.root) for r in components.stars(df).collect()}
    assert got == {(i, 0) for i in range(1, 41)} | {(101, 100)}
    assert components.stars(df.limit(0)).collect() == []


def test_rows(spark):
    rows = [(3, None, "x"), (2, "", "x"), (None, " ", "x"), (5, "a b c d", "y"), (4, "A  b c D", "y"), (4, "A  b c D", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted((r.id or 0, r.component_id) for r in simhash.components(docs).collect())
    assert got == [(0, 2), (2, 2), (3, 2), (4, 4), (4, 4), (5, 4)]
    kept = simhash.one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [(2, "", "x"), (4, "A  b c D", "y")]
    assert simhash.components(docs.limit(0)).collect() == []
    assert simhash.one_per_group(docs.limit(0)).collect() == []
    mapped = docs.selectExpr("*", "map(1, fp) as `a.b`")
    assert simhash.one_per_group(mapped).count() == 2
    unnamed = docs.where("doc_id is null")
    assert [tuple(r) for r in simhash.one_per_group(unnamed).collect()] == [(None, " ", "x")]


def test_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs]
    component = plain_components(rows)
    got = QUERIES["op1_simhash_neardup"](spark, sf_dir).collect()
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in got) == sorted(
        (d, f"{f:016x}", component[f]) for d, f in rows
    )
