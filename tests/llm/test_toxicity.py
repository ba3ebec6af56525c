import random
import zlib

import numpy as np
import pytest

from stockweave.llm import toxicity
from stockweave.llm.catalog import QUERIES


def plain_segments(scores):
    """Maximal segments by their definition: the best stretch, then the same left and right of it."""

    def best(low, high):
        found = None
        for a in range(low, high):
            for b in range(a + 1, high + 1):
                s = sum(scores[a:b])
                # of equal sums the shortest, which has no stretch of sum zero at its ends
                if s > 0 and (found is None or (s, a - b) > (found[2], found[0] - found[1])):
                    found = (a, b, s)
        return [] if found is None else best(low, found[0]) + [found] + best(found[1], high)

    return best(0, len(scores))


@pytest.mark.parametrize("seed", range(20))
def test_segments_are_the_maximal_ones(seed):
    rng = random.Random(seed)
    # powers of two with random signs: sums never tie
    scores = [rng.choice([-1, 1]) * float(2**k) for k in rng.sample(range(24), 18)]
    assert toxicity.segments(scores) == plain_segments(scores)


def test_segments_of_edges():
    assert toxicity.segments([]) == [] and toxicity.segments([-1.0, 0.0]) == []
    assert toxicity.segments([1.0, -5.0, 1.0]) == [(0, 1, 1.0), (2, 3, 1.0)]
    # the stretch of sum 7 begins after the 3, which only breaks even with the -3
    scores = [4.0, -5.0, 3.0, -3.0, 1.0, 2.0, -2.0, 2.0, -2.0, 1.0, 5.0]
    assert toxicity.segments(scores) == [(0, 1, 4.0), (2, 3, 3.0), (4, 11, 7.0)]
    many = toxicity.segments([1.0, -0.5] * 200_000)
    assert many == [(0, 399_999, 100_000.5)]


def made(n, seed=0):
    """(doc_id, text, toxic): toxic texts have words of two families, some never repeated."""
    rng = random.Random(seed)
    plain = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(n):
        own = rng.choices(plain, k=rng.randrange(30, 120))
        toxic = int(rng.random() < 0.2)
        if toxic:
            at = rng.randrange(len(own))
            own[at:at] = [f"{rng.choice(['zgrul', 'bragh'])}{rng.randrange(300)}" for _ in range(3)]
        rows.append((k, " ".join(own), toxic))
    return rows


def frames(spark, rows):
    docs = spark.createDataFrame([(i, t, 7) for i, t, _ in rows], "doc_id long, text string, toxic int")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    return docs, labels


def test_unseen_words_of_known_kin(spark):
    rows = made(900)
    docs, labels = frames(spark, rows)
    model = toxicity.train(docs, labels)
    truth = {i: y for i, _, y in rows}
    held = [r for r in toxicity.scored(docs, model).collect() if zlib.crc32(str(r.id).encode()) % 3 == 1]
    assert len(held) > 200
    assert sum((r.score >= 0.7) == bool(truth[r.id]) for r in held) >= 0.97 * len(held)
    text = dict((i, t) for i, t, _ in rows)
    found = [(r, p) for r in held if truth[r.id] for p in r.passages]
    assert len(found) >= 0.9 * sum(truth[r.id] for r in held)
    for r, p in found:
        assert text[r.id][p["start"] : p["end"]].startswith(("zgrul", "bragh"))


def test_held_out_labels_do_not_count(spark):
    rows = made(300)
    docs, labels = frames(spark, rows)
    flipped = [(i, t, 1 - y if zlib.crc32(str(i).encode()) % 3 == 1 else y) for i, t, y in rows]
    a = toxicity.train(docs, labels)
    b = toxicity.train(docs, frames(spark, flipped)[1])
    assert (a.toxic == b.toxic).all() and a.link == b.link and a.documents == b.documents


def test_copies_are_one_witness(spark):
    rows = made(200)
    copies = [(1000 + k, rows[0][1] + f" w{k % 3}", 1) for k in range(60)]
    model = toxicity.train(*frames(spark, rows + copies))
    assert sum(model.documents) <= 200


def test_odd_rows(spark):
    rows = made(200)
    docs, labels = frames(spark, rows)
    model = toxicity.train(docs, labels)
    odd = [(1, None, 0), (2, "", 0), (3, " \n", 0), (None, "w1", 0), (4, "İ" * 3 + " zgrul1 bragh2 zgrul3", 0), (4, "w1 " * 50000, 0), (4, "w1", 0), (4, "w1", 0)]
    got = {}
    for r in toxicity.scored(frames(spark, odd)[0], model).collect():
        got.setdefault(r.id, []).append(r)
    assert got[1][0].score == got[2][0].score == got[3][0].score < 0.2 and got[1][0].passages == []
    assert sorted(len(v) for v in got.values()) == [1, 1, 1, 1, 4]
    # offsets are of the text as it is, though its lower case is longer
    (p,) = next(r for r in got[4] if r.passages).passages
    assert odd[4][1][p["start"] : p["end"]] == "zgrul1 bragh2 zgrul3"
    assert toxicity.scored(docs.limit(0), model).collect() == []
    # no label of one kind, no labels at all, labels without values
    for few in (labels.where("toxic = 1"), labels.limit(0), spark.createDataFrame([(1, None), (None, 1)], labels.schema)):
        assert toxicity.train(docs, few) is None
    assert [r.score for r in toxicity.scored(docs.limit(2), None).collect()] == [0.0, 0.0]


def test_law_and_link():
    rng = np.random.default_rng(5)
    sizes = np.full(20000, 150)
    rate, log_k = 1.3, -2.0
    best = (np.log(sizes) + log_k + rng.gumbel(size=20000)) / rate
    fitted = toxicity._fit_law(best, sizes)
    assert abs(fitted[0] - rate) < 0.06 and abs(fitted[1] - log_k) < 0.25
    x = rng.uniform(0, 10, 5000)
    y = (rng.random(5000) < 1 / (1 + np.exp(4 - x))).astype(float)
    a, b = toxicity._fit_link(x, y)
    assert abs(a + 4) < 0.5 and abs(b - 1) < 0.12


def test_query(spark):
    """Held-out accuracy on the given documents and labels."""
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES["op13_toxicity"](spark, sf_dir)
    assert dict(found.dtypes) | {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"} == dict(found.dtypes)
    rows = {r.doc_id: r for r in found.collect()}
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in rows.items())
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    held = [(rows[r.doc_id].predicted, r.toxic) for r in labels if rows[r.doc_id].held_out]
    toxic = [p for p, y in held if y]
    clean = [p for p, y in held if not y]
    assert np.mean(toxic) >= 0.7 and np.mean(clean) <= 0.01
