import random

import pytest

from stockweave.llm import decontaminate as dc
from stockweave.llm.catalog import QUERIES


def plain_search(index, text):
    """All passages against all items, every score summed in full."""
    tokens = [index.terms.get(dc.normal(w), -1) for w in (text or "").lower().split()]
    size, best = index.segment, {}
    for start in range(0, len(tokens), size):
        window = tokens[start : start + 2 * size]
        terms = set(window)
        for k in range(len(index.ids)):
            score = sum(w[at.index(k)] for t, (at, w) in enumerate(index.postings) if t in terms and k in at)
            if score < index.threshold - 1e-9:
                continue
            shares = []
            for wanted in (index.questions[k], index.answers[k]):
                n = len(next(iter(wanted)))
                own = {tuple(window[i : i + n]) for i in range(len(window) - n + 1)}
                shares.append(len(wanted & own) / len(wanted))
            if min(shares) < index.overlap - 1e-9:
                continue
            score = round(min(score, 1.0), 6)
            if k not in best or score > best[k][1]:
                best[k] = (index.ids[k], score, round(shares[0], 6), round(shares[1], 6), start)
    return [best[k] for k in sorted(best)]


@pytest.mark.parametrize("threshold, overlap", [(0.6, 0.7), (0.3, 0.0), (0.9, 0.2)])
def test_search_as_brute_force(threshold, overlap):
    rng = random.Random(4)
    common = [f"c{k}" for k in range(12)]
    items = []
    for i in range(45):
        words = [rng.choice(common) if rng.random() < 0.5 else f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 40))]
        cut = rng.randrange(len(words) + 1)
        items.append((i, " ".join(words[:cut]) + ". " + " ".join(words[cut:])))
    items += [(100, items[0][1]), (101, ""), (102, None), (103, "...")]
    index = dc.build(items, threshold, overlap)
    texts = [None, "", "c1 c2"]
    for _ in range(40):
        words = [rng.choice(common) if rng.random() < 0.4 else f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 400))]
        for _ in range(rng.randrange(3)):
            own = items[rng.randrange(45)][1].split()
            own = [w for w in own if rng.random() > 0.1]
            at = rng.randrange(len(words))
            words[at:at] = own
        texts.append(" ".join(words))
    found = dc.search(index, texts)
    assert sum(map(len, found)) > 10
    for text, hits in zip(texts, found):
        assert [tuple(h.values()) for h in hits] == plain_search(index, text)


def test_split():
    assert dc.split_item("What is it? It is A b.") == (["what", "is", "it"], ["it", "is", "a", "b"])
    assert dc.split_item("one line\nanswer here") == (["one", "line"], ["answer", "here"])
    assert dc.split_item("no end") == (["no", "end"], ["no", "end"])


def test_rows_and_passes(spark):
    item = "Question words stand here in a row? The answer follows them at once"
    items = spark.createDataFrame([(1, item), (2, None), (3, item), (4, "other words entirely unlike it all")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "x " * 500 + item + " y" * 500, "h"), (1, item.upper(), "h"), (2, None, "h"), (3, "", "h"), (4, "The answer follows them at once", "h")],
        "doc_id long, text string, hits string",
    )
    for size in (dc.INDEX_BYTES, 20):
        rows = dc.matches(docs, items, index_bytes=size).collect()
        got = sorted((r.row.doc_id, r.row.hits, sorted(h.item_id for h in r.hits)) for r in rows)
        assert got == [(1, "h", [1, 3]), (1, "h", [1, 3]), (2, "h", []), (3, "h", []), (4, "h", [])]
    assert {len(r.hits) for r in dc.matches(docs, items.limit(0)).collect()} == {0}
    assert dc.matches(docs.limit(0), items).collect() == []


def test_query(spark, sf_dir):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    index = dc.build(sorted(items, key=lambda x: (str(x[0]), x[1])), dc.THRESHOLD, dc.OVERLAP)
    want = sorted((r.doc_id, *h) for r in docs for h in plain_search(index, r.text))
    got = sorted(tuple(r) for r in QUERIES["op8_benchmark_decontamination"](spark, sf_dir).collect())
    assert got == want
    leaked = {(r.doc_id, i) for r in docs for i, t in items if t in r.text}
    assert leaked <= {(d, i) for d, i, *_ in got}


def test_hits_do_not_depend_on_the_parts(spark):
    rng = random.Random(8)
    common = [f"c{k}" for k in range(10)]
    texts = [
        " ".join(rng.choice(common) if rng.random() < 0.6 else f"w{rng.randrange(60)}" for _ in range(rng.randrange(8, 90)))
        for _ in range(40)
    ]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")
    rows = []
    for d in range(60):
        own = [w for w in texts[d % 40].split() if rng.random() > 0.25]
        rows.append((d, " ".join(["x"] * rng.randrange(150) + own)))
    docs = spark.createDataFrame([*rows, rows[0], (99, None)], "doc_id long, text string")
    got = [
        sorted((r.row.doc_id, sorted(map(tuple, r.hits))) for r in dc.matches(docs, items, overlap=0.2, index_bytes=n).collect())
        for n in (dc.INDEX_BYTES, 3000)
    ]
    assert sum(len(h) for _, h in got[0]) > 20 and got[0] == got[1]
