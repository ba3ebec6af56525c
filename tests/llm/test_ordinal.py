import math
import random

import pytest

from stockweave.llm import ordinal
from stockweave.llm.catalog import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def graded(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    labels = labels.select("doc_id", ordinal.grade_of(labels.quality, labels.toxic).alias("g"))
    rows = docs.join(labels, "doc_id").orderBy("doc_id").collect()
    return [(*ordinal.features(r.text), r.g, r.text) for r in rows]


def test_held_out(graded):
    """Trained on two thirds: low quality goes, clean documents stay."""
    train = [x[:3] for k, x in enumerate(graded) if k % 3]
    model = ordinal.fit(train)
    assert model.thresholds == sorted(model.thresholds)
    held = [x for k, x in enumerate(graded) if not k % 3]
    kept = [model.tails(model.index(t))[1] >= ordinal.KEEP_PROBABILITY for *_, t in held]
    good = [k for k, x in zip(kept, held) if x[2] == 2]
    low = [k for k, x in zip(kept, held) if x[2] == 0]
    assert sum(good) >= 0.95 * len(good) and sum(low) <= 0.15 * len(low)
    grades = [sum(model.tails(model.index(t))) for *_, t in held]
    mean = [sum(g for g, x in zip(grades, held) if x[2] == k) / sum(x[2] == k for x in held) for k in (0, 2)]
    assert mean[0] + 1 < mean[1]


def test_likelihood_falls_and_thresholds_order():
    rows = [([k % 7, 10 + g], [1.0] * 8, g) for k in range(300) for g in range(3)]
    model = ordinal.fit(rows)
    for g in range(3):
        tails = model.tails(sum(model.weights[[1, 10 + g]].tolist()) / ordinal._UNIT + sum(model.shape_weights))
        p = [1 - tails[0], tails[0] - tails[1], tails[1]]
        assert max(range(3), key=p.__getitem__) == g and math.isclose(sum(p), 1)


def test_fit_is_the_optimum_of_the_plain_likelihood():
    """The penalised likelihood, stated in plain Python, has no slope where the fit ends."""
    rng = random.Random(3)
    rows = []
    for _ in range(900):
        g = rng.choice([0, 1, 1, 2])
        own = [b for b in range(5) if rng.random() < (0.8 if b % 3 == g else 0.15)]
        rows.append((own, [rng.random() for _ in range(7)] + [1.0 if rng.random() < 0.1 else 0.0], g))
    model = ordinal.fit(rows)
    used = [b for b in range(5) if model.weights[b]]
    assert used
    params = [model.weights[b] / ordinal._UNIT for b in used] + list(model.shape_weights) + list(model.thresholds)

    def loss(p):
        w, v, t = dict(zip(used, p)), p[len(used) : len(used) + 8], p[len(used) + 8 :]
        total = 0.0
        for own, shape, g in rows:
            index = sum(w.get(b, 0.0) for b in own) + sum(a * b for a, b in zip(v, shape))
            below = [0.0] + [1 / (1 + math.exp(index - x)) for x in t] + [1.0]
            total -= math.log(below[g + 1] - below[g])
        return total / len(rows) + ordinal.RIDGE / 2 * sum(x * x for x in p[: len(used) + 8])

    here = loss(params)
    for k in range(len(params)):
        for step in (0.05, -0.05):
            assert loss(params[:k] + [params[k] + step] + params[k + 1 :]) > here - 1e-6
        up, down = (loss(params[:k] + [params[k] + e] + params[k + 1 :]) for e in (1e-4, -1e-4))
        assert abs(up - down) / 2e-4 < 2e-3, k


def test_no_model_keeps_all(spark):
    docs = spark.createDataFrame([(1, None, 5.0), (2, "text", 5.0)], "doc_id long, text string, grade double")
    labels = spark.createDataFrame([(1, 1, 0), (None, 0, 0), (2, None, 1)], "doc_id long, quality int, toxic int")
    assert ordinal.train(docs, labels) is None
    assert ordinal.train(docs, labels.limit(0)) is None
    rows = ordinal.scored(docs, None).collect()
    assert [(r.row.doc_id, r.grade, r.kept) for r in rows] == [(1, None, True), (2, None, True)]


def test_rows(spark, graded):
    model = ordinal.fit([x[:3] for x in graded])
    texts = [None, "", "x" * 100000, "word " * 20000] + [graded[0][3]] * 2
    docs = spark.createDataFrame([(k, t, 5.0) for k, t in enumerate(texts)], "doc_id long, text string, grade double")
    rows = {r.row.doc_id: r for r in ordinal.scored(docs, model).collect()}
    for k, t in enumerate(texts):
        tails = model.tails(model.index(t))
        assert math.isclose(rows[k].p_top, tails[1]) and math.isclose(rows[k].grade, sum(tails))
    assert ordinal.scored(docs.limit(0), model).collect() == []


def test_query_covers_all_documents(spark, sf_dir):
    rows = QUERIES["op5_quality_classifier"](spark, sf_dir).collect()
    assert len(rows) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r.expected_grade <= 2 and r.kept == (r.p_top >= ordinal.KEEP_PROBABILITY) for r in rows)
