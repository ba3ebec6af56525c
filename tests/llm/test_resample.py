import math
import random
import zlib
from collections import Counter
from hashlib import sha256
import re

import numpy as np
from pyspark.sql import functions as F

from stockweave.llm import resample
from stockweave.llm.catalog import QUERIES


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def bucket(word, n=10000):
    return zlib.crc32(word.encode()) % n


def plain(docs, target, percent=10, least=20):
    """(doc_id, n_features, weight, score, rank) by plain sums."""
    s, t = Counter(), Counter()
    for found, rows in ((s, [x for _, x in docs]), (t, target)):
        for x in rows:
            found.update(map(bucket, words(x)))
    all_s, all_t = sum(s.values()) + 10000.0, sum(t.values()) + 10000.0

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * all_s / ((s[b] + 1.0) * all_t)))

    rows = []
    for i, x in docs:
        own = words(x)
        weight = sum(gain(bucket(w)) for w in own)
        score = None
        if i is not None:
            h = int(sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(own), weight, score, None])
    able = sorted((r for r in rows if r[3] is not None and r[1] >= least), key=lambda r: (-r[3], r[0], r[1]))
    for place, r in enumerate(able[: percent * len(able) // 100], 1):
        r[4] = place
    return sorted(map(tuple, rows), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_planes_give_exact_weights():
    rng = np.random.default_rng(3)
    for width in (1, 63, 64, 65, 10000):
        gains = rng.integers(-9000, 9000, width)
        sliced = resample.Gains(gains)
        for n in (0, 1, width):
            at = rng.permutation(width)[:n]
            counts = rng.integers(1, 5000, n)
            assert sliced.weight(at, counts) == int((gains[at] * counts).sum())
    assert resample.Gains(np.zeros(5, dtype=np.int64)).weight(np.array([2]), np.array([7])) == 0


def test_runs_of_words():
    assert resample.features_of([b"a", b"b", b"c"], 2) == [b"a", b"b", b"c", b"a b", b"b c"]
    assert resample.words_of("Don't ÉCOLE_3x\x00z".encode()) == [b"don", b"t", "École".encode(), b"3x", b"z"]


def test_rows(spark):
    rng = random.Random(4)
    vocabulary = [f"w{k}" for k in range(50)] + ["Été", "straße", "日本"]
    docs = [(k, " ".join(rng.choices(vocabulary, k=rng.randrange(0, 60)))) for k in range(120)]
    docs += [(500, None), (501, ""), (502, " \n"), (None, "w1 " * 30), (503, "w2 w3 " * 9000)]
    docs += [docs[3]] * 4 + [(504, "!!! ???"), (505, "w1," * 25)]
    target = ["w1 w2 w3 w1", None, "", "日本 w7"]
    ddl = "doc_id long, text string, score long, bucket int, n long"
    df = spark.createDataFrame([(i, x, 1, 2, 3) for i, x in docs], ddl)
    goal = spark.createDataFrame([(x,) for x in target], "text string")
    assert got(resample.resample(df, goal, percent=30)) == plain(docs, target, 30)
    assert resample.resample(df.limit(0), goal).collect() == []
    assert got(resample.resample(df, goal.limit(0))) == plain(docs, [])


def test_query(spark, sf_dir):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    target = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    found = QUERIES["op11_importance_resampling"](spark, sf_dir)
    assert [t for _, t in found.dtypes] == ["bigint"] * 5
    assert got(found) == plain(docs, target)
    drawn = found.where(F.col("rank").isNotNull())
    assert drawn.count() and drawn.select("rank").distinct().count() == drawn.count()
