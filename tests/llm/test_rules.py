import math
import re
from collections import Counter, defaultdict

import duckdb

from stockweave.llm import rules
from stockweave.llm.catalog import ORACLES, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    covered = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(words)
    failed = n < 20 or 100 * len(covered) > 30 * n
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


TEXTS = [
    None, "", " \n\t\x0b", "one", "   x", "a b c d e f g h", "a b c d e f g h " * 2,
    "x " * 400, "The Cat\nThe Cat\n the cat\n\n\nThe Cat", " ".join(f"w{i}" for i in range(40)) + " a b c d e f g h" * 2,
    "#*$%&|<> é😀 \r\n" * 30, "w " + " ".join(f"v{i % 97}" for i in range(20000)),
]


def rows_of(df):
    return [(r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in df.collect()]


def test_counts(spark):
    rows = [(k, t, "en" if k % 2 else None, 1) for k, t in enumerate(TEXTS)] + [(None, TEXTS[9], "xx", 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, id int")
    got = rows_of(rules.judge(docs))
    assert sorted(got, key=str) == sorted(((d, *plain(t)) for d, t, _, _ in rows), key=str)
    assert rules.judge(docs.limit(0)).collect() == []


def distance(p, q):
    def part(a, b):
        return sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b) if x)

    return math.sqrt(max(0, (part(p, q) + part(q, p)) / 2))


def classes(text):
    left, out = text, []
    for pattern in (r"[^\W\d_A-ZÀ-ÖØ-ÞŸ]+", r"[\x20\x09-\x0D]+", r"[A-ZÀ-ÖØ-ÞŸ]+", r"\d+", r"[.,;:?'\"()’-]+"):
        shorter = re.sub(pattern, "", left)
        out.append(len(left) - len(shorter))
        left = shorter
    return [*out, len(left)]


def test_distances_and_verdict(spark):
    good = ["the cat of the house and a dog in it is to be with us as that was for him on this day " + " ".join(f"name{i} other{j}" for j in range(15)) for i in range(30)]
    odd = [g.upper().replace(" ", "!! ") for g in good[:2]]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(good + odd)], "doc_id long, text string, lang string")
    got = {r.id: r for r in rules.judge(docs, max_class_distance=0.4).collect()}
    shares = {}
    for i, t in enumerate(good + odd):
        c = classes(t)
        shares[i] = [x / sum(c) for x in c]
    sound = [i for i in got if not got[i].base_failed]
    mean = [sum(shares[i][k] for i in sound) / len(sound) for k in range(6)]
    for i in got:
        assert math.isclose(got[i].class_distance, distance(shares[i], mean), abs_tol=1e-6)
    assert all(got[i].kept for i in range(30)) and not any(got[i].kept for i in (30, 31))
    short = docs.selectExpr("doc_id", "'A!! B!! C!! D!!' as text", "lang")
    assert not any(r.kept for r in rules.judge(short).collect())


def test_sql(spark, tmp_path, sf_dir):
    """The SQL gives the same rows, odd texts included."""
    odd = [(k, t, "fr" if k % 3 else None, None, None) for k, t in enumerate(TEXTS)]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.unionByName(spark.createDataFrame(odd, docs.schema)).coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    df = QUERIES["op10_quality_rules"](spark, str(tmp_path))
    want = con.execute(f"select {', '.join(df.columns)} from ({ORACLES['op10_quality_rules']})").fetchall()
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(map(str, want))


def test_query(spark, sf_dir):
    df = QUERIES["op10_quality_rules"](spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = df.collect()
    assert len(rows) == len(texts)
    verdict = Counter()
    for r in rows:
        want = plain(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.kept and r.base_failed)
        if not r.base_failed:
            verdict[labels.get(r.doc_id), r.kept] += 1
    assert verdict[1, False] == 0
