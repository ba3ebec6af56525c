import random

import pytest

from stockweave.llm import licenses
from stockweave.llm.catalog import QUERIES
from stockweave.llm.license_texts import TEMPLATES

INDEX = licenses.build(TEMPLATES)


def found(text):
    return [(x["license"], text[x["start"] : x["end"]], x["coverage"]) for x in licenses.scan(INDEX, [text])[0]]


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_every_template_finds_itself(name):
    text = "Some words before. " + TEMPLATES[name] + " and after it the end"
    hit = found(text)
    assert [(x[0], x[2]) for x in hit if x[2] == 1.0][:1] == [(name, 1.0)]
    assert hit[0][1].split()[0] == TEMPLATES[name].split()[0]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = row[:]
        for j, y in enumerate(b):
            row[j + 1] = old[j] + 1 if x == y else max(row[j], old[j + 1])
    return row[-1]


def test_edited_text_as_full_alignment():
    rng = random.Random(3)
    words = TEMPLATES["MIT"].split()
    for _ in range(5):
        own = [w for w in words if rng.random() > 0.04]
        for _ in range(6):
            own.insert(rng.randrange(len(own)), "inserted")
        hit = licenses.scan(INDEX, ["x " * 500 + " ".join(own) + " y" * 500])[0]
        mit = [x for x in hit if x["license"] == "MIT"]
        plain = [[w for w in map(licenses.plain, p) if w] for p in (words, [w.lower() for w in own])]
        plain[0] = [w.lower() for w in plain[0]]
        assert len(mit) == 1 and mit[0]["matched_words"] == lcs(*plain)


def test_places_and_limits():
    note = TEMPLATES["MIT-notice"]
    text = f"{note}\nwords between {note} " + "all rights " * 30 + note.upper()
    assert [x[0] for x in found(text)] == ["MIT-notice"] * 3
    assert found("Released under the") == [] and found("") == []
    assert licenses.scan(INDEX, [None]) == [[]]
    with pytest.raises(ValueError):
        licenses.build({"short": "two words"})


def test_winnowing_keeps_one_run_in_every_window():
    words = TEMPLATES["BSD-3-Clause"].lower().split()
    kept = set(licenses.winnowed(words))
    assert all(kept & {i, i + 1} for i in range(len(words) - licenses.RUN))


def test_query(spark, sf_dir):
    rows = QUERIES["op4_license_scans"](spark, sf_dir).collect()
    want = set()
    for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect():
        for name, text in TEMPLATES.items():
            at = r.text.find(text)
            if len(text) < 100 and at >= 0:
                want.add((r.doc_id, name, at, at + len(text)))
    assert want and want <= {(r.doc_id, r.license, r.start, r.end) for r in rows}
    assert all(0.75 <= r.coverage <= 1 for r in rows)


def test_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, TEMPLATES["MIT"], "x"), (2, TEMPLATES["MIT"], "x")], "id long, text string, licenses string"
    )
    rows = licenses.matches(docs).collect()
    assert sorted((r.row.id, len(r.licenses), r.row.licenses) for r in rows) == [(1, 0, "x"), (2, 1, "x"), (2, 1, "x")]
    assert licenses.matches(docs.limit(0)).collect() == []


def plain_words(text):
    return [w for w in map(licenses.plain, text.lower().split()) if w]


def hit_of(name, words):
    hits = [x for x in licenses.scan(INDEX, ["x " * 30 + " ".join(words) + " y" * 30])[0]]
    return next((x for x in hits if x["license"] == name), None), hits


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_every_edit_of_one_word_is_found(name):
    """Left out, put in or changed at every place, wherever the coverage still holds."""
    words = plain_words(TEMPLATES[name])
    step = max(1, len(words) // 12)
    for k in range(0, len(words), step):
        for edited in (words[:k] + words[k + 1 :], words[:k] + ["zz"] + words[k:], words[:k] + ["zz"] + words[k + 1 :]):
            n = lcs(words, edited)
            if n < licenses.MIN_COVERAGE * len(words):
                continue
            own, hits = hit_of(name, edited)
            # a template that another one holds is listed where it is the better match
            assert own is None and hits or own["matched_words"] == n, (name, k, edited)


@pytest.mark.parametrize("name", [n for n, t in sorted(TEMPLATES.items()) if len(t.split()) >= 40])
def test_words_put_in_at_one_place_are_skipped(name):
    rng = random.Random(name)
    words = plain_words(TEMPLATES[name])
    for more in (1, 12, 13, 20, 31, 40):
        k = rng.randrange(len(words) // 4, 3 * len(words) // 4)
        own, _ = hit_of(name, words[:k] + [f"zz{i}" for i in range(more)] + words[k:])
        assert own["matched_words"] == len(words), (name, more)


def test_random_edits_as_full_alignment():
    """Up to a fifth of the words changed at random: the matches of the whole table, all templates."""
    rng = random.Random(8)
    for name, text in sorted(TEMPLATES.items()):
        words = plain_words(text)
        if len(words) < 12:
            continue
        for _ in range(3):
            edited = [w if rng.random() > 0.12 else rng.choice(["zz", "qq"]) for w in words]
            n = lcs(words, edited)
            own, hits = hit_of(name, edited)
            assert n < 0.75 * len(words) or (own is None and hits) or own["matched_words"] == n


def test_short_notices_with_other_articles():
    for text in ("Licensed under MIT License", "Released under an MIT License", "licensed under (the) MIT-License"):
        assert found(f"so {text} it is")[:1] or text.endswith("MIT-License")
    assert found("of the people under the law by the people") == []


def test_two_places_side_by_side():
    mit = TEMPLATES["MIT"]
    assert [x[0] for x in found(mit + " and " + mit)] == ["MIT", "MIT"]


def test_empty_blank_and_very_long_texts(spark):
    note, long = TEMPLATES["MIT-notice"], "of the software under the license " * 4000
    docs = spark.createDataFrame([(1, ""), (2, " \n\t "), (3, long + note), (4, None)], "id long, text string")
    got = {r.row.id: r.licenses for r in licenses.matches(docs).collect()}
    assert [len(got[k]) for k in (1, 2, 4)] == [0, 0, 0] and got[3][-1].end >= len(long) + len(note) - 1


def test_query_scans_every_text_once(spark, sf_dir):
    found = QUERIES["op4_license_scans"](spark, sf_dir)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
