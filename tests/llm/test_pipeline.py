"""The pipeline's stages, each against a plain statement of its decision."""

import importlib.util
import os
import sys

import pytest
from pyspark.sql import functions as F

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

import corpus_pipeline  # noqa: E402
from stockweave.llm import decontaminate, ordinal, packing, secret_spans, simhash  # noqa: E402

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_order_of_the_stages():
    assert list(STAGES) == [
        "quality_classifier", "simhash_neardup", "benchmark_decontamination", "secret_scans", "best_fit_packing",
    ]


def test_quality_stage(spark, docs, sf_dir):
    kept = by_id(STAGES["quality_classifier"](spark, docs, sf_dir))
    model = ordinal.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = by_id(docs)
    want = {d for d, r in rows.items() if model.tails(model.index(r.text))[1] >= ordinal.KEEP_PROBABILITY}
    assert set(kept) == want and all(kept[d] == rows[d] for d in kept)
    good = {r.doc_id for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect() if r.quality and not r.toxic}
    assert len(good & want) >= 0.95 * len(good)


def test_dedup_stage(spark, docs, sf_dir):
    kept = by_id(STAGES["simhash_neardup"](spark, docs, sf_dir))
    component = {r.id: r.component_id for r in simhash.components(docs).collect()}
    assert set(kept) == set(component.values()) and len(kept) < len(component)
    rows = by_id(docs)
    assert all(kept[d] == rows[d] for d in kept)


def test_decontamination_stage(spark, docs, sf_dir):
    kept = by_id(STAGES["benchmark_decontamination"](spark, docs, sf_dir))
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    index = decontaminate.build(items, decontaminate.THRESHOLD, decontaminate.OVERLAP)
    rows = by_id(docs)
    clean = {d for d, r in rows.items() if not decontaminate.search(index, [r.text])[0]}
    assert set(kept) == clean and len(clean) < len(rows) and all(kept[d] == rows[d] for d in kept)


def test_secret_stage(spark, docs, sf_dir):
    text = "é key: token = 04dbebab91ab85687d33eeaaf9ac699e1188f962, more"
    own = spark.createDataFrame([(10**6, text, "en", "s", len(text))], docs.schema)
    docs = docs.unionByName(own)
    kept = by_id(STAGES["secret_scans"](spark, docs, sf_dir))
    found = secret_spans.find(docs, carry=["doc_id"]).select("row.doc_id", "all_spans")
    spans = {r.doc_id: r.all_spans for r in found.collect()}
    rows = by_id(docs)
    assert set(kept) == set(rows) and kept and any(spans.values())
    for d, r in rows.items():
        if spans[d]:
            secret = r.text[spans[d][0].start : spans[d][0].end]
            assert secret not in kept[d].text and "[SECRET]" in kept[d].text
            assert kept[d].n_chars == len(kept[d].text) and kept[d].source == r.source
        else:
            assert kept[d] == r


def test_whole_run_and_odd_rows(spark, docs, sf_dir, tmp_path):
    odd = spark.createDataFrame(
        [(None, None, None, None, None), (10**6, None, "en", "s", 0), (10**6, "", "xx", None, 0), (10**6 + 1, "a " * 60000, "en", "s", 120000)],
        docs.schema,
    )
    root = tmp_path / "sf"
    docs.unionByName(odd).unionByName(odd).write.parquet(str(root / "documents.parquet"))
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.parquet(str(root / f"{t}.parquet"))
    step = spark.read.parquet(str(root / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, step, str(root))
        assert out.schema.names == docs.schema.names
        step = out
    bins = corpus_pipeline.run(spark, str(root)).collect()
    packed = {d for r in bins for d in r.doc_ids}
    assert packed == {r.doc_id for r in step.collect()}
    assert all(r.used <= packing.CAPACITY for r in bins)


def test_extra_columns_with_the_names_inside(spark, docs, sf_dir):
    """Columns called as what the stages add come through all but the last as they were."""
    names = ["row", "grade", "p_top", "kept", "id", "fp", "root", "hits", "base", "all_spans", "merged", "node", "cluster", "shard", "raw", "key", "total"]
    more = docs.limit(60).select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id").cast("string")).alias(n) for n in names])
    step = more = spark.createDataFrame(more.collect(), more.schema)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, sf_dir)
        assert step.columns == more.columns
        assert all(r[n] == f"{n}-{r.doc_id}" for r in step.collect() for n in names)
    bins = corpus_pipeline.STAGES[-1][1](spark, step, sf_dir).collect()
    assert {d for r in bins for d in r.doc_ids} == {r.doc_id for r in step.collect()}


def test_empty_tables(spark, docs, sf_dir, tmp_path):
    root = tmp_path / "sf"
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(str(root / f"{t}.parquet"))
    assert corpus_pipeline.run(spark, str(root)).collect() == []


def test_registered_and_guarded(tmp_path):
    """Without the folder, or the pipeline module, the entry file still offers the rest."""
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))

    class Missing:
        def find_spec(self, name, path=None, target=None):
            if name.startswith(("stockweave.llm", "corpus_pipeline")):
                raise ModuleNotFoundError(f"No module named {name!r}", name=name)

    hidden = {k: sys.modules.pop(k) for k in list(sys.modules) if k.startswith(("stockweave.llm", "corpus_pipeline"))}
    import stockweave

    attribute = stockweave.__dict__.pop("llm", None)
    finder = Missing()
    sys.meta_path.insert(0, finder)
    try:
        spec = importlib.util.spec_from_file_location("entry_without", os.path.join(ROOT, "__spark_entry__.py"))
        module = importlib.util.module_from_spec(spec)
        spec.loader.exec_module(module)
        assert not any(n.startswith("op") and n[2].isdigit() or n == "pipeline" for n in module.queries())
        assert len(module.oracle_sql()) >= 80
    finally:
        sys.meta_path.remove(finder)
        sys.modules.update(hidden)
        if attribute is not None:
            stockweave.llm = attribute
