"""The whole write-audit-publish run: every source test is taken, histories are kept, no layer is left out."""

import logging

import pytest
from pyspark.sql import functions as F

from stockweave import session
from stockweave.catalog import CHAIN_LAYERS, DATA_TESTS, QUERIES, models_over, ready
from stockweave.operators import quality
from stockweave.operators.joins import literal_date
from stockweave.plans.registry import LAYERS, Models
from stockweave.sources.chain import SNAPSHOTS, check_sources, run_chain
from stockweave.sources.publish import AuditFailed, Lakehouse
from stockweave.sources.tables import TABLES

AS_OF = "2001-08-01"


@pytest.fixture
def lake(spark, tmp_path, request):
    return Lakehouse(spark, str(tmp_path / "lake"), environment="t_" + request.node.name.lower())


def test_source_tests_that_only_warn_are_taken(spark, caplog):
    tables = {
        "orders": spark.createDataFrame(
            [(1, "2001-07-01"), (1, "2001-07-02"), (2, "2001-07-03")], "order_id long, order_date string"
        ).withColumn("order_date", F.col("order_date").cast("date")),
        "order_items": spark.createDataFrame([(1,), (7,), (8,), (None,)], "order_id long"),
    }
    tests = [t for t in DATA_TESTS if t.table in tables]
    with caplog.at_level(logging.WARNING):
        check_sources(tests, tables.get, literal_date(AS_OF))
    found = {r.getMessage() for r in caplog.records}
    assert found == {
        "orders: monthly_duplicates_orders_order_id found 1 rows",
        "orders: unique_orders_order_id found 1 rows",
        "order_items: orphans_order_items_order_id found 3 rows",
        "order_items: not_null_order_items_order_id found 1 rows",
    }


def test_histories_are_kept_from_run_to_run(lake, spark, sf_dir):
    landing = models_over(spark, sf_dir)
    assert landing.ref("customers").count() > 3
    customers = landing.ref("customers").where("customer_id < 4").select(*TABLES["customers"].columns)
    twice = customers.unionByName(customers.where("customer_id = 1"))
    moved = customers.withColumn("city", F.when(F.col("customer_id") == 2, "Elsewhere").otherwise(F.col("city")))
    for day, table in (("2001-08-01", customers), ("2001-08-02", moved), ("2001-08-03", moved)):
        run_chain(
            lake, "run", lambda n, t=table: t if n == "customers" else landing.ref(n), [], [], literal_date(day), ["dim"]
        )
    got = lake.read("snapshots", "snp_customers").where("customer_id = 2").orderBy("valid_from").collect()
    assert [(str(r.valid_from), r.valid_to and str(r.valid_to), r.city) for r in got] == [
        ("2001-08-01 00:00:00", "2001-08-02 00:00:00", customers.where("customer_id = 2").first().city),
        ("2001-08-02 00:00:00", None, "Elsewhere"),
    ]
    assert lake.read("snapshots", "snp_customers").count() == customers.count() + 1
    assert lake.read("snapshots", "snp_products").count() == landing.ref("products").count()
    # a first snapshot takes repeated keys as they are; a failed run leaves the history alone
    other = Lakehouse(spark, f"{lake.root}-2", environment=f"{lake.environment}_2")
    run_chain(other, "run", lambda n: twice if n == "customers" else landing.ref(n), [], [], literal_date(AS_OF), ["dim"])
    assert other.read("snapshots", "snp_customers").count() == twice.count()
    bad = quality.DataTest("dim_products", "not_null", "product_id", severity="error", threshold=-1)
    with pytest.raises(AuditFailed, match="dim_products"):
        run_chain(lake, "run", landing.ref, [], [bad], literal_date(AS_OF), ["dim"])
    assert lake.read("snapshots", "snp_customers").count() == customers.count() + 1


def test_the_published_chain_is_whole():
    assert CHAIN_LAYERS == LAYERS and len(SNAPSHOTS) == 2


def test_files_of_a_run_take_less_disk(lake, spark, sf_dir):
    settings = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.parquet.compression.codec")
    before = [spark.conf.get(s) for s in settings]
    inside = []

    def source(name):
        inside.append([spark.conf.get(s) for s in settings])
        return models_over(spark, sf_dir).ref(name)

    run_chain(lake, "run", source, [], [], literal_date(AS_OF), ["dim"])
    assert inside and all(found == ["true", "zstd"] for found in inside)
    assert [spark.conf.get(s) for s in settings] == before
    path = lake.version("snapshots", "snp_products")["path"]
    assert all(f.endswith(".zstd.parquet") for f in spark.read.parquet(path).inputFiles())


def test_a_report_deals_items_once_by_order(spark, sf_dir):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        report = QUERIES["rpt_daily_category_sales_performance"](spark, sf_dir)
        plan = report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    # promotions, products and orders, two sides each, then the sums per group
    assert len(exchanges) == 7 and not any("category" in e and "order_id" in e for e in exchanges)


def test_a_model_built_in_slices_has_the_same_rows(spark, sf_dir):
    name = "rpt_daily_category_sales_performance"
    whole = models_over(spark, sf_dir)
    slices = Models(spark, whole.ref, slices=3).build(name)
    assert slices.schema.simpleString() == whole.build(name).schema.simpleString()
    got, expected = ([tuple(r) for r in df.collect()] for df in (slices, whole.build(name)))
    assert sorted(map(repr, got)) == sorted(map(repr, expected)) and got


def test_slices_follow_the_input(spark, sf_dir, monkeypatch):
    ready(spark, sf_dir)
    assert session.sized_slices() == 1
    monkeypatch.setattr(session, "_wanted", 6 * 256)
    assert session.sized_slices() == 12
