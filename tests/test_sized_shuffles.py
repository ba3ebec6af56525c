"""Shuffles start with partitions by the size of the given tables."""

import pytest

from stockweave import catalog, session

KEY = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture(autouse=True)
def plain(spark):
    session.prepare(spark)
    yield
    spark.conf.unset(KEY)
    session.prepare(spark)


def test_partitions_follow_the_input(spark, sf_dir, monkeypatch):
    catalog.ready(spark, sf_dir)
    assert spark.conf.get(KEY, None) is None  # small tables: as many as the caller set
    few = session.file_bytes(spark, f"{sf_dir}/orders.parquet")
    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", few // 8)
    catalog.ready(spark, sf_dir)
    assert int(spark.conf.get(KEY)) > 16
    session.prepare(spark)
    assert spark.conf.get(KEY, None) is None


def test_number_of_the_caller_stands(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(session, "INPUT_BYTES_PER_PARTITION", 100)
    spark.conf.set(KEY, "7")
    catalog.ready(spark, sf_dir)
    assert spark.conf.get(KEY) == "7"
    session.prepare(spark)
    assert spark.conf.get(KEY) == "7"
