"""Readers, publishing, branches, partition upserts, layer runs and streams."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from stockweave.catalog import models_over
from stockweave.operators import quality
from stockweave.operators.joins import literal_date
from stockweave.plans import marts
from stockweave.plans.registry import MODELS, Models, layer_order, run_layer
from stockweave.plans.staging import harmonise_cross_reference, harmonise_maintenance
from stockweave.sources.chain import run_chain
from stockweave.sources.facts import (
    advance_fact,
    advance_tracked_fact,
    create_fact,
    create_tracked_fact,
)
from stockweave.sources.ingest import (
    TooManyRejects,
    ingest,
    ingest_all,
    ingest_checked,
    ingest_upsert,
)
from stockweave.sources.publish import AuditFailed, Lakehouse
from stockweave.sources.readers import (
    JdbcSource,
    lower_columns,
    read_csv,
    read_csv_checked,
    read_csv_raw,
)
from stockweave.sources.tables import DAILY_LOAD, TABLES
from stockweave.streaming import funnel, windows
from stockweave.streaming.upsert import last_per_key, upsert_stream


def D(*ymd):
    return dt.datetime(*ymd)


@pytest.fixture
def lake(spark, tmp_path, request):
    env = "t_" + request.node.name.replace("[", "_").replace("]", "_").lower()
    return Lakehouse(spark, str(tmp_path / "lake"), environment=env)


def test_load_catalogue():
    assert sum(len(v) for v in DAILY_LOAD.values()) == 13
    assert TABLES["orders"].landing_name == "sales_orders"
    assert all(set(t.key) <= set(t.columns) for t in TABLES.values())


def test_csv_scan(spark, tmp_path):
    (tmp_path / "geography.csv").write_text("zip,city,region,district\n1,A,R,D\n2,,R,D\n")
    spec = TABLES["geography"]
    df = read_csv(spark, str(tmp_path / "geography.csv"), spec)
    assert [tuple(r) for r in df.collect()] == [(1, "A", "R", "D"), (2, None, "R", "D")]
    narrow = read_csv(spark, str(tmp_path / "geography.csv"), spec, ["zip"])
    assert narrow.columns == ["zip"]
    assert read_csv(spark, str(tmp_path / "missing.csv"), spec) is None


def test_repeated_header_keeps_the_first(spark, tmp_path):
    path = tmp_path / "logs.csv"
    path.write_text("LINE,SHIFT_NAME,SHIFT_NAME,SIZE_TYPE\nL1,S1,other,ST1\n")
    df = lower_columns(read_csv_raw(spark, str(path)))
    assert df.columns == ["line", "shift_name", "size_type"]
    assert tuple(df.first()) == ("L1", "S1", "ST1")


def test_quoted_header_and_empty_file(spark, tmp_path):
    path = tmp_path / "logs.csv"
    path.write_text('LINE,"A, B",LINE\nL1,x,y\n')
    df = read_csv_raw(spark, str(path))
    assert df.columns == ["LINE", "A, B"] and tuple(df.first()) == ("L1", "x")
    (tmp_path / "empty.csv").write_text("")
    assert read_csv_raw(spark, str(tmp_path / "empty.csv")).columns == []


def test_jdbc_tables_are_striped(spark, monkeypatch):
    asked = []
    source = JdbcSource("jdbc:x", "u", "p")
    monkeypatch.setattr(JdbcSource, "bounds", lambda self, *a: (1, 99))
    monkeypatch.setattr(JdbcSource, "read", lambda self, spark, *a: asked.append(a))
    source.read_table(spark, TABLES["orders"])
    source.read_table(spark, TABLES["promotions"])
    orders, promotions = TABLES["orders"], TABLES["promotions"]
    assert asked == [("orders", orders.group, "order_id", 1, 99, 64), ("promotions", promotions.group)]


def test_manufacturing_extracts(spark):
    raw = spark.createDataFrame([(" 7 ", None, "E1")], "ORDER string, DESCRIPTION string, EQUIPMENT_ID string")
    assert harmonise_maintenance(raw).first().asDict() == {
        "order_id": "7",
        "start_date": "",
        "equipment_id": "E1",
        "order_type": "",
        "description": "",
    }
    cross = spark.createDataFrame([(" E1", "L1 "), ("E2", None)], "a string, b string")
    assert [tuple(r) for r in harmonise_cross_reference(cross).collect()] == [("E1", "L1")]


def test_ingest_and_upsert(lake, spark, tmp_path):
    (tmp_path / "geography.csv").write_text("zip,city,region,district\n1,A,R,D\n2,B,R,D\n")

    def read(spec):
        return read_csv(spark, str(tmp_path / f"{spec.name}.csv"), spec)

    assert ingest_all(lake, read) == ["geography"]
    assert lake.read("landing", "master_data_geography").count() == 2
    changed = spark.createDataFrame([(2, "BB", "R", "D"), (3, "C", "R", "D")], TABLES["geography"].ddl)
    ingest_upsert(lake, TABLES["geography"], changed)
    got = lake.read("landing", "master_data_geography").orderBy("zip").collect()
    assert [r["city"] for r in got] == ["A", "BB", "C"]
    ingest(lake, TABLES["geography"], read)
    assert lake.read("landing", "master_data_geography").count() == 2


def test_failed_audit_keeps_the_published_version(lake, spark):
    def audit(df):
        test = quality.DataTest("t", "not_null", "id", severity="error")
        return quality.audit([test], lambda name: df, literal_date("2000-01-01"))

    lake.publish(spark.range(3), "marts", "t", audit)
    with pytest.raises(AuditFailed):
        lake.publish(spark.sql("select cast(null as bigint) as id"), "marts", "t", audit)
    assert lake.read("marts", "t").count() == 3


def test_branches(lake, spark):
    lake.publish(spark.range(3), "fact", "t")
    dev = lake.create_branch("dev")
    dev.publish(spark.range(5), "fact", "t")
    assert (lake.read("fact", "t").count(), dev.read("fact", "t").count()) == (3, 5)
    lake.merge_branch("dev")
    lake.drop_branch("dev")
    assert lake.read("fact", "t").count() == 5
    assert dev.read("fact", "t") is None
    with pytest.raises(ValueError):
        lake.drop_branch("main")


DDL = "k int, v string, p string"


def table_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_upsert_touches_only_its_partitions(lake, spark):
    start = spark.createDataFrame(
        [(1, "a", "1"), (2, "b", "1"), (3, "c", "2"), (4, "d", "3"), (5, "e", None), (6, "f", None)], DDL
    )
    lake.publish(start, "fact", "t", partition_by=("p",))
    path = Path(lake.version("fact", "t")["path"].removeprefix("file:"))
    before = {f for f in (path / "p=1").iterdir()}
    source = spark.createDataFrame([(4, "D", "2"), (7, "g", "x:y z'\\%"), (8, "h", None), (5, "E", "2")], DDL)
    touched = lake.upsert_partitions(source, "fact", "t", "k", "p")
    assert sorted(touched, key=str) == ["2", "3", None, "x:y z'\\%"]
    want = [
        (1, "a", "1"), (2, "b", "1"), (3, "c", "2"), (4, "D", "2"), (5, "E", "2"), (6, "f", None),
        (7, "g", "x:y z'\\%"), (8, "h", None),
    ]
    assert table_rows(lake.read("fact", "t")) == sorted(want, key=str)
    view = spark.table(f"{lake.database('fact')}.t").select("k", "v", "p")
    assert table_rows(view) == sorted(want, key=str)
    # The files of partition 1 stay as they were, partition 3 is written in place, nothing is left aside.
    assert {f for f in (path / "p=1").iterdir()} == before
    assert lake.version("fact", "t")["path"].endswith(path.name)
    assert [p.name for p in path.parent.iterdir()] == [path.name]
    lake.upsert_partitions(source, "fact", "t", "k", "p")
    assert table_rows(lake.read("fact", "t")) == sorted(want, key=str)


def test_upsert_by_partition_fails_whole(lake, spark, monkeypatch):
    lake.publish(spark.createDataFrame([(1, "a", "1"), (2, "b", None)], DDL), "fact", "t", partition_by=("p",))
    before = table_rows(lake.read("fact", "t"))
    for bad, message in (([(1, "x", "1"), (1, "y", "1")], "more than one"), ([(None, "x", "1")], "without k")):
        with pytest.raises(ValueError, match=message):
            lake.upsert_partitions(spark.createDataFrame(bad, DDL), "fact", "t", "k", "p")
    change = spark.createDataFrame([(1, "A", "2")], DDL)
    after = [(1, "A", "2"), (2, "b", None)]
    with monkeypatch.context() as crash:
        crash.setattr(DataFrameWriter, "partitionBy", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.upsert_partitions(change, "fact", "t", "k", "p")
    assert table_rows(lake.read("fact", "t")) == before
    lake.upsert_partitions(change, "fact", "t", "k", "p")
    assert table_rows(lake.read("fact", "t")) == after
    assert lake.upsert_partitions(change.limit(0), "fact", "t", "k", "p") == []


def test_an_overwrite_cut_short_is_finished(lake, spark, monkeypatch):
    """Partition 1 loses its only row; the crash leaves it there, the next upsert removes it."""
    start = [(1, "a", "1"), (2, "b", None), (3, "c", "3")]
    lake.publish(spark.createDataFrame(start, DDL), "fact", "t", partition_by=("p",))
    with monkeypatch.context() as crash:
        crash.setattr(Lakehouse, "_drop_partitions", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.upsert_partitions(spark.createDataFrame([(1, "A", "2")], DDL), "fact", "t", "k", "p")
    lake.upsert_partitions(spark.createDataFrame([(3, "C", "3")], DDL), "fact", "t", "k", "p")
    assert table_rows(lake.read("fact", "t")) == [(1, "A", "2"), (2, "b", None), (3, "C", "3")]


def test_branches_upsert_their_own_folder(lake, spark):
    lake.publish(spark.createDataFrame([(0, "a", "0"), (1, "b", "1")], DDL), "fact", "t", partition_by=("p",))
    dev = lake.create_branch("dev")
    # A partitioned table is upserted by partition by the plain call as well.
    dev.upsert(spark.createDataFrame([(0, "z", "9")], DDL), "fact", "t", "k")
    dev.upsert(spark.createDataFrame([(1, "y", "1")], DDL), "fact", "t", "k")
    assert table_rows(lake.read("fact", "t")) == [(0, "a", "0"), (1, "b", "1")]
    lake.merge_branch("dev")
    dev.upsert(spark.createDataFrame([(1, "x", "1")], DDL), "fact", "t", "k")
    assert table_rows(lake.read("fact", "t")) == [(0, "z", "9"), (1, "y", "1")]
    assert table_rows(dev.read("fact", "t")) == [(0, "z", "9"), (1, "x", "1")]


def test_older_changes_of_a_later_batch_do_not_win(lake, spark):
    ddl = "k int, v string, at int, p int"
    lake.publish(spark.createDataFrame([(1, "a", 5, 1), (2, "b", None, 1)], ddl), "fact", "t", partition_by=("p",))

    def arrive(*rows):
        lake.upsert_partitions(spark.createDataFrame(rows, ddl), "fact", "t", "k", "p", "at")
        return table_rows(lake.read("fact", "t"))

    assert arrive((1, "old", 4, 2), (2, "B", 1, 2)) == [(1, "a", 5, 1), (2, "B", 1, 2)]
    assert arrive((1, "same", 5, 3), (2, "null", None, 1)) == [(1, "same", 5, 3), (2, "B", 1, 2)]
    assert arrive((1, "x", 4, 9)) == [(1, "same", 5, 3), (2, "B", 1, 2)]


def test_fact_advances_in_place(lake, spark, sf_dir):
    models = models_over(spark, sf_dir)
    orders, items = models.ref("stg_orders"), models.ref("int_order_items_discounted")
    first = orders.where("order_date <= date'1999-06-10'")
    create_fact(lake, "sales", marts.fct_sales_orders(first, items))
    months = advance_fact(lake, "sales", marts.fct_sales_orders, orders, items)
    assert min(months).isoformat() == "1999-06-01"
    full = marts.fct_sales_orders(orders, items)
    got = lake.read("fact", "sales").select(*full.columns)
    assert got.count() == full.count()
    assert got.exceptAll(full).count() == 0


def test_a_finished_run_leaves_nothing(spark, tmp_path):
    from stockweave.session import materialize, run_scope, shared_dir

    root = Path(shared_dir(spark).removeprefix("file:"))
    before = set(root.iterdir())
    with run_scope(spark) as folder:
        df = materialize(materialize(spark.range(3)))
        assert df.count() == 3 and Path(folder).is_dir()
    with pytest.raises(RuntimeError), run_scope(spark):
        materialize(spark.range(3))
        raise RuntimeError
    assert set(root.iterdir()) == before


def test_layers_build_in_order(lake, spark, sf_dir):
    assert layer_order("dim")[0].startswith("dim_")
    inline = models_over(spark, sf_dir)
    stored = Models(
        spark, inline.ref, lambda name: lake.read(MODELS[name].layer, name)
    )
    only = ["stg_geography", "stg_customers", "stg_products"]

    def write(name, df):
        lake.publish(df, MODELS[name].layer, name)

    assert set(run_layer(stored, "staging", write, only)) == set(only)
    run_layer(stored, "dim", write, ["dim_customers", "dim_products"])
    assert lake.read("dim", "dim_customers").count() == inline.ref("dim_customers").count()


def test_stream_upsert_and_restart(lake, spark, tmp_path):
    ddl = "k int, v string, at int, p int"
    changes, checkpoint = str(tmp_path / "changes"), str(tmp_path / "ck")
    lake.publish(spark.createDataFrame([(1, "a", 0, 1), (2, "b", 0, 2)], ddl), "fact", "t", partition_by=("p",))

    def arrive(data):
        if data:
            spark.createDataFrame(data, ddl).coalesce(1).write.mode("append").parquet(changes)
        stream = spark.readStream.schema(ddl).parquet(changes)
        upsert_stream(stream, lake, "fact", "t", "k", "p", checkpoint, "at").awaitTermination()
        return table_rows(lake.read("fact", "t").select("k", "v", "p"))

    assert arrive([(2, "x", 1, 2), (2, "B", 2, 2)]) == [(1, "a", 1), (2, "B", 2)]
    after = arrive([(2, "BB", 3, 3), (3, "C", 3, None)])
    assert after == [(1, "a", 1), (2, "BB", 3), (3, "C", None)]
    assert arrive([]) == after  # a restart without new files


def test_late_events_count(lake, spark, tmp_path):
    ddl = "ts timestamp_ntz, event_type string"
    path, checkpoint = str(tmp_path / "events"), str(tmp_path / "ck")

    def arrive(*days):
        rows = [(D(2024, 1, day), "view") for day in days]
        spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(ddl).parquet(path)
        funnel.funnel_stream(funnel.daily_counts(stream), lake, checkpoint).awaitTermination()

    arrive(10, 10)
    arrive(11)
    arrive(5, 10)
    got = sorted(map(tuple, funnel.current_counts(lake).collect()))
    assert [(r[0].day, r[1], r[2]) for r in got] == [(5, "view", 1), (10, "view", 3), (11, "view", 1)]


def test_last_change_per_key(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, v string, at int")
    got = sorted((r["k"], r["v"]) for r in last_per_key(df, "k", "at").collect())
    assert got == [(1, "b"), (2, "c")]


def test_models_only_use_declared_names():
    for m in MODELS.values():
        assert all(r in MODELS or r in TABLES for r in m.refs)


def test_malformed_lines_are_set_aside(lake, spark, tmp_path):
    path = tmp_path / "geography.csv"
    path.write_text("zip,city,region,district\n1,A,R,D\nx,B,R,D\n3,C\n4,D,R,D,more\n5,,R,D\n")
    spec = TABLES["geography"]
    good, bad = read_csv_checked(spark, str(path), spec)
    assert sorted(r["zip"] for r in good.collect()) == [1, 5]
    assert sorted(r["line"] for r in bad.collect()) == ["3,C", "4,D,R,D,more", "x,B,R,D"]
    assert {r["source_file"] for r in bad.collect()} == {"geography.csv"}
    ingest_checked(lake, spec, str(path), most=0.9)
    assert lake.read("landing", spec.landing_name).count() == 2
    path.write_text("zip,city,region,district\n7,A,R,D\nx,B,R,D\n")
    with pytest.raises(TooManyRejects):
        ingest_checked(lake, spec, str(path), most=0.2)
    assert lake.read("landing", spec.landing_name).count() == 2
    assert lake.read("landing", f"{spec.landing_name}_rejects").count() == 1


def test_observed_tests_take_no_scan(lake, spark, monkeypatch):
    ddl = "k int, v double, d date"
    rows = [(1, 1.0, dt.date(2000, 1, 1)), (None, 9.0, dt.date(2000, 1, 5)), (3, None, None)]
    df = spark.createDataFrame(rows, ddl)
    as_of = literal_date("2000-01-10")

    def found(kind, column, **more):
        test = quality.DataTest("t", kind, column, severity="error", **more)
        _, counted = lake.stage(df, "marts", "x", (), [quality.observed_failures(test, as_of)])
        by_scan = quality.audit([test], lambda _: df, as_of).first()["failures"]
        assert counted == [by_scan]
        return by_scan

    assert found("not_null", "k") == 1 and found("not_null", "k", where="v > 5") == 1
    assert found("range", "v", least=2, most=8) == 2 and found("range", "v", most=10) == 0
    assert found("freshness", "d", max_age_days=5) == 0 and found("freshness", "d", max_age_days=4) == 1
    assert found("max_update", "d", lookback_days=5) == 0 and found("max_update", "d", lookback_days=4) == 1
    with pytest.raises(ValueError):
        quality.observed_failures(quality.DataTest("t", "unique", "k"))
    # the written folder is not read before the pointer moves
    monkeypatch.setattr(Lakehouse, "read", lambda *a: None)
    monkeypatch.setattr(quality, "audit", lambda *a: 1 / 0)
    tests = [quality.DataTest("t", "not_null", "k", severity="error", threshold=1)]
    lake.publish(df, "marts", "t", tests=tests, partition_by=("d",))
    before = lake.location("marts", "t")
    with pytest.raises(AuditFailed, match="not_null_t_k found 1"):
        lake.publish(df, "marts", "t", tests=[quality.DataTest("t", "not_null", "k", severity="error")])
    assert lake.location("marts", "t") == before


def test_late_changes_of_old_orders(lake, spark):
    orders = spark.createDataFrame(
        [(1, "a", None, dt.date(2000, 1, 1)), (2, "b", "", dt.date(2000, 2, 1)), (3, None, "a", dt.date(2000, 3, 1))],
        "order_id int, x string, y string, order_date date",
    )
    items = spark.createDataFrame([(1, "p", 1), (1, "q", 2), (2, "p", 1)], "order_id int, sku string, n int")

    def build(orders, items):
        totals = items.groupBy("order_id").agg(F.sum("n").alias("n"))
        return orders.join(totals, "order_id", "left")

    create_tracked_fact(lake, "f", build, orders, items)
    assert advance_tracked_fact(lake, "f", build, orders, items) == []
    # the same rows in another order change nothing; values that swap columns do
    assert advance_tracked_fact(lake, "f", build, orders, items.orderBy(F.desc("sku"))) == []
    swapped = orders.withColumns({"x": F.when(F.col("order_id") == 3, F.col("y")).otherwise(F.col("x")),
                                  "y": F.when(F.col("order_id") == 3, F.lit(None)).otherwise(F.col("y"))})
    assert [m.month for m in advance_tracked_fact(lake, "f", build, swapped, items)] == [3]
    # a repeated item, and an item that goes
    again = items.unionByName(items.where("sku = 'q'"))
    assert [m.month for m in advance_tracked_fact(lake, "f", build, swapped, again)] == [1]
    assert [m.month for m in advance_tracked_fact(lake, "f", build, swapped, again.where("order_id = 1"))] == [2]
    got = {r["order_id"]: (r["x"], r["y"], r["n"]) for r in lake.read("fact", "f").collect()}
    assert got == {1: ("a", None, 5), 2: ("b", "", None), 3: ("a", None, None)}


def test_late_rows_are_counted_beside_closed_windows(spark, tmp_path):
    ddl = "ts timestamp_ntz, event_type string"
    root = str(tmp_path / "w")

    def arrive(*times):
        rows = [(t, "view") for t in times]
        if rows:
            spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(ddl).parquet(f"{root}/in")
        windows.split_stream(stream, root, f"{root}/ck1").awaitTermination()
        windows.count_stream(spark, root, f"{root}/ck2").awaitTermination()
        found = windows.closed_counts(spark, root).collect()
        return sorted((r.traffic_date and r.traffic_date.day, r.sessions, r.late_sessions) for r in found)

    assert arrive(D(2024, 1, 1), D(2024, 1, 2)) == []
    # the first day closes with the second one over, and what comes for it then is late
    assert arrive(D(2024, 1, 3), D(2024, 1, 1, 5)) == [(1, 2, 0)]
    assert arrive(D(2024, 1, 1, 9), D(2024, 1, 2, 9)) == [(1, 3, 1)]
    assert arrive() == [(1, 3, 1)]
    assert arrive(D(2024, 1, 6)) == [(1, 3, 1), (2, 2, 0), (3, 1, 0)]
    assert (tmp_path / "w" / "passed" / "batch=0" / "_SUCCESS").exists()


def test_a_failed_chain_leaves_main_as_it_was(lake, spark, sf_dir):
    inline, as_of = models_over(spark, sf_dir), literal_date("2000-01-01")
    lake.publish(spark.range(2), "staging", "stg_geography")
    bad = quality.DataTest("stg_geography", "range", "zip", severity="error", most=0)
    with pytest.raises(AuditFailed, match="stg_geography"):
        run_chain(lake, "run", inline.ref, [], [bad], as_of, ["staging"])
    assert lake.read("staging", "stg_geography").count() == 2
    assert not spark.catalog.databaseExists(lake.on_branch("run").database("staging"))
    source = quality.DataTest("orders", "not_null", "order_status", severity="error", threshold=-1)
    with pytest.raises(AuditFailed, match="sources: not_null_orders_order_status"):
        run_chain(lake, "run", inline.ref, [source], [], as_of, ["staging"])
    unique = quality.DataTest("stg_geography", "unique", "zip", severity="error")
    names = run_chain(lake, "run", inline.ref, [], [unique], as_of, ["staging"])
    assert len(names) == 13 and lake.read("staging", "stg_geography").count() == inline.ref("stg_geography").count()


def test_an_ordered_batch_is_written_once(spark, tmp_path, monkeypatch):
    from stockweave.operators import changes
    from stockweave.sources import publish

    ddl, cuts = "k long, v string, at int, p int", []
    for module in (changes, publish):
        real = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, real=real: cuts.append(df.columns) or real(df))
    lake = Lakehouse(spark, str(tmp_path / "lake"), environment="t_once")
    lake.publish(spark.createDataFrame([(1, "a", 5, 1), (2, "b", None, 1)], ddl), "fact", "t", partition_by=("p",))
    batch = [(1, "old", 4, 2), (2, "new", 1, 2), (3, "c", 1, 3)]
    lake.upsert_partitions(spark.createDataFrame(batch, ddl), "fact", "t", "k", "p", "at", reduced=True)
    assert len(cuts) == 1
    got = sorted(tuple(r[c] for c in ("k", "v", "p")) for r in lake.read("fact", "t").collect())
    assert got == [(1, "a", 1), (2, "new", 2), (3, "c", 3)]
    with pytest.raises(ValueError, match="without k"):
        lake.upsert_partitions(spark.createDataFrame([(None, "x", 9, 9)], ddl), "fact", "t", "k", "p", "at", reduced=True)


def test_late_orders_meet_in_buckets(spark, sf_dir, monkeypatch):
    from stockweave import catalog
    from stockweave.operators import changes

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans, real = [], changes.source_digests

        def spied(*sources):
            digests = real(*sources)
            plans.append(digests._jdf.queryExecution().executedPlan().toString())
            return digests

        from stockweave.sources import facts

        monkeypatch.setattr(facts, "source_digests", spied)
        catalog.QUERIES["incremental_late_orders"](spark, sf_dir)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(plans) == 2 and not any("Exchange" in p for p in plans)


def test_tables_load_side_by_side(spark, tmp_path):
    import threading

    from stockweave.sources.ingest import ingest_all
    from stockweave.sources.tables import TABLES

    both = threading.Barrier(2, timeout=20)

    def read(spec):
        both.wait()  # broken unless two loads run at a time
        if spec.name == "orders":
            return None
        return spark.createDataFrame([], spec.schema)

    lake = Lakehouse(spark, str(tmp_path / "lake"), environment="t_loads")
    assert ingest_all(lake, read, ["customers", "orders"]) == ["customers"]
    assert lake.read("landing", TABLES["customers"].landing_name).count() == 0


def test_models_that_read_none_of_each_other_are_written_side_by_side(spark, sf_dir):
    import threading

    both, seen = threading.Barrier(2, timeout=20), []

    def write(name, df):
        if not also_after:
            both.wait()  # broken unless two writes run at a time
        seen.append(name)

    also_after, only = {}, ["stg_orders", "stg_products"]
    assert set(run_layer(models_over(spark, sf_dir), "staging", write, only)) == set(only)
    first, second = [n for n in layer_order("staging") if n in only]
    also_after, seen = {second: [first]}, []
    run_layer(models_over(spark, sf_dir), "staging", write, only, lambda n: also_after.get(n, ()))
    assert seen == [first, second]
