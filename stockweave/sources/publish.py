"""Write-audit-publish: tables are views over the Parquet folders of runs.

Each run writes its own folder, so a reader never sees a half-written table
and nothing is overwritten while it is read. Publishing replaces the view,
which the catalog does in one step. A table partitioned by a column is one
ordinary partitioned folder: an upsert overwrites the partitions it touches by
Spark's dynamic partition overwrite, from rows written aside first. A branch
is a second set of views: making one copies pointers, merging one moves them. A
folder belongs to one branch; another branch that upserts it writes its own.
"""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Callable, Sequence
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from stockweave.operators.changes import checked_batch, merged, moves, newer_moves
from stockweave.operators.quality import DataTest, observed_failures, outcomes_of
from stockweave.session import delete_folder, materialize, path_exists

log = logging.getLogger(__name__)

MAIN = "main"
_LOCATION = "stockweave.location"
# What Spark names the partition of NULL.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


class AuditFailed(RuntimeError):
    """An error-severity data test failed; the table was not published."""


def database_name(layer: str, branch: str = MAIN, environment: str = "") -> str:
    """Layers have one database per environment and branch."""
    name = f"{environment}_{layer}" if environment else layer
    return name if branch == MAIN else f"{name}__{branch}"


def _text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


class Lakehouse:
    """Publishes and reads tables of layer databases below one storage root."""

    def __init__(self, spark: SparkSession, root: str, branch: str = MAIN, environment: str = ""):
        self.spark = spark
        self.root = root.rstrip("/")
        self.branch = branch
        self.environment = environment

    def database(self, layer: str) -> str:
        return database_name(layer, self.branch, self.environment)

    def location(self, layer: str, table: str) -> str | None:
        """What a published table points to (see ``version``), None when there is none."""
        name = f"{self.database(layer)}.{table}"
        if not self.spark.catalog.tableExists(name):
            return None
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {name} ('{_LOCATION}')").collect()
        return rows[0]["value"]

    def version(self, layer: str, table: str) -> dict | None:
        """``schema``, ``partition`` column, ``path`` and ``owner`` branch of a published table."""
        location = self.location(layer, table)
        return None if location is None else json.loads(location)

    def read(self, layer: str, table: str) -> DataFrame | None:
        """The published rows, with the types they were published with."""
        found = self.version(layer, table)
        if found is None:
            return None
        return self.spark.read.schema(StructType.fromJson(found["schema"])).parquet(found["path"])

    def stage(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] = (),
        observed: Sequence[Column] = (),
    ) -> tuple[str, list[int]]:
        """Write a run's folder without publishing it; (path, values of ``observed``).

        ``observed`` are aggregates taken from the rows while they are written.
        """
        path = f"{self.root}/{layer}/{table}/run={uuid.uuid4().hex}"
        # One task per partition value would make a single file of a hot month;
        # rebalancing splits large partitions and merges small ones.
        df = df.hint("rebalance", *partition_by) if partition_by else df
        if not observed:
            df.write.partitionBy(*partition_by).parquet(path)
            return path, []
        # The last step before the write, so the rows of a task count once, with its commit.
        seen = Observation()
        named = [c.alias(f"m{i}") for i, c in enumerate(observed)]
        df.observe(seen, *named).write.partitionBy(*partition_by).parquet(path)
        return path, [int(seen.get[f"m{i}"] or 0) for i in range(len(observed))]

    def point(self, layer: str, table: str, location: str) -> None:
        """Make the view of a table show what ``location`` names."""
        found = json.loads(location)
        schema = StructType.fromJson(found["schema"])
        # Types are cast: partition values of a folder are read back by their looks.
        columns = ", ".join(
            f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schema
        )
        database = self.database(layer)
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {database}.{table} "
            f"TBLPROPERTIES ('{_LOCATION}' = {_text(location)}) "
            f"AS SELECT {columns} FROM parquet.`{found['path']}`"
        )

    def _location(self, schema: StructType, partition: str | None, path: str) -> str:
        # Parquet drops nullability; a stored schema says what a read gives.
        kept = StructType([type(f)(f.name, f.dataType, True) for f in schema])
        return json.dumps(
            {"schema": kept.jsonValue(), "partition": partition, "path": path, "owner": self.branch}
        )

    def publish(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        audit: Callable[[DataFrame], DataFrame] | None = None,
        partition_by: Sequence[str] = (),
        tests: Sequence[DataTest] = (),
        as_of: Column | None = None,
    ) -> DataFrame:
        """Write, test what was written, then move the pointer.

        ``tests`` are observed while the rows are written and take no scan of
        their own: kinds ``not_null``, ``range``, ``freshness`` and
        ``max_update``. ``audit`` is for all others; it maps the written frame to
        (test_name, severity, failures, status) rows. Warnings are logged; a
        failed error-severity test raises and leaves the published version as it
        was.
        """
        measures = [observed_failures(t, as_of) for t in tests]
        path, failures = self.stage(df, layer, table, partition_by, measures)
        self._judge(table, outcomes_of(tests, failures))
        if audit is not None:
            # One row per declared test: small by construction.
            self._judge(table, [r.asDict() for r in audit(self.spark.read.parquet(path)).collect()])
        column = partition_by[0] if len(partition_by) == 1 else None
        self.point(layer, table, self._location(df.schema, column, path))
        return self.read(layer, table)

    @staticmethod
    def _judge(table: str, results: Sequence[dict]) -> None:
        for row in results:
            if row["status"] == "fail":
                raise AuditFailed(f"{table}: {row['test_name']} found {row['failures']} rows")
            if row["status"] == "warn":
                log.warning("%s: %s found %s rows", table, row["test_name"], row["failures"])

    def upsert(self, source: DataFrame, layer: str, table: str, key: str) -> DataFrame:
        """Merge ``source`` into the published table as a new version.

        A table partitioned by one column goes by ``upsert_partitions``: only the
        partitions it touches are written. Others are written anew.
        """
        found = self.version(layer, table)
        if found is not None and found["partition"] is not None:
            self.upsert_partitions(source, layer, table, key, found["partition"])
            return self.read(layer, table)
        batch = checked_batch(source, key)
        current = self.read(layer, table)
        return self.publish(batch if current is None else merged(current, batch, key), layer, table)

    def upsert_partitions(
        self,
        source: DataFrame,
        layer: str,
        table: str,
        key: str,
        column: str,
        order: str | None = None,
        reduced: bool = False,
    ) -> list:
        """Upsert into a table partitioned by ``column``; only touched partitions are written.

        A row may move to another partition, so the one its old version sits in
        is touched as well. With an ``order`` column of the table, a row replaces
        its old version only if that is not newer, whatever batch it came in; a
        NULL order is older than any. Repeated and NULL keys are refused; a source
        that is ``reduced`` has one row per key by an aggregate, and is not tested for
        repeats. Returns the touched values; there are at most as many as partitions.

        The new rows of the touched partitions (NULL's included) are written
        aside, then put in place by dynamic partition overwrite. A crash before
        that leaves the table as it was; one in the middle leaves some partitions
        new, and the next upsert first puts the rest in place. One writer at a
        time; readers that start in between see the partitions done so far.
        """
        found = self.version(layer, table)
        # A reduced source goes straight into the join with the target: its aggregate has
        # brought it in place by key, and it is written once, by what the join leaves.
        direct = reduced and order is not None and found is not None
        batch = source if direct else checked_batch(source, key)
        if found is None:
            self.publish(batch, layer, table, partition_by=(column,))
            return [row[0] for row in batch.select(column).distinct().collect()]
        if found["partition"] != column:
            raise ValueError(f"{table} is not partitioned by {column}")
        self._put_in_place(found)
        target = self.read(layer, table)
        batch = batch.select(*target.columns)
        # Written once: it says which rows count, and the partitions they leave and enter.
        if order is None:
            moved = materialize(moves(target, batch.select(key, column), key, column))
        else:
            moved = materialize(newer_moves(target, batch, key, column, order))
            batch = moved.select(*target.columns)
        if direct and not moved.where(F.col(key).isNull()).isEmpty():
            raise ValueError(f"source row without {key}")
        left = moved.where("_held").select(F.col("_from").alias(column))
        values = left.unionByName(moved.select(column)).distinct()
        touched = [r[0] for r in values.collect()]
        if not touched:
            return []
        if found["owner"] != self.branch:
            self.publish(merged(target, batch, key, moved), layer, table, partition_by=(column,))
            return touched
        aside = self._aside(found)
        rows = merged(target.where(self._within(column, touched)), batch, key, moved)
        rows.write.mode("overwrite").parquet(f"{aside}/rows")
        values.coalesce(1).write.mode("overwrite").parquet(f"{aside}/touched")
        self._put_in_place(found)
        return touched

    def replace_partitions(self, source: DataFrame, layer: str, table: str, column: str) -> None:
        """Put the rows of ``source`` in place of the partitions they fall into; others stay."""
        found = self.version(layer, table)
        if found is None or found["partition"] != column:
            raise ValueError(f"{table} is not partitioned by {column}")
        self._put_in_place(found)
        source = source.select(*[f["name"] for f in found["schema"]["fields"]])
        if found["owner"] != self.branch:
            fresh = materialize(source)
            known = fresh.select(column).distinct()
            same = F.col(f"t.{column}").eqNullSafe(F.col(f"k.{column}"))
            rest = self.read(layer, table).alias("t").join(known.alias("k"), same, "left_anti")
            self.publish(rest.unionByName(fresh), layer, table, partition_by=(column,))
            return
        aside = self._aside(found)
        source.write.mode("overwrite").parquet(f"{aside}/rows")
        written = self.spark.read.schema(source.schema).parquet(f"{aside}/rows")
        written.select(column).distinct().coalesce(1).write.mode("overwrite").parquet(f"{aside}/touched")
        self._put_in_place(found)

    @staticmethod
    def _aside(found: dict) -> str:
        return f"{found['path']}-aside"

    def _put_in_place(self, found: dict) -> None:
        """Overwrite the partitions written aside, if any; a second time changes nothing."""
        aside, column = self._aside(found), found["partition"]
        if not path_exists(self.spark, f"{aside}/touched/_SUCCESS"):
            return
        schema = StructType.fromJson(found["schema"])
        rows = self.spark.read.schema(schema).parquet(f"{aside}/rows")
        # Partition values are few, and their names are what the folders are named by.
        name = F.coalesce(F.col(column).cast("string"), F.lit(_NULL_PARTITION))
        touched = self.spark.read.schema(StructType([schema[column]])).parquet(f"{aside}/touched")
        names = touched.select(name.alias("name")).distinct()
        emptied = names.join(rows.select(name.alias("name")).distinct(), "name", "left_anti")
        (
            rows.hint("rebalance", column)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(column)
            .parquet(found["path"])
        )
        self._drop_partitions(found["path"], column, {r["name"] for r in emptied.collect()})
        self.spark.catalog.refreshByPath(found["path"])
        delete_folder(self.spark, aside)

    def _drop_partitions(self, path: str, column: str, names: set[str]) -> None:
        """Delete the partitions that have no row any more: an overwrite does not see them."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for status in files.listStatus(root) if names else ():
            name, _, value = status.getPath().getName().partition("=")
            if name == column and unquote(value) in names:
                files.delete(status.getPath(), True)

    @staticmethod
    def _within(column: str, values: Sequence) -> Column:
        known = F.coalesce(F.col(column).isin([v for v in values if v is not None]), F.lit(False))
        return known | F.col(column).isNull() if None in values else known

    # --- branches ---------------------------------------------------------

    def _layers(self) -> list[str]:
        plain = {database_name(layer, MAIN, self.environment): layer for layer in self._known()}
        return [plain[d.name] for d in self.spark.catalog.listDatabases() if d.name in plain]

    @staticmethod
    def _known() -> list[str]:
        from stockweave.plans.registry import LAYERS, MODELS

        layers = {m.layer for m in MODELS.values()} | set(LAYERS)
        return sorted(layers | {"landing", "snapshots"})

    def _tables(self, layer: str) -> list[str]:
        database = self.database(layer)
        if not self.spark.catalog.databaseExists(database):
            return []
        return [t.name for t in self.spark.catalog.listTables(database) if not t.isTemporary]

    def on_branch(self, branch: str) -> Lakehouse:
        return Lakehouse(self.spark, self.root, branch, self.environment)

    def create_branch(self, branch: str) -> Lakehouse:
        """A branch that starts with this branch's tables; no data is copied."""
        made = self.on_branch(branch)
        for layer in self._layers():
            for table in self._tables(layer):
                if made.location(layer, table) is None:
                    made.point(layer, table, self.location(layer, table))
        return made

    def merge_branch(self, branch: str) -> None:
        """Point this branch's tables at the versions of ``branch``.

        Their folders then belong to this branch.
        """
        other = self.on_branch(branch)
        for layer in self._known():
            for table in other._tables(layer):
                found = other.version(layer, table)
                schema = StructType.fromJson(found["schema"])
                location = self._location(schema, found["partition"], found["path"])
                self.point(layer, table, location)
                other.point(layer, table, location)

    def drop_branch(self, branch: str) -> None:
        if branch == MAIN:
            raise ValueError("the main branch stays")
        other = self.on_branch(branch)
        for layer in self._known():
            self.spark.sql(f"DROP DATABASE IF EXISTS {other.database(layer)} CASCADE")


def merge_into(source: DataFrame, table: str, key: str) -> None:
    """MERGE for tables whose format supports it: update matches, insert the rest."""
    (
        source.alias("s")
        .mergeInto(table, F.expr(f"{table}.{key} = s.{key}"))
        .whenMatched()
        .updateAll()
        .whenNotMatched()
        .insertAll()
        .merge()
    )
