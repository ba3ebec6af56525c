"""Landing loads: full refresh, keyed upsert, and the batch entry point."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

from stockweave.session import at_once, prepare
from stockweave.sources.publish import Lakehouse
from stockweave.sources.readers import JdbcSource, conform, read_csv, read_csv_checked
from stockweave.sources.tables import DAILY_LOAD, TABLES, TableSpec

log = logging.getLogger(__name__)

LANDING = "landing"


def ingest(
    lake: Lakehouse, spec: TableSpec, read: Callable[[TableSpec], DataFrame | None]
) -> DataFrame | None:
    """Full refresh of one landing table; a source that is missing is skipped."""
    df = read(spec)
    if df is None:
        return None
    return lake.publish(conform(df, spec), LANDING, spec.landing_name)


class TooManyRejects(RuntimeError):
    """More lines of a file were malformed than the load allows."""


def ingest_checked(lake: Lakehouse, spec: TableSpec, path: str, most: float = 0.05) -> DataFrame:
    """Full refresh from a CSV that may have malformed lines.

    Malformed lines go to ``<table>_rejects`` beside the landing table. If their
    share is above ``most`` only the rejects are published, and the landing table
    stays as it was.
    """
    rows, rejects = read_csv_checked(lake.spark, path, spec)
    n_rejects, n_rows = rejects.count(), rows.count()
    lake.publish(rejects, LANDING, f"{spec.landing_name}_rejects")
    if n_rejects > most * (n_rows + n_rejects):
        raise TooManyRejects(f"{spec.name}: {n_rejects} of {n_rows + n_rejects} lines")
    return lake.publish(conform(rows, spec), LANDING, spec.landing_name)


def ingest_upsert(lake: Lakehouse, spec: TableSpec, changes: DataFrame) -> DataFrame:
    """Merge changed rows into a landing table by its declared key."""
    if len(spec.key) != 1:
        raise ValueError(f"{spec.name} has no single-column key")
    return lake.upsert(conform(changes, spec), LANDING, spec.landing_name, spec.key[0])


def ingest_all(
    lake: Lakehouse,
    read: Callable[[TableSpec], DataFrame | None],
    names: Iterable[str] | None = None,
) -> list[str]:
    """The daily load: every table of every source group, or those of ``names``.

    Tables do not depend on each other; one that fails keeps no other from loading,
    and its error is raised when all are done.
    """
    names = [n for group in DAILY_LOAD.values() for n in group] if names is None else list(names)
    loaded = at_once(lambda name: ingest(lake, TABLES[name], read) is not None, names)
    return [name for name, there in zip(names, loaded) if there]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Load landing tables.")
    parser.add_argument("--root", required=True, help="storage root of the tables")
    parser.add_argument("--environment", default="", help="prefix of the databases")
    parser.add_argument("--schema", help="source group; all when unset")
    parser.add_argument("--table", help="one table; all of the group when unset")
    parser.add_argument("--csv-dir", help="folder with <table>.csv files")
    parser.add_argument("--jdbc-url")
    parser.add_argument("--jdbc-user", default="")
    parser.add_argument("--jdbc-password", default="")
    args = parser.parse_args(argv)
    spark = prepare(SparkSession.builder.appName("landing-load").getOrCreate())
    lake = Lakehouse(spark, args.root, environment=args.environment)
    if args.csv_dir:

        def read(spec: TableSpec):
            return read_csv(spark, f"{args.csv_dir}/{spec.name}.csv", spec)

    elif args.jdbc_url:
        source = JdbcSource(args.jdbc_url, args.jdbc_user, args.jdbc_password)

        def read(spec: TableSpec):
            return source.read_table(spark, spec)

    else:
        parser.error("name a source: --csv-dir or --jdbc-url")
    groups = [args.schema] if args.schema else list(DAILY_LOAD)
    names = [args.table] if args.table else [name for group in groups for name in DAILY_LOAD[group]]
    ingest_all(lake, read, names)


if __name__ == "__main__":
    main()
