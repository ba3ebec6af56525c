"""The whole write-audit-publish run: source tests, snapshots and all layers on a branch, then main.

Nothing of a run shows on main before its last test has passed. Tests of one pass are
taken while a table is written; the others read what was written, on the branch.
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from stockweave.operators import changes, quality
from stockweave.operators.quality import OBSERVED_KINDS, DataTest
from stockweave.plans.registry import LAYERS, MODELS, Models, run_layer
from stockweave.session import at_once, lean_disk, sized_slices
from stockweave.sources.publish import AuditFailed, Lakehouse


log = logging.getLogger(__name__)

# The layer of the type-2 histories.
SNAPSHOT_LAYER = "snapshots"


@dataclass(frozen=True)
class Snapshot:
    """A type-2 history of a landing table; a change in one of ``check`` opens a new row."""

    name: str
    source: str
    key: str
    check: tuple[str, ...]


SNAPSHOTS = (
    Snapshot("snp_customers", "customers", "customer_id", ("city", "zip", "age_group", "acquisition_channel")),
    Snapshot("snp_products", "products", "product_id", ("product_name", "category", "segment", "price", "cogs")),
)


def check_sources(tests: Sequence[DataTest], source: Callable[[str], DataFrame], as_of: Column) -> None:
    """Raise if an error-severity test of a source fails: no layer is built then. Warnings are logged.

    All outcomes are collected: a filter on the status would let Catalyst leave out
    the tests that can only warn.
    """
    if not tests:
        return
    results = quality.audit(tests, source, as_of).collect()
    for row in results:
        if row["status"] == "warn":
            log.warning("%s: %s found %s rows", row["table_name"], row["test_name"], row["failures"])
    failed = ", ".join(sorted(r["test_name"] for r in results if r["status"] == "fail"))
    if failed:
        raise AuditFailed(f"sources: {failed}")


def take_snapshot(lake: Lakehouse, snapshot: Snapshot, source: Callable[[str], DataFrame], as_of: Column) -> None:
    """Fold the source as it is into its history; the first snapshot takes it whole."""
    history, rows = lake.read(SNAPSHOT_LAYER, snapshot.name), source(snapshot.source)
    if history is None:
        rows = changes.scd2_open(rows, snapshot.key, as_of)
    else:
        rows = changes.scd2_apply(history, rows, snapshot.key, snapshot.check, as_of)
    lake.publish(rows, SNAPSHOT_LAYER, snapshot.name)


def run_chain(
    lake: Lakehouse,
    branch: str,
    source: Callable[[str], DataFrame],
    source_tests: Sequence[DataTest],
    tests: Sequence[DataTest],
    as_of: Column,
    layers: Sequence[str] = LAYERS,
    snapshots: Sequence[Snapshot] = SNAPSHOTS,
) -> list[str]:
    """Build, test and publish all models of ``layers``; returns their names.

    ``source`` gives the landing tables. The sources are tested, then their histories
    advanced, then every model reads what was written on the branch before it. If a
    test fails the branch goes and main is as it was.
    """
    with lean_disk(lake.spark):
        check_sources(source_tests, source, as_of)
        return _built(lake, branch, source, tests, as_of, layers, snapshots)


def _built(
    lake: Lakehouse,
    branch: str,
    source: Callable[[str], DataFrame],
    tests: Sequence[DataTest],
    as_of: Column,
    layers: Sequence[str],
    snapshots: Sequence[Snapshot],
) -> list[str]:
    """The part of ``run_chain`` after the source tests."""
    dev = lake.create_branch(branch)

    def written(name: str) -> DataFrame | None:
        return dev.read(MODELS[name].layer, name)

    def write(name: str, df: DataFrame) -> None:
        own = [t for t in tests if t.table == name]
        later = [t for t in own if t.kind not in OBSERVED_KINDS]

        def audit(stored: DataFrame) -> DataFrame:
            def ref(table: str) -> DataFrame:
                return stored if table == name else written(table)

            return quality.audit(later, ref, as_of)

        observed = [t for t in own if t.kind in OBSERVED_KINDS]
        dev.publish(
            df, MODELS[name].layer, name, audit if later else None, tests=observed, as_of=as_of
        )

    def helpers(name: str) -> list[str]:
        return [t.helper for t in tests if t.table == name and t.helper]

    models = Models(lake.spark, source, written, sized_slices())
    names: list[str] = []
    # Histories are dated to the second; the same text names their rows.
    now = as_of.cast("timestamp_ntz").cast("string")
    try:
        at_once(lambda s: take_snapshot(dev, s, source, now), snapshots)
        for layer in layers:
            names += run_layer(models, layer, write, also_after=helpers)
        lake.merge_branch(branch)
    finally:
        lake.drop_branch(branch)
    return names
