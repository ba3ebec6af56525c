"""SimHash fingerprints of word shingles and their near-duplicate components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockweave.llm.common import picked, rows_of
from stockweave.llm.components import stars
from stockweave.llm.vptree import SEGMENTS, build_tree, spanning_links
from stockweave.session import materialize

WORDS = 4
RADIUS = 4
SEED = 42
LEAF_SIZE = 4096
# The trees are built on this many fingerprints per leaf, within these bounds.
LEAF_SAMPLE = 32
SAMPLE_ROWS = (4096, 262144)
# A leaf beyond this many words is compared in blocks that spread over tasks.
BLOCK_SIZE = 16384

_LANES = np.uint64(0x0101010101010101)


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set, bit 0 first."""
    counts = np.zeros((8, 8), dtype=np.int64)  # [byte, bit in the byte]
    for start in range(0, len(hashes), 255):  # a byte lane counts up to 255
        block = hashes[start : start + 255]
        for bit in range(8):
            lanes = ((block >> np.uint64(bit)) & _LANES).sum(dtype=np.uint64)
            counts[:, bit] += np.frombuffer(lanes.tobytes(), dtype=np.uint8)
    return counts.ravel()


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """SimHash of a UTF-8 text as a signed 64-bit number; 0 if it has no word."""
    parts = (text or b"").lower().split()  # bytes: A-Z and ASCII white space only
    if not parts:
        return 0
    line = b" ".join(parts)
    gaps = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
    starts = np.concatenate([[0], gaps + 1])
    ends = np.concatenate([gaps, [len(line)]])
    n = max(1, len(parts) - words + 1)
    last = min(words, len(parts)) - 1
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[last:].tolist())
    hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype=np.uint64)
    bits = np.packbits(2 * bit_counts(hashes) > n, bitorder="little")
    return int(np.frombuffer(bits.tobytes(), dtype=np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, body, fp) for every row; a NULL or blank text has fingerprint 0.

    ``body`` is a hash of the text, so that a row can be found again.
    """
    texts = picked(docs, id=id_col, text=text_col).select(
        "id", F.xxhash64("text").alias("body"), F.col("text").cast("binary").alias("text")
    )
    kind = dict(texts.dtypes)["id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, values in rows_of(batches):
            fps = pa.array([fingerprint(v) for v in values], type=pa.int64())
            columns = [batch.column(0), batch.column(1), fps]
            yield pa.RecordBatch.from_arrays(columns, ["id", "body", "fp"])

    return texts.mapInArrow(run, f"id {kind}, body long, fp long")


def _leaf_rows(unique: DataFrame, total: int, radius: int, leaf_size: int) -> DataFrame:
    """(leaf, fp): every fingerprint in its home leaf and the leaves it overlaps, per segment."""
    order = F.xxhash64("fp")
    rows = min(max(total * LEAF_SAMPLE // leaf_size, SAMPLE_ROWS[0]), SAMPLE_ROWS[1])
    sample = unique.select("fp").orderBy(order, "fp").limit(rows).toPandas()["fp"]
    sample = sample.to_numpy(dtype=np.int64).view(np.uint64)
    near = radius // len(SEGMENTS)
    trees = [build_tree(sample, total, leaf_size, mask, near) for mask in SEGMENTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False)
            base = 0
            for tree in trees:
                index, leaf = tree.route(fps.view(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(leaf + base), pa.array(fps[index])], ["leaf", "fp"]
                )
                base += max(1, tree.leaves)

    return unique.select("fp").mapInArrow(run, "leaf long, fp long")


def fingerprint_links(
    unique: DataFrame, radius: int = RADIUS, leaf_size: int = LEAF_SIZE, block: int = BLOCK_SIZE
) -> DataFrame:
    """(child, root): links that connect all distinct fingerprints within ``radius`` bits.

    Every pair within the radius meets in a leaf of one of the trees, where all 64
    bits decide. A leaf above ``block`` words is dealt into k parts and each of the
    k (k + 1) / 2 pairs of parts becomes a task of its own, so a hot leaf does not
    land in one. A leaf returns a spanning star per group, not its pairs.
    """
    placed = materialize(_leaf_rows(unique, unique.count(), radius, leaf_size))
    sizes = placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"))
    parts = F.ceil(F.col("n") / F.lit(block)).cast("long")
    # One row per leaf, and a leaf has eight sampled fingerprints: a bounded broadcast.
    placed = placed.join(F.broadcast(sizes.select("leaf", parts.alias("parts"))), "leaf")
    own = F.pmod(F.xxhash64("fp"), F.col("parts"))
    placed = placed.select(
        "leaf",
        "fp",
        own.alias("own"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("other"),
    ).select(
        "leaf", "fp", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high")
    )

    def run(group: pa.Table) -> pa.Table:
        words = group.column("fp").to_numpy().view(np.uint64)
        child, root = spanning_links(words, radius)
        return pa.table({"child": child.view(np.int64), "root": root.view(np.int64)})

    return placed.groupBy("leaf", "low", "high").applyInArrow(run, "child long, root long")


def components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = RADIUS,
) -> DataFrame:
    """(id, body, fp, root, component_id) for every row of ``docs``.

    Rows link when their fingerprints differ in at most ``radius`` bits;
    ``component_id`` is the smallest id reachable, ``root`` the component's own
    key. Rows with equal fingerprints are one node, so copies never make pairs.
    NULL and blank texts share fingerprint 0 and link like any other. Repeated
    rows are kept. ``component_id`` is NULL only where all ids of the component
    are. Empty in, empty out; other columns of ``docs`` play no part.
    """
    found = materialize(fingerprints(docs, id_col, text_col))
    unique = materialize(found.groupBy("fp").agg(F.min("id").alias("least")))
    linked = stars(fingerprint_links(unique, radius))
    rooted = unique.join(linked.withColumnRenamed("child", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(named, "root").select("fp", "root", "component_id")
    return found.join(labels, "fp").select("id", "body", "fp", "root", "component_id")


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of ``docs`` per component, with all its columns: the one whose id names it.

    Where several rows carry that id, the one with the least text hash stays,
    and of rows equal in id and text one. A component whose ids are all NULL
    keeps one row as well.
    """
    chosen = (
        components(docs, id_col, text_col)
        .where(F.col("id").eqNullSafe(F.col("component_id")))
        .groupBy("root", "id", "body")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("root")
        .agg(F.min(F.struct("id", "body", "n")).alias("of"))
        .groupBy(F.col("of.id").alias("_keep_id"), F.col("of.body").alias("_keep_body"))
        .agg((F.sum("of.n") > 1).alias("_many"))
    )
    marked = docs.select(F.struct("*").alias("_row"), F.xxhash64(f"`{text_col}`").alias("_body"))
    same = F.col(f"_row.`{id_col}`").eqNullSafe(F.col("_keep_id")) & (
        F.col("_body") == F.col("_keep_body")
    )
    kept = marked.join(chosen, same)
    # Whole rows are grouped only where a row is repeated.
    # Rows that differ in columns without a hash (maps) only are alike here.
    hashed = [f.name for f in docs.schema if "map<" not in f.dataType.simpleString()]
    order = F.xxhash64(*[F.col(f"_row.`{c}`") for c in hashed])
    repeated = kept.where("_many").groupBy("_keep_id", "_keep_body")
    first = repeated.agg(F.min_by("_row", order).alias("_row")).select("_row.*")
    return kept.where(~F.col("_many")).select("_row.*").unionByName(first)
