"""The corpus pipeline: each stage works on what the one before it kept.

All stages but the last return the columns they were given, whatever those are called.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockweave.llm import decontaminate, ordinal, packing, secret_spans, simhash
from stockweave.llm.common import ready, table
from stockweave.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of the best grade is too small go.

    NULL counts as an empty text, which goes; a NULL id decides nothing. Equal texts
    share their fate, repeated rows stay repeated. Without labels of two grades
    every document stays. Empty in, empty out.
    """
    model = ordinal.train(docs, table(spark, sf_dir, "labels"))
    return ordinal.scored(docs, model).where("kept").select("row.*")


def simhash_neardup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays: that of the least id.

    NULL and blank texts are one component. Of rows with the same id and text one
    stays; a component whose ids are all NULL keeps one row. Very long texts are
    fingerprinted whole. Empty in, empty out.
    """
    ready(spark)
    return simhash.one_per_group(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage that leaks a test item go.

    NULL and blank texts leak nothing and stay, as does everything if there are no
    items. Each row is judged by itself: repeated rows share their fate.
    """
    found = decontaminate.matches(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("hits") == 0).select("row.*")


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts; no document goes. ``n_chars`` follows the text.

    NULL texts stay NULL and keep their ``n_chars``, blank ones are left as they
    are. Overlapping secrets get one mask. Repeated rows stay repeated.
    """
    ready(spark)
    clean = secret_spans.redact(docs)
    length = F.char_length("text").cast(dict(docs.dtypes)["n_chars"])
    return clean.withColumn("n_chars", F.coalesce(length, F.col("n_chars")))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per bin with the documents packed in it.

    Every row is packed, NULL ids and texts as well: a text without bytes takes one
    place. A document longer than a bin is in several. Equal sizes go by a hash of
    id and text, repeated rows are copies and never share a bin, nor do blank
    texts, which are copies of each other. Empty in, empty out.
    """
    ready(spark)
    return packing.bins_of(packing.pack(docs))


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_neardup", simhash_neardup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

# The classifier is trained and fingerprints need XXH64, so SQL cannot state the
# rows; tests compare the stages with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
