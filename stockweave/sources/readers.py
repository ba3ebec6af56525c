"""Readers behind one interface: CSV, Parquet and JDBC, all with declared schemas."""

from __future__ import annotations

import logging
import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockweave.session import materialize
from stockweave.sources.tables import TableSpec

log = logging.getLogger(__name__)


def read_csv(
    spark: SparkSession, path: str, spec: TableSpec, columns: Sequence[str] | None = None
) -> DataFrame | None:
    """Scan a headed CSV with the declared types; a missing file is logged, not raised.

    ``columns`` narrows the scan: the CSV source parses only what is selected.
    """
    try:
        df = spark.read.csv(
            path, header=True, schema=spec.schema, enforceSchema=False, mode="FAILFAST"
        )
    except AnalysisException as err:
        if err.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no file at %s, table %s not loaded", path, spec.name)
        return None
    return df.select(*columns) if columns else df


# Where the permissive reader puts a line it cannot parse, and the file the line is from.
CORRUPT = "_corrupt_record"
SOURCE_FILE = "_source_file"


def read_csv_checked(spark: SparkSession, path: str, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of a headed CSV: lines that do not fit the declared types are set aside.

    A line with a value of another type, or with too many or too few values, is a
    reject: (source_file, line). The file is parsed once, with all columns, and
    the parsed rows are written down, so both frames tell of the same parse.
    """
    schema = T.StructType([*spec.schema.fields, T.StructField(CORRUPT, T.StringType())])
    parsed = spark.read.csv(
        path, header=True, schema=schema, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT
    )
    stored = materialize(parsed.select("*", F.col("_metadata.file_name").alias(SOURCE_FILE)))
    good = stored.where(F.col(CORRUPT).isNull()).drop(CORRUPT, SOURCE_FILE)
    bad = stored.where(F.col(CORRUPT).isNotNull())
    return good, bad.select(F.col(SOURCE_FILE).alias("source_file"), F.col(CORRUPT).alias("line"))


def read_csv_raw(spark: SparkSession, path: str) -> DataFrame:
    """Scan a headed CSV as strings. Repeated headers keep the first of each.

    Spark names repeated headers by position (``SHIFT_NAME4``); the later copies
    go together with their values, so the other columns keep their meaning.
    """
    df = spark.read.csv(path, header=True, inferSchema=False)
    # The reader itself splits the header line, quoted commas included.
    head = spark.read.csv(path, header=False, inferSchema=False).first()
    if head is None:
        return df
    seen: set[str] = set()
    keep = []
    for position, name in enumerate((n or "").strip() for n in head):
        if name not in seen:
            seen.add(name)
            keep.append((position, name))
    # The unsplit names are unique, so a positional rename is unambiguous.
    unique = df.toDF(*[f"_c{i}" for i in range(len(df.columns))])
    return unique.select(*[F.col(f"_c{i}").alias(name) for i, name in keep])


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


@dataclass(frozen=True)
class JdbcSource:
    """A relational source read in parallel stripes of a numeric or date column."""

    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"

    def _properties(self) -> dict[str, str]:
        return {"user": self.user, "password": self.password, "driver": self.driver}

    def read(
        self,
        spark: SparkSession,
        table: str,
        schema: str = "public",
        stripe_column: str | None = None,
        lower: object = None,
        upper: object = None,
        stripes: int = 64,
    ) -> DataFrame:
        """Without a stripe column the whole table comes through one connection."""
        name = f"{schema}.{table}"
        if stripe_column is None:
            return spark.read.jdbc(self.url, name, properties=self._properties())
        return spark.read.jdbc(
            self.url,
            name,
            column=stripe_column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=stripes,
            properties=self._properties(),
        )

    def bounds(self, spark: SparkSession, table: str, schema: str, column: str) -> tuple:
        """Least and greatest value of a column, asked of the database."""
        query = f"(select min({column}) as lo, max({column}) as hi from {schema}.{table}) as b"
        row = spark.read.jdbc(self.url, query, properties=self._properties()).first()
        return row["lo"], row["hi"]

    def read_table(self, spark: SparkSession, spec: TableSpec, stripes: int = 64) -> DataFrame:
        """A declared table, in stripes of its stripe column where it has one and rows."""
        if spec.stripe_column is None:
            return self.read(spark, spec.name, spec.group)
        lower, upper = self.bounds(spark, spec.name, spec.group, spec.stripe_column)
        if lower is None:
            return self.read(spark, spec.name, spec.group)
        return self.read(
            spark, spec.name, spec.group, spec.stripe_column, lower, upper, stripes
        )

    def write(self, df: DataFrame, table: str, schema: str = "public", mode: str = "overwrite"):
        df.write.jdbc(self.url, f"{schema}.{table}", mode=mode, properties=self._properties())


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Select and cast the declared columns, in the declared order."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema])


def lower_columns(df: DataFrame) -> DataFrame:
    """Lower-case header names, as the manufacturing extracts need."""
    return df.toDF(*[re.sub(r"\s+", "_", c.strip()).lower() for c in df.columns])


def string_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])
