"""Data tests. Each returns a small frame; ``audit`` folds many into one table.

Every test pre-aggregates by the tested key before anything is shuffled or
joined, so a key repeated a billion times costs one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockweave.functions.exprs import exact_sum, month_of


def not_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with NULL per column, all columns in one pass: (column_name, failures)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("failures")) for c in columns]
    )
    return counts.select(F.explode(pairs).alias("p")).select("p.*")


def duplicated_values(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, NULL aside: (value, n_rows)."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def orphan_count(
    main: DataFrame,
    join_key: str,
    helper: DataFrame,
    helper_key: str | None = None,
    check_column: str | None = None,
    where: Column | None = None,
    helper_where: Column | None = None,
) -> DataFrame:
    """Rows of ``main`` whose helper row is missing or has NULL in ``check_column``.

    Counts what a left join would show, repeated helper keys included, from
    per-key counts of both sides: (null_count).
    """
    helper_key = helper_key or join_key
    check_column = check_column or helper_key
    main = main if where is None else main.where(where)
    helper = helper if helper_where is None else helper.where(helper_where)
    keys = main.groupBy(F.col(join_key).alias("_k")).agg(F.count("*").alias("_n"))
    offers = (
        helper.where(F.col(helper_key).isNotNull())
        .groupBy(F.col(helper_key).alias("_k"))
        .agg(F.sum(F.col(check_column).isNull().cast("bigint")).alias("_nulls"))
    )
    lost = F.col("_n") * F.coalesce(F.col("_nulls"), F.lit(1))
    return keys.join(offers, "_k", "left").agg(
        F.coalesce(F.sum(lost), F.lit(0)).cast("bigint").alias("null_count")
    )


def month_start(as_of: Column, lookback_months: int) -> Column:
    return F.trunc(F.add_months(as_of, -lookback_months), "MM")


def as_date(column: str) -> Column:
    """The first ten characters as a date: takes dates, timestamps and text."""
    return F.substring(F.col(column).cast("string"), 1, 10).cast("date")


def monthly_duplicates(
    df: DataFrame,
    date_field: str,
    code_field: str,
    as_of: Column,
    lookback_months: int = 3,
    date_is_string: bool = False,
) -> DataFrame:
    """Months of the look-back in which a code repeats: (month, issue_type, issue_count)."""
    when = as_date(date_field) if date_is_string else F.col(date_field)
    surplus = F.count(code_field) - F.countDistinct(code_field)
    return (
        df.where(when >= month_start(as_of, lookback_months))
        .groupBy(month_of(as_date(date_field)).alias("month"))
        .agg(surplus.alias("issue_count"))
        .where(F.col("issue_count") != 0)
        .select("month", F.lit("DUPLICATE_ORDER_CODE").alias("issue_type"), "issue_count")
    )


def stale_since(
    df: DataFrame,
    date_field: str,
    as_of: Column,
    lookback_months: int = 3,
    lookback_days: int | None = None,
    date_is_string: bool = False,
) -> DataFrame:
    """One row when the newest date of the look-back is older than the cutoff."""
    start = month_start(as_of, lookback_months)
    cutoff = start if lookback_days is None else F.date_sub(as_of, lookback_days)
    when = as_date(date_field) if date_is_string else F.col(date_field)
    return (
        df.where(when >= start)
        .agg(F.max(as_date(date_field)).alias("max_date"))
        .where(F.col("max_date") < cutoff)
        .select(
            "max_date",
            F.lit("MAX_UPDATE_TOO_OLD").alias("issue_type"),
            F.datediff(as_of, F.col("max_date")).alias("days_since_last_update"),
        )
    )


def freshness(df: DataFrame, ts_field: str, as_of: Column, warn_days: int, error_days: int):
    """Age of the newest row against two limits: (max_date, age_days, status)."""
    newest = df.agg(F.max(F.col(ts_field).cast("date")).alias("max_date"))
    age = F.datediff(as_of, F.col("max_date"))
    return newest.select(
        "max_date",
        age.alias("age_days"),
        F.when(age.isNull() | (age > error_days), F.lit("error"))
        .when(age > warn_days, F.lit("warn"))
        .otherwise(F.lit("pass"))
        .alias("status"),
    )


def mass_check(
    df: DataFrame, group: str, probability: str = "probability", tolerance: float = 1e-4
):
    """Groups and whether their probabilities sum to one: (group, total, ok)."""
    total = exact_sum(probability, 12)
    return (
        df.groupBy(group)
        .agg(F.round(total, 8).alias("total_probability"))
        .withColumn(
            "is_valid", (F.abs(F.col("total_probability") - 1.0) <= tolerance + 1e-5).cast("int")
        )
    )


@dataclass(frozen=True)
class DataTest:
    """A declared data test; ``severity`` decides what a failure is called.

    A test fails when its failures exceed ``threshold``. ``where`` and
    ``helper_where`` are SQL filters of the two sides. Kinds:

    * ``unique``, ``not_null``: values that repeat, rows without one
    * ``orphans``: rows whose ``helper`` row is missing or lacks ``check_column``
    * ``monthly_duplicates``: months of the look-back in which a code repeats
    * ``max_update``: 1 if the newest date of the look-back is older than
      ``lookback_days``
    * ``freshness``: 1 if the newest date is older than ``max_age_days``, or there is none
    * ``mass``: groups whose probabilities do not sum to one
    * ``range``: rows whose value lies outside ``least`` to ``most``; NULL does not
    """

    table: str
    kind: str
    column: str
    severity: str = "warn"
    helper: str | None = None
    date_field: str | None = None
    lookback_months: int = 3
    helper_key: str | None = None
    check_column: str | None = None
    where: str | None = None
    helper_where: str | None = None
    threshold: int = 0
    lookback_days: int | None = None
    max_age_days: int = 0
    least: float | None = None
    most: float | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{self.column}" + ("_filtered" if self.where else "")


def _outcome(test: DataTest, failures: Column) -> Column:
    bad = F.lit("fail" if test.severity == "error" else "warn")
    return F.struct(
        F.lit(test.name).alias("test_name"),
        F.lit(test.table).alias("table_name"),
        F.lit(test.severity).alias("severity"),
        failures.cast("bigint").alias("failures"),
        F.when(failures > test.threshold, bad).otherwise(F.lit("pass")).alias("status"),
    )


def _result(test: DataTest, counted: DataFrame) -> DataFrame:
    return counted.select(_outcome(test, F.col("failures")).alias("o")).select("o.*")


def _key_counts(df: DataFrame, key: str) -> DataFrame:
    """Values that repeat and rows without one, from one group-by: (repeated, missing)."""
    n = F.col("n")
    return (
        df.groupBy(F.col(key).alias("k"))
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.count_if(F.col("k").isNotNull() & (n > 1)).alias("repeated"),
            F.coalesce(F.sum(F.when(F.col("k").isNull(), n)), F.lit(0)).alias("missing"),
        )
    )


# Kinds one pass over the rows can tell, so that they can be taken while a table is written.
OBSERVED_KINDS = ("not_null", "range", "freshness", "max_update")


def observed_failures(test: DataTest, as_of: Column | None = None) -> Column:
    """The failures of a test as one aggregate over the table, for ``Dataset.observe``."""
    c = F.col(test.column)
    inside = F.lit(True) if test.where is None else F.coalesce(F.expr(test.where), F.lit(False))
    if test.kind == "not_null":
        return F.count_if(inside & c.isNull())
    if test.kind == "range":
        return F.count_if(inside & F.coalesce(_outside(test), F.lit(False)))
    newest = F.max(F.when(inside, c).cast("date"))
    if test.kind == "freshness":
        return F.when(F.date_diff(as_of, newest) <= test.max_age_days, 0).otherwise(1)
    if test.kind == "max_update":
        # A look-back without rows has no newest date and does not fail, as in ``stale_since``.
        start = month_start(as_of, test.lookback_months)
        days = test.lookback_days
        cutoff = start if days is None else F.date_sub(as_of, days)
        newest = F.max(F.when(inside & (c >= start), c).cast("date"))
        return F.when(newest < cutoff, 1).otherwise(0)
    raise ValueError(f"a {test.kind} test cannot be taken from one pass of the rows")


def outcomes_of(tests: Sequence[DataTest], failures: Sequence[int]) -> list[dict]:
    """The rows ``audit`` would give for counted failures."""
    rows = []
    for test, n in zip(tests, failures):
        bad = "fail" if test.severity == "error" else "warn"
        status = bad if n > test.threshold else "pass"
        rows.append(
            {
                "test_name": test.name,
                "table_name": test.table,
                "severity": test.severity,
                "failures": n,
                "status": status,
            }
        )
    return rows


def _outside(test: DataTest) -> Column:
    wrong = F.lit(False)
    if test.least is not None:
        wrong = wrong | (F.col(test.column) < test.least)
    return wrong if test.most is None else wrong | (F.col(test.column) > test.most)


def _single(test: DataTest, ref, as_of: Column) -> DataFrame:
    """(failures) of a test that shares its scan with no other."""
    df = ref(test.table)
    n_rows = F.count(F.lit(1)).alias("failures")
    if test.where is not None:
        df = df.where(test.where)
    if test.kind == "orphans":
        helper = ref(test.helper)
        if test.helper_where is not None:
            helper = helper.where(test.helper_where)
        counted = orphan_count(df, test.column, helper, test.helper_key, test.check_column)
        return counted.withColumnRenamed("null_count", "failures")
    if test.kind == "monthly_duplicates":
        months = monthly_duplicates(df, test.date_field, test.column, as_of, test.lookback_months)
        return months.agg(n_rows)
    if test.kind == "max_update":
        stale = stale_since(df, test.column, as_of, test.lookback_months, test.lookback_days)
        return stale.agg(n_rows)
    if test.kind == "freshness":
        age = freshness(df, test.column, as_of, test.max_age_days, test.max_age_days)
        return age.select((F.col("status") != "pass").cast("int").alias("failures"))
    if test.kind == "range":
        return df.where(_outside(test)).agg(n_rows)
    if test.kind == "mass":
        return mass_check(df, test.column).agg(F.count_if(F.col("is_valid") == 0).alias("failures"))
    raise ValueError(f"unknown test kind {test.kind}")


def audit(tests: Sequence[DataTest], ref, as_of: Column) -> DataFrame:
    """Run declared tests: one row per test with its failures and status.

    ``ref`` resolves a table name to a frame. Unique and not-null tests of one
    key share a group-by; the other not-null tests of a table share one scan.
    """
    results = []
    keyed: dict[tuple, list[DataTest]] = {}
    for test in tests:
        if test.kind in ("unique", "not_null"):
            keyed.setdefault((test.table, test.where, test.column), []).append(test)
        else:
            results.append(_result(test, _single(test, ref, as_of)))
    scans: dict[tuple, list[DataTest]] = {}
    for (table, where, column), group in keyed.items():
        if all(t.kind == "not_null" for t in group):
            scans.setdefault((table, where), []).extend(group)
            continue
        df = ref(table) if where is None else ref(table).where(where)
        found = {"unique": F.col("repeated"), "not_null": F.col("missing")}
        outcomes = F.array(*[_outcome(t, found[t.kind]) for t in group])
        counts = _key_counts(df, column)
        results.append(counts.select(F.explode(outcomes).alias("o")).select("o.*"))
    for (table, where), group in scans.items():
        df = ref(table) if where is None else ref(table).where(where)
        counts = df.agg(*[F.count_if(F.col(t.column).isNull()).alias(t.column) for t in group])
        outcomes = F.array(*[_outcome(t, F.col(t.column)) for t in group])
        results.append(counts.select(F.explode(outcomes).alias("o")).select("o.*"))
    return reduce(DataFrame.unionByName, results)


def status_tally(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count("*").alias("n_tests"))


def first_per_status(results: DataFrame, fails: int = 3, warns: int = 5) -> DataFrame:
    """The first failures and warnings a notice lists, by test name.

    Declared tests are counted in tens, so one window per status is small.
    """
    place = F.row_number().over(Window.partitionBy("status").orderBy("test_name"))
    wanted = F.when(F.col("status") == "fail", fails).when(F.col("status") == "warn", warns)
    return results.withColumn("place", place).where(F.col("place") <= wanted)
