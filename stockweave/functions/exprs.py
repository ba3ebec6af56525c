"""Column expressions with one fixed meaning on every engine and partitioning.

Sums of money go through DECIMAL, so the result does not depend on the order
in which tasks finish; ratios are snapped to ten digits before half-up
rounding, so binary noise cannot flip a digit.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY_DIGITS = 4
MONEY = "decimal(18,4)"


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fixed(c: str | Column, digits: int = MONEY_DIGITS) -> Column:
    """A DOUBLE as a whole number of its last kept digit, half up.

    A direct cast from DOUBLE to DECIMAL goes through the number's text form
    and costs more than the rest of an aggregate; this stays in arithmetic.
    """
    return F.floor(col(c) * float(10**digits) + 0.5).cast("decimal(18,0)")


def unfixed(total: Column, digits: int = MONEY_DIGITS) -> Column:
    """A sum of ``fixed`` numbers back in units, still DECIMAL."""
    return total * F.lit(Decimal(1).scaleb(-digits))


def exact_sum(c: str | Column, digits: int = MONEY_DIGITS) -> Column:
    """Order-independent sum of a DOUBLE column, as DOUBLE."""
    return unfixed(F.sum(fixed(c, digits)), digits).cast("double")


def round_half_up(c: Column, digits: int) -> Column:
    return F.round(c.cast("decimal(28,10)"), digits).cast("double")


def safe_div(num: Column, den: Column) -> Column:
    """``num / den`` as DOUBLE; NULL where the denominator is zero."""
    return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))


def pct(num: Column, den: Column, digits: int = 2) -> Column:
    return round_half_up(safe_div(num, den) * 100.0, digits)


def days_from(start: str | Column, end: str | Column) -> Column:
    return F.datediff(col(end), col(start))


def month_of(d: str | Column) -> Column:
    return F.trunc(col(d), "MM")


def iso_weekday(d: str | Column) -> Column:
    """1 = Monday ... 7 = Sunday."""
    return F.weekday(col(d)) + 1


def at_least_zero(c: Column) -> Column:
    """``greatest(c, 0)`` that keeps NULL as NULL."""
    return F.when(c < 0, F.lit(0).cast("double")).otherwise(c)


def sample_std(n: Column, total: Column, squares: Column) -> Column:
    """Sample standard deviation from exact integer moments; NULL below two rows."""
    numerator = n.cast("decimal(38,0)") * squares.cast("decimal(38,0)") - total.cast(
        "decimal(38,0)"
    ) * total.cast("decimal(38,0)")
    return F.when(
        n > 1,
        F.sqrt(numerator.cast("double") / (n.cast("double") * (n.cast("double") - 1.0))),
    )
