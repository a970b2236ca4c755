"""Column expression builders.

Each function maps one or more ``Column`` (or column names) to a ``Column``.  They
are the null and error semantics of the package in one place:

* malformed input becomes null (``try_cast`` / ``try_to_date``), never an error,
  so a single bad row cannot fail a job over the whole table;
* percentages are computed from integer counts and rounded half-up exactly, so
  every engine that follows the same integer formula gives the same value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from loanframe import rules

ColumnOrName = Column | str


def as_column(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def named(name: str) -> Column:
    """The column called ``name`` exactly (dots or spaces in raw headers are part of
    the name, not a field path)."""
    return F.col("`" + name.replace("`", "``") + "`")


def first_int(c: ColumnOrName) -> Column:
    """First run of digits as an int; null when there is none or it overflows."""
    digits = F.regexp_extract(as_column(c), r"(\d+)", 1)
    return F.nullif(digits, F.lit("")).try_cast("int")


def month_year_date(
    c: ColumnOrName,
    pattern: str = rules.DATE_PATTERN,
    fmt: str = rules.DATE_FORMAT,
) -> Column:
    """Space-trimmed ``Mon-YYYY`` text to the first day of that month.

    Text that fails ``pattern`` or names no month (``Foo-2015``) becomes null.
    """
    trimmed = F.trim(as_column(c))
    return F.when(trimmed.rlike(pattern), F.try_to_date(trimmed, fmt))


def safe_double(c: ColumnOrName) -> Column:
    """Text to double; malformed text becomes null."""
    return as_column(c).try_cast("double")


def threshold_bucket(
    c: ColumnOrName,
    bounds: Sequence[float] = rules.DTI_BOUNDS,
    labels: Sequence[str] = rules.DTI_LABELS,
    null_label: str = rules.DTI_UNKNOWN,
) -> Column:
    """Label by ascending upper bounds: ``x < bounds[i]`` gets ``labels[i]``.

    A value equal to a bound goes to the next bucket; values at or above the last
    bound (and NaN, which sorts above every number) get ``labels[-1]``.
    """
    if len(labels) != len(bounds) + 1:
        raise ValueError("threshold_bucket: need exactly one more label than bounds")
    if list(bounds) != sorted(bounds):
        raise ValueError("threshold_bucket: bounds must be ascending")
    x = as_column(c)
    expr = F.when(x.isNull(), F.lit(null_label))
    for bound, label in zip(bounds, labels):
        expr = expr.when(x < F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(labels[-1]))


def positive_flag(c: ColumnOrName) -> Column:
    """Three-valued flag: null when the text is no number, else ``number > 0``."""
    return safe_double(c) > F.lit(0)


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def half_up_pct(n: ColumnOrName, total: ColumnOrName) -> Column:
    """``round(n / total * 100, 2)`` rounded half-up on the exact ratio.

    Uses integer arithmetic, ``(n*20000 + total) div (2*total) / 100``, so the value
    is the correctly rounded percentage for ``n >= 0`` (no double rounding error).
    Null when ``total`` is 0 or null.  Exact for counts up to about 4.6e14 (the
    ``n * 20000`` term stays within bigint); 100 TB of loan rows is about 1e12.
    """
    n_, t_ = as_column(n).cast("bigint"), as_column(total).cast("bigint")
    hundredths = _div(n_ * F.lit(20000) + t_, t_ * F.lit(2))
    return F.when(t_ > 0, hundredths / F.lit(100))


def signed_half_up_pct(n: ColumnOrName, total: ColumnOrName) -> Column:
    """:func:`half_up_pct` for a signed numerator: rounds ``|n|``, keeps the sign."""
    n_ = as_column(n).cast("bigint")
    magnitude = half_up_pct(F.abs(n_), total)
    return F.when(n_ < 0, -magnitude).otherwise(magnitude)
