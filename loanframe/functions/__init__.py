"""Column expressions shared by the operators.  All are built-in Spark expressions,
so they stay inside whole-stage code generation."""

from loanframe.functions.columns import (
    as_column,
    first_int,
    half_up_pct,
    month_year_date,
    named,
    positive_flag,
    safe_double,
    signed_half_up_pct,
    threshold_bucket,
)

__all__ = [
    "as_column",
    "first_int",
    "half_up_pct",
    "month_year_date",
    "named",
    "positive_flag",
    "safe_double",
    "signed_half_up_pct",
    "threshold_bucket",
]
