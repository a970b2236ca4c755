"""Labelling and derived features.

All narrow: one filter and projections that Catalyst collapses into the scan's
stage.  The resolved-status filter is pushed into the Parquet scan when the input
is a Parquet table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe import rules
from loanframe.functions import positive_flag, safe_double, threshold_bucket


def is_resolved(
    status: str = "loan_status", resolved: Sequence[str] = rules.RESOLVED_STATUSES
) -> Column:
    """Predicate of a resolved loan; false for a null status."""
    return F.coalesce(F.col(status).isin(*resolved), F.lit(False))


def default_label(
    status: str = "loan_status", default_status: str = rules.DEFAULT_STATUS
) -> Column:
    """1 for a default, else 0."""
    return F.when(F.col(status) == default_status, 1).otherwise(0)


def label_target(
    df: DataFrame,
    status: str = "loan_status",
    resolved: Sequence[str] = rules.RESOLVED_STATUSES,
    default_status: str = rules.DEFAULT_STATUS,
    target: str = "is_default",
) -> DataFrame:
    """Keep resolved loans; ``target`` is int 1 for a default, else 0."""
    return df.filter(F.col(status).isin(*resolved)).withColumn(
        target, default_label(status, default_status)
    )


def add_vintage_year(
    df: DataFrame, issue: str = "issue_d", target: str = "vintage_year"
) -> DataFrame:
    """Issue year as int; null issue date gives null."""
    return df.withColumn(target, F.year(issue))


def add_loan_age(
    df: DataFrame,
    issue: str = "issue_d",
    last_payment: str = "last_pymnt_d",
    target: str = "loan_age_months",
) -> DataFrame:
    """Months from issue to last payment (Spark ``months_between``), double."""
    return df.withColumn(target, F.months_between(last_payment, issue))


def add_dti_bucket(
    df: DataFrame,
    column: str = "dti",
    target: str = "dti_bucket",
    bounds: Sequence[float] = rules.DTI_BOUNDS,
    labels: Sequence[str] = rules.DTI_LABELS,
    null_label: str = rules.DTI_UNKNOWN,
) -> DataFrame:
    """Replace ``column`` by its double value and add the bucket label."""
    return df.withColumn(column, safe_double(column)).withColumn(
        target, threshold_bucket(column, bounds, labels, null_label)
    )


def add_delinquency_flag(
    df: DataFrame, column: str = "delinq_2yrs", target: str = "has_prior_delinquency"
) -> DataFrame:
    """True when ``column`` is a positive number, false for 0 or less, else null."""
    return df.withColumn(target, positive_flag(column))


def add_features(df: DataFrame) -> DataFrame:
    """Vintage, age, debt-to-income bucket and delinquency flag."""
    return (
        df.transform(add_vintage_year)
        .transform(add_loan_age)
        .transform(add_dti_bucket)
        .transform(add_delinquency_flag)
    )
