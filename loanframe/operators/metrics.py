"""Bad-rate aggregates.

Every aggregate is a hash aggregate with a map-side partial step, so a hot key (one
grade holding a third of the loans) is pre-combined in each task before the
shuffle; the shuffle carries one row per (task, group), not per loan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanframe import rules

RATIO_COLUMNS = ("dimension", "dimension_value", "default_count", "total_count", "npl_ratio")
CURVE_COLUMNS = ("vintage_year", "loan_age_months", "default_count", "total_count", "npl_ratio")


def _counts(target: str):
    return (
        F.sum(target).cast("bigint").alias("default_count"),
        F.count(F.lit(1)).alias("total_count"),
    )


def _ratio():
    return F.col("default_count") / F.col("total_count")


def _bad_rates(long: DataFrame) -> DataFrame:
    """Counts and ratio of rows ``(__target, dimension, dimension_value)``."""
    return (
        long.groupBy("dimension", "dimension_value")
        .agg(*_counts("__target"))
        .select(*RATIO_COLUMNS[:-1], _ratio().alias("npl_ratio"))
    )


def npl_ratio(df: DataFrame, dimension: str, target: str = "is_default") -> DataFrame:
    """Bad rate per value of one dimension; null is its own group (A1).

    ``dimension_value`` keeps the dimension's type.
    """
    return _bad_rates(
        df.select(
            F.col(target).alias("__target"),
            F.lit(dimension).alias("dimension"),
            F.col(dimension).alias("dimension_value"),
        )
    )


def npl_ratio_by_dimensions(
    df: DataFrame,
    dimensions: Sequence[str] = rules.NPL_DIMENSIONS,
    target: str = "is_default",
) -> DataFrame:
    """Bad rate per value of each dimension, long format (A2).

    One scan and one shuffle for all dimensions: the needed columns are projected
    and cast to string, ``unpivot`` turns each loan into one row per dimension (an
    ``Expand`` directly feeding the partial aggregate), and a single
    ``groupBy(dimension, dimension_value)`` produces every group.  Nulls stay rows.
    """
    dimensions = list(dict.fromkeys(dimensions))
    narrow = df.select(
        F.col(target).alias("__target"),
        *[F.col(d).cast("string").alias(d) for d in dimensions],
    )
    long = narrow.unpivot(["__target"], dimensions, "dimension", "dimension_value")
    return _bad_rates(long)


def default_rate_curve(
    df: DataFrame,
    vintage: str = "vintage_year",
    age: str = "loan_age_months",
    target: str = "is_default",
) -> DataFrame:
    """Bad rate per (vintage, whole months of age); ages are floored (A3).

    Not cumulative: a loan counts once, in the month cell of its final age.  A null
    age is kept as its own cell.
    """
    return (
        df.groupBy(
            F.col(vintage).alias("vintage_year"),
            F.floor(age).alias("loan_age_months"),
        )
        .agg(*_counts(target))
        .select(*CURVE_COLUMNS[:-1], _ratio().alias("npl_ratio"))
    )


def label_distribution(df: DataFrame, target: str = "is_default") -> DataFrame:
    """Loans per label value, ordered by the label."""
    return (
        df.groupBy(target)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.asc_nulls_first(target))
    )
