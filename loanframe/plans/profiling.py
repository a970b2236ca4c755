"""Profiling pipeline (P3): the shared cleaning, labelling and features, without
the misaligned-row filter, then the values of chosen columns with their counts, so
rare values are visible before rules are chosen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from loanframe import rules
from loanframe.operators.clean import clean_raw
from loanframe.operators.features import add_features, label_target
from loanframe.operators.profile import top_values, value_profile


def profiled_loans(
    raw: DataFrame,
    date_columns: Sequence[str] = rules.DATE_COLUMNS,
    numeric_sparse: Sequence[str] = rules.SPARSE_NUMERIC_COLUMNS,
    date_sparse: Sequence[str] = rules.SPARSE_DATE_COLUMNS,
) -> DataFrame:
    return (
        raw.transform(clean_raw, date_columns, numeric_sparse, date_sparse)
        .transform(label_target)
        .transform(add_features)
    )


def run_profiling(
    raw: DataFrame,
    columns: Sequence[str] = ("purpose", "addr_state"),
    k: int | None = None,
    date_columns: Sequence[str] = rules.DATE_COLUMNS,
    numeric_sparse: Sequence[str] = rules.SPARSE_NUMERIC_COLUMNS,
    date_sparse: Sequence[str] = rules.SPARSE_DATE_COLUMNS,
) -> DataFrame:
    """Values with counts for each of ``columns``: all of them, or with ``k`` the most
    frequent ones and the counts of what they leave out."""
    loans = profiled_loans(raw, date_columns, numeric_sparse, date_sparse)
    return value_profile(loans, columns) if k is None else top_values(loans, columns, k)
