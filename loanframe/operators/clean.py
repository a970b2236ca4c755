"""Cleaning: drop, parse and filter raw loan columns.

All are narrow transformations (no shuffle).  Parsing several columns is one
``withColumns`` projection, so Catalyst sees one ``Project`` however many columns
are parsed.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanframe import rules
from loanframe.functions import first_int, month_year_date, named, safe_double


def require_columns(df: DataFrame, columns: Sequence[str], caller: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{caller} needs columns that the input lacks: {missing}")


def drop_member_id(df: DataFrame, column: str = "member_id") -> DataFrame:
    """Drop the (all-null) member id column; no-op when it is absent."""
    return df.drop(column)


def clean_term(
    df: DataFrame, source: str = "term", target: str = "term_months"
) -> DataFrame:
    """``' 36 months'`` -> int 36 in ``target``; the source column is dropped."""
    out = df.withColumn(target, first_int(source))
    return out if source == target else out.drop(source)


def clean_dates(
    df: DataFrame,
    columns: Sequence[str] = rules.DATE_COLUMNS,
    pattern: str = rules.DATE_PATTERN,
    fmt: str = rules.DATE_FORMAT,
) -> DataFrame:
    """Replace each ``Mon-YYYY`` text column by a date (first of the month).

    Raises ``ValueError`` naming the columns that are absent.
    """
    require_columns(df, columns, "clean_dates")
    return df.withColumns({c: month_year_date(c, pattern, fmt) for c in columns})


def cast_sparse_numerics(
    df: DataFrame, columns: Sequence[str] = rules.SPARSE_NUMERIC_COLUMNS
) -> DataFrame:
    """Replace each text column by a double; malformed text becomes null."""
    require_columns(df, columns, "cast_sparse_numerics")
    return df.withColumns({c: safe_double(c) for c in columns})


def clean_sparse(
    df: DataFrame,
    numeric_columns: Sequence[str] = rules.SPARSE_NUMERIC_COLUMNS,
    date_columns: Sequence[str] = rules.SPARSE_DATE_COLUMNS,
    pattern: str = rules.DATE_PATTERN,
    fmt: str = rules.DATE_FORMAT,
) -> DataFrame:
    """Numbers and dates of the sparse blocks in one projection; others untouched."""
    require_columns(df, list(numeric_columns) + list(date_columns), "clean_sparse")
    exprs = {c: safe_double(c) for c in numeric_columns}
    exprs.update({c: month_year_date(c, pattern, fmt) for c in date_columns})
    return df.withColumns(exprs)


def state_ok(column: str = "addr_state", pattern: str = rules.STATE_PATTERN):
    """Predicate of a well-aligned row: the state column matches ``pattern``."""
    return F.col(column).rlike(pattern)


def drop_shifted_rows(
    df: DataFrame, column: str = "addr_state", pattern: str = rules.STATE_PATTERN
) -> DataFrame:
    """Keep rows whose ``column`` matches ``pattern``; null and misaligned rows go."""
    return df.filter(state_ok(column, pattern))


def split_shifted_rows(
    df: DataFrame, column: str = "addr_state", pattern: str = rules.STATE_PATTERN
) -> tuple[DataFrame, DataFrame]:
    """``(kept, rejected)``: the rows :func:`drop_shifted_rows` keeps and drops."""
    ok = state_ok(column, pattern)
    return df.filter(ok), df.filter(~F.coalesce(ok, F.lit(False)))


def preview(
    df: DataFrame, columns: Sequence[str], n: int = rules.PREVIEW_ROWS
) -> DataFrame:
    """The first ``n`` rows of ``columns`` (a display limit, as in the step runs)."""
    return df.select(*columns).limit(n)


def cast_numbers(df: DataFrame, types: Mapping[str, str] = rules.NUMERIC_TYPES) -> DataFrame:
    """Give the text columns named in ``types`` their number type; malformed text becomes
    null.  Columns that are absent are skipped, so one map serves every subset."""
    present = {c: named(c).try_cast(t) for c, t in types.items() if c in df.columns}
    return df.withColumns(present) if present else df


def clean_raw(
    df: DataFrame,
    date_columns: Sequence[str] = rules.DATE_COLUMNS,
    numeric_columns: Sequence[str] = rules.SPARSE_NUMERIC_COLUMNS,
    sparse_date_columns: Sequence[str] = rules.SPARSE_DATE_COLUMNS,
    numeric_types: Mapping[str, str] = rules.NUMERIC_TYPES,
) -> DataFrame:
    """Drop member id and the reader's own columns (malformed rows, file), type the numbers, parse
    term, dates and the sparse blocks (no row filter, no inference pass)."""
    return (
        df.transform(drop_member_id)
        .drop(rules.CORRUPT_COLUMN, rules.FILE_COLUMN)
        .transform(cast_numbers, numeric_types)
        .transform(clean_term)
        .transform(clean_dates, date_columns)
        .transform(clean_sparse, numeric_columns, sparse_date_columns)
    )
