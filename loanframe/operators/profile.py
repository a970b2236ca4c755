"""Profiles used to choose cleaning rules.

Shape rules:

* wide counts (fill rates, dataset profile) are one ``agg`` over the input that
  returns one row, turned into long rows by ``inline`` on that single row;
* shares divide by a total that is a scalar subquery over the already grouped
  rows, never by a window over all groups (which would pull every group into one
  task);
* top values per column are ranked over range partitions (:func:`ranked`), so a column
  of any number of values, with any ``k``, is spread over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanframe import rules
from loanframe.functions import half_up_pct, named
from loanframe.operators.clean import require_columns
from loanframe.operators.ranking import ranked


def status_profile(df: DataFrame, column: str = "loan_status") -> DataFrame:
    """Loans per status (null included) with their share in %, by count desc (A4)."""
    grouped = df.groupBy(column).agg(F.count(F.lit(1)).alias("count"))
    total = grouped.agg(F.sum("count")).scalar()
    return (
        grouped.withColumn("__total", total)
        .select(column, "count", half_up_pct("count", "__total").alias("pct"))
        .orderBy(F.desc("count"), F.asc_nulls_first(column))
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column`` with ``row_count``, most frequent first (A5)."""
    return (
        df.groupBy(column)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .orderBy(F.desc("row_count"), F.asc_nulls_first(column))
    )


def _value_groups(df: DataFrame, columns: Sequence[str], caller: str) -> DataFrame:
    columns = list(dict.fromkeys(columns))
    require_columns(df, columns, caller)
    narrow = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = narrow.unpivot([], list(columns), "column", "value")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("row_count"))


def value_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every value of each column, as ``(column, value, row_count)``, by column and
    then most frequent first (A6).  The order is a range-partitioned sort, so a column
    with very many values is spread over tasks."""
    return _value_groups(df, columns, "value_profile").orderBy(
        "column", F.desc("row_count"), F.asc_nulls_first("value")
    )


def top_values(df: DataFrame, columns: Sequence[str], k: int) -> DataFrame:
    """The ``k`` most frequent values of each column, as ``(column, value, row_count,
    rank)``, ties broken by value, nulls first, and what they leave out:
    ``other_values`` and ``other_rows`` are the column's values and rows beyond them
    (A6).  :func:`value_profile` has all values."""
    grouped = _value_groups(df, columns, "top_values")
    # All values are ranked over ranges, in many tasks, whatever k is.
    order = [F.desc("row_count"), F.asc_nulls_first("value")]
    grouped = ranked(grouped, order, ["column"])
    top = grouped.filter(F.col("rank") <= k)
    # One row a column on either side: the join adds no shuffle of values.
    whole = grouped.groupBy("column").agg(
        F.count(F.lit(1)).alias("__values"), F.sum("row_count").alias("__rows")
    )
    shown = top.groupBy("column").agg(
        F.count(F.lit(1)).alias("__shown"), F.sum("row_count").alias("__shown_rows")
    )
    left = whole.join(shown, "column").select(
        "column",
        (F.col("__values") - F.col("__shown")).alias("other_values"),
        (F.col("__rows") - F.col("__shown_rows")).alias("other_rows"),
    )
    return top.join(left, "column").select(
        "column", "value", "row_count", F.col("rank").cast("int").alias("rank"), "other_values", "other_rows"
    )


def _fill_structs(columns: Sequence[str], block_of: Mapping[str, str] | None):
    structs = []
    for i, c in enumerate(columns):
        fields = []
        if block_of is not None:
            fields.append(F.lit(block_of[c]).alias("block"))
        fields += [
            F.lit(c).alias("column"),
            F.col("__total").alias("total_rows"),
            F.col(f"__nn{i}").alias("non_null_count"),
        ]
        structs.append(F.struct(*fields))
    return F.inline(F.array(*structs))


def _fill_rates(
    df: DataFrame, columns: Sequence[str], block_of: Mapping[str, str] | None
) -> DataFrame:
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[F.count(named(c)).alias(f"__nn{i}") for i, c in enumerate(columns)],
    )
    long = counts.select(_fill_structs(columns, block_of))
    key = ["block", "column"] if block_of is not None else ["column"]
    return long.select(
        *key,
        "total_rows",
        "non_null_count",
        (F.col("total_rows") - F.col("non_null_count")).alias("null_count"),
        F.when(
            F.col("total_rows") > 0, F.col("non_null_count") / F.col("total_rows")
        )
        .otherwise(F.lit(0.0))
        .alias("fill_rate"),
    ).orderBy(F.desc("fill_rate"), *[F.asc(k) for k in key])


def fill_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per column: total, non-null and null counts and ``fill_rate`` (0.0 on no
    rows), by fill rate desc; one scan for all columns (A7)."""
    columns = list(dict.fromkeys(columns))
    require_columns(df, columns, "fill_rates")
    return _fill_rates(df, columns, None)


def sparse_block_fill(
    df: DataFrame, blocks: Mapping[str, Sequence[str]] = rules.SPARSE_BLOCKS
) -> DataFrame:
    """:func:`fill_rates` over every column of every sparse block, with the block
    name (A8)."""
    block_of = {c: b for b, cols in blocks.items() for c in cols}
    columns = list(block_of)
    require_columns(df, columns, "sparse_block_fill")
    return _fill_rates(df, columns, block_of)


def dataset_profile(df: DataFrame) -> DataFrame:
    """``(ordinal, column, data_type, rows, non_null)`` for every column in one
    scan (S2)."""
    fields = df.schema.fields
    counts = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count(named(f.name)).alias(f"__nn{i}") for i, f in enumerate(fields)],
    )
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("ordinal"),
                        F.lit(f.name).alias("column"),
                        F.lit(f.dataType.simpleString()).alias("data_type"),
                        F.col("__rows").alias("rows"),
                        F.col(f"__nn{i}").alias("non_null"),
                    )
                    for i, f in enumerate(fields)
                ]
            )
        )
    )


def sample_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """A display sample of ``n`` rows."""
    return df.limit(n)
