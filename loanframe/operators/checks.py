"""Domain, pattern and non-empty checks.

The checks are metric DataFrames first; the raising wrappers read their single
aggregated row.  Both category checks are one aggregate, so the data is scanned
once (two filtered counts would scan it twice).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe import rules


def category_violations(
    df: DataFrame,
    domain_column: str = "purpose",
    domain: Sequence[str] = rules.PURPOSES,
    pattern_column: str = "addr_state",
    pattern: str = rules.STATE_PATTERN,
    nulls_invalid: bool = False,
) -> DataFrame:
    """One scan: rows ``(check, column, violations)`` for the domain and the pattern.

    A null value is no violation (``NOT x IN (...)`` is null for null ``x``) unless
    ``nulls_invalid`` is set.
    """
    out_of_domain = ~F.col(domain_column).isin(*domain)
    off_pattern = ~F.col(pattern_column).rlike(pattern)
    if nulls_invalid:
        out_of_domain = F.coalesce(out_of_domain, F.lit(True))
        off_pattern = F.coalesce(off_pattern, F.lit(True))
    counts = df.agg(
        F.count_if(out_of_domain).alias("domain"),
        F.count_if(off_pattern).alias("pattern"),
    )
    return counts.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("domain").alias("check"),
                    F.lit(domain_column).alias("column"),
                    F.col("domain").alias("violations"),
                ),
                F.struct(
                    F.lit("pattern").alias("check"),
                    F.lit(pattern_column).alias("column"),
                    F.col("pattern").alias("violations"),
                ),
            )
        )
    )


def validate_categoricals(
    df: DataFrame,
    domain_column: str = "purpose",
    domain: Sequence[str] = rules.PURPOSES,
    pattern_column: str = "addr_state",
    pattern: str = rules.STATE_PATTERN,
    nulls_invalid: bool = False,
) -> None:
    """Raise ``ValueError`` on any violation; the domain error is reported first."""
    found = {
        r["check"]: r["violations"]
        for r in category_violations(
            df, domain_column, domain, pattern_column, pattern, nulls_invalid
        ).collect()
    }
    raise_on_violations(
        found["domain"], found["pattern"], domain_column, domain, pattern_column, pattern
    )


def raise_on_violations(
    domain_violations: int,
    pattern_violations: int,
    domain_column: str = "purpose",
    domain: Sequence[str] = rules.PURPOSES,
    pattern_column: str = "addr_state",
    pattern: str = rules.STATE_PATTERN,
) -> None:
    """The errors of :func:`validate_categoricals` for counts computed elsewhere."""
    if domain_violations > 0:
        raise ValueError(
            f"validate_categoricals: {domain_violations} row(s) carry unexpected "
            f"{domain_column} values (not among the {len(set(domain))} known categories)"
        )
    if pattern_violations > 0:
        raise ValueError(
            f"validate_categoricals: {pattern_violations} row(s) carry {pattern_column} "
            f"values not matching {pattern}"
        )


def output_row_counts(
    spark: SparkSession, tables: Mapping[str, DataFrame | str]
) -> DataFrame:
    """Rows ``(metric, row_count)`` with ``metric = '<label>_row_count'`` (Q2).

    A table is a DataFrame or the name of a catalog table.
    """
    parts = [
        (spark.table(df) if isinstance(df, str) else df)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(f"{label}_row_count").alias("metric"), "row_count")
        for label, df in tables.items()
    ]
    if not parts:
        return spark.createDataFrame([], "metric string, row_count bigint")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def output_gate(
    spark: SparkSession, tables: Mapping[str, DataFrame | str]
) -> DataFrame:
    """:func:`output_row_counts` plus ``passed = row_count > 0`` per table (Q7)."""
    return output_row_counts(spark, tables).withColumn(
        "passed", F.col("row_count") > 0
    )


def require_non_empty(
    spark: SparkSession, tables: Mapping[str, DataFrame | str]
) -> None:
    """Raise ``ValueError`` naming every output that has no rows."""
    empty = [
        r["metric"]
        for r in output_gate(spark, tables).filter(~F.col("passed")).collect()
    ]
    if empty:
        raise ValueError(f"empty output table(s): {sorted(empty)}")
