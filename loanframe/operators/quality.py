"""Data-quality metrics as DataFrames (Q1, Q3-Q6, Q8).

Nothing here collects: each metric is a small long-format DataFrame that can be
written, joined against a stored baseline, or unioned into one report table.

Percentages are exact half-up roundings of integer ratios (see
:func:`loanframe.functions.half_up_pct`).  Drift carries percentages as integer
hundredths so ``current - baseline`` is exact.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loanframe import rules
from loanframe.functions import half_up_pct, named, signed_half_up_pct
from loanframe.operators.clean import require_columns, state_ok
from loanframe.operators.ranking import ranked

SNAPSHOT_COLUMNS = ("column", "value", "row_count", "pct")
DRIFT_COLUMNS = ("column", "value", "current_pct", "baseline_pct", "shift_pct", "flagged")
REPORT_COLUMNS = ("section", "column", "value", "metric", "number", "note")


def _delta(counts: DataFrame) -> DataFrame:
    delta = F.col("checkpoint_row_count") - F.col("raw_row_count")
    return counts.select(
        "raw_row_count",
        "checkpoint_row_count",
        delta.alias("row_count_delta"),
        signed_half_up_pct(delta, "raw_row_count").alias("row_count_delta_pct"),
    )


def row_count_delta(raw: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """One row: raw and checkpoint counts, their delta and the delta in % of raw
    (null when raw is empty) (Q1)."""
    checkpoint_rows = checkpoint.agg(F.count(F.lit(1))).scalar()
    return _delta(
        raw.agg(F.count(F.lit(1)).alias("raw_row_count")).select(
            "raw_row_count", checkpoint_rows.alias("checkpoint_row_count")
        )
    )


def row_count_delta_of(raw_rows: DataFrame, checkpoint_rows: DataFrame) -> DataFrame:
    """:func:`row_count_delta` from two one-row tables that hold the counts
    ``raw_row_count`` and ``checkpoint_row_count``."""
    return _delta(raw_rows.withColumn("checkpoint_row_count", checkpoint_rows.scalar()))


def row_count_delta_from_stats(stats: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """:func:`row_count_delta` with the raw count taken from :func:`batch_stats`
    (saved by the batch job), so the raw input is not read again."""
    checkpoint_rows = checkpoint.agg(F.count(F.lit(1))).scalar()
    return _delta(
        stats.select(
            F.col("raw_rows").alias("raw_row_count"),
            checkpoint_rows.alias("checkpoint_row_count"),
        )
    )


def null_rates(
    df: DataFrame, columns: Sequence[str] = rules.NULL_CHECK_COLUMNS
) -> DataFrame:
    """``(column, null_count, null_pct)``, one scan; ``null_pct`` is null on no rows
    (Q3)."""
    columns = list(dict.fromkeys(columns))
    require_columns(df, columns, "null_rates")
    counts = df.agg(
        F.count(F.lit(1)).alias("__total"),
        *[F.count_if(named(c).isNull()).alias(f"__n{i}") for i, c in enumerate(columns)],
    )
    long = counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(c).alias("column"),
                        F.col(f"__n{i}").alias("null_count"),
                        F.col("__total").alias("total"),
                    )
                    for i, c in enumerate(columns)
                ]
            )
        )
    )
    return long.select(
        "column", "null_count", half_up_pct("null_count", "total").alias("null_pct")
    )


def distribution_snapshot(
    df: DataFrame, columns: Sequence[str] = rules.DISTRIBUTION_COLUMNS
) -> DataFrame:
    """Share of each value per column in %, as ``(column, value, row_count, pct)``
    (Q4).

    Values are cast to string; null stays a null value of its own.  One scan and one
    shuffle for all columns; the total is a scalar subquery over the grouped rows,
    so the input is not scanned a second time.  No rows in, no rows out.
    """
    columns = list(dict.fromkeys(columns))
    require_columns(df, columns, "distribution_snapshot")
    narrow = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = narrow.unpivot([], list(columns), "column", "value")
    grouped = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("row_count"))
    # Every column's groups add up to the row count, so the total is the sum over
    # all groups divided by the number of columns.  The subquery then has the same
    # plan as ``grouped`` and reuses its shuffle instead of scanning the input again.
    total = grouped.agg(
        F.call_function("div", F.sum("row_count"), F.lit(len(columns)))
    ).scalar()
    return grouped.withColumn("__total", total).select(
        "column", "value", "row_count", half_up_pct("row_count", "__total").alias("pct")
    )


def checkpoint_metrics(
    df: DataFrame,
    null_columns: Sequence[str] = rules.NULL_CHECK_COLUMNS,
    distribution_columns: Sequence[str] = rules.DISTRIBUTION_COLUMNS,
) -> DataFrame:
    """Everything that the report counts in the checkpoint (Q1, Q3, Q4), as
    ``(kind, column, value, row_count)`` from one scan and one shuffle.

    One ``Expand`` stacks three kinds of rows, and one grouping counts them: ``rows`` (one
    group), ``nulls`` (of a checked column only whether it is null, so a column of any
    number of values makes two groups) and ``values`` (a distribution column's values as
    text; null is a value).  Read by :func:`row_count_of`, :func:`null_rates_of` and
    :func:`snapshot_of`.
    """
    null_columns = list(dict.fromkeys(null_columns))
    distribution_columns = list(dict.fromkeys(distribution_columns))
    require_columns(df, null_columns + distribution_columns, "checkpoint_metrics")
    stacked = [F.lit("").alias("rows")]
    stacked += [
        F.when(named(c).isNull(), F.lit("null")).otherwise(F.lit("")).alias(f"nulls {c}")
        for c in null_columns
    ]
    stacked += [named(c).cast("string").alias(f"values {c}") for c in distribution_columns]
    narrow = df.select(*stacked)
    long = narrow.unpivot([], [named(c) for c in narrow.columns], "name", "value")
    grouped = long.groupBy("name", "value").agg(F.count(F.lit(1)).alias("row_count"))
    kind = F.split_part("name", F.lit(" "), F.lit(1))
    return grouped.select(
        kind.alias("kind"),
        F.substring("name", F.length(kind) + 2, F.length("name")).alias("column"),
        "value",
        "row_count",
    )


def row_count_of(metrics: DataFrame) -> DataFrame:
    """``checkpoint_row_count``, one row, from :func:`checkpoint_metrics`."""
    rows = F.coalesce(F.sum(F.when(F.col("kind") == "rows", F.col("row_count"))), F.lit(0))
    return metrics.agg(rows.alias("checkpoint_row_count"))


def null_rates_of(
    metrics: DataFrame, columns: Sequence[str] = rules.NULL_CHECK_COLUMNS
) -> DataFrame:
    """:func:`null_rates` from :func:`checkpoint_metrics`."""
    columns = list(dict.fromkeys(columns))
    nulls = (F.col("kind") == "nulls") & (F.col("value") == "null")
    counts = metrics.agg(
        F.coalesce(F.sum(F.when(F.col("kind") == "rows", F.col("row_count"))), F.lit(0)).alias("total"),
        *[
            F.coalesce(F.sum(F.when(nulls & (F.col("column") == c), F.col("row_count"))), F.lit(0)).alias(f"n{i}")
            for i, c in enumerate(columns)
        ],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("null_count"), "total")
        for i, c in enumerate(columns)
    ]
    long = counts.select(F.inline(F.array(*rows)))
    return long.select(
        "column", "null_count", half_up_pct("null_count", "total").alias("null_pct")
    )


def snapshot_of(metrics: DataFrame) -> DataFrame:
    """:func:`distribution_snapshot` from :func:`checkpoint_metrics`."""
    total = row_count_of(metrics).scalar()
    return (
        metrics.filter(F.col("kind") == "values")
        .withColumn("__total", total)
        .select("column", "value", "row_count", half_up_pct("row_count", "__total").alias("pct"))
    )


def _hundredths(c: Column) -> Column:
    return F.round(F.coalesce(c, F.lit(0.0)) * F.lit(100)).cast("bigint")


def drift(
    current: DataFrame,
    baseline: DataFrame,
    threshold_pct: float = rules.DRIFT_THRESHOLD_PCT,
) -> DataFrame:
    """Compare two snapshots ``(column, value, pct)`` (Q5).

    Every (column, value) on either side appears once; a missing side counts as
    0.0; ``shift_pct = current - baseline`` to two decimals; ``flagged`` when
    ``|shift| >= threshold_pct``.  Null values match each other.  Both inputs are
    aggregated snapshots, so the full outer join moves only their rows.
    """
    cur = current.select(
        F.col("column").alias("c_column"),
        F.col("value").alias("c_value"),
        F.col("pct").alias("c_pct"),
    )
    base = baseline.select(
        F.col("column").alias("b_column"),
        F.col("value").alias("b_value"),
        F.col("pct").alias("b_pct"),
    )
    joined = cur.join(
        base,
        (F.col("c_column") == F.col("b_column"))
        & F.col("c_value").eqNullSafe(F.col("b_value")),
        "full_outer",
    )
    diff = _hundredths(F.col("c_pct")) - _hundredths(F.col("b_pct"))
    return joined.select(
        F.coalesce("c_column", "b_column").alias("column"),
        F.when(F.col("c_column").isNotNull(), F.col("c_value"))
        .otherwise(F.col("b_value"))
        .alias("value"),
        F.coalesce("c_pct", F.lit(0.0)).alias("current_pct"),
        F.coalesce("b_pct", F.lit(0.0)).alias("baseline_pct"),
        (diff / F.lit(100)).alias("shift_pct"),
        (F.abs(diff) >= F.lit(threshold_pct * 100)).alias("flagged"),
    )


def batch_counts(
    df: DataFrame,
    status: str = "loan_status",
    resolved: Sequence[str] = rules.RESOLVED_STATUSES,
    state_column: str = "addr_state",
    state_pattern: str = rules.STATE_PATTERN,
    domain_column: str | None = "purpose",
    domain: Sequence[str] = rules.PURPOSES,
) -> list[Column]:
    """The aggregates of :func:`batch_stats` over raw rows ``df``, to be computed by
    ``agg`` or, while the rows are written, by ``observe``."""
    aligned = F.coalesce(state_ok(state_column, state_pattern), F.lit(False))
    resolved_ = F.coalesce(F.col(status).isin(*resolved), F.lit(False))
    malformed = F.max(F.lit(None).cast("bigint"))
    if rules.CORRUPT_COLUMN in df.columns:
        malformed = F.count(rules.CORRUPT_COLUMN)
    counts = [
        F.count(F.lit(1)).alias("raw_rows"),
        malformed.alias("malformed_rows"),
        F.count_if(aligned).alias("aligned_rows"),
        F.count_if(aligned & resolved_).alias("labelled_rows"),
    ]
    if domain_column is not None:
        counts += [
            F.count_if(aligned & ~F.col(domain_column).isin(*domain)).alias(
                "domain_violations"
            ),
            F.count_if(~F.col(state_column).rlike(state_pattern)).alias("pattern_violations"),
        ]
    return counts


def raw_width(df: DataFrame) -> int:
    """The number of raw columns, without those that the reader adds."""
    return len([c for c in df.columns if c not in (rules.CORRUPT_COLUMN, rules.FILE_COLUMN)])


def batch_stats(
    df: DataFrame,
    status: str = "loan_status",
    resolved: Sequence[str] = rules.RESOLVED_STATUSES,
    state_column: str = "addr_state",
    state_pattern: str = rules.STATE_PATTERN,
    domain_column: str | None = "purpose",
    domain: Sequence[str] = rules.PURPOSES,
) -> DataFrame:
    """One row of counts over the raw rows of the batch job, from one scan.

    ``raw_rows``; ``malformed_rows`` with a wrong field count (null when the reader kept
    no such column); ``aligned_rows`` kept by the shifted-row filter; ``labelled_rows``
    also resolved; ``domain_violations`` among the aligned rows, and
    ``pattern_violations`` among all rows, which that filter drops (the category check,
    C7 and C8; left out when ``domain_column`` is None); ``raw_columns``.  The batch job
    validates from this row and can save it, so the quality job need not read the
    raw input again for its count.
    """
    counts = batch_counts(
        df, status, resolved, state_column, state_pattern, domain_column, domain
    )
    return df.agg(*counts).withColumn("raw_columns", F.lit(raw_width(df)))


def funnel_rows(stats: DataFrame) -> DataFrame:
    """The two row filters of the batch job, in order, from :func:`batch_stats`:
    ``(step, stage, rows_before, rows_after, rows_removed, raw_columns)``."""
    stages = F.array(
        F.struct(
            F.lit(1).alias("step"),
            F.lit("drop_shifted_rows").alias("stage"),
            F.col("raw_rows").alias("rows_before"),
            F.col("aligned_rows").alias("rows_after"),
        ),
        F.struct(
            F.lit(2).alias("step"),
            F.lit("label_target").alias("stage"),
            F.col("aligned_rows").alias("rows_before"),
            F.col("labelled_rows").alias("rows_after"),
        ),
    )
    return stats.select(F.inline(stages), "raw_columns").select(
        "step",
        "stage",
        "rows_before",
        "rows_after",
        (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        "raw_columns",
    )


def stage_funnel(
    df: DataFrame,
    status: str = "loan_status",
    resolved: Sequence[str] = rules.RESOLVED_STATUSES,
    state_column: str = "addr_state",
    state_pattern: str = rules.STATE_PATTERN,
) -> DataFrame:
    """Rows before, after and removed by each row filter of the batch job, in its
    order (shifted rows, then unresolved statuses), from one scan of the raw rows
    (Q8).  Also reports the raw column count."""
    return funnel_rows(
        batch_stats(df, status, resolved, state_column, state_pattern, domain_column=None)
    )


def _metrics(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """``(column, value, metric, number)``: one row for each of ``metrics``."""
    structs = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("number")) for m in metrics
    ]
    return df.select("column", "value", F.inline(F.array(*structs)))


def report_rows(
    row_counts: DataFrame,
    output_counts: DataFrame,
    null_rate_rows: DataFrame,
    snapshot: DataFrame,
    drift_rows: DataFrame | None,
    drift_note: str | None = None,
) -> DataFrame:
    """All report sections as one long table
    ``(section, column, value, metric, number, note)`` (Q6).

    Sections: ``row_counts`` (one row per count), ``output_counts``, ``null_rates``,
    ``distribution`` (the share of every value and its rank within the column, largest
    first) and ``drift`` (baseline share, current share and shift of the flagged values).
    Without a baseline, or when nothing is flagged, ``drift`` holds one row whose
    ``note`` says so; ``drift_note`` adds another such row.
    """
    null_str = F.lit(None).cast("string")
    null_num = F.lit(None).cast("double")

    def rows(section, column, value, metric, number, note=null_str):
        return [
            F.lit(section).alias("section"),
            column.alias("column"),
            value.alias("value"),
            metric.alias("metric"),
            number.cast("double").alias("number"),
            note.alias("note"),
        ]

    rc = row_counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("number"))
                    for m in (
                        "raw_row_count",
                        "checkpoint_row_count",
                        "row_count_delta",
                        "row_count_delta_pct",
                    )
                ]
            )
        )
    ).select(*rows("row_counts", null_str, null_str, F.col("metric"), F.col("number")))
    oc = output_counts.select(
        *rows("output_counts", null_str, null_str, F.col("metric"), F.col("row_count"))
    )
    nr = null_rate_rows.select(
        *rows("null_rates", F.col("column"), null_str, F.lit("null_pct"), F.col("null_pct"))
    )
    # By ranges: a column may have very many values.
    by_share = [F.desc("row_count"), F.asc_nulls_first("value")]
    ds = _metrics(ranked(snapshot, by_share, ["column"]), ["pct", "rank"]).select(
        *rows("distribution", F.col("column"), F.col("value"), F.col("metric"), F.col("number"))
    )

    def note(text):
        # A constant note: one local row, so no input is read for it.
        return row_counts.sparkSession.createDataFrame(
            [("drift", None, None, "status", None, text)],
            "section string, column string, value string, metric string, "
            "number double, note string",
        )

    if drift_rows is None:
        dr = note("There was nothing to compare with: the shares of this run become the baseline.")
    else:
        flagged = _metrics(
            drift_rows.filter(F.col("flagged")), ["baseline_pct", "current_pct", "shift_pct"]
        ).select(
            *rows("drift", F.col("column"), F.col("value"), F.col("metric"), F.col("number"))
        )
        none_flagged = (
            drift_rows.agg(F.count_if(F.col("flagged")).alias("n"))
            .filter(F.col("n") == 0)
            .select(
                *rows(
                    "drift",
                    null_str,
                    null_str,
                    F.lit("status"),
                    null_num,
                    F.lit("All shares moved less than the threshold."),
                )
            )
        )
        dr = flagged.unionByName(none_flagged)
    if drift_note:
        dr = dr.unionByName(note(drift_note))
    return rc.unionByName(oc).unionByName(nr).unionByName(ds).unionByName(dr)
