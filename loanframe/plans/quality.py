"""Quality pipeline (P2): raw + checkpoint + outputs -> counts, null rates,
distribution snapshot, drift against the stored baseline, report rows.

The checkpoint is scanned once: rows, nulls and shares are counted by one grouping.
Every metric stays a DataFrame; the only actions are the write of those counts, the
baseline save on the first run and whatever the caller does with the report rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe import rules
from loanframe.operators.checks import output_row_counts
from loanframe.operators.quality import (
    checkpoint_metrics,
    drift,
    null_rates_of,
    report_rows,
    row_count_delta_of,
    row_count_of,
    snapshot_of,
)
from loanframe.sources.files import (
    load_baseline,
    read_checkpoint,
    save_baseline,
    scratch_path,
    scratch_table,
    write_table,
)


@dataclass
class QualityResult:
    row_counts: DataFrame
    output_counts: DataFrame
    null_rates: DataFrame
    snapshot: DataFrame
    drift: DataFrame | None
    report: DataFrame
    baseline_saved: bool


def run_quality(
    spark: SparkSession,
    raw: DataFrame | None,
    checkpoint: DataFrame,
    outputs: Mapping[str, DataFrame | str],
    baseline_path: str | None = None,
    null_columns: Sequence[str] = rules.NULL_CHECK_COLUMNS,
    distribution_columns: Sequence[str] = rules.DISTRIBUTION_COLUMNS,
    threshold_pct: float = rules.DRIFT_THRESHOLD_PCT,
    refresh_baseline: bool = False,
    batch_stats: DataFrame | None = None,
) -> QualityResult:
    """Build every quality metric.  Without a stored baseline at ``baseline_path``
    the current snapshot is saved there (first run) and no drift is computed.  With
    ``refresh_baseline`` the drift against the old baseline is written out first; then
    the current snapshot replaces it, and the report says so.  A checkpoint without rows
    is not saved as a baseline.

    With ``batch_stats`` (the row the batch job saved) the raw row count comes from
    it and ``raw`` may be ``None``: the raw input is not read again.  ``outputs``
    maps labels to output DataFrames or catalog table names.
    """
    if batch_stats is not None:
        raw_rows = batch_stats.select(F.col("raw_rows").alias("raw_row_count"))
    elif raw is not None:
        raw_rows = raw.agg(F.count(F.lit(1)).alias("raw_row_count"))
    else:
        raise ValueError("run_quality: pass the raw rows or the batch job's stats")
    # The one scan of the checkpoint; written, since all sections below read it.
    metrics = scratch_table(
        checkpoint_metrics(checkpoint, null_columns, distribution_columns), "metrics"
    )
    rc = row_count_delta_of(raw_rows, row_count_of(metrics))
    oc = output_row_counts(spark, outputs)
    nr = null_rates_of(metrics, null_columns)
    snap = snapshot_of(metrics)

    baseline = load_baseline(spark, baseline_path) if baseline_path else None
    saved, note = False, None
    dr = drift(snap, baseline, threshold_pct) if baseline is not None else None
    if baseline_path and (baseline is None or refresh_baseline):
        # A few rows per column; written, so that they are not derived again and do not
        # read the baseline after it was replaced.
        snap = read_checkpoint(spark, write_table(snap, scratch_path(spark, "snapshot")))
        if dr is not None:
            dr = drift(snap, baseline, threshold_pct)
            dr = read_checkpoint(spark, write_table(dr, scratch_path(spark, "drift")))
            note = "The baseline was replaced by the shares of this run after the comparison."
        if not snap.isEmpty():
            save_baseline(snap, baseline_path, refresh=refresh_baseline)
            saved = True
    return QualityResult(
        row_counts=rc,
        output_counts=oc,
        null_rates=nr,
        snapshot=snap,
        drift=dr,
        report=report_rows(rc, oc, nr, snap, dr, note),
        baseline_saved=saved,
    )
