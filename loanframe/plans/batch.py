"""Batch pipeline (P1): raw loans -> clean -> validate -> label and features ->
Parquet checkpoint -> bad-rate table and default-rate curve.

Passes over the raw input: one aggregate (both category checks, the raw row count, the
malformed rows and the row funnel) and one checkpoint write.  They are two passes here, as
this job writes straight to the paths or catalog tables it is given and must check before;
:func:`loanframe.plans.publish_batch` needs one.  The two aggregate tables are
computed from the checkpoint, so they read only the columns they need from Parquet
and do not re-run the cleaning chain; the bad-rate table is one scan and one
shuffle for all its dimensions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from loanframe import rules
from loanframe.operators.checks import raise_on_violations
from loanframe.operators.clean import clean_raw, drop_shifted_rows
from loanframe.operators.features import add_features, label_target
from loanframe.operators.metrics import default_rate_curve, npl_ratio_by_dimensions
from loanframe.operators.quality import batch_stats
from loanframe.sources.files import read_checkpoint, write_checkpoint, write_table
from loanframe.sources.releases import Release


def prepare_loans(
    raw: DataFrame,
    date_columns: Sequence[str] = rules.DATE_COLUMNS,
    numeric_sparse: Sequence[str] = rules.SPARSE_NUMERIC_COLUMNS,
    date_sparse: Sequence[str] = rules.SPARSE_DATE_COLUMNS,
    numeric_types: Mapping[str, str] = rules.NUMERIC_TYPES,
) -> DataFrame:
    """Clean, drop misaligned rows, label resolved loans and add the features
    (lazy; no validation)."""
    return (
        raw.transform(clean_raw, date_columns, numeric_sparse, date_sparse, numeric_types)
        .transform(drop_shifted_rows)
        .transform(label_target)
        .transform(add_features)
    )


@dataclass
class BatchResult:
    checkpoint: DataFrame
    npl_ratio: DataFrame
    default_rate_curve: DataFrame
    stats: DataFrame
    paths: dict
    #: The release that holds all of them, where the job published one.
    release: Release | None = None


def run_batch(
    spark: SparkSession,
    raw: DataFrame,
    checkpoint_path: str,
    ratio_target: str,
    curve_target: str,
    date_columns: Sequence[str] = rules.DATE_COLUMNS,
    numeric_sparse: Sequence[str] = rules.SPARSE_NUMERIC_COLUMNS,
    date_sparse: Sequence[str] = rules.SPARSE_DATE_COLUMNS,
    purposes: Sequence[str] = rules.PURPOSES,
    dimensions: Sequence[str] = rules.NPL_DIMENSIONS,
    output_format: str = "parquet",
    as_tables: bool = False,
    checkpoint_partition_by: Sequence[str] | None = None,
    stage_raw: str | None = None,
    stats_path: str | None = None,
) -> BatchResult:
    """Run P1 end to end; raises ``ValueError`` (before writing) on bad categories.

    ``stage_raw``: a path where the raw text is first written as Parquet.  Then the
    raw input is read once; the category check reads two Parquet columns and the
    checkpoint pass reads Parquet splits in parallel.  Worth it for a single
    (unsplittable) gzip file or when reading the raw text is the slow part; for
    large splittable inputs it costs one extra full write.

    The category check (C7, C8) and the row funnel (Q8) come from one aggregate
    over the raw rows (:func:`loanframe.operators.batch_stats`); its single row is
    returned as ``stats`` and, with ``stats_path``, saved next to the outputs so the
    quality job can take the raw row count from it instead of reading the raw
    input again.
    """
    if stage_raw:
        raw = read_checkpoint(spark, write_checkpoint(raw, stage_raw))
    cleaned = raw.transform(clean_raw, date_columns, numeric_sparse, date_sparse)
    counted = batch_stats(raw.drop("member_id"), domain=purposes)
    row = counted.first()
    # Rows that fail the pattern are dropped below, so none is left to object to.
    raise_on_violations(row["domain_violations"], 0, domain=purposes)
    stats = spark.createDataFrame([row], counted.schema)
    if stats_path:
        write_table(stats, stats_path)
        stats = spark.read.parquet(stats_path)
    labelled = drop_shifted_rows(cleaned).transform(label_target).transform(add_features)

    write_checkpoint(labelled, checkpoint_path, checkpoint_partition_by)
    checkpoint = read_checkpoint(spark, checkpoint_path)

    write_table(
        npl_ratio_by_dimensions(checkpoint, dimensions), ratio_target, output_format, as_tables
    )
    write_table(default_rate_curve(checkpoint), curve_target, output_format, as_tables)

    def _read(target: str) -> DataFrame:
        if as_tables:
            return spark.table(target)
        return spark.read.format(output_format).load(target)

    return BatchResult(
        checkpoint=checkpoint,
        npl_ratio=_read(ratio_target),
        default_rate_curve=_read(curve_target),
        stats=stats,
        paths={
            "checkpoint": checkpoint_path,
            "npl_ratio": ratio_target,
            "default_rate_curve": curve_target,
            "stats": stats_path,
        },
    )
