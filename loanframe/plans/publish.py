"""The batch job as one release (P1 with S1, S3, S5, C6 and Q8).

One pass over the raw rows writes them all, cleaned and labelled, to a new run folder:
the loans that are kept, and apart from them, with the stage that removed them, those that
are not.  While they are written, ``observe`` counts them (the category checks, the row
funnel, malformed rows); no separate pass is needed.  Only when the counts are valid, agree
with the rows found in the files, and both output tables have rows is the run published, in
one step (:mod:`loanframe.sources.releases`).  Until then, and whenever the job dies,
readers have the checkpoint and outputs of the release before, together.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from loanframe import rules
from loanframe.functions import named
from loanframe.operators.checks import raise_on_violations, require_non_empty
from loanframe.operators.clean import clean_raw, state_ok
from loanframe.operators.features import add_features, default_label, is_resolved
from loanframe.operators.metrics import default_rate_curve, npl_ratio_by_dimensions
from loanframe.operators.quality import batch_counts, batch_stats, raw_width
from loanframe.plans.batch import BatchResult
from loanframe.sources.files import write_table
from loanframe.sources.releases import Release, discard_run, latest_release, publish_run, stage_run

#: Columns of the written rows beside the loans' own: the stage that removed a row (null on
#: kept ones), the text of a line with a wrong number of fields, and its file.
REMOVED_BY, RAW_LINE, RAW_FILE = "removed_by", "raw_line", "raw_file"
AUDIT_COLUMNS = (REMOVED_BY, RAW_LINE, RAW_FILE)
_OUTCOME = "outcome"
_TABLES = {
    "checkpoint": "rows/outcome=kept",
    "rejected": "rows/outcome=rejected",
    "npl_ratio": "npl_ratio",
    "default_rate_curve": "default_rate_curve",
    "stats": "stats",
}
#: Files that a task holds open at once, so that it need not sort its rows by folder first.
_OPEN_FILES = "16"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def _or_null(df: DataFrame, column: str) -> Column:
    return named(column) if column in df.columns else F.lit(None).cast("string")


def _every_row(
    raw: DataFrame,
    date_columns: Sequence[str],
    numeric_sparse: Sequence[str],
    date_sparse: Sequence[str],
) -> DataFrame:
    """All raw rows cleaned, labelled and with features, and the audit columns: what the
    row filters would remove is marked instead."""
    taken = {c.lower() for c in raw.columns} & {*AUDIT_COLUMNS, _OUTCOME}
    if taken:
        raise ValueError(f"publish_batch: the raw rows have columns named {sorted(taken)}")
    marked = raw.withColumns(
        {RAW_LINE: _or_null(raw, rules.CORRUPT_COLUMN), RAW_FILE: _or_null(raw, rules.FILE_COLUMN)}
    )
    cleaned = clean_raw(marked, date_columns, numeric_sparse, date_sparse)
    aligned = F.coalesce(state_ok(), F.lit(False))
    stage = F.when(~aligned, "drop_shifted_rows").when(~is_resolved(), "label_target")
    labelled = add_features(cleaned.withColumn("is_default", default_label()))
    return labelled.withColumns(
        {
            REMOVED_BY: stage,
            _OUTCOME: F.when(stage.isNull(), "kept").otherwise("rejected"),
        }
    )


def publish_batch(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    date_columns: Sequence[str] = rules.DATE_COLUMNS,
    numeric_sparse: Sequence[str] = rules.SPARSE_NUMERIC_COLUMNS,
    date_sparse: Sequence[str] = rules.SPARSE_DATE_COLUMNS,
    purposes: Sequence[str] = rules.PURPOSES,
    dimensions: Sequence[str] = rules.NPL_DIMENSIONS,
    checkpoint_partition_by: Sequence[str] | None = None,
) -> BatchResult:
    """Run P1 with one pass over ``raw`` and publish checkpoint, rejected rows, both
    output tables and the counts as one release under ``root``.

    ``ValueError`` on bad categories or an empty output; nothing is published then, and
    what was staged is deleted.  Rows are counted as they are written and again from the
    files; a difference is an error too.
    """
    run = stage_run(root)
    counted = Observation()
    rows = _every_row(
        raw.observe(counted, *batch_counts(raw, domain=purposes)),
        date_columns,
        numeric_sparse,
        date_sparse,
    )
    schema = rows.drop(_OUTCOME).schema
    by = [_OUTCOME, *(checkpoint_partition_by or [])]
    if checkpoint_partition_by:
        rows = rows.hint("rebalance", *by)
    try:
        with _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", _OPEN_FILES):
            rows.write.partitionBy(*by).parquet(f"{run}/rows")
        found = counted.get
        raise_on_violations(found["domain_violations"], 0, domain=purposes)
        if not found["labelled_rows"]:
            raise ValueError("publish_batch: no resolved loan is left")
        facts = found | {"raw_columns": raw_width(raw.drop("member_id"))}
        staged = Release(0, run, _TABLES, facts | {"schema": schema.json()})
        kept, rejected = _loans(spark, staged), rejected_rows(spark, staged)
        written = {"kept": kept.count(), "rejected": rejected.count()}
        expected = {
            "kept": found["labelled_rows"],
            "rejected": found["raw_rows"] - found["labelled_rows"],
        }
        if written != expected:
            raise ValueError(f"publish_batch: {written} rows were written, {expected} counted")
        write_table(npl_ratio_by_dimensions(kept, dimensions), staged.path("npl_ratio"))
        write_table(default_rate_curve(kept), staged.path("default_rate_curve"))
        write_table(_stats(spark, raw, staged.facts), staged.path("stats"))
        result = _result(spark, staged)
        require_non_empty(
            spark, {"npl_ratio": result.npl_ratio, "vintage_curve": result.default_rate_curve}
        )
    except ValueError:
        discard_run(spark, run)
        raise
    return _result(spark, publish_run(spark, run, _TABLES, staged.facts))


def _stats(spark: SparkSession, raw: DataFrame, facts: Mapping[str, object]) -> DataFrame:
    """The counts as the one row that :func:`batch_stats` gives."""
    fields = batch_stats(raw.drop("member_id").limit(0)).schema
    fields = StructType([StructField(f.name, f.dataType) for f in fields])
    return spark.createDataFrame([tuple(facts[f.name] for f in fields)], fields)


def _all_columns(release: Release) -> StructType:
    return StructType.fromJson(json.loads(release.facts["schema"]))


def _loans(spark: SparkSession, release: Release) -> DataFrame:
    schema = _all_columns(release)
    own = StructType([f for f in schema.fields if f.name not in AUDIT_COLUMNS])
    return spark.read.schema(own).parquet(release.path("checkpoint"))


def _has(release: Release, table: str) -> bool:
    facts = release.facts
    rejected = facts["raw_rows"] - facts["labelled_rows"]
    return bool(rejected if table == "rejected" else facts["labelled_rows"])


def rejected_rows(spark: SparkSession, release: Release) -> DataFrame:
    """The raw rows of a release that are no loans of its checkpoint, cleaned, each with
    ``removed_by``, the stage whose filter it failed first (C6, C9)."""
    schema = _all_columns(release)
    if not _has(release, "rejected"):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(release.path("rejected"))


def malformed_lines(spark: SparkSession, release: Release) -> DataFrame:
    """``(raw_file, raw_line, reason, removed_by)`` of every raw line with a wrong number
    of fields (S1), among the kept rows (``removed_by`` null) and the rejected ones.  Only
    Parquet row groups with such lines are read."""
    schema = _all_columns(release)
    parts = [
        spark.read.schema(schema).parquet(release.path(t))
        for t in ("checkpoint", "rejected")
        if _has(release, t)
    ]
    out = [
        p.filter(F.col(RAW_LINE).isNotNull()).select(
            RAW_FILE, RAW_LINE, F.lit("wrong number of fields").alias("reason"), REMOVED_BY
        )
        for p in parts
    ]
    return out[0] if len(out) == 1 else out[0].unionByName(out[1])


def row_audit(spark: SparkSession, release: Release) -> DataFrame:
    """``(step, stage, rows_counted, rows_found, ties_out)`` (Q8): the rows that each
    filter removed, those kept and all raw rows, as counted while they were written and as
    found in the release's tables."""
    facts = release.facts
    kept = _loans(spark, release).agg(F.count(F.lit(1)).alias("rows_found"))
    found = rejected_rows(spark, release).groupBy(F.col(REMOVED_BY).alias("stage"))
    found = found.agg(F.count(F.lit(1)).alias("rows_found"))
    found = found.unionByName(kept.select(F.lit("kept").alias("stage"), "rows_found"))
    whole = found.agg(F.lit("raw").alias("stage"), F.sum("rows_found").alias("rows_found"))
    found = found.unionByName(whole)
    counted = [
        (1, "drop_shifted_rows", facts["raw_rows"] - facts["aligned_rows"]),
        (2, "label_target", facts["aligned_rows"] - facts["labelled_rows"]),
        (3, "kept", facts["labelled_rows"]),
        (4, "raw", facts["raw_rows"]),
    ]
    table = spark.createDataFrame(counted, "step int, stage string, rows_counted bigint")
    joined = table.join(found, "stage", "left").na.fill(0, ["rows_found"])
    return joined.select(
        "step",
        "stage",
        "rows_counted",
        "rows_found",
        (F.col("rows_counted") == F.col("rows_found")).alias("ties_out"),
    )


def _result(spark: SparkSession, release: Release) -> BatchResult:
    paths = {label: release.path(label) for label in release.tables}
    return BatchResult(
        checkpoint=_loans(spark, release),
        npl_ratio=spark.read.parquet(paths["npl_ratio"]),
        default_rate_curve=spark.read.parquet(paths["default_rate_curve"]),
        stats=spark.read.parquet(paths["stats"]),
        paths=paths,
        release=release,
    )


def read_release(spark: SparkSession, root: str) -> BatchResult | None:
    """Checkpoint and outputs of the newest release under ``root``, all of one run;
    ``None`` before the first."""
    newest = latest_release(spark, root)
    return None if newest is None else _result(spark, newest)
