"""

``entry`` runs the flagship query (bad rate by segment) on sf0.001.  ``queries``
test tables through the loan-shaped view; ``oracle_sql`` holds the same query in
DuckDB SQL over the same tables, with the view rebuilt as common table
expressions.
"""

from __future__ import annotations

import os
import re
import sys
from collections.abc import Callable

# The package sits next to this file; make it importable however this file is
# loaded.  Only the driver imports it: there are no Python UDFs, so executors
# never need the package.
_HERE = os.path.dirname(os.path.abspath(__file__))
if _HERE not in sys.path:
    sys.path.insert(0, _HERE)

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from loanframe import rules  # noqa: E402
from loanframe.operators import (
    add_loan_age,
    batch_stats,
    cast_numbers,
    category_violations,
    checkpoint_metrics,
    clean_raw,
    dataset_profile,
    default_rate_curve,
    distribution_snapshot,
    drift,
    drop_member_id,
    drop_shifted_rows,
    fill_rates,
    label_distribution,
    label_target,
    npl_ratio,
    npl_ratio_by_dimensions,
    null_rates,
    output_gate,
    output_row_counts,
    preview,
    row_count_delta,
    sparse_block_fill,
    split_shifted_rows,
    stage_funnel,
    status_profile,
    top_values,
    value_counts,
)
from loanframe.operators.clean import clean_dates, clean_sparse, clean_term
from loanframe.plans import (
    malformed_lines,
    prepare_loans,
    profiled_loans,
    publish_batch,
    rejected_rows,
    row_audit,
    run_profiling,
    run_quality,
)
from loanframe.sources import (
    load_baseline,
    loan_view,
    read_checkpoint,
    read_raw_csv,
    save_baseline,
    scratch_path,
    write_checkpoint,
    write_csv,
    write_table,
)
from loanframe.sources import tpch_loans as lv

SMOKE_DIR = "/root/testdata/sf0.001"

# Columns of the view after cleaning, profiled for fill rates.
FILL_COLUMNS = (
    "grade",
    "addr_state",
    "purpose",
    "loan_status",
    "issue_d",
    "last_pymnt_d",
    "term_months",
    "dti",
    "delinq_2yrs",
) + lv.NUMERIC_SPARSE + lv.DATE_SPARSE


# --- shared Spark building blocks over the view --------------------------------


def _raw(spark: SparkSession, d: str) -> DataFrame:
    return loan_view(spark, d)


def _cleaned(spark: SparkSession, d: str) -> DataFrame:
    return clean_raw(_raw(spark, d), lv.DATE_COLUMNS, lv.NUMERIC_SPARSE, lv.DATE_SPARSE)


def _loans(spark: SparkSession, d: str) -> DataFrame:
    return prepare_loans(_raw(spark, d), lv.DATE_COLUMNS, lv.NUMERIC_SPARSE, lv.DATE_SPARSE)


def _profiled(spark: SparkSession, d: str) -> DataFrame:
    return profiled_loans(_raw(spark, d), lv.DATE_COLUMNS, lv.NUMERIC_SPARSE, lv.DATE_SPARSE)


def _snapshots(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    loans = _loans(spark, d)
    current = distribution_snapshot(loans.filter(F.col("vintage_year") >= 1998))
    baseline = distribution_snapshot(loans.filter(_EARLIER))
    return current, baseline


# Loans of an earlier run: old vintages, and those whose vintage is unknown.
_EARLIER = "coalesce(vintage_year < 1998, true)"


def _checkpoint(spark: SparkSession, loans: DataFrame) -> DataFrame:
    return read_checkpoint(spark, write_checkpoint(loans, scratch_path(spark, "checkpoint")))


def _written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    return spark.read.schema(df.schema).parquet(write_table(df, scratch_path(spark, name)))


def _outputs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Both output tables as the batch job leaves them: written, from one checkpoint."""
    loans = _checkpoint(spark, _loans(spark, d))
    return {
        "npl_ratio": _written(spark, npl_ratio_by_dimensions(loans), "ratio"),
        "vintage_curve": _written(spark, default_rate_curve(loans), "curve"),
    }


def _known(raw: DataFrame) -> DataFrame:
    return raw.filter(
        F.col("purpose").isin(*lv.PURPOSE_DOMAIN) | F.col("purpose").isNull()
        | ~F.coalesce(F.col("addr_state").rlike(rules.STATE_PATTERN), F.lit(False))
    )


def _batch(spark: SparkSession, d: str):
    """P1 over the loans with a known or missing purpose: the job refuses others, and
    the view holds some."""
    return _published(spark, _known(_raw(spark, d)))


def _published(spark: SparkSession, raw: DataFrame):
    return publish_batch(
        spark, raw, scratch_path(spark, "release"),
        lv.DATE_COLUMNS, lv.NUMERIC_SPARSE, lv.DATE_SPARSE, lv.PURPOSE_DOMAIN,
    )


# --- queries -------------------------------------------------------------------


def q_clean_term(spark, d):
    df = clean_term(drop_member_id(_raw(spark, d)))
    return df.select("id", "grade", "addr_state", "purpose", "loan_status", "term_months")


def q_preview_first_loans(spark, d):
    """C16 on an ordered input: the first loans by id, as the term step previews
    them (a top-k by id; deterministic)."""
    return preview(_cleaned(spark, d).orderBy("id"), ["id", "term_months", "grade"])


def q_clean_dates(spark, d):
    return clean_dates(_raw(spark, d), lv.DATE_COLUMNS).select("id", *lv.DATE_COLUMNS)


def q_clean_sparse(spark, d):
    df = clean_sparse(_raw(spark, d), lv.NUMERIC_SPARSE, lv.DATE_SPARSE)
    return df.select("id", *lv.NUMERIC_SPARSE, *lv.DATE_SPARSE)


def q_shifted_rows_kept(spark, d):
    return drop_shifted_rows(_cleaned(spark, d)).select("id", "addr_state")


def q_shifted_rows_rejected(spark, d):
    _, rejected = split_shifted_rows(_cleaned(spark, d))
    return rejected.select("id", "addr_state", "purpose", "loan_status")


def q_category_violations(spark, d):
    aligned = drop_shifted_rows(_cleaned(spark, d))
    return category_violations(aligned, domain=lv.PURPOSE_DOMAIN)


def q_category_violations_raw(spark, d):
    """C7 + C8 before the shifted rows are dropped, with nulls let pass and counted."""
    rows = [
        category_violations(_cleaned(spark, d), domain=lv.PURPOSE_DOMAIN, nulls_invalid=n).withColumn(
            "nulls_invalid", F.lit(n)
        )
        for n in (False, True)
    ]
    return rows[0].unionByName(rows[1])


def q_label_target(spark, d):
    aligned = drop_shifted_rows(_cleaned(spark, d))
    return label_target(aligned).select("id", "loan_status", "is_default")


def q_label_distribution(spark, d):
    return label_distribution(_loans(spark, d))


def q_loan_features(spark, d):
    return _loans(spark, d).select(
        "id",
        "is_default",
        "vintage_year",
        "loan_age_months",
        "term_months",
        "dti",
        "dti_bucket",
        "has_prior_delinquency",
    )


def q_loan_age_days(spark, d):
    """C12 on day-level dates, from the order to its last shipment: whole months where
    the days of the month (or both month ends) agree, else 31sts; and the floor of A3."""
    orders = spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("issue_d")
    )
    shipped = (
        spark.read.parquet(f"{d}/lineitem.parquet")
        .groupBy(F.col("l_orderkey").alias("id"))
        .agg(F.max("l_shipdate").cast("date").alias("last_pymnt_d"))
    )
    aged = add_loan_age(orders.join(shipped, "id", "left"))
    return aged.select("id", "loan_age_months", F.floor("loan_age_months").alias("age_cell"))


def q_bad_rate_by_grade(spark, d):
    return npl_ratio(_loans(spark, d), "grade")


def q_bad_rate_by_dimension(spark, d):
    return npl_ratio_by_dimensions(_loans(spark, d))


def q_default_rate_curve(spark, d):
    return default_rate_curve(_loans(spark, d))


def q_status_profile(spark, d):
    return status_profile(_cleaned(spark, d))


def q_value_counts(spark, d):
    return value_counts(_profiled(spark, d), "purpose")


def q_top_values(spark, d):
    return top_values(_profiled(spark, d), ["purpose", "addr_state"], k=10)


def q_value_profile(spark, d):
    """A6 + P3 without a limit, on a column with hundreds of values, most of them rare."""
    raw = _raw(spark, d).withColumn("branch", (F.col("id") % 499).cast("string"))
    return run_profiling(
        raw, ["branch", "addr_state"], None, lv.DATE_COLUMNS, lv.NUMERIC_SPARSE, lv.DATE_SPARSE
    )


def q_fill_rates(spark, d):
    return fill_rates(_cleaned(spark, d), FILL_COLUMNS)


def q_sparse_block_fill(spark, d):
    return sparse_block_fill(_cleaned(spark, d), lv.SPARSE_BLOCKS)


def q_dataset_profile(spark, d):
    return dataset_profile(_raw(spark, d))


def q_batch_stats(spark, d):
    return batch_stats(_cleaned(spark, d), domain=lv.PURPOSE_DOMAIN)


def q_row_count_delta(spark, d):
    return row_count_delta(_raw(spark, d), _loans(spark, d))


def q_stage_funnel(spark, d):
    return stage_funnel(drop_member_id(_raw(spark, d)))


def q_null_rates(spark, d):
    return null_rates(_loans(spark, d))


def q_distribution(spark, d):
    return distribution_snapshot(_loans(spark, d))


def q_drift(spark, d):
    current, baseline = _snapshots(spark, d)
    return drift(current, baseline)


def q_output_counts(spark, d):
    return output_row_counts(spark, _outputs(spark, d))


def q_output_gate(spark, d):
    outputs = _outputs(spark, d)
    none = outputs["npl_ratio"].filter(F.col("total_count") < 0)
    return output_gate(spark, outputs | {"nothing": _written(spark, none, "nothing")})


def _quality(spark, d, with_baseline: bool = True, refresh: bool = False):
    """P2 as run after P1: the labelled loans are the checkpoint and both outputs are
    written; a baseline of an earlier run may be stored."""
    ckpt = _checkpoint(spark, _loans(spark, d))
    path = scratch_path(spark, "baseline")
    if with_baseline:
        save_baseline(distribution_snapshot(ckpt.filter(_EARLIER)), path)
    outputs = {
        "npl_ratio": _written(spark, npl_ratio_by_dimensions(ckpt), "ratio"),
        "vintage_curve": _written(spark, default_rate_curve(ckpt), "curve"),
    }
    return run_quality(spark, _raw(spark, d), ckpt, outputs, path, refresh_baseline=refresh), path


def q_quality_report_rows(spark, d):
    return _quality(spark, d)[0].report


def _with_stored_baseline(spark, report: DataFrame, path: str) -> DataFrame:
    stored = load_baseline(spark, path).select(
        F.lit("stored_baseline").alias("section"),
        "column",
        "value",
        F.lit("pct").alias("metric"),
        F.col("pct").alias("number"),
        F.lit(None).cast("string").alias("note"),
    )
    return report.unionByName(stored)


def q_quality_first_run(spark, d):
    """P2 without a stored baseline: the report says so, and the shares are stored."""
    result, path = _quality(spark, d, with_baseline=False)
    return _with_stored_baseline(spark, result.report, path)


def q_quality_refresh(spark, d):
    """P2 that compares with the stored baseline and then replaces it."""
    result, path = _quality(spark, d, refresh=True)
    return _with_stored_baseline(spark, result.report, path)


def q_batch_ratio(spark, d):
    return _batch(spark, d).npl_ratio


def q_batch_curve(spark, d):
    return _batch(spark, d).default_rate_curve


def q_batch_stats_saved(spark, d):
    return _batch(spark, d).stats


def q_batch_rejected_rows(spark, d):
    """The raw rows that are no loans of the published checkpoint, and why."""
    rejected = rejected_rows(spark, _batch(spark, d).release)
    return rejected.select("id", "removed_by", "addr_state", "purpose", "loan_status")


def q_batch_row_audit(spark, d):
    """Q8: rows kept and rejected as counted in the job's one pass, and as found."""
    return row_audit(spark, _batch(spark, d).release)


def q_csv_malformed_lines(spark, d):
    """S1 + P1: raw CSV text in which some lines have a field too many and some lack their
    last two; the lines as the release keeps them."""
    raw = _known(_as_text(spark, d))
    fields = [F.coalesce(F.col(c), F.lit("")) for c in lv.RAW_COLUMNS]
    number = F.col("id").cast("bigint")
    line = (
        F.when(number % 37 == 0, F.concat_ws(",", *fields, F.lit("surplus")))
        .when(number % 41 == 0, F.concat_ws(",", *fields[:-2]))
        .otherwise(F.concat_ws(",", *fields))
    )
    # One column whose name is the whole header: lines are written as they are.
    text = raw.select(line.alias(",".join(lv.RAW_COLUMNS)))
    path = scratch_path(spark, "raw-lines")
    text.write.option("header", True).option("sep", "\u0001").csv(path)
    released = _published(spark, read_raw_csv(spark, path, file_column=rules.FILE_COLUMN)).release
    return malformed_lines(spark, released).select(
        F.split_part("raw_line", F.lit(","), F.lit(1)).alias("id"),
        F.size(F.split("raw_line", ",")).alias("n_fields"),
        F.col("raw_file").contains("raw-lines").alias("has_file"),
        "reason",
        "removed_by",
    )


def q_catalog_outputs(spark, d):
    """S5 + Q2: both output tables as catalog tables, counted by their names."""
    loans = _checkpoint(spark, _loans(spark, d))
    tables = {"npl_ratio": npl_ratio_by_dimensions(loans), "vintage_curve": default_rate_curve(loans)}
    names = {}
    for label, df in tables.items():
        path = scratch_path(spark, label)
        names[label] = f"loanframe_{path.rsplit('-', 1)[1]}"
        write_table(df, names[label], as_table=True, path=path)
    return output_row_counts(spark, names)


def q_checkpoint_metrics(spark, d):
    """Q1, Q3, Q4 of the checkpoint from one scan."""
    return checkpoint_metrics(_checkpoint(spark, _loans(spark, d)))


def q_checkpoint_roundtrip(spark, d):
    """S3 + S4: write the labelled loans as the Parquet checkpoint, read it back,
    and compute the default-rate curve from the checkpoint."""
    path = write_checkpoint(_loans(spark, d), scratch_path(spark, "checkpoint"))
    return default_rate_curve(read_checkpoint(spark, path))


def _as_text(spark, d) -> DataFrame:
    return _raw(spark, d).withColumn("id", F.col("id").cast("string"))


def q_csv_source_ratio(spark, d):
    """S1 + P1 chain + S3/S4/S5: the view written as raw CSV text in another column
    order, with a column that is not asked for; read back by name, cleaned and labelled,
    checkpointed, aggregated, written as the curated table and read back."""
    text = _as_text(spark, d).select(*reversed(lv.RAW_COLUMNS), F.lit("x").alias("url"))
    csv_dir = write_csv(text, scratch_path(spark, "raw-csv"))
    raw = read_raw_csv(spark, csv_dir, columns=lv.RAW_COLUMNS)
    loans = prepare_loans(raw, lv.DATE_COLUMNS, lv.NUMERIC_SPARSE, lv.DATE_SPARSE)
    return _written(spark, npl_ratio_by_dimensions(_checkpoint(spark, loans)), "ratio")


def q_csv_source_by_name(spark, d):
    """Two CSV files with different column orders and an extra column, read as a
    subset of the columns, typed by name (C4's rule, no inference) and checkpointed."""
    text = _as_text(spark, d)
    even, odd = (F.col("id").cast("bigint") % 2 == k for k in (0, 1))
    one = text.filter(even).select("id", "dti", "grade", "addr_state", "term")
    two = text.filter(odd).select("term", "addr_state", F.lit("a,b").alias("emp_title"), "grade", "dti", "id")
    paths = [write_csv(df, scratch_path(spark, "raw-csv")) for df in (one, two)]
    raw = read_raw_csv(spark, paths, columns=["id", "grade", "addr_state", "dti"])
    typed = cast_numbers(raw.drop(rules.CORRUPT_COLUMN), {"id": "bigint", "dti": "double"})
    return _checkpoint(spark, typed)


COVERS = {
    "clean_term": "C1 C2",
    "preview_first_loans": "C16",
    "clean_dates": "C3",
    "clean_sparse": "C4 C5",
    "shifted_rows_kept": "C6",
    "shifted_rows_rejected": "C6",
    "category_violations": "C7",
    "category_violations_raw": "C7 C8",
    "loan_age_days": "C12",
    "label_target": "C9 C10",
    "label_distribution": "A9",
    "loan_features": "C11 C12 C13 C14 C15",
    "bad_rate_by_grade": "A1",
    "bad_rate_by_dimension": "A2",
    "default_rate_curve": "A3",
    "status_profile": "A4",
    "value_counts": "A5",
    "top_values": "A6",
    "value_profile": "A6 P3",
    "fill_rates": "A7",
    "sparse_block_fill": "A8",
    "dataset_profile": "S2",
    "batch_stats": "C7 C8 Q8",
    "row_count_delta": "Q1",
    "stage_funnel": "Q8",
    "null_rates": "Q3",
    "distribution": "Q4",
    "drift": "Q5",
    "output_counts": "Q2",
    "output_gate": "Q7",
    "quality_report_rows": "S3 S4 S6 S7 Q1 Q2 Q3 Q4 Q5 Q6 P2",
    "quality_first_run": "S6 S7 Q6 P2",
    "quality_refresh": "S6 S7 Q5 Q6 P2",
    "batch_ratio": "S3 S4 S5 C7 A2 P1",
    "batch_curve": "S3 S4 S5 A3 P1",
    "batch_stats_saved": "C7 C8 Q8 P1",
    "batch_rejected_rows": "C6 C9 P1",
    "batch_row_audit": "C6 C9 Q8 P1",
    "csv_malformed_lines": "S1 P1",
    "catalog_outputs": "S5 Q2",
    "checkpoint_metrics": "Q1 Q3 Q4",
    "checkpoint_roundtrip": "S3 S4 A3",
    "csv_source_ratio": "S1 S3 S4 S5 A2",
    "csv_source_by_name": "S1 S3 S4",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: globals()[f"q_{name}"] for name in COVERS
}


# --- oracle SQL (DuckDB) -------------------------------------------------------


def _my(x: str) -> str:
    return f"strftime({x}, '%b-%Y')"


def _month_year_sql(c: str) -> str:
    t = f"trim({c})"
    return (
        f"CASE WHEN regexp_full_match({t}, '[A-Za-z]{{3}}-\\d{{4}}') "
        f"THEN CAST(try_strptime({t}, '%b-%Y') AS DATE) END"
    )


_VIEW = f"""
lines AS (
  SELECT l_orderkey, max(l_shipdate) AS last_ship,
         sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS n_ret
  FROM lineitem GROUP BY l_orderkey
),
raw AS (
  SELECT o_orderkey AS id,
    CAST(NULL AS VARCHAR) AS member_id,
    CASE WHEN o_orderkey % 401 = 0 THEN NULL
         ELSE substr('ABCDE', CAST(substr(o_orderpriority, 1, 1) AS INTEGER), 1) END AS grade,
    CASE WHEN o_orderkey % 211 = 0 THEN '941xx' WHEN o_orderkey % 223 = 0 THEN 'ca'
         WHEN o_orderkey % 227 = 0 THEN NULL
         ELSE concat(chr(65 + n_nationkey), chr(65 + n_regionkey)) END AS addr_state,
    CASE WHEN o_orderkey % 307 = 0 THEN 'bogus' WHEN o_orderkey % 311 = 0 THEN NULL
         ELSE lower(c_mktsegment) END AS purpose,
    CASE WHEN o_orderkey % 409 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN 'Fully Paid'
         WHEN o_orderstatus = 'O' THEN 'Charged Off' ELSE 'Current' END AS loan_status,
    CASE WHEN o_orderkey % 97 = 0 THEN 'not a date' WHEN o_orderkey % 101 = 0 THEN 'Foo-2015'
         WHEN o_orderkey % 89 = 0 THEN NULL ELSE concat(' ', {_my('o_orderdate')}) END AS issue_d,
    CASE WHEN o_orderkey % 103 = 0 THEN '' ELSE {_my('last_ship')} END AS last_pymnt_d,
    CASE WHEN o_orderkey % 83 = 0 THEN 'n/a' WHEN o_orderkey % 2 = 0 THEN ' 36 months'
         ELSE ' 60 months' END AS term,
    CASE WHEN o_orderkey % 79 = 0 THEN 'n/a' ELSE CAST(c_acctbal / 200 AS VARCHAR) END AS dti,
    CASE WHEN o_orderkey % 73 = 0 THEN NULL WHEN o_orderkey % 71 = 0 THEN '-1'
         ELSE CAST(n_ret AS VARCHAR) END AS delinq_2yrs,
    CASE WHEN o_orderkey % 253 = 0 THEN 'bad'
         WHEN o_orderkey % 11 = 0 THEN CAST(o_totalprice / 10 AS VARCHAR) END AS hardship_amount,
    CASE WHEN o_orderkey % 253 = 0 THEN 'bad'
         WHEN o_orderkey % 11 = 0 THEN {_my('o_orderdate')} END AS hardship_start_date,
    CASE WHEN o_orderkey % 23 = 0 THEN CAST(o_totalprice / 4 AS VARCHAR) END AS settlement_amount,
    CASE WHEN o_orderkey % 23 = 0 THEN {_my('last_ship')} END AS settlement_date,
    CASE WHEN o_orderkey % 19 = 0 THEN {_my('o_orderdate')} END AS sec_app_earliest_cr_line,
    CASE WHEN o_orderkey % 19 = 0 THEN CAST(o_totalprice AS VARCHAR) END AS annual_inc_joint
  FROM orders
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  LEFT JOIN lines ON l_orderkey = o_orderkey
),
cleaned AS (
  SELECT id, grade, addr_state, purpose, loan_status,
    {_month_year_sql('issue_d')} AS issue_d,
    {_month_year_sql('last_pymnt_d')} AS last_pymnt_d,
    dti, delinq_2yrs,
    try_cast(hardship_amount AS DOUBLE) AS hardship_amount,
    {_month_year_sql('hardship_start_date')} AS hardship_start_date,
    try_cast(settlement_amount AS DOUBLE) AS settlement_amount,
    {_month_year_sql('settlement_date')} AS settlement_date,
    {_month_year_sql('sec_app_earliest_cr_line')} AS sec_app_earliest_cr_line,
    try_cast(annual_inc_joint AS DOUBLE) AS annual_inc_joint,
    try_cast(nullif(regexp_extract(term, '(\\d+)', 1), '') AS INTEGER) AS term_months
  FROM raw
),
aligned AS (
  SELECT * FROM cleaned WHERE regexp_full_match(addr_state, '[A-Z]{{2}}')
),
labelled AS (
  SELECT *, CASE WHEN loan_status = 'Charged Off' THEN 1 ELSE 0 END AS is_default
  FROM aligned WHERE loan_status IN ('Fully Paid', 'Charged Off')
),
typed AS (
  SELECT * REPLACE (try_cast(dti AS DOUBLE) AS dti),
    CAST(year(issue_d) AS INTEGER) AS vintage_year,
    CAST((year(last_pymnt_d) - year(issue_d)) * 12
         + month(last_pymnt_d) - month(issue_d) AS DOUBLE) AS loan_age_months,
    try_cast(delinq_2yrs AS DOUBLE) > 0 AS has_prior_delinquency
  FROM labelled
),
loans AS (
  SELECT *,
    CASE WHEN dti IS NULL THEN 'Unknown' WHEN dti < 20 THEN 'Low'
         WHEN dti < 40 THEN 'Moderate' ELSE 'High' END AS dti_bucket
  FROM typed
),
profiled AS (
  SELECT * FROM cleaned WHERE loan_status IN ('Fully Paid', 'Charged Off')
)"""


def _with(*extra: str) -> str:
    ctes = [_VIEW.strip()] + [e.strip() for e in extra]
    return "WITH " + ",\n".join(ctes) + "\n"


def _pct(n: str, t: str) -> str:
    """Exact half-up percentage of integers, as in loanframe.functions.half_up_pct."""
    return (
        f"CASE WHEN CAST({t} AS BIGINT) > 0 THEN "
        f"(CAST({n} AS BIGINT) * 20000 + CAST({t} AS BIGINT)) "
        f"// (2 * CAST({t} AS BIGINT)) / 100 END"
    )


def _ratio_sql(source: str, dims) -> str:
    parts = [
        f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS dimension_value, "
        f"CAST(sum(is_default) AS BIGINT) AS default_count, count(*) AS total_count, "
        f"CAST(sum(is_default) AS BIGINT) / count(*) AS npl_ratio "
        f"FROM {source} GROUP BY {d}"
        for d in dims
    ]
    return "\nUNION ALL\n".join(parts)


_CURVE = (
    "SELECT vintage_year, CAST(floor(loan_age_months) AS BIGINT) AS loan_age_months, "
    "CAST(sum(is_default) AS BIGINT) AS default_count, count(*) AS total_count, "
    "CAST(sum(is_default) AS BIGINT) / count(*) AS npl_ratio "
    "FROM loans GROUP BY 1, 2"
)


def _snapshot_sql(source: str, name: str) -> str:
    cols = rules.DISTRIBUTION_COLUMNS
    long = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column, CAST({c} AS VARCHAR) AS value FROM {source}" for c in cols
    )
    return f"""
{name}_long AS (
  {long}
),
{name}_grouped AS (
  SELECT column, value, count(*) AS row_count FROM {name}_long GROUP BY column, value
),
{name} AS (
  SELECT column, value, row_count,
    {_pct('row_count', f"(SELECT sum(row_count) FROM {name}_grouped WHERE column = '{cols[0]}')")} AS pct
  FROM {name}_grouped
)"""


_SNAPSHOTS = (
    _snapshot_sql("loans", "snap"),
    _snapshot_sql("(SELECT * FROM loans WHERE vintage_year >= 1998)", "snap_cur"),
    _snapshot_sql("(SELECT * FROM loans WHERE coalesce(vintage_year < 1998, true))", "snap_base"),
)

def _drift_cte(current: str, baseline: str) -> str:
    return f"""
drift AS (
  SELECT coalesce(c.column, b.column) AS column,
    CASE WHEN c.column IS NOT NULL THEN c.value ELSE b.value END AS value,
    coalesce(c.pct, 0.0) AS current_pct,
    coalesce(b.pct, 0.0) AS baseline_pct,
    (CAST(round(coalesce(c.pct, 0.0) * 100) AS BIGINT)
      - CAST(round(coalesce(b.pct, 0.0) * 100) AS BIGINT)) / 100 AS shift_pct,
    abs(CAST(round(coalesce(c.pct, 0.0) * 100) AS BIGINT)
      - CAST(round(coalesce(b.pct, 0.0) * 100) AS BIGINT)) >= 200.0 AS flagged
  FROM {current} c FULL OUTER JOIN {baseline} b
    ON c.column = b.column AND c.value IS NOT DISTINCT FROM b.value
)"""

_ROW_COUNTS_CTE = f"""
rc_counts AS (
  SELECT (SELECT count(*) FROM raw) AS raw_row_count,
         (SELECT count(*) FROM loans) AS checkpoint_row_count
),
row_counts AS (
  SELECT raw_row_count, checkpoint_row_count,
    checkpoint_row_count - raw_row_count AS row_count_delta,
    CASE WHEN checkpoint_row_count - raw_row_count < 0
         THEN -({_pct('abs(checkpoint_row_count - raw_row_count)', 'raw_row_count')})
         ELSE {_pct('abs(checkpoint_row_count - raw_row_count)', 'raw_row_count')} END
      AS row_count_delta_pct
  FROM rc_counts
)"""

_OUTPUT_COUNTS_CTE = f"""
ratio_table AS (
  {_ratio_sql('loans', rules.NPL_DIMENSIONS)}
),
curve_table AS (
  {_CURVE}
),
output_counts AS (
  SELECT 'npl_ratio_row_count' AS metric, count(*) AS row_count FROM ratio_table
  UNION ALL
  SELECT 'vintage_curve_row_count' AS metric, count(*) AS row_count FROM curve_table
)"""


def _null_rates_cte() -> str:
    parts = "\n  UNION ALL ".join(
        f"SELECT '{c}' AS column, count(*) FILTER (WHERE {c} IS NULL) AS null_count, "
        f"count(*) AS total FROM loans"
        for c in rules.NULL_CHECK_COLUMNS
    )
    return f"""
null_counts AS (
  {parts}
),
null_rates AS (
  SELECT column, null_count, {_pct('null_count', 'total')} AS null_pct FROM null_counts
)"""


def _fill_sql(columns, block_of=None) -> str:
    parts = []
    for c in columns:
        block = f"'{block_of[c]}' AS block, " if block_of else ""
        parts.append(
            f"SELECT {block}'{c}' AS column, count(*) AS total_rows, "
            f"count({c}) AS non_null_count FROM cleaned"
        )
    body = "\nUNION ALL\n".join(parts)
    key = "block, column" if block_of else "column"
    return f"""SELECT {key}, total_rows, non_null_count,
  total_rows - non_null_count AS null_count,
  CASE WHEN total_rows > 0 THEN non_null_count / total_rows ELSE 0.0 END AS fill_rate
FROM (
{body}
) t"""


def _dataset_profile_sql() -> str:
    parts = []
    for i, c in enumerate(lv.RAW_COLUMNS):
        t = "bigint" if c == "id" else "string"
        parts.append(
            f"SELECT {i + 1} AS ordinal, '{c}' AS column, '{t}' AS data_type, "
            f"count(*) AS rows, count({c}) AS non_null FROM raw"
        )
    return "\nUNION ALL\n".join(parts)


def _report_sql(drift_part: str) -> str:
    return _with(*_SNAPSHOTS, _drift_cte("snap", "snap_base"), _ROW_COUNTS_CTE, _OUTPUT_COUNTS_CTE, _null_rates_cte()) + """
SELECT 'row_counts' AS section, CAST(NULL AS VARCHAR) AS column, CAST(NULL AS VARCHAR) AS value,
  metric, number, CAST(NULL AS VARCHAR) AS note
FROM (
  SELECT 'raw_row_count' AS metric, CAST(raw_row_count AS DOUBLE) AS number FROM row_counts
  UNION ALL SELECT 'checkpoint_row_count', CAST(checkpoint_row_count AS DOUBLE) FROM row_counts
  UNION ALL SELECT 'row_count_delta', CAST(row_count_delta AS DOUBLE) FROM row_counts
  UNION ALL SELECT 'row_count_delta_pct', CAST(row_count_delta_pct AS DOUBLE) FROM row_counts
) r
UNION ALL
SELECT 'output_counts', NULL, NULL, metric, CAST(row_count AS DOUBLE), NULL FROM output_counts
UNION ALL
SELECT 'null_rates', column, NULL, 'null_pct', CAST(null_pct AS DOUBLE), NULL FROM null_rates
UNION ALL
SELECT 'distribution', column, value, 'pct', CAST(pct AS DOUBLE), NULL FROM snap
UNION ALL
SELECT 'distribution', column, value, 'rank', CAST(row_number() OVER (
  PARTITION BY column ORDER BY row_count DESC, value ASC NULLS FIRST) AS DOUBLE), NULL FROM snap
""" + drift_part


_DRIFT_PART = """UNION ALL
SELECT 'drift', column, value, 'baseline_pct', CAST(baseline_pct AS DOUBLE), NULL FROM drift WHERE flagged
UNION ALL
SELECT 'drift', column, value, 'current_pct', CAST(current_pct AS DOUBLE), NULL FROM drift WHERE flagged
UNION ALL
SELECT 'drift', column, value, 'shift_pct', CAST(shift_pct AS DOUBLE), NULL FROM drift WHERE flagged
UNION ALL
SELECT 'drift', NULL, NULL, 'status', NULL, 'All shares moved less than the threshold.'
FROM (SELECT count(*) FILTER (WHERE flagged) AS n FROM drift) WHERE n = 0
"""
_STORED_PART = """UNION ALL
SELECT 'stored_baseline', column, value, 'pct', CAST(pct AS DOUBLE), NULL FROM snap
"""


def _note(text: str) -> str:
    return f"UNION ALL SELECT 'drift', NULL, NULL, 'status', NULL, '{text}'\n"


_ALIGNED = "coalesce(regexp_full_match(addr_state, '[A-Z]{2}'), false)"
_DOMAIN = ", ".join(f"'{p}'" for p in lv.PURPOSE_DOMAIN)

_QUOTE_COLUMN = re.compile(r'(?<!["\w])column(?!["\w])')


# The rows that P1 accepts, and the rows that are dropped as misaligned before the check.
_KNOWN = f"(purpose IN ({_DOMAIN}) OR purpose IS NULL OR NOT {_ALIGNED})"


# The rows that P1 accepts, with the stage that removes them.
_REMOVED_CTE = f"""
removed AS (
  SELECT *, CASE WHEN NOT {_ALIGNED} THEN 'drop_shifted_rows'
    WHEN NOT coalesce(loan_status IN ('Fully Paid', 'Charged Off'), false) THEN 'label_target' END AS removed_by
  FROM cleaned WHERE {_KNOWN}
)"""


def _metrics_sql() -> str:
    parts = ["SELECT 'rows' AS kind, '' AS column, '' AS value, count(*) AS row_count FROM loans HAVING count(*) > 0"]
    parts += [
        f"SELECT 'nulls', '{c}', CASE WHEN {c} IS NULL THEN 'null' ELSE '' END, count(*) FROM loans GROUP BY {c} IS NULL"
        for c in rules.NULL_CHECK_COLUMNS
    ]
    parts += [
        f"SELECT 'values', '{c}', CAST({c} AS VARCHAR), count(*) FROM loans GROUP BY {c}"
        for c in rules.DISTRIBUTION_COLUMNS
    ]
    return "\nUNION ALL\n".join(parts)


def _stats_sql(source: str) -> str:
    return f"""SELECT count(*) AS raw_rows,
  CAST(NULL AS BIGINT) AS malformed_rows,
  count(*) FILTER (WHERE {_ALIGNED}) AS aligned_rows,
  count(*) FILTER (WHERE {_ALIGNED} AND loan_status IN ('Fully Paid', 'Charged Off')) AS labelled_rows,
  count(*) FILTER (WHERE {_ALIGNED} AND NOT purpose IN ({_DOMAIN})) AS domain_violations,
  count(*) FILTER (WHERE NOT regexp_full_match(addr_state, '[A-Z]{{2}}')) AS pattern_violations,
  {len(lv.RAW_COLUMNS) - 1} AS raw_columns
FROM {source}"""


def _oracles() -> dict[str, str]:
    w = _with()
    known = _with(f"known AS (SELECT * FROM loans WHERE purpose IN ({_DOMAIN}) OR purpose IS NULL)")
    ratio_dims = _ratio_sql("loans", rules.NPL_DIMENSIONS)
    fill_cols = FILL_COLUMNS
    block_of = {c: b for b, cols in lv.SPARSE_BLOCKS.items() for c in cols}
    return {
        "clean_term": w
        + "SELECT id, grade, addr_state, purpose, loan_status, term_months FROM cleaned",
        "preview_first_loans": w
        + "SELECT id, term_months, grade FROM cleaned ORDER BY id LIMIT 10",
        "clean_dates": w + "SELECT id, issue_d, last_pymnt_d FROM cleaned",
        "clean_sparse": w
        + "SELECT id, hardship_amount, settlement_amount, annual_inc_joint, "
        "hardship_start_date, settlement_date, sec_app_earliest_cr_line FROM cleaned",
        "shifted_rows_kept": w + "SELECT id, addr_state FROM aligned",
        "shifted_rows_rejected": w
        + "SELECT id, addr_state, purpose, loan_status FROM cleaned "
        "WHERE NOT coalesce(regexp_full_match(addr_state, '[A-Z]{2}'), false)",
        "category_violations": w
        + """SELECT 'domain' AS "check", 'purpose' AS column,
  count(*) FILTER (WHERE NOT purpose IN ('automobile', 'building', 'furniture', 'household', 'machinery')) AS violations
FROM aligned
UNION ALL
SELECT 'pattern', 'addr_state', count(*) FILTER (WHERE NOT regexp_full_match(addr_state, '[A-Z]{2}'))
FROM aligned""",
        "label_target": w + "SELECT id, loan_status, is_default FROM labelled",
        "label_distribution": w
        + "SELECT is_default, count(*) AS row_count FROM loans GROUP BY is_default",
        "loan_features": w
        + "SELECT id, is_default, vintage_year, loan_age_months, term_months, dti, "
        "dti_bucket, has_prior_delinquency FROM loans",
        "bad_rate_by_grade": w
        + "SELECT 'grade' AS dimension, grade AS dimension_value, "
        "CAST(sum(is_default) AS BIGINT) AS default_count, count(*) AS total_count, "
        "CAST(sum(is_default) AS BIGINT) / count(*) AS npl_ratio FROM loans GROUP BY grade",
        "bad_rate_by_dimension": w + ratio_dims,
        "default_rate_curve": w + _CURVE,
        "status_profile": w
        + f"""SELECT loan_status, "count", {_pct('"count"', 't')} AS pct
FROM (SELECT loan_status, count(*) AS "count", sum(count(*)) OVER () AS t
      FROM cleaned GROUP BY loan_status) g""",
        "value_counts": w
        + "SELECT purpose, count(*) AS row_count FROM profiled GROUP BY purpose",
        "top_values": w
        + """SELECT column, value, row_count, CAST(rank AS INTEGER) AS rank,
  CAST(count(*) FILTER (WHERE rank > 10) OVER (PARTITION BY column) AS BIGINT) AS other_values,
  CAST(coalesce(sum(row_count) FILTER (WHERE rank > 10) OVER (PARTITION BY column), 0) AS BIGINT) AS other_rows
FROM (
  SELECT column, value, row_count,
    row_number() OVER (PARTITION BY column ORDER BY row_count DESC, value ASC NULLS FIRST) AS rank
  FROM (
    SELECT column, value, count(*) AS row_count FROM (
      SELECT 'purpose' AS column, purpose AS value FROM profiled
      UNION ALL SELECT 'addr_state', addr_state FROM profiled
    ) u GROUP BY column, value
  ) g
) r QUALIFY rank <= 10""",
        "fill_rates": w + _fill_sql(fill_cols),
        "sparse_block_fill": w + _fill_sql(list(block_of), block_of),
        "dataset_profile": w + _dataset_profile_sql(),
        "batch_stats": w + _stats_sql("cleaned"),
        "row_count_delta": _with(_ROW_COUNTS_CTE) + "SELECT * FROM row_counts",
        "stage_funnel": w
        + f"""SELECT step, stage, rows_before, rows_after, rows_before - rows_after AS rows_removed,
  {len(lv.RAW_COLUMNS) - 1} AS raw_columns
FROM (
  SELECT 1 AS step, 'drop_shifted_rows' AS stage, count(*) AS rows_before,
    count(*) FILTER (WHERE regexp_full_match(addr_state, '[A-Z]{{2}}')) AS rows_after
  FROM raw
  UNION ALL
  SELECT 2, 'label_target',
    count(*) FILTER (WHERE regexp_full_match(addr_state, '[A-Z]{{2}}')),
    count(*) FILTER (WHERE regexp_full_match(addr_state, '[A-Z]{{2}}')
                       AND loan_status IN ('Fully Paid', 'Charged Off'))
  FROM raw
) s""",
        "null_rates": _with(_null_rates_cte()) + "SELECT * FROM null_rates",
        "distribution": _with(_SNAPSHOTS[0]) + "SELECT * FROM snap",
        "drift": _with(*_SNAPSHOTS[1:], _drift_cte("snap_cur", "snap_base")) + "SELECT * FROM drift",
        "output_counts": _with(_OUTPUT_COUNTS_CTE) + "SELECT * FROM output_counts",
        "output_gate": _with(_OUTPUT_COUNTS_CTE)
        + "SELECT metric, row_count, row_count > 0 AS passed FROM output_counts "
        "UNION ALL SELECT 'nothing_row_count', 0, false",
        "quality_report_rows": _report_sql(_DRIFT_PART),
        "quality_first_run": _report_sql(
            _note("There was nothing to compare with: the shares of this run become the baseline.")
            + _STORED_PART
        ),
        "quality_refresh": _report_sql(
            _DRIFT_PART
            + _note("The baseline was replaced by the shares of this run after the comparison.")
            + _STORED_PART
        ),
        "batch_ratio": known + _ratio_sql("known", rules.NPL_DIMENSIONS),
        "batch_curve": known + _CURVE.replace("FROM loans", "FROM known"),
        "batch_stats_saved": w + _stats_sql(f"(SELECT * FROM cleaned WHERE {_KNOWN})"),
        "category_violations_raw": w
        + "\nUNION ALL\n".join(
            f"SELECT '{check}' AS \"check\", '{c}' AS column, "
            f"count(*) FILTER (WHERE coalesce(NOT {ok}, {nulls})) AS violations, "
            f"{nulls} AS nulls_invalid FROM cleaned"
            for nulls in ("false", "true")
            for check, c, ok in (
                ("domain", "purpose", f"(purpose IN ({_DOMAIN}))"),
                ("pattern", "addr_state", "regexp_full_match(addr_state, '[A-Z]{2}')"),
            )
        ),
        "loan_age_days": """WITH shipped AS (
  SELECT l_orderkey, CAST(max(l_shipdate) AS DATE) AS b FROM lineitem GROUP BY l_orderkey
),
days AS (
  SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS a, b
  FROM orders LEFT JOIN shipped ON l_orderkey = o_orderkey
),
aged AS (
  SELECT id, (year(b) - year(a)) * 12 + month(b) - month(a)
    + CASE WHEN day(a) = day(b) OR (a = last_day(a) AND b = last_day(b)) THEN 0.0::DOUBLE
           ELSE (day(b) - day(a)) / 31.0::DOUBLE END AS months
  FROM days
)
SELECT id, round(months, 8) AS loan_age_months, CAST(floor(round(months, 8)) AS BIGINT) AS age_cell
FROM aged""",
        "csv_source_by_name": w
        + "SELECT id, grade, addr_state, try_cast(dti AS DOUBLE) AS dti FROM raw",
        "value_profile": w
        + """SELECT column, value, count(*) AS row_count FROM (
  SELECT 'branch' AS column, CAST(id % 499 AS VARCHAR) AS value FROM profiled
  UNION ALL SELECT 'addr_state', addr_state FROM profiled
) u GROUP BY column, value""",
        "batch_rejected_rows": _with(_REMOVED_CTE)
        + "SELECT id, removed_by, addr_state, purpose, loan_status FROM removed WHERE removed_by IS NOT NULL",
        "batch_row_audit": _with(_REMOVED_CTE)
        + """SELECT CAST(step AS INTEGER) AS step, stage, n AS rows_counted, n AS rows_found, true AS ties_out FROM (
  SELECT 1 AS step, 'drop_shifted_rows' AS stage, count(*) FILTER (WHERE removed_by = 'drop_shifted_rows') AS n FROM removed
  UNION ALL SELECT 2, 'label_target', count(*) FILTER (WHERE removed_by = 'label_target') FROM removed
  UNION ALL SELECT 3, 'kept', count(*) FILTER (WHERE removed_by IS NULL) FROM removed
  UNION ALL SELECT 4, 'raw', count(*) FROM removed
) s""",
        "csv_malformed_lines": _with(_REMOVED_CTE)
        + f"""SELECT CAST(id AS VARCHAR) AS id,
  CAST(CASE WHEN id % 37 = 0 THEN {len(lv.RAW_COLUMNS) + 1} ELSE {len(lv.RAW_COLUMNS) - 2} END AS INTEGER) AS n_fields,
  true AS has_file, 'wrong number of fields' AS reason, removed_by
FROM removed WHERE id % 37 = 0 OR id % 41 = 0""",
        "catalog_outputs": _with(_OUTPUT_COUNTS_CTE) + "SELECT * FROM output_counts",
        "checkpoint_metrics": w + _metrics_sql(),
        "checkpoint_roundtrip": w + _CURVE,
        "csv_source_ratio": w + ratio_dims,
    }


# --- driver API ----------------------------------------------------------------


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: bad rate by grade, state, purpose and vintage on sf0.001."""
    return q_bad_rate_by_dimension(spark, SMOKE_DIR)


def _training_data() -> tuple[dict, dict]:
    """Queries and SQL of the training-data operators, and their pipeline; empty
    where the optional subpackage is not installed."""
    found, sql = {}, {}
    try:
        from loanframe.llm import queries as llm_queries
    except ImportError:
        return found, sql
    found |= llm_queries.QUERIES
    sql |= llm_queries.ORACLES
    try:
        import corpus_pipeline
    except ImportError:
        return found, sql
    found["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        sql["pipeline"] = corpus_pipeline.ORACLE_SQL
    return found, sql


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return QUERIES | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    # "column" is a reserved word in DuckDB: quote it as an identifier.
    own = {k: _QUOTE_COLUMN.sub('"column"', v) for k, v in _oracles().items()}
    return own | _training_data()[1]
