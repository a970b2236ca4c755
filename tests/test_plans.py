import pyspark.sql.functions as F
import pytest

from loanframe.plans import run_batch, run_profiling, run_quality
from loanframe.sources import loan_view, read_raw_csv, write_csv
from loanframe.sources import tpch_loans as lv

SF = "/root/testdata/sf0.001"
VIEW_RULES = dict(date_columns=lv.DATE_COLUMNS, numeric_sparse=lv.NUMERIC_SPARSE, date_sparse=lv.DATE_SPARSE)


@pytest.fixture(scope="module")
def raw_csv(spark):
    from loanframe.sources import scratch_path

    text = loan_view(spark, SF).withColumn("id", F.col("id").cast("string"))
    return write_csv(text, scratch_path(spark, "raw"))


def _raw(spark, path):
    return read_raw_csv(spark, path, columns=lv.RAW_COLUMNS)


def test_batch_raises_on_bad_categories_before_writing(spark, raw_csv, tmp_out):
    ckpt = tmp_out("ckpt")
    with pytest.raises(ValueError, match="purpose"):
        run_batch(spark, _raw(spark, raw_csv), ckpt, tmp_out("ratio"), tmp_out("curve"),
                  purposes=lv.PURPOSE_DOMAIN, **VIEW_RULES)
    from loanframe.sources import load_baseline

    assert load_baseline(spark, ckpt) is None  # nothing written


def _batch(spark, raw_csv, tmp_out):
    raw = _raw(spark, raw_csv).filter(F.coalesce(F.col("purpose") != "bogus", F.lit(True)))
    return run_batch(spark, raw, tmp_out("ckpt"), tmp_out("ratio"), tmp_out("curve"),
                     purposes=lv.PURPOSE_DOMAIN, **VIEW_RULES)


def test_batch_end_to_end(spark, raw_csv, tmp_out):
    res = _batch(spark, raw_csv, tmp_out)
    ckpt = res.checkpoint
    assert {"is_default", "vintage_year", "loan_age_months", "dti_bucket", "has_prior_delinquency",
            "term_months"} <= set(ckpt.columns)
    assert "member_id" not in ckpt.columns and "term" not in ckpt.columns
    n = ckpt.count()
    assert n > 0
    totals = {r[0]: r[1] for r in res.npl_ratio.groupBy("dimension").sum("total_count").collect()}
    assert totals == {d: n for d in ("grade", "addr_state", "purpose", "vintage_year")}
    assert res.default_rate_curve.agg(F.sum("total_count")).first()[0] == n


def test_quality_first_run_saves_baseline_second_compares(spark, raw_csv, tmp_out):
    res = _batch(spark, raw_csv, tmp_out)
    raw = _raw(spark, raw_csv)
    outputs = {"npl_ratio": res.npl_ratio, "vintage_curve": res.default_rate_curve}
    base = tmp_out("baseline")
    first = run_quality(spark, raw, res.checkpoint, outputs, base)
    assert first.baseline_saved and first.drift is None
    notes = [r.note for r in first.report.filter("section = 'drift'").collect()]
    assert len(notes) == 1 and "nothing to compare" in notes[0]
    second = run_quality(spark, raw, res.checkpoint, outputs, base)
    assert not second.baseline_saved
    assert second.drift.filter("flagged").count() == 0
    rc = second.row_counts.first()
    assert rc.raw_row_count == raw.count() and rc.checkpoint_row_count == res.checkpoint.count()


def test_quality_refresh_replaces_the_baseline(spark, raw_csv, tmp_out):
    res = _batch(spark, raw_csv, tmp_out)
    outputs = {"npl_ratio": res.npl_ratio, "vintage_curve": res.default_rate_curve}
    base = tmp_out("baseline")
    old = res.checkpoint.filter(F.col("vintage_year") < 1998)
    first = run_quality(spark, None, old, outputs, base, batch_stats=res.stats)
    assert first.baseline_saved
    drifted = run_quality(spark, None, res.checkpoint, outputs, base, batch_stats=res.stats)
    order = ["column", "value"]
    shifts = drifted.drift.orderBy(*order).collect()
    assert not drifted.baseline_saved and any(r.flagged for r in shifts)
    refreshed = run_quality(spark, None, res.checkpoint, outputs, base, batch_stats=res.stats,
                            refresh_baseline=True)
    assert refreshed.baseline_saved
    assert refreshed.drift.orderBy(*order).collect() == shifts
    told = [r.note for r in refreshed.report.filter("section = 'drift' and note is not null").collect()]
    assert any("replaced" in n for n in told)
    again = run_quality(spark, None, res.checkpoint, outputs, base, batch_stats=res.stats)
    assert again.drift.filter("flagged").count() == 0


def test_quality_from_batch_stats_skips_raw(spark, raw_csv, tmp_out):
    raw = _raw(spark, raw_csv).filter(F.coalesce(F.col("purpose") != "bogus", F.lit(True)))
    stats_path = tmp_out("stats")
    res = run_batch(spark, raw, tmp_out("ckpt"), tmp_out("ratio"), tmp_out("curve"),
                    purposes=lv.PURPOSE_DOMAIN, stats_path=stats_path, **VIEW_RULES)
    s = res.stats.first()
    assert s.raw_rows == raw.count() and s.labelled_rows == res.checkpoint.count()
    outputs = {"npl_ratio": res.npl_ratio, "vintage_curve": res.default_rate_curve}
    with_raw = run_quality(spark, raw, res.checkpoint, outputs).row_counts.first()
    from_stats = run_quality(spark, None, res.checkpoint, outputs,
                             batch_stats=spark.read.parquet(stats_path)).row_counts.first()
    assert tuple(with_raw) == tuple(from_stats)
    with pytest.raises(ValueError):
        run_quality(spark, None, res.checkpoint, outputs)


def test_batch_outputs_as_catalog_tables_and_other_formats(spark, raw_csv, tmp_out):
    raw = _raw(spark, raw_csv).filter(F.coalesce(F.col("purpose") != "bogus", F.lit(True)))
    names = ("loanframe_ratio_t", "loanframe_curve_t")
    try:
        res = run_batch(spark, raw, tmp_out("ckpt"), names[0], names[1], purposes=lv.PURPOSE_DOMAIN,
                        as_tables=True, **VIEW_RULES)
        assert spark.table(names[0]).count() == res.npl_ratio.count() > 0
        assert spark.table(names[1]).count() == res.default_rate_curve.count() > 0
    finally:
        for n in names:
            spark.sql(f"DROP TABLE IF EXISTS {n}")
    res = run_batch(spark, raw, tmp_out("ckpt"), tmp_out("ratio"), tmp_out("curve"), purposes=lv.PURPOSE_DOMAIN,
                    output_format="json", **VIEW_RULES)
    assert res.npl_ratio.count() > 0 and "npl_ratio" in res.npl_ratio.columns


def test_profiling(spark, raw_csv):
    raw = _raw(spark, raw_csv).withColumn("branch", (F.col("id") % 97).cast("int").cast("string"))
    whole = run_profiling(raw, ["branch", "addr_state"], **VIEW_RULES)
    assert whole.columns == ["column", "value", "row_count"]
    n = whole.filter("column = 'branch'").count()
    assert n > 60
    top = run_profiling(raw, ["branch", "addr_state"], k=5, **VIEW_RULES).filter("column = 'branch'").collect()
    assert len(top) == 5 and {r.other_values for r in top} == {n - 5}


def test_an_empty_checkpoint_is_no_baseline(spark, raw_csv, tmp_out):
    res = _batch(spark, raw_csv, tmp_out)
    base = tmp_out("baseline")
    out = run_quality(spark, None, res.checkpoint.limit(0), {}, base, batch_stats=res.stats)
    assert not out.baseline_saved and out.drift is None
    from loanframe.sources import load_baseline

    assert load_baseline(spark, base) is None


def test_saved_and_returned_stats_have_one_schema(spark, raw_csv, tmp_out):
    raw = _raw(spark, raw_csv).filter(F.coalesce(F.col("purpose") != "bogus", F.lit(True)))
    path = tmp_out("stats")
    args = (tmp_out("ckpt"), tmp_out("ratio"), tmp_out("curve"))
    saved = run_batch(spark, raw, *args, purposes=lv.PURPOSE_DOMAIN, stats_path=path, **VIEW_RULES)
    kept = run_batch(spark, raw, *args, purposes=lv.PURPOSE_DOMAIN, **VIEW_RULES)
    assert spark.read.parquet(path).dtypes == saved.stats.dtypes == kept.stats.dtypes
    assert dict(saved.checkpoint.dtypes)["id"] == "bigint"
