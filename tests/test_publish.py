"""The published batch job: one pass, all or nothing, every raw row accounted for."""

import os

import pytest
from pyspark.sql import functions as F

from loanframe import rules
from loanframe.operators import batch_stats, default_rate_curve, npl_ratio_by_dimensions
from loanframe.plans import (
    malformed_lines,
    prepare_loans,
    publish,
    publish_batch,
    read_release,
    rejected_rows,
    row_audit,
)
from loanframe.sources import loan_view, read_raw_csv
from loanframe.sources import tpch_loans as lv

SF = "/root/testdata/sf0.001"
VIEW_RULES = dict(date_columns=lv.DATE_COLUMNS, numeric_sparse=lv.NUMERIC_SPARSE, date_sparse=lv.DATE_SPARSE)


@pytest.fixture(scope="module")
def raw(spark):
    view = loan_view(spark, SF).filter(F.coalesce(F.col("purpose") != "bogus", F.lit(True)))
    return view.withColumn("id", F.col("id").cast("string")).cache()


def _publish(spark, raw, root, **kwargs):
    return publish_batch(spark, raw, root, purposes=lv.PURPOSE_DOMAIN, **VIEW_RULES, **kwargs)


def _rows(df):
    return sorted(map(str, df.collect()))


def _folders(root):
    path = root.removeprefix("file:")
    return sorted(f for f in os.listdir(path) if f.startswith("run-")) if os.path.isdir(path) else []


@pytest.mark.parametrize("partition_by", [None, ["vintage_year"]])
def test_a_release_holds_what_the_separate_steps_give(spark, raw, tmp_out, partition_by):
    root = tmp_out("release")
    assert read_release(spark, root) is None
    _publish(spark, raw, root, checkpoint_partition_by=partition_by)
    got, loans = read_release(spark, root), prepare_loans(raw, **VIEW_RULES)
    columns = sorted(loans.columns)
    assert sorted(got.checkpoint.columns) == columns
    assert _rows(got.checkpoint.select(columns)) == _rows(loans.select(columns))
    assert _rows(got.npl_ratio) == _rows(npl_ratio_by_dimensions(loans))
    assert _rows(got.default_rate_curve) == _rows(default_rate_curve(loans))
    assert _rows(got.stats) == _rows(batch_stats(raw.drop("member_id"), domain=lv.PURPOSE_DOMAIN))
    rejected = rejected_rows(spark, got.release)
    both = got.checkpoint.select("id").unionByName(rejected.select("id"))
    assert _rows(both) == _rows(raw.select(F.col("id").cast(both.schema["id"].dataType)))
    kinds = {r[0] for r in rejected.select("removed_by").distinct().collect()}
    assert kinds == {"drop_shifted_rows", "label_target"}
    audit = row_audit(spark, got.release).collect()
    assert [r.stage for r in sorted(audit)] == ["drop_shifted_rows", "label_target", "kept", "raw"]
    assert all(r.ties_out for r in audit) and malformed_lines(spark, got.release).count() == 0


def test_the_raw_rows_are_read_once(spark, raw, tmp_out):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(v):
        seen.add(1)
        return v

    text = raw.withColumn("addr_state", counted("addr_state"))
    _publish(spark, text, tmp_out("release"))
    assert seen.value == raw.count()


class Died(Exception):
    pass


@pytest.mark.parametrize("calls", [0, 1, 2])
def test_a_job_that_dies_leaves_the_release_before(spark, raw, tmp_out, monkeypatch, calls):
    root, write = tmp_out("release"), publish.write_table
    half = raw.filter(F.col("id").cast("int") % 2 == 0)
    _publish(spark, half, root)
    before = {k: _rows(getattr(read_release(spark, root), k)) for k in ("checkpoint", "npl_ratio", "default_rate_curve", "stats")}
    left = [calls]

    def dies(*args, **kwargs):
        if left[0] == 0:
            raise Died
        left[0] -= 1
        return write(*args, **kwargs)

    with monkeypatch.context() as m:
        m.setattr(publish, "write_table", dies)
        with pytest.raises(Died):
            _publish(spark, raw, root)
    old = read_release(spark, root)
    assert before == {k: _rows(getattr(old, k)) for k in before}
    _publish(spark, raw, root)
    new = read_release(spark, root)
    assert new.release.number == old.release.number + 1
    assert new.checkpoint.count() > old.checkpoint.count()
    # A reader that opened the old release goes on reading the old run, all of it.
    assert before == {k: _rows(getattr(old, k)) for k in before}


def test_bad_categories_and_empty_results_publish_nothing(spark, raw, tmp_out):
    root = tmp_out("release")
    with pytest.raises(ValueError, match="purpose"):
        _publish(spark, loan_view(spark, SF), root)
    with pytest.raises(ValueError, match="no resolved loan"):
        _publish(spark, raw.filter("loan_status = 'Current'"), root)
    with pytest.raises(ValueError, match="no resolved loan"):
        _publish(spark, raw.limit(0), root)
    with pytest.raises(ValueError, match="raw_line"):
        _publish(spark, raw.withColumn("RAW_LINE", F.lit(1)), root)
    assert read_release(spark, root) is None and _folders(root) == []


def test_all_rows_kept(spark, raw, tmp_out):
    good = raw.filter("addr_state rlike '^[A-Z]{2}$' and loan_status in ('Fully Paid', 'Charged Off')")
    res = _publish(spark, good, tmp_out("release"))
    assert rejected_rows(spark, res.release).count() == 0
    assert rejected_rows(spark, res.release).schema["removed_by"] is not None
    assert all(r.ties_out for r in row_audit(spark, res.release).collect())


def test_malformed_lines_are_kept_with_file_and_reason(spark, raw, tmp_out):
    folder = tmp_out("csv")
    ok = raw.filter("addr_state rlike '^[A-Z]{2}$' and loan_status = 'Fully Paid'").limit(3).collect()
    lines = [",".join("" if v is None else str(v) for v in r) for r in ok]
    bad = {lines[0] + ",surplus": None, lines[1].rsplit(",", 2)[0]: None, "77,,A": "drop_shifted_rows"}
    text = spark.createDataFrame([(x,) for x in [lines[2], *bad]], [",".join(raw.columns)])
    text.coalesce(1).write.option("header", True).option("sep", "\u0001").csv(folder)
    read = read_raw_csv(spark, folder, file_column=rules.FILE_COLUMN)
    res = _publish(spark, read, tmp_out("release"))
    got = malformed_lines(spark, res.release).collect()
    assert {r.raw_line: r.removed_by for r in got} == bad
    assert len(got) == res.stats.first().malformed_rows == 3
    assert {r.reason for r in got} == {"wrong number of fields"}
    assert all(folder.removeprefix("file:") in r.raw_file for r in got)
    assert res.checkpoint.count() == 3
