"""Physical-plan properties the operators are designed for (read from explain)."""

import re

import pytest

import __spark_entry__ as E
from loanframe.operators import (
    distribution_snapshot,
    label_target,
    npl_ratio_by_dimensions,
    status_profile,
    top_values,
)
from loanframe.sources import read_checkpoint, scratch_path, write_checkpoint

SF = "/root/testdata/sf0.001"


def plan(df, capsys, mode="formatted"):
    capsys.readouterr()
    df.explain(mode=mode)
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def checkpoint(spark):
    path = write_checkpoint(E._loans(spark, SF), scratch_path(spark, "plan-ckpt"))
    return read_checkpoint(spark, path)


def test_ratio_table_is_one_scan_one_shuffle(checkpoint, capsys):
    p = plan(npl_ratio_by_dimensions(checkpoint), capsys)
    assert len(re.findall(r"^\(\d+\) Scan parquet", p, re.M)) == 1
    assert len(re.findall(r"^\(\d+\) Exchange", p, re.M)) == 1
    assert "Expand" in p
    assert "partial_sum" in p  # map-side combine before the shuffle
    # only the five needed columns are read from the checkpoint
    [schema] = re.findall(r"ReadSchema: (struct<[^\n]*>)", p)
    assert set(re.findall(r"(\w+):", schema)) == {"grade", "addr_state", "purpose", "vintage_year", "is_default"}


def test_snapshot_total_reuses_the_shuffle(checkpoint, capsys):
    for df in (distribution_snapshot(checkpoint), status_profile(checkpoint, "grade")):
        df.collect()
        p = plan(df, capsys, "simple")
        assert "isFinalPlan=true" in p
        assert "ReusedExchange" in p
        # one scan executed: only executed scans sit under ColumnarToRow
        assert p.count("ColumnarToRow") == 1


def test_top_values_ranks_without_a_window(checkpoint, capsys):
    # Ranks come from sorted ranges that are written: no task sorts a column's values.
    p = plan(top_values(checkpoint, ["purpose", "addr_state"], 60), capsys, "simple")
    assert "Window" not in p and "Sort [row_count" not in p


def test_status_filter_reaches_the_parquet_scan(checkpoint, capsys):
    p = plan(label_target(checkpoint.drop("is_default")), capsys, "simple")
    assert re.search(r"PushedFilters: \[[^\]]*In\(loan_status", p)


@pytest.mark.parametrize("name", sorted(E.QUERIES))
def test_no_python_udf_no_cartesian(spark, capsys, name):
    p = plan(E.queries()[name](spark, SF), capsys, "simple")
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"
