"""Profiles against plain Python on generated rows."""

import random
from collections import Counter
from decimal import ROUND_HALF_UP, Decimal

import pytest

from loanframe import rules
from loanframe.operators import (
    dataset_profile,
    fill_rates,
    null_rates,
    sample_rows,
    sparse_block_fill,
    status_profile,
    top_values,
    value_counts,
    value_profile,
)


def pct(n, total):
    return float((Decimal(n) * 100 / Decimal(total)).quantize(Decimal("0.01"), ROUND_HALF_UP))


def by_count(counts):
    return sorted(counts.items(), key=lambda x: (-x[1], x[0] is not None, x[0] or ""))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(41)
    return [(r.choice(["oak", "elm", "ash", None]), f"s{int(r.paretovariate(0.5)) % 190}") for _ in range(640)]


@pytest.fixture(scope="module")
def trees(spark, rows):
    return spark.createDataFrame(rows, "wood string, site string")


# A4, A5
def test_shares_and_counts_are_ordered(trees, rows):
    want = by_count(Counter(r[0] for r in rows))
    assert [tuple(r) for r in status_profile(trees, "wood").collect()] == [(v, n, pct(n, len(rows))) for v, n in want]
    assert [tuple(r) for r in value_counts(trees, "site").collect()] == by_count(Counter(r[1] for r in rows))


@pytest.mark.parametrize("n, total", [(1, 32), (5, 32), (1, 800), (3, 800), (2, 3)])
def test_shares_round_half_up(spark, n, total):
    df = spark.range(total).selectExpr(f"if(id < {n}, 'few', 'rest') AS k")
    assert {r.k: r.pct for r in status_profile(df, "k").collect()} == {"few": pct(n, total), "rest": pct(total - n, total)}


# A6
def test_profile_has_every_value(trees, rows):
    out = [tuple(r) for r in value_profile(trees, ["site", "wood"]).collect()]
    assert out == [(c, v, n) for c, at in (("site", 1), ("wood", 0)) for v, n in by_count(Counter(r[at] for r in rows))]
    assert len(out) > 65


def test_top_values_tell_what_they_leave_out(trees, rows):
    counts = by_count(Counter(r[1] for r in rows))
    out = top_values(trees, ["site", "wood"], 3).filter("column = 'site'").orderBy("rank").collect()
    assert [(r.value, r.row_count, r["rank"]) for r in out] == [(v, n, i + 1) for i, (v, n) in enumerate(counts[:3])]
    assert {(r.other_values, r.other_rows) for r in out} == {(len(counts) - 3, sum(n for _, n in counts[3:]))}
    whole = top_values(trees, ["wood"], 99).collect()
    assert {(r.other_values, r.other_rows) for r in whole} == {(0, 0)} and len(whole) == 4


@pytest.mark.parametrize("f", [lambda d: top_values(d, ["bark"], 1), lambda d: value_profile(d, ["bark"]), lambda d: fill_rates(d, ["bark"])])
def test_absent_columns_are_named(trees, f):
    with pytest.raises(ValueError, match="bark"):
        f(trees)


# A7
def test_fill_rates(trees, rows):
    n = sum(r[0] is not None for r in rows)
    assert [tuple(r) for r in fill_rates(trees, ["wood", "site"]).collect()] == [
        ("site", 640, 640, 0, 1.0), ("wood", 640, n, 640 - n, n / 640)]
    assert [r.fill_rate for r in fill_rates(trees.limit(0), ["wood"]).collect()] == [0.0]


# A8
def test_blocks(spark):
    df = spark.createDataFrame([("1", None, None), (None, None, "z")], "a string, b string, c string")
    got = {(r.block, r.column): r.non_null_count for r in sparse_block_fill(df, {"p": ("a", "b"), "q": ("c",)}).collect()}
    assert got == {("p", "a"): 1, ("p", "b"): 0, ("q", "c"): 1}
    assert sum(map(len, rules.SPARSE_BLOCKS.values())) == len({c for b in rules.SPARSE_BLOCKS.values() for c in b})


# S2
def test_dataset_profile_and_odd_names(spark):
    df = spark.createDataFrame([(None, 1.5, "u"), (4, None, "v"), (5, 2.5, None)], "n int, `p.q` double, `r s` string")
    assert [tuple(r) for r in dataset_profile(df).collect()] == [
        (1, "n", "int", 3, 2), (2, "p.q", "double", 3, 2), (3, "r s", "string", 3, 2)]
    assert {r.column: r.null_count for r in null_rates(df, ["p.q", "r s"]).collect()} == {"p.q": 1, "r s": 1}
    assert {r.column: r.non_null_count for r in fill_rates(df, ["p.q", "r s"]).collect()} == {"p.q": 2, "r s": 2}
    assert sample_rows(df, 2).count() == 2
