"""Cleaning steps on own cases, and against plain Python."""

import datetime as dt
import random
import re

import pytest

from loanframe import rules
from loanframe.operators import (
    cast_numbers,
    cast_sparse_numerics,
    clean_dates,
    clean_raw,
    clean_sparse,
    clean_term,
    drop_member_id,
    drop_shifted_rows,
    preview,
    split_shifted_rows,
)


def one_column(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


# C1
def test_drop_is_optional(spark):
    df = spark.range(2).selectExpr("id", "'q' AS code")
    assert drop_member_id(df, "code").columns == ["id"] == drop_member_id(df.drop("code"), "code").columns


# C2
def test_term_takes_the_first_number(spark):
    r = random.Random(8)
    texts = ["".join(r.choice("0123456789 abz-") for _ in range(r.randint(0, 9))) for _ in range(200)] + [None, "5" * 30]
    out = clean_term(one_column(spark, "span", texts), "span", "n")
    assert out.columns == ["n"] and dict(out.dtypes)["n"] == "int"

    def plain(t):
        m = re.search(r"\d+", t or "")
        return int(m[0]) if m and int(m[0]) < 1 << 31 else None

    assert [x.n for x in out.collect()] == [plain(t) for t in texts]


# C3
def test_dates_of_every_month_and_odd_text(spark):
    names = "Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split()
    good = {f" {m}-{1999 + i} ": dt.date(1999 + i, i + 1, 1) for i, m in enumerate(names)}
    odd = ["Abc-2001", "13-2001", "Jan 2001", "Jan-201", "Jan-20011", "1-Jan-2001", "Jan-2001\n", "", None]
    df = one_column(spark, "d", [*good, *odd])
    out = clean_dates(df, ["d"])
    assert dict(out.dtypes)["d"] == "date"
    assert [x.d for x in out.collect()] == [*good.values(), *[None] * len(odd)]
    with pytest.raises(ValueError, match="absent_one"):
        clean_dates(df, ["d", "absent_one"])


# C4, C5
def test_sparse_numbers_and_dates(spark):
    df = spark.createDataFrame([("7.25", "Jul-2003", "keep"), ("7,25", "July-2003", "it"), (None, None, None)], "n string, d string, s string")
    out = clean_sparse(df, ["n"], ["d"])
    assert out.dtypes == [("n", "double"), ("d", "date"), ("s", "string")]
    assert [tuple(r) for r in out.collect()] == [(7.25, dt.date(2003, 7, 1), "keep"), (None, None, "it"), (None, None, None)]
    assert [r.n for r in cast_sparse_numerics(df, ["n"]).collect()] == [7.25, None, None]
    with pytest.raises(ValueError, match="nowhere"):
        cast_sparse_numerics(df, ["nowhere"])


def test_numbers_are_typed_by_name(spark):
    df = spark.createDataFrame([("12", "3.5", "x"), ("twelve", "", None)], "id string, loan_amnt string, `a.b` string")
    out = cast_numbers(df)
    assert out.dtypes == [("id", "bigint"), ("loan_amnt", "double"), ("a.b", "string")]
    assert [tuple(r) for r in out.collect()] == [(12, 3.5, "x"), (None, None, None)]
    assert cast_numbers(df, {"a.b": "int"}).dtypes[2] == ("a.b", "int")
    assert cast_numbers(df, {"other": "int"}).dtypes == df.dtypes


def test_the_whole_cleaning_drops_what_only_the_reader_needs(spark):
    df = spark.createDataFrame([("1", None, " 7 months", None)], f"id string, member_id string, term string, {rules.CORRUPT_COLUMN} string")
    out = clean_raw(df, [], [], [])
    assert out.dtypes == [("id", "bigint"), ("term_months", "int")] and out.first() == (1, 7)


# C6
def test_rows_are_kept_or_rejected_by_the_pattern(spark):
    r = random.Random(9)
    codes = ["".join(r.choice("QZq9 ") for _ in range(r.randint(0, 4))) for _ in range(300)] + [None, "ZQ\n", "ÄÖ"]
    df = spark.createDataFrame(list(enumerate(codes)), "n int, code string")
    want = [i for i, c in enumerate(codes) if c is not None and re.fullmatch("[A-Z]{2}", c)]
    kept, rejected = split_shifted_rows(df, "code")
    assert [x.n for x in kept.collect()] == [x.n for x in drop_shifted_rows(df, "code").collect()] == want
    assert sorted(want + [x.n for x in rejected.collect()]) == list(range(len(codes)))


# C16
def test_preview_is_short(spark):
    out = preview(spark.range(37).selectExpr("id AS a", "id AS b"), ["b"], 4)
    assert out.columns == ["b"] and out.count() == 4
