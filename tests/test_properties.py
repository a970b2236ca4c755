"""Property tests: the column functions against plain-Python definitions.

Each example is a whole list of values evaluated in one Spark job, so a few
examples cover thousands of values.
"""

import datetime as dt
import re
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loanframe.functions import (
    first_int,
    half_up_pct,
    month_year_date,
    signed_half_up_pct,
    threshold_bucket,
)

SETTINGS = settings(max_examples=15, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def _pct(n, t):
    if t <= 0:
        return None
    return float((Decimal(n) * 100 / Decimal(t)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(0, 10**9)), min_size=1, max_size=300))
def test_half_up_pct_is_exact(spark, pairs):
    pairs = [(min(n, t), t) for n, t in pairs]
    df = spark.createDataFrame(pairs, "n bigint, t bigint")
    got = [r.p for r in df.select(half_up_pct("n", "t").alias("p")).collect()]
    assert got == [_pct(n, t) for n, t in pairs]


@SETTINGS
@given(st.lists(st.tuples(st.integers(-10**9, 10**9), st.integers(1, 10**9)), min_size=1, max_size=300))
def test_signed_half_up_pct(spark, pairs):
    df = spark.createDataFrame(pairs, "n bigint, t bigint")
    got = [r.p for r in df.select(signed_half_up_pct("n", "t").alias("p")).collect()]
    want = [(-1 if n < 0 else 1) * _pct(abs(n), t) for n, t in pairs]
    assert got == want


def _first_int(text):
    if text is None:
        return None
    m = re.search(r"[0-9]+", text)
    if not m:
        return None
    v = int(m.group(0))
    return v if v <= 2**31 - 1 else None


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.text(alphabet=" 0123456789abcmonths-", max_size=16)), min_size=1, max_size=300))
def test_first_int(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.v for r in df.select(first_int("t").alias("v")).collect()]
    assert got == [_first_int(t) for t in texts]


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.floats(allow_nan=True, allow_infinity=True, width=64)), min_size=1, max_size=300))
def test_threshold_bucket(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.b for r in df.select(threshold_bucket("x").alias("b")).collect()]

    def bucket(x):
        if x is None:
            return "Unknown"
        if x != x:  # NaN sorts above every number in Spark
            return "High"
        return "Low" if x < 20 else "Moderate" if x < 40 else "High"

    assert got == [bucket(v) for v in values]


def _month_year(text):
    if text is None:
        return None
    t = text.strip(" ")
    if not re.fullmatch(r"[A-Za-z]{3}-[0-9]{4}", t):
        return None
    mon = t[:3].lower()
    names = [m.lower() for m in MONTHS]
    if mon not in names:
        return None
    year = int(t[4:])
    if year == 0:
        return None
    return dt.date(year, names.index(mon) + 1, 1)


month_texts = st.one_of(
    st.none(),
    st.builds(
        lambda pre, m, y, post, case: pre + getattr(m, case)() + "-" + f"{y:04d}" + post,
        st.sampled_from(["", " ", "  ", "\t"]),
        st.sampled_from(MONTHS + ["Foo", "Sept", "Ja"]),
        st.integers(1, 9999),
        st.sampled_from(["", " ", "x"]),
        st.sampled_from(["title", "lower", "upper"]),
    ),
    st.text(max_size=10),
)


@SETTINGS
@given(st.lists(month_texts, min_size=1, max_size=300))
def test_month_year_date(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.d for r in df.select(month_year_date("t").alias("d")).collect()]
    assert got == [_month_year(t) for t in texts]


# --- whole operators against brute force on random rows ---------------------------

from collections import Counter  # noqa: E402

from loanframe.operators import (  # noqa: E402
    distribution_snapshot,
    drift,
    npl_ratio_by_dimensions,
    top_values,
)

cat = st.one_of(st.none(), st.sampled_from(["A", "B", "C", "D"]))
loan_rows = st.lists(
    st.tuples(cat, cat, st.one_of(st.none(), st.integers(2010, 2014)), st.integers(0, 1)),
    min_size=0,
    max_size=200,
)
LOAN_SCHEMA = "grade string, purpose string, vintage_year int, is_default int"


@SETTINGS
@given(loan_rows)
def test_snapshot_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, LOAN_SCHEMA)
    got = {(r.column, r.value): (r.row_count, r.pct) for r in distribution_snapshot(df, ["grade", "vintage_year"]).collect()}
    want = {}
    for i, col in enumerate(["grade", "purpose", "vintage_year"]):
        if col == "purpose":
            continue
        for v, n in Counter(r[i] for r in rows).items():
            want[(col, None if v is None else str(v))] = (n, _pct(n, len(rows)))
    assert got == want


@SETTINGS
@given(loan_rows)
def test_ratio_table_against_brute_force(spark, rows):
    df = spark.createDataFrame(rows, LOAN_SCHEMA)
    got = {
        (r.dimension, r.dimension_value): (r.default_count, r.total_count, r.npl_ratio)
        for r in npl_ratio_by_dimensions(df, ["grade", "purpose", "vintage_year"]).collect()
    }
    want = {}
    for i, col in enumerate(["grade", "purpose", "vintage_year"]):
        groups = {}
        for r in rows:
            key = None if r[i] is None else str(r[i])
            d, t = groups.get(key, (0, 0))
            groups[key] = (d + r[3], t + 1)
        for key, (d, t) in groups.items():
            want[(col, key)] = (d, t, d / t)
    assert got == want


@SETTINGS
@given(loan_rows, st.integers(1, 3))
def test_top_values_against_brute_force(spark, rows, k):
    df = spark.createDataFrame(rows, LOAN_SCHEMA)
    def nkey(t):
        return tuple((x is None, str(x)) for x in t)

    got = sorted(((r.column, r.value, r.row_count, r["rank"]) for r in top_values(df, ["grade", "purpose"], k).collect()), key=nkey)
    want = []
    for i, col in enumerate(["grade", "purpose"]):
        counts = Counter(r[i] for r in rows)
        ordered = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or ""))
        want += [(col, v, n, rank + 1) for rank, (v, n) in enumerate(ordered[:k])]
    assert got == sorted(want, key=nkey)


pct_values = st.integers(0, 10000).map(lambda h: h / 100)
snapshots = st.dictionaries(st.tuples(st.sampled_from(["grade", "purpose"]), cat), pct_values, max_size=8)


@SETTINGS
@given(snapshots, snapshots, st.sampled_from([0.5, 2.0, 5.0]))
def test_drift_against_brute_force(spark, current, baseline, threshold):
    schema = "column string, value string, pct double"
    cur = spark.createDataFrame([(c, v, p) for (c, v), p in current.items()], schema)
    base = spark.createDataFrame([(c, v, p) for (c, v), p in baseline.items()], schema)
    got = {(r.column, r.value): (r.current_pct, r.baseline_pct, r.shift_pct, r.flagged)
           for r in drift(cur, base, threshold).collect()}
    want = {}
    for key in set(current) | set(baseline):
        c, b = current.get(key, 0.0), baseline.get(key, 0.0)
        shift = (round(c * 100) - round(b * 100)) / 100
        want[key] = (c, b, shift, abs(shift) >= threshold)
    assert got == want


state_texts = st.one_of(
    st.none(),
    st.text(alphabet="ACNYca \n9x", max_size=4),
    st.sampled_from(["CA", "NY", "CA\n", "ca", "C", "CAL", "941xx", ""]),
)


@SETTINGS
@given(st.lists(state_texts, min_size=1, max_size=200))
def test_shifted_row_filter_against_brute_force(spark, states):
    from loanframe.operators import drop_shifted_rows

    df = spark.createDataFrame(list(enumerate(states)), "id bigint, addr_state string")
    kept = sorted(r.id for r in drop_shifted_rows(df).collect())
    want = [i for i, s in enumerate(states) if s is not None and re.fullmatch(r"[A-Z]{2}", s)]
    assert kept == want


purpose_texts = st.one_of(st.none(), st.sampled_from(["car", "house", "bogus", "", "CAR"]))


@SETTINGS
@given(st.lists(st.tuples(purpose_texts, state_texts), min_size=1, max_size=200), st.booleans())
def test_category_violations_against_brute_force(spark, rows, nulls_invalid):
    from loanframe.operators import category_violations

    df = spark.createDataFrame(rows, "purpose string, addr_state string")
    got = {r.check: r.violations for r in category_violations(
        df, domain=("car", "house"), nulls_invalid=nulls_invalid).collect()}

    def bad_domain(p):
        return nulls_invalid if p is None else p not in ("car", "house")

    def bad_pattern(s):
        return nulls_invalid if s is None else not re.fullmatch(r"[A-Z]{2}", s)

    assert got == {
        "domain": sum(bad_domain(p) for p, _ in rows),
        "pattern": sum(bad_pattern(s) for _, s in rows),
    }


import math  # noqa: E402

ages = st.one_of(st.none(), st.integers(-300, 3000).map(lambda a: a / 10))


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(2010, 2012)), ages, st.integers(0, 1)),
                min_size=0, max_size=200))
def test_default_rate_curve_against_brute_force(spark, rows):
    from loanframe.operators import default_rate_curve

    df = spark.createDataFrame(rows, "vintage_year int, loan_age_months double, is_default int")
    got = {(r.vintage_year, r.loan_age_months): (r.default_count, r.total_count, r.npl_ratio)
           for r in default_rate_curve(df).collect()}
    cells = {}
    for v, a, d in rows:
        key = (v, None if a is None else math.floor(a))
        dc, tc = cells.get(key, (0, 0))
        cells[key] = (dc + d, tc + 1)
    assert got == {k: (dc, tc, dc / tc) for k, (dc, tc) in cells.items()}


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(["Fully Paid", "Charged Off", "Current"])),
                min_size=1, max_size=200))
def test_status_profile_against_brute_force(spark, statuses):
    from loanframe.operators import status_profile

    df = spark.createDataFrame([(s,) for s in statuses], "loan_status string")
    got = [(r.loan_status, r["count"], r.pct) for r in status_profile(df).collect()]
    counts = Counter(statuses)
    ordered = sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or ""))
    assert got == [(s, n, _pct(n, len(statuses))) for s, n in ordered]


sparse_rows = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 9)), st.one_of(st.none(), st.sampled_from(["a", "b"]))),
    min_size=0,
    max_size=200,
)


@SETTINGS
@given(sparse_rows)
def test_fill_and_null_rates_against_brute_force(spark, rows):
    from loanframe.operators import fill_rates, null_rates

    df = spark.createDataFrame(rows, "x int, y string")
    n = len(rows)
    fills = {r.column: (r.total_rows, r.non_null_count, r.null_count, r.fill_rate)
             for r in fill_rates(df, ["x", "y"]).collect()}
    nulls = {r.column: (r.null_count, r.null_pct) for r in null_rates(df, ["x", "y"]).collect()}
    for i, c in enumerate(["x", "y"]):
        nn = sum(r[i] is not None for r in rows)
        assert fills[c] == (n, nn, n - nn, nn / n if n else 0.0)
        assert nulls[c] == (n - nn, _pct(n - nn, n))


status_texts = st.one_of(st.none(), st.sampled_from(["Fully Paid", "Charged Off", "Current"]))


@SETTINGS
@given(st.lists(st.tuples(state_texts, status_texts, purpose_texts), min_size=0, max_size=200))
def test_counts_and_funnel_against_brute_force(spark, rows):
    from loanframe.operators import batch_stats, label_distribution, label_target, value_counts

    df = spark.createDataFrame(rows, "addr_state string, loan_status string, purpose string")
    # A5: value counts, most frequent first, ties by value with null first
    got = [tuple(r) for r in value_counts(df, "purpose").collect()]
    counts = Counter(p for _, _, p in rows)
    assert got == sorted(counts.items(), key=lambda kv: (-kv[1], kv[0] is not None, kv[0] or ""))
    # A9 over labelled rows
    labels = Counter(1 if s == "Charged Off" else 0 for _, s, _ in rows if s in ("Fully Paid", "Charged Off"))
    assert [tuple(r) for r in label_distribution(label_target(df)).collect()] == sorted(labels.items())
    # batch stats: row funnel and the category check among aligned rows
    aligned = [r for r in rows if r[0] is not None and re.fullmatch(r"[A-Z]{2}", r[0])]
    s = batch_stats(df, domain=("car", "house")).first()
    assert (s.raw_rows, s.aligned_rows) == (len(rows), len(aligned))
    assert s.labelled_rows == sum(r[1] in ("Fully Paid", "Charged Off") for r in aligned)
    assert s.domain_violations == sum(r[2] is not None and r[2] not in ("car", "house") for r in aligned)
    assert s.pattern_violations == sum(r[0] is not None for r in rows) - len(aligned)


@SETTINGS
@given(st.integers(0, 3000), st.integers(0, 3000))
def test_row_count_delta_against_brute_force(spark, raw_n, ckpt_n):
    from loanframe.operators import row_count_delta

    r = row_count_delta(spark.range(raw_n), spark.range(ckpt_n)).first()
    delta = ckpt_n - raw_n
    want_pct = None if raw_n == 0 else (-1 if delta < 0 else 1) * _pct(abs(delta), raw_n)
    assert tuple(r) == (raw_n, ckpt_n, delta, want_pct)
