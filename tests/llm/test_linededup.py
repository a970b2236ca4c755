import hashlib
import random
import re
from collections import Counter

import pytest
from oracle_check import compare, duck

from loanframe.llm.linededup import LONG_WORDS, ORACLE, remove_repeated_chunks


def pieces_of(text):
    return re.findall(r"\n*[^\n]+\n*", text)


def units_of(lines, again):
    """(first line, size, chunks) of what is compared, chunks being (first, size)."""
    h = [int(hashlib.md5(x.encode()).hexdigest()[:8], 16) for x in lines]
    long = [x.count(" ") >= LONG_WORDS for x in lines]
    cuts, start = [], None
    for i, x in enumerate(lines):
        if x not in again:
            continue
        start = i if start is None else start
        goes_on = i + 1 < len(lines) and lines[i + 1] in again
        rolled = (h[i] + (h[i - 1] if i and lines[i - 1] in again else 0) * 65_599) % (1 << 32)
        if not goes_on or long[i] or long[i + 1] or (rolled >> 16) % 2 == 0:
            cuts.append((start, i + 1 - start))
            start = None
    alone = [(a, n, [(a, n)]) for a, n in cuts if n > 1 or long[a]]
    return alone + [(a, n + m, [(a, n), (b, m)]) for (a, n), (b, m) in zip(cuts, cuts[1:]) if b == a + n]


def slow(rows):
    """Expected text of each distinct (id, text), by plain comparison."""
    docs = sorted({r[:2] for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    lines = {d: [p.strip("\n") for p in pieces_of(d[1] or "")] for d in docs}
    counts = Counter(x for own in lines.values() for x in own)
    again = {x for x, n in counts.items() if n > 1}
    units = {d: sorted(units_of(lines[d], again)) for d in docs}
    first = {}
    for d in docs:
        for a, n, _ in units[d]:
            first.setdefault(tuple(lines[d][a : a + n]), (d, a))
    out = {}
    for d in docs:
        gone = set()
        for a, n, chunks in units[d]:
            whose, at = first[tuple(lines[d][a : a + n])]
            if (whose, at) != (d, a) and not (whose == d and a < at + n):
                gone.update(i for b, m in chunks for i in range(b, b + m))
        rest = "".join(p for i, p in enumerate(pieces_of(d[1] or "")) if i not in gone)
        out[d] = rest.rstrip("\n") if gone else d[1]
    return out


def _rows():
    r = random.Random(2)
    line = lambda: " ".join(r.choice("abcdefghij") for _ in range(r.randint(1, 8)))
    passage = [line() for _ in range(9)]
    wide = " ".join(f"w{i}" for i in range(60))
    rows = []
    for d in range(80):
        own = [line() for _ in range(r.randint(1, 12))]
        at = r.randint(0, len(own))
        if d % 3 == 0:
            own[at:at] = passage
        if d % 7 == 0:
            own.append(wide)
        rows.append((d, "\n".join(own).replace("a b", "a b\n\n"), "s"))
    rows += [(100, rows[5][1], "s"), (5, rows[5][1], "other"), (101, None, None), (102, "", "s"), (103, "\n\n", "s")]
    rows += [(None, rows[0][1], "s"), (104, "\n".join(["x y"] * 3000), "s"), (104, "second text\nof one id", "s")]
    return rows


def test_equals_plain_comparison(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, _ID string").repartition(5)
    out = remove_repeated_chunks(df)
    assert out.columns == df.columns
    want = slow(rows)
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert got == sorted(((r[0], want[r[:2]]) for r in rows), key=str)
    assert sum(w != t for (_, t), w in want.items()) > 20


@pytest.mark.parametrize("shape", [(2, 30), (3, 20), (4, 15), (6, 10), (12, 10), (2, 26), (1, 60)])
def test_passages_go_whatever_stands_around_them(spark, shape):
    """Of passages of over 50 words between lines of their own, two and five copies."""
    n, size = shape
    r = random.Random(n)
    word = lambda: "".join(r.choice("abcdefghijklmnop") for _ in range(5))
    line = lambda: " ".join(word() for _ in range(size))
    passages = [[line() for _ in range(n)] for _ in range(12)]
    rows, planted = [], Counter()
    for k, p in enumerate(passages):
        for _ in range(2 if k % 2 else 5):
            own = [line() for _ in range(r.randint(0, 3))] + p + [line() for _ in range(r.randint(0, 3))]
            rows.append((len(rows), "\n".join(own)))
            planted.update(p)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = remove_repeated_chunks(df).collect()
    left = Counter(x for r in out for x in r.text.split("\n"))
    assert {x: left[x] for x in planted} == dict.fromkeys(planted, 1)
    # All other lines stay.
    before = Counter(x for _, t in rows for x in t.split("\n"))
    assert all(left[x] == c for x, c in before.items() if x not in planted)


def test_first_occurrence_stays_whole_and_collisions_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    from loanframe.llm import linededup

    same = "\n".join(["x y z"] * 40)
    out = remove_repeated_chunks(spark.createDataFrame([(1, same), (2, same)], "doc_id long, text string")).collect()
    left = {r.doc_id: r.text for r in out}
    assert left[1].startswith("x y z\nx y z") and left[2] == ""
    # All hashes of units are equal: bytes decide.
    real = F.xxhash64
    monkeypatch.setattr(linededup.F, "xxhash64", lambda *c: real(*c) if len(c) > 1 else F.lit(7).cast("bigint"))
    rows = [(i, f"own {i}\nalpha {i % 3}\nbeta {i % 3}\nown too {i}") for i in range(9)]
    out = remove_repeated_chunks(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sum("alpha" in r.text for r in out) == 3 and sum("beta" in r.text for r in out) == 3


def test_report_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a\nb\nc"), (2, None)], "doc_id long, text string")
    rows = remove_repeated_chunks(df, report=True).orderBy("doc_id").collect()
    assert [(r.n_lines, r.n_lines_removed, r.n_chunks_removed) for r in rows] == [(3, 0, 0), (0, 0, 0)]
    assert remove_repeated_chunks(df.filter("false")).count() == 0


def test_other_columns_stay(spark):
    df = spark.createDataFrame([(1, "a", 7, "q")], "doc_id long, text string, starts int, `odd.name` string")
    out = remove_repeated_chunks(df.drop("starts"))
    assert out.columns == ["doc_id", "text", "odd.name"]
    assert remove_repeated_chunks(df).collect()[0].asDict()["starts"] == 7


def test_plan_has_no_python(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = remove_repeated_chunks(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_equals_sql(spark, sf):
    from loanframe.llm.queries import op7_line_dedup

    r = compare(spark, "op7", op7_line_dedup, ORACLE, sf, duck(sf))
    assert r["ok"], r["problems"]
