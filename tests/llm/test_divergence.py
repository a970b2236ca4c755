import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_importance import LETTER, lowered

from loanframe.llm import divergence
from loanframe.llm.divergence import SCALE, divergence_audit, kept_terms, pair_sums, run_shares, term_counts


def plain_audit(rows, min_docs=3, top=200):
    """The contract, term by term."""
    rows = [(a or "", b or "", LETTER.findall(lowered(t))) for a, b, t in rows]
    out = []
    for lang in {a for a, _, _ in rows}:
        own = [(b, t) for a, b, t in rows if a == lang]
        df, total, by = Counter(), Counter(), defaultdict(Counter)
        for b, t in own:
            df.update(set(t))
            by[b].update(t)
        kept = [w for w in df if df[w] >= min_docs]
        for b in by:
            total.update({w: by[b][w] for w in kept})

        def shares(counts):
            n = sum(counts[w] for w in kept)
            return {w: 1 + SCALE * (counts[w] + 1) // (n + len(kept)) for w in kept}

        p, q = {b: shares(by[b]) for b in by}, shares(total)
        for b in by:
            pairs = [(c, sum((p[b][w] - p[c][w]) ** 2 // p[c][w] for w in kept)) for c in by if c != b]
            terms = [(w, (p[b][w] - q[w]) ** 2 // q[w]) for w in kept if by[b][w] and p[b][w] > q[w]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, b, part, i, v, k) for k, (i, v) in enumerate(items[:most], 1)]
    return sorted(out)


def _rows(n, seed):
    r = random.Random(seed)
    words = ["the", "Été", "kuma", "Rot", "漢字", "x"] + [f"{a}{b}" for a in "abcdefgh" for b in "klmnop"]
    out = []
    for _ in range(n):
        lang = r.choice(["en"] * 5 + ["fr", "de", None])
        source = r.choice(["hot"] * 6 + ["s1", "s2", "é", None])
        some = words if source == "hot" else words[r.randrange(20) :]
        out.append((lang, source, " ".join(r.choice(some) for _ in range(r.randint(0, 25)))))
    return out


@pytest.mark.parametrize("block_runs", [3, 1 << 17])
def test_audit_equals_a_plain_count(spark, monkeypatch, block_runs):
    monkeypatch.setattr(divergence, "BLOCK_RUNS", block_runs)
    rows = _rows(250, 3)
    rows += [("en", "mute", "1 2 3"), ("en", "mute", None), ("lone", "only", "a"), ("lone", "other", "b c"), ("one", "one", "z z")]
    rows += [("es", "s1", "Hola " * 4), ("es", "s1", "hola"), ("es", "s2", "HOLA adios")]
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    out = divergence_audit(df, top=7)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in out.collect()) == plain_audit(rows, top=7)


def test_pairs_over_runs_equal_pairs_over_terms():
    r = random.Random(5)
    for _ in range(200):
        size = r.randint(1, 40)
        dense = [[r.choice([0, 0, 0, 1, 2, 10**9]) for _ in range(size)] for _ in range(2)]
        n = [sum(d) for d in dense]
        columns = []
        for d, total in zip(dense, n):
            runs = [(i, c) for i, c in enumerate(d) if c]
            columns.append(run_shares([i for i, _ in runs], [1] * len(runs), [c for _, c in runs], size, total, size))
        p, q = ([1 + SCALE * (c + 1) // (t + size) for c in d] for d, t in zip(dense, n))
        assert pair_sums(*columns) == (
            sum((x - y) ** 2 // y for x, y in zip(p, q)),
            sum((x - y) ** 2 // x for x, y in zip(p, q)),
        )


def test_sums_beyond_64_bits_of_partial_products():
    a = run_shares([0], [10**6], [10**9], 10**6, 10**15, 10**6)
    b = run_shares([], [], [], 10**6, 10**15, 10**6)
    p, q = 1 + SCALE * (10**9 + 1) // (10**15 + 10**6), 1
    assert pair_sums(a, b)[0] == 10**6 * ((p - q) ** 2 // q)
    assert np.array_equal(b[0], [10**6])


def test_empty_table_clashing_columns_and_long_text(spark):
    schema = "LANG string, source string, text string, term string, n long, block int"
    assert divergence_audit(spark.createDataFrame([], schema)).count() == 0
    rows = [("en", "a", "kuma tado " * 200_000, "own", 1, 2), ("en", "b", "kuma", "own", 1, 2), ("en", "b", "kuma", "own", 1, 2)]
    out = divergence_audit(spark.createDataFrame(rows, schema))
    assert sorted(tuple(r) for r in out.collect()) == plain_audit([r[:3] for r in rows])


@pytest.mark.parametrize("held_words", [1, 40])
def test_counts_do_not_depend_on_what_a_task_holds(spark, monkeypatch, held_words):
    monkeypatch.setattr(divergence, "HELD_WORDS", held_words)
    monkeypatch.setattr(divergence, "SENT_ROWS", 3)
    rows = _rows(120, 8) + [("en", "hot", "long " * 300_000 + "Kuma rot"), ("en", "mute", None), ("alone", "mute", "1")]
    df = spark.createDataFrame(rows, "lang string, source string, text string").coalesce(2)
    n, docs = Counter(), Counter()
    for a, b, t in rows:
        own = (a or "", b or "")
        words = LETTER.findall(lowered(t))
        n.update((*own, w) for w in words)
        docs.update({(*own, w) for w in words} | {(*own, None)})
    out = term_counts(df)
    assert out.columns == ["lang", "source", "term", "n", "docs"]
    counted = [tuple(r) for r in out.collect()]
    assert len(counted) == len(docs)
    assert set(counted) == {(*k, n[k], d) for k, d in docs.items()}


def test_counts_and_kept_terms_need_one_shuffle(spark):
    df = spark.createDataFrame(_rows(50, 2), "lang string, source string, text string")
    plan = kept_terms(term_counts(df))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    # A term of several sources leaves a task as one row.
    df = spark.createDataFrame([("en", f"s{i % 4}", "kuma tado") for i in range(40)], "lang string, source string, text string")
    held = divergence._Held()
    for r in df.collect():
        held.docs[r.source] = held.docs.get(r.source, 0) + 1
        held.add(r.source, [w.encode() for w in r.text.split()])
    sent = [r for b in held.rows("en") for r in b.to_pylist()]
    assert [(r["lang"], r["term"], len(r["cells"])) for r in sent] == [("en", None, 4), ("en", "kuma", 4), ("en", "tado", 4)]
    assert all(c["n"] == c["docs"] == 10 for r in sent[1:] for c in r["cells"])


def test_runs_of_entries_equal_runs_of_terms():
    r = random.Random(9)
    kind = pa.list_(pa.struct([("source", pa.string()), ("n", pa.int64())]))
    for _ in range(100):
        rows = [[{"source": s, "n": r.randint(1, 2)} for s in "abc" if r.random() < 0.7] for _ in range(r.randint(1, 12))]
        terms, begin = [r.randint(1, 4) for _ in rows], r.randint(0, 5)
        # A slice, as entries of one language are one of a batch.
        cells = pa.array([[{"source": "z", "n": 7}], *rows], kind).slice(1)
        dense = defaultdict(dict)
        at = begin
        for cell, k in zip(rows, terms):
            for c in cell:
                dense[c["source"]].update({at + i: c["n"] for i in range(k)})
            at += k
        found = {s: list(zip(*(x.tolist() for x in part))) for s, part in divergence.piece_runs(cells, np.array(terms), begin)}
        assert {s: {a + i: c for a, k, c in runs for i in range(k)} for s, runs in found.items()} == dense
        for runs in found.values():
            assert all(a + k < b or (a + k == b and c != d) for (a, k, c), (b, _, d) in zip(runs, runs[1:]))


def test_shares_of_counts_beyond_64_bits(spark):
    counts = [0, 1, 8_999_999_999, 9_000_000_000, 10**15]
    size, v = 10**16, 12345
    df = spark.createDataFrame([(c, size, v) for c in counts], "n long, size long, v long")
    got = df.select("n", divergence._share(F.col("n"), F.col("size"), F.col("v")).alias("p")).collect()
    assert {r.n: int(r.p) for r in got} == {c: 1 + SCALE * (c + 1) // (size + v) for c in counts}
