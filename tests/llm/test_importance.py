import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loanframe.llm import words
from loanframe.llm.importance import fit_gains, importance_scores, resample, run_crcs, shifted
from loanframe.llm.words import LETTERS, LETTERS_AND_DIGITS, word_blocks

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LETTER = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def plain_runs(text, least, most):
    found = WORD.findall(lowered(text))
    return [" ".join(found[i : i + n]) for n in range(least, most + 1) for i in range(len(found) - n + 1)]


def plain_scores(docs, target, least=1, most=1, buckets=10_000, percent=10, min_words=20):
    def counts(texts):
        out = [0] * buckets
        for t in texts:
            for f in plain_runs(t, least, most):
                out[zlib.crc32(f.encode()) % buckets] += 1
        return out

    s, t = counts(x for _, x in docs), counts(target)
    S, T = sum(s), sum(t)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    rows = {}
    for i, text in docs:
        f = plain_runs(text, least, most)
        w = sum(gain[zlib.crc32(x.encode()) % buckets] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{i}".encode()).hexdigest()[:8], 16)
        rows[i] = [len(f), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None]
    eligible = [i for i, text in docs if len(WORD.findall(lowered(text))) >= min_words]
    eligible.sort(key=lambda i: (-rows[i][2], i))
    for rank, i in enumerate(eligible[: percent * len(eligible) // 100], 1):
        rows[i][3] = rank
    return {i: tuple(r) for i, r in rows.items()}


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aZ09 éß\x7f\x00-_.漢\n", max_size=60), st.integers(1, 3), st.integers(0, 2), st.integers(1, 9))
def test_run_crcs_are_those_of_the_runs(text, least, more, block):
    before, words.BLOCK = words.BLOCK, block
    try:
        got = [int(c) for x in run_crcs(word_blocks(text.encode(), LETTERS_AND_DIGITS), least, least + more) for c in x]
    finally:
        words.BLOCK = before
    assert sorted(got) == sorted(zlib.crc32(f.encode()) for f in plain_runs(text, least, least + more))


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="aZ09 éß\x7f\x00-_.漢\n", max_size=60), st.integers(1, 9))
def test_words_do_not_depend_on_blocks(text, block):
    before, words.BLOCK = words.BLOCK, block
    try:
        for table, pattern in ((LETTERS_AND_DIGITS, WORD), (LETTERS, LETTER)):
            got = [w.decode() for b in word_blocks(text.encode(), table) for w in b]
            assert got == pattern.findall(lowered(text))
    finally:
        words.BLOCK = before


def test_shift_cancels_a_prefix_of_any_length():
    for n in (0, 1, 7, 1000, 1 << 20):
        a, b = b"some prefix ", bytes(i % 251 for i in range(n))
        back = zlib.crc32(a + b) ^ int(shifted(np.array([zlib.crc32(a)], np.uint32), np.array([n]))[0])
        assert back == zlib.crc32(b)


@pytest.fixture(scope="module")
def tables():
    r = random.Random(13)
    vocabulary = [f"w{i}" for i in range(300)] + ["Éa", "straße"]
    docs = [(i, " ".join(r.choice(vocabulary[: 40 + i % 260]) for _ in range(r.randint(0, 60)))) for i in range(400)]
    docs += [(900, None), (901, ""), (902, "-- !"), (903, "w1 " * 300_000)]
    target = [" ".join(r.choice(vocabulary[:60]) for _ in range(30)) for _ in range(20)] + [None, ""]
    return docs, target


@pytest.mark.parametrize("least,most", [(1, 1), (1, 3)])
def test_scores_and_draw_equal_a_plain_count(spark, tables, least, most):
    docs, target = tables
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    gain = fit_gains(df, bench, least=least, most=most)
    out = importance_scores(df, gain, least=least, most=most).collect()
    want = plain_scores(docs, target, least, most)
    assert {r.doc_id: (r.n_features, r.weight, r.score, r["rank"]) for r in out} == want
    drawn = {i for i, w in want.items() if w[3]}
    clash = df.selectExpr("doc_id", "text", "'own' as Score", "1 as rank", "2 as weight")
    got = resample(clash, bench, least=least, most=most)
    assert got.columns == clash.columns
    assert {(r.doc_id, r.Score, r["rank"]) for r in got.collect()} == {(i, "own", 1) for i in drawn}


def test_empty_and_repeated(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([("a b",)], "text string")
    assert importance_scores(empty, fit_gains(empty, bench)).count() == 0
    assert resample(empty, bench).count() == 0
    same = spark.createDataFrame([(None, "a " * 30)] * 7 + [(5, "b " * 30)] * 13, "doc_id long, text string")
    out = importance_scores(same, fit_gains(same, empty)).collect()
    assert sorted(r["rank"] for r in out if r["rank"]) == [1, 2]
    assert len({(r.doc_id, r.score) for r in out}) == 2
    with pytest.raises(ValueError):
        fit_gains(same, bench, least=0)
