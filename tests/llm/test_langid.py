import math
import random

import numpy as np
import pytest

from loanframe.llm.langid import (
    BUCKETS,
    codewords,
    drop_unidentified,
    fit_language_model,
    identify_language,
    ngram_counts,
)

WORDS = {
    "aa": "bala kuma tado rima",
    "bb": "xyst qrevz wplk zzyx",
    "cc": "éloû çaré ênuî dàïs",
}


def _rows(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        lang = r.choice(list(WORDS))
        out.append((i, " ".join(r.choice(WORDS[lang].split()) for _ in range(r.randint(1, 30))), lang))
    return out


def _fit(spark, rows):
    return fit_language_model(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def test_held_out_accuracy_and_odd_rows(spark):
    model = _fit(spark, _rows(200, 1) + [(900, None, "aa"), (901, "...", "bb"), (902, "bala", None)])
    assert model.languages == ["aa", "bb", "cc"]
    odd = [(None, None, "x"), (1, "", "x"), (2, "12 !! 3", "x"), (3, "kuma " * 300_000, "aa"), (3, "kuma", "aa"), (3, "kuma", "aa")]
    df = spark.createDataFrame(_rows(100, 2) + odd, "doc_id long, text string, SCORE string")
    out = identify_language(df, model)
    assert out.columns == ["doc_id", "text", "lang_pred", "score", "ambiguous"]
    rows = out.collect()
    assert len(rows) == 106
    right = [r.lang_pred == w[2] for r, w in zip(sorted(rows[:100], key=lambda r: r.doc_id), _rows(100, 2))]
    assert np.mean(right) > 0.97
    assert [(r.lang_pred, r.score) for r in rows[100:103]] == [("und", 0.0)] * 3
    assert {r.lang_pred for r in rows[103:]} == {"aa"}
    assert all(0 <= r.score <= 1 for r in rows)


def test_no_and_one_language(spark):
    none = _fit(spark, [(1, "abc", None)])
    df = spark.createDataFrame([(1, "abc"), (2, "7")], "doc_id long, text string")
    assert {r.lang_pred for r in identify_language(df, none).collect()} == {"und"}
    one = _fit(spark, [(1, "abc", "aa")])
    assert [(r.lang_pred, r.score) for r in identify_language(df, one).collect()] == [("aa", 1.0), ("und", 0.0)]
    assert identify_language(df.filter("false"), one).count() == 0
    clash = spark.createDataFrame([(1, "abc", "own"), (2, "7", "own")], "doc_id long, text string, Score string")
    assert [tuple(r) for r in drop_unidentified(clash, one).collect()] == [(1, "abc", "own")]


def test_ambiguity_is_flagged(spark):
    # The same texts under two labels: no classifier can tell them apart.
    model = _fit(spark, [(i, "bala kuma tado", "aa" if i % 2 else "bb") for i in range(20)])
    df = spark.createDataFrame([(1, "bala kuma")], "doc_id long, text string")
    assert identify_language(df, model).collect()[0].ambiguous


@pytest.mark.parametrize("n", [2, 3, 7, 8, 40])
def test_codewords_differ_and_split(n):
    code = codewords(n).astype(int)
    assert (abs(code.sum(0)) < n).all()
    distance = (code.shape[1] - code @ code.T) // 2
    assert distance[np.triu_indices(n, 1)].min() >= 1


def test_blocks_do_not_change_the_counts(monkeypatch):
    text = "Déjà vu, " * 5000
    whole = ngram_counts(text)
    monkeypatch.setattr("loanframe.llm.langid.BLOCK", 997)
    cut = ngram_counts(text)
    assert whole.shape == (BUCKETS,)
    # Only n-grams at the seams are counted again.
    assert abs(cut.sum() / whole.sum() - 1) < 0.02


def test_query_columns(spark):
    from loanframe.llm.queries import op10_language_id

    rows = op10_language_id(spark, "/root/testdata/sf0.001")
    assert set(rows.columns) >= {"doc_id", "held_out", "lang_pred", "score"}
    held = rows.filter("held_out").join(
        spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "lang"), "doc_id"
    )
    assert held.filter("lang = lang_pred").count() / held.count() > 0.95


def plain_counts(text):
    """Counts of the hashed runs of one to three letters and word borders, one by one."""
    codes = [0]
    for c in "".join(text).lower():
        codes.append(ord(c) if c.isalpha() else 0)
    codes.append(0)
    kept = [c for i, c in enumerate(codes) if i == 0 or c or codes[i - 1]]
    if not any(kept):
        return None
    total, mask = [0] * BUCKETS, (1 << 32) - 1
    for i, a in enumerate(kept):
        h = a * 0x9E3779B1 & mask
        runs = [h]
        if i + 1 < len(kept):
            h = (h * 0x85EBCA6B + kept[i + 1] * 0xC2B2AE35) & mask
            runs.append(h)
        if i + 2 < len(kept):
            h = (h * 0x27D4EB2F + kept[i + 2] * 0x165667B1) & mask
            runs.append(h)
        for h in runs:
            total[((h ^ h >> 15) * 0x2C1B3C6D & mask) >> 17] += 1
    return total


def plain_model(rows):
    """Classifiers, bit weights and scales from (text, lang), with plain loops."""
    read = [(plain_counts(t or ""), name) for t, name in rows if name is not None]
    read = [(c, name) for c, name in read if c is not None]
    languages = sorted({name for _, name in read})
    n = len(languages)
    splits = range(1, 1 << (n - 1))
    codes = [[1 if i == 0 or not s >> (i - 1) & 1 else -1 for s in splits] for i in range(n)]
    share = []
    for name in languages:
        own = [sum(column) for column in zip(*(c for c, x in read if x == name))]
        share.append([(x + 0.5) / (sum(own) + 0.5 * BUCKETS) for x in own])
    weights = []
    for j in range(len(splits)):
        plus, minus = ([share[i] for i in range(n) if codes[i][j] == sign] for sign in (1, -1))
        weights.append([math.log(sum(p) / len(plus)) - math.log(sum(m) / len(minus)) for p, m in zip(zip(*plus), zip(*minus))])

    def margin(counts, j):
        return sum(c * w for c, w in zip(counts, weights[j]) if c) / sum(counts)

    trust, scales = [[0.0] * len(splits) for _ in range(n)], [0.0] * len(splits)
    for j in range(len(splits)):
        for i, name in enumerate(languages):
            told = [margin(c, j) for c, x in read if x == name]
            trust[i][j] = max(sum(m * codes[i][j] > 0 for m in told) / len(told) - 0.5, 0) + 1e-3
            scales[j] += sum(abs(m) for m in told) / len(told) / n
    trust = [[x / sum(row) for x in row] for row in trust]

    def predict(text):
        counts = plain_counts(text or "")
        if counts is None:
            return "und", 0.0
        f = [max(-4.0, min(4.0, margin(counts, j) / scales[j])) for j in range(len(splits))]
        loss = [sum(w * math.exp(-x * c) for w, x, c in zip(trust[i], f, codes[i])) for i in range(n)]
        fit = [math.exp(-4 * (x - min(loss))) for x in loss]
        best = loss.index(min(loss))
        return languages[best], fit[best] / sum(fit)

    return predict


def test_predictions_equal_a_plain_version(spark):
    """Counts, classifiers, weights and decoding told anew, on texts that mix languages."""
    r = random.Random(12)
    mixed = " ".join(WORDS.values()).split()
    train = _rows(60, 5) + [(900, None, "aa"), (901, "...", "bb"), (902, "Kuma, TADO!", "cc"), (903, "bala", None)]
    texts = [" ".join(r.choice(mixed) for _ in range(r.randint(1, 8))) for _ in range(60)] + [None, "", "7 !", "ÉLOÛ\nxyst--bala", "İx"]
    predict = plain_model([(t, name) for _, t, name in train])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x.doc_id: (x.lang_pred, x.score) for x in identify_language(docs, _fit(spark, train)).collect()}
    want = {i: predict(t) for i, t in enumerate(texts)}
    assert len({name for name, _ in want.values()}) == 4
    for i in want:
        assert got[i][0] == want[i][0] and abs(got[i][1] - want[i][1]) < 1e-4
