import itertools
import math
import random
import tracemalloc
import unicodedata

import numpy as np
import pytest

from loanframe.llm.quality import (
    FEATURES,
    OWN,
    RIDGE,
    ROUNDS,
    STEP,
    LineField,
    _forward_backward,
    _long_marginals,
    document_scores,
    fit_line_field,
    fit_quality,
    line_features,
    score_quality,
)


def test_marginals_and_normalisers_equal_enumeration():
    r = np.random.default_rng(4)
    move = r.normal(size=(2, 2))
    sizes = [1, 3, 2, 5, 1]
    lean = r.normal(size=sum(sizes))
    ends = np.cumsum(sizes)
    documents = [slice(e - n, e) for e, n in zip(ends, sizes)]
    got, pairs, z = _forward_backward(lean, move, documents)
    want, want_pairs = np.zeros(len(lean)), np.zeros((2, 2))
    for d in documents:
        weights, total = [], 0.0
        for labels in itertools.product((0, 1), repeat=d.stop - d.start):
            w = np.exp(sum(lean[d.start + i] for i, y in enumerate(labels) if y) + sum(move[a, b] for a, b in zip(labels, labels[1:])))
            weights.append((labels, w))
            total += w
        for labels, w in weights:
            for i, y in enumerate(labels):
                want[d.start + i] += y * w / total
            for a, b in zip(labels, labels[1:]):
                want_pairs[a, b] += w / total
    assert np.allclose(got, want) and np.allclose(pairs, want_pairs)


def _docs(n, seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdefg") for _ in range(r.randint(2, 8)))
    rows = []
    for i in range(n):
        good = r.random() < 0.6
        lines = []
        for _ in range(r.randint(1, 9)):
            words = [word() for _ in range(r.randint(3, 12))]
            lines.append(" ".join(words).capitalize() + "." if good else " ".join(w.upper() + "!!" for w in words))
        rows.append((i, "\n".join(lines), int(good)))
    return rows


def test_held_out_accuracy_and_odd_rows(spark):
    train, test = _docs(200, 1), _docs(80, 2)
    docs = spark.createDataFrame(train, "doc_id long, text string, quality int")
    labels = docs.select("doc_id", "quality").union(spark.createDataFrame([(None, 1), (3, None), (99_999, 0)], "a long, b int"))
    field = fit_quality(docs, labels)
    odd = [(None, None, None), (901, "", None), (902, "\n\n", None), (903, "Word. " * 200_000, None), (903, "퟿" * 3, None)]
    df = spark.createDataFrame(test + odd, "doc_id long, text string, SCORE int")
    out = score_quality(df, field)
    assert out.columns == ["doc_id", "text", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == len(test) + len(odd)
    assert np.mean([r.predicted == t[2] for r, t in zip(rows, test)]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert rows[len(test)].score == rows[len(test) + 1].score
    assert score_quality(df.filter("false"), field).count() == 0


def test_no_labels_and_one_kind(spark):
    docs = spark.createDataFrame(_docs(10, 3), "doc_id long, text string, quality int")
    none = fit_quality(docs, docs.filter("false"))
    assert all(abs(r.score - 0.5) < 1e-9 for r in score_quality(docs, none).collect())
    good = fit_quality(docs, docs.selectExpr("doc_id", "1 as quality"))
    assert min(r.score for r in score_quality(docs, good).collect()) > 0.8


def test_long_documents_are_learned_from(spark):
    rows = [(i, "\n".join([text] * 60), y) for i, text, y in _docs(40, 6)]
    rows = [(i, text + "\n" + "\n".join(text.split("\n")[0] for _ in range(400)), y) for i, text, y in rows]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    assert min(text.count("\n") for _, text, _ in rows) > 400
    out = score_quality(docs, fit_quality(docs, docs.select("doc_id", "quality"))).collect()
    assert np.mean([r.predicted == t[2] for r, t in zip(out, rows)]) > 0.95
    assert {t[2] for t in rows} == {0, 1}


def test_neighbouring_lines_matter():
    base = line_features("One line here.\nX\nTwo words")[0]
    other = line_features("ONE!! LINE!! HERE!!\nX\nTwo words")[0]
    assert base.shape == (3, FEATURES)
    assert (base[1] != other[1]).any() and (base[2] == other[2]).all()
    field = LineField(np.zeros(FEATURES), np.array([[3.0, 0.0], [0.0, 3.0]]))
    field.lean[2] = -6.0  # upper-case lines are bad
    low, high = document_scores(field, ["Fine.\nFine.\nAAA BBB", "Fine.\nFine.\nFine."])
    assert low < high


def test_fit_does_not_depend_on_order():
    sample = [(line_features(t)[0], y) for _, t, y in _docs(20, 5)]
    a = fit_line_field(sample)
    assert np.isfinite(a.lean).all()
    assert np.allclose(a.lean, fit_line_field(sample[::-1]).lean, atol=1e-6)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.01"])
def test_query_on_held_out_documents(spark, sf):
    from loanframe.llm.queries import op3_quality_classifier

    out = op3_quality_classifier(spark, sf)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = out.filter("held_out").join(labels, "doc_id").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_weights_do_not_depend_on_partitions(spark, monkeypatch):
    from loanframe.llm import quality

    monkeypatch.setattr(quality, "SAMPLE", 15)
    docs = _docs(40, 6)
    df = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in docs], "doc_id long, quality int")
    a, b = (quality.fit_quality(df.repartition(n), labels.repartition(n)) for n in (1, 7))
    assert (a.lean == b.lean).all()


def plain_kind(c):
    """A character's kind, told anew from its Unicode category."""
    category = unicodedata.category(c)
    if c in "\t\n\x0b\x0c\r" or category[0] == "Z":
        return "space"
    if c in ".,;:?!":
        return "stop"
    if category in ("Ll", "Lu", "Lt", "Lm", "Lo", "Mn"):
        return {"Ll": "lower", "Lu": "upper", "Lt": "upper"}.get(category, "letter")
    if category[0] == "N":
        return "digit"
    return "mark" if category[0] == "P" and c not in "*#%&@/\\_" else "symbol"


def plain_own(lines, i):
    """The features of line ``i`` by itself, one character at a time."""
    line, kinds = lines[i], [plain_kind(c) for c in lines[i]]
    at = range(len(line))
    count = lambda test: sum(1 for k in at if test(k))
    begins = lambda k: kinds[k] != "space" and (k == 0 or kinds[k - 1] == "space")
    ends = lambda k: kinds[k] != "space" and (k == len(line) - 1 or kinds[k + 1] == "space")
    is_letter = lambda k: kinds[k] in ("lower", "upper", "letter")
    same = lambda k: k > 0 and line[k] == line[k - 1] and kinds[k] != "space"
    chars = max(1, count(lambda k: kinds[k] != "space"))
    words = max(1, count(begins))
    letters, upper = count(is_letter), count(lambda k: kinds[k] == "upper")
    own_words = line.split()
    pairs = list(zip(own_words, own_words[1:]))
    return [
        letters / chars,
        upper / max(1, letters),
        upper > 0.6 * max(1, letters),
        count(lambda k: kinds[k] == "digit") / chars,
        count(lambda k: kinds[k] == "stop") / chars,
        count(lambda k: kinds[k] == "mark") / chars,
        count(lambda k: kinds[k] == "symbol") / chars,
        count(lambda k: kinds[k] == "symbol" and begins(k) and ends(k)) / words,
        count(lambda k: kinds[k] == "symbol" and ends(k) and not begins(k)) / words,
        count(lambda k: line[k] == "!" and ends(k)) / words,
        count(lambda k: kinds[k] == "stop" and ends(k)) / words,
        count(lambda k: kinds[k] == "upper" and begins(k)) / words,
        count(lambda k: same(k) and not is_letter(k)) / chars,
        count(lambda k: same(k) and is_letter(k)) / chars,
        min(chars / words, 20) / 10,
        math.log(1 + words) / 5,
        words < 4,
        line == "",
        line != "" and line in lines[:i],
        sum(a == b for a, b in pairs) / len(pairs) if pairs else 0,
        len(set(own_words)) / len(own_words) if pairs else 1,
    ]


def plain_features(text):
    lines = text.split("\n")
    own = [[float(x) for x in plain_own(lines, i)] for i in range(len(lines))]
    none = [0.0] * OWN
    return [[*own[i], *(own[i - 1] if i else none), *(own[i + 1] if i + 1 < len(own) else none), 1.0] for i in range(len(own))]


def plain_marginals(lean, move):
    """Marginals and pair marginals by enumeration of all labellings."""
    total, good, pairs = 0.0, np.zeros(len(lean)), np.zeros((2, 2))
    for labels in itertools.product((0, 1), repeat=len(lean)):
        w = math.exp(sum(x for x, y in zip(lean, labels) if y) + sum(move[a, b] for a, b in zip(labels, labels[1:])))
        total += w
        good += w * np.array(labels)
        for a, b in zip(labels, labels[1:]):
            pairs[a, b] += w
    return good / total, pairs / total


def random_texts(n, seed, most=200):
    r = random.Random(seed)
    alphabet = "aaB3 .,!#-\n\n éßǅʰ\t\x0b你́A *_ "
    return ["", "\n", "same\nsame\n\nother\nsame"] + ["".join(r.choice(alphabet) for _ in range(r.randint(0, most))) for _ in range(n)]


def test_features_equal_the_plain_ones_in_blocks_of_any_size(monkeypatch):
    from loanframe.llm import quality

    for block in (1, 40, 1 << 18):
        monkeypatch.setattr(quality, "BLOCK_CHARS", block)
        for text in random_texts(40, 8):
            want = np.array(plain_features(text))
            got, size = line_features(text)
            assert np.allclose(got, want) and size.tolist() == [len(x) for x in text.split("\n")]
            first = len(want) // 3
            assert np.allclose(line_features(text, first, first + 2)[0], want[first : first + 2])


def test_scores_equal_enumeration(monkeypatch):
    from loanframe.llm import quality

    g = np.random.default_rng(2)
    field = LineField(g.normal(size=FEATURES) * 0.5, g.normal(size=(2, 2)))
    texts = ["\n".join(t.split("\n")[:9]) for t in random_texts(30, 3, most=60)]
    want = []
    for text in texts:
        p, size = plain_marginals(np.array(plain_features(text)) @ field.lean, field.move)[0], [len(x) for x in text.split("\n")]
        want.append(np.average(p, weights=size) if sum(size) else p.mean())
    for side in (0, 4, 1024):  # all in stretches, some, none
        monkeypatch.setattr(quality, "SIDE_LINES", side)
        assert np.allclose(document_scores(field, texts), want)


def test_stretches_of_a_long_chain_equal_the_plain_recursion():
    g = np.random.default_rng(6)
    for n in (1, 2, 3, 7, 16, 17, 1000, 5003):
        lean, move = g.normal(size=n) * 4, g.normal(size=(2, 2)) * 3
        want = _forward_backward(lean, move, [slice(0, n)])[0]
        assert np.allclose(_long_marginals(lean, move), want, atol=1e-9)


def test_fit_equals_a_plain_one():
    """The same ascent with features and marginals told by the plain versions."""
    texts = [("Fine words here.\nAnd more of them.", 1), ("AAA!!\nBBB ###", 0), ("Good line.", 1), ("$$ 1 $$\n\n!!", 0)]
    got = fit_line_field([(line_features(t)[0], y) for t, y in texts])
    weights = np.zeros(FEATURES + 4)
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    read = [(np.array(plain_features(t)), y) for t, y in texts]
    for t in range(1, ROUNDS + 1):
        slope = -RIDGE * weights
        for x, y in read:
            p, pairs = plain_marginals(x @ weights[:FEATURES], weights[FEATURES:].reshape(2, 2))
            stays = np.zeros((2, 2))
            stays[y, y] = len(x) - 1
            slope += np.concatenate([x.T @ (y - p), (stays - pairs).ravel()]) / len(read)
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        weights += STEP * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    assert np.allclose(got.lean, weights[:FEATURES], atol=1e-6)
    assert np.allclose(got.move.ravel(), weights[FEATURES:], atol=1e-6)


def test_very_long_texts_take_bounded_memory():
    field = LineField(np.full(FEATURES, 0.1), np.eye(2))
    text = "\n".join(f"ab {i}" for i in range(200_000))
    line_features("warm up")
    tracemalloc.start()
    document_scores(field, [text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # Features of all lines at once would take 100 MB in one of their several copies.
    assert peak < 100e6
