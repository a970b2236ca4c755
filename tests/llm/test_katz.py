import math
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from loanframe.llm.katz import K, SURE, Sizes, Unigrams, discounts, katz_scores, pack, segments, unpack


def tokens_of(text):
    return [w for w in "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w] + ["</s>"]


class Plain:
    """The model in dictionaries, by the definition."""

    def __init__(self, texts, order=2):
        self.order, self.uni = order, Counter()
        self.after = defaultdict(Counter)  # context -> token -> count
        for t in texts:
            tokens = tokens_of(t)
            self.uni.update(tokens)
            all_ = ["<s>", *tokens]
            for i in range(1, len(all_)):
                for n in range(1, min(order - 1, i) + 1):
                    self.after[tuple(all_[i - n : i])][all_[i]] += 1
        self.contexts = {c: sum(x.values()) for c, x in self.after.items()}
        self.pairs = Counter({(c[0], w): n for c, x in self.after.items() if len(c) == 1 for w, n in x.items()})
        self.n = sum(self.uni.values())
        self.d1 = discounts([sum(c == r for c in self.uni.values()) for r in range(1, K + 2)])
        self.d = {}
        for n in range(1, order):
            counts = Counter(v for c, x in self.after.items() if len(c) == n for v in x.values())
            self.d[n] = discounts([counts[r] for r in range(1, K + 2)])
        left = sum(c * (1 - self.d1[c]) for c in self.uni.values() if c <= K)
        self.total = self.n if left > 0 else self.n + 1
        self.left = (left or 1) / self.total if self.n else 1.0
        self.weights = {}

    def single(self, w):
        c = self.uni[w]
        return (self.d1[c] if c <= K else 1) * c / self.total if c else self.left

    def probability(self, *gram):
        *context, b = gram
        context = tuple(context)
        if not context:
            return self.single(b)
        seen = self.after.get(context)
        if not seen:
            return self.probability(*context[1:], b)
        c1 = self.contexts[context]
        total = c1 + (c1 > SURE or all(c > K for c in seen.values()))
        of = lambda c: (self.d[len(context)][c] if c <= K else 1) * c / total
        if b in seen:
            return of(seen[b])
        if context not in self.weights:
            rest = sum(self.probability(*context[1:], w) for w in seen)
            self.weights[context] = (1 - sum(map(of, seen.values()))) / (1 - rest)
        return self.weights[context] * self.probability(*context[1:], b)

    def scores(self, text):
        tokens = tokens_of(text)
        base = sum(math.log10((self.uni[t] + 0.1) / (self.n + 0.1 * (len(self.uni) + 1))) for t in tokens)
        all_ = ["<s>", *tokens]
        model = sum(math.log10(self.probability(*all_[max(0, i - self.order + 1) : i + 1])) for i in range(1, len(all_)))
        return len(tokens), sum(self.uni[t] > 0 for t in tokens), base, model


def _docs(seed, n=150):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(n):
        text = " ".join("The" if r.random() < 0.3 else words[int(r.paretovariate(0.7)) % 300] for _ in range(r.randint(0, 60)))
        rows.append((i, text))
    rows += [(1000, None), (1001, ""), (1002, "\t\n"), (None, "the w1"), (1003, "É É \x01 \x85 the"), (0, rows[0][1]), (0, rows[0][1])]
    rows.append((1004, "the " * 6000 + "w1"))
    return rows


def _check(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string, score string" if len(rows[0]) == 3 else "doc_id long, text string")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 0
    out, model = katz_scores(df, held, **options)
    got = out.collect()
    is_held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 4 == 0
    plain = Plain([t for i, t in rows if not is_held(i)], options.get("order", 3))
    want = sorted((i or 0, is_held(i), *plain.scores(t)) for i, t in rows)
    got = sorted((r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.base_score, r.score) for r in got)
    assert [w[:4] for w in want] == [g[:4] for g in got]
    assert np.allclose([w[4:] for w in want], [g[4:] for g in got], rtol=1e-9, atol=1e-9)
    assert {r.train_tokens for r in out.collect()} == {plain.n}
    return plain, model


@pytest.mark.parametrize("order, block", [(2, 1_500_000), (2, 200), (3, 1_500_000), (3, 200), (4, 200)])
def test_scores_equal_the_plain_model(spark, order, block):
    plain, model = _check(spark, _docs(1), block_tokens=block, order=order)
    assert plain.contexts["the",] > 4 * SURE  # its pairs are split over several buckets
    assert [len(x.split) > 0 for x in model.levels] == [True] * (order - 1)
    for n, level in enumerate(model.levels, 1):
        assert np.allclose(level.factors, plain.d[n])


def test_grams_go_on_over_pieces_of_a_text():
    from loanframe.llm.katz import _Block, _Walk

    block = _Block()
    block.add(0, 7, False, [b"\t"], [b"a", b"b"])
    block.add(0, 7, False, [b"a", b"b"], [b"c", b"\x0b"])
    coded = pa.Table.from_batches([block.coded(0, 1)])
    words = zstandard.decompress(coded["lists"][0][0]["words"].as_py()).split(b"\n")
    assert unpack(coded["lists"][0][0]["counts"].as_py())[0].tolist() == [int(w != b"\t") for w in words]
    answer = pack(np.arange(len(words)), np.ones(len(words), np.int64))
    walk = _Walk(coded, [[answer]], Unigrams(4, 4, 1, [4, 0, 0, 0, 0, 0]))
    walk.level = 2
    walk.ask(Sizes(1, 1000))
    got = [(words[b], int(n)) for b, n in zip(walk.b, walk.trained)]
    assert sorted(got) == [(b"\x0b", 1), (b"b", 1), (b"c", 1)]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_plain_model_sums_to_one(order):
    plain = Plain([t for _, t in _docs(2)], order)
    for a in [["<s>"], ["the"], ["w1"], ["w7"], ["never seen"], ["<s>", "the"], ["the", "the"], ["w1", "the"], ["the", "w1", "the"]]:
        given = a[-order + 1 :]
        assert sum(plain.probability(*given, b) for b in [*plain.uni, "an unknown token"]) == pytest.approx(1, abs=1e-9)


def test_no_training_rows_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    rows = katz_scores(df, F.lit(True))[0].orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in rows] == [(3, 0, 0, 0, 0), (1, 0, 0, 0, 0)]
    assert katz_scores(df.filter("false"), F.lit(False))[0].count() == 0


def test_long_texts_are_read_in_pieces():
    text = "Ab  cD\te" * 1000
    whole = [w for part in segments(text) for w in part]
    pieces = list(segments(text, 100))
    assert len(pieces) > 50 and [w for part in pieces for w in part] == whole
    assert list(segments("x" * 1000, 10)) == [[b"x" * 1000, b"\x0b"]]


def test_packing():
    arrays = [np.array([0, 5, 1 << 40]), np.array([], np.int64), np.array([255, 256]), np.array([0.1, -2.5])]
    for a, b in zip(arrays, unpack(pack(*arrays))):
        assert (a == b).all()


def test_rising_numbers_and_repeated_floats_pack_small():
    random_ = np.random.default_rng(1)
    ids = np.cumsum(random_.integers(1, 40, 10000)) * 24 + 7
    floats = random_.random(100)[random_.integers(0, 100, 10000)]
    a, b = unpack(pack(ids, floats))
    assert (a == ids).all() and (b == floats).all()
    assert len(pack(ids)) < 12000 and len(pack(floats)) < 12000


def test_one_level_is_kept_on_disk(spark, tmp_out):
    from loanframe.sources.files import _scratch_dir

    kept, folder = _scratch_dir(spark).removeprefix("file:"), tmp_out("katz")
    before = set(os.listdir(kept)) if os.path.isdir(kept) else set()
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(setting)
    out, _ = katz_scores(spark.createDataFrame(_docs(4), "doc_id long, text string"), F.lit(False), tables=folder)
    new = set(os.listdir(kept)) - before - {os.path.basename(folder)}
    assert sorted(n.rsplit("-", 1)[0] for n in new) == ["blocks_3", "grams_3"]
    assert not any(os.path.isdir(f"{kept}/{n}/own=true") for n in new)
    assert spark.conf.get(setting) == was
    assert out.count() == len(_docs(4))  # reads what is left
    for r in spark.read.parquet(f"{folder}/unigrams").collect():
        counts = unpack(bytes(r.counts))[0]
        assert (counts[1:] <= counts[:-1]).all()  # frequent words have small numbers


def test_discounts_fall_back_to_half_a_count():
    assert discounts([9, 0, 1, 1, 1, 1])[1] == 0.5
    good = discounts([1000, 400, 230, 150, 110, 85])
    assert (good[1:] > 0).all() and (good[1:] < 1).all() and good[1] != 0.5


def test_tables_hold_all_counts(spark, tmp_out):
    rows, folder = _docs(3), tmp_out("katz")
    plain, _ = _check(spark, rows, tables=folder)
    buckets = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    words, uni = {}, Counter()
    for r in spark.read.parquet(f"{folder}/unigrams").collect():
        for k, (w, c) in enumerate(zip(zstandard.decompress(bytes(r.words)).split(b"\n"), unpack(bytes(r.counts))[0])):
            word = {"\t": "<s>", "\x0b": "</s>"}.get(w.decode(), w.decode())
            words[k * buckets + r.bucket] = word
            uni[word] += int(c)
    assert +uni == plain.uni
    pairs = Counter()
    for r in spark.read.parquet(f"{folder}/pairs").collect():
        for a, b, c in zip(*(x.tolist() for x in unpack(bytes(r.value)))):
            pairs[words[a], words[b]] += c
    assert pairs == plain.pairs
    ids, triples, weights = {}, Counter(), {}
    for r in spark.read.parquet(f"{folder}/pairs").collect():
        a, b, _ = unpack(bytes(r.value))
        ids |= {i: (words[x], words[y]) for i, x, y in zip(unpack(bytes(r.ids))[0].tolist(), a.tolist(), b.tolist())}
    for r in spark.read.parquet(f"{folder}/grams_3").collect():
        for a, b, c in zip(*(x.tolist() for x in unpack(bytes(r.value)))):
            triples[*ids[a], words[b]] += c
    assert triples == Counter({(*c, w): n for c, x in plain.after.items() if len(c) == 2 for w, n in x.items()})
    for n, names in ((2, lambda a: (words[a],)), (3, ids.get)):
        for r in spark.read.parquet(f"{folder}/contexts_{n}").collect():
            a, w = unpack(bytes(r.value))
            weights |= {names(k): v for k, v in zip(a.tolist(), w.tolist())}
    assert set(weights) == set(plain.after)
    for context, w in plain.weights.items():
        assert weights[context] == pytest.approx(w, rel=1e-9)
    factors = spark.read.parquet(f"{folder}/discounts_3").first().factors
    assert np.allclose(factors, plain.d[2])


def test_query(spark):
    from loanframe.llm.queries import op8_katz_scores

    out = op8_katz_scores(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    r = out.filter("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s > r.b


def test_a_block_takes_few_bytes_a_token():
    import tracemalloc

    from loanframe.llm.katz import Level, _answer_grams, _asker, _Block, _complete, _walked

    random_ = np.random.default_rng(3)
    block = _Block()
    for k in range(300):
        block.add(k, k, k % 9 == 0, [b"\t"], [b"w%d" % i for i in random_.integers(0, 3000, 1000)] + [b"\x0b"])
    n, sizes = block.size, Sizes(7, 1 << 40)
    coded = pa.Table.from_batches([block.coded(0, 7)])
    told = []
    for x in coded["lists"][0].as_py():
        counts = unpack(x["counts"])[0]
        told.append(pack(np.arange(len(counts)), counts))
    uni, levels, answers = Unigrams(n, 1000, 300, [5, 4, 3, 2, 1, 1]), [], [told]
    half = np.array([1, *((r - 0.5) / r for r in range(1, K + 1))])

    def state():
        return coded.append_column("answers", pa.array([answers], pa.list_(pa.list_(pa.binary()))))

    def peak(work):
        tracemalloc.start()
        work()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most / n

    for level, most in ((2, 75), (3, 120)):
        ask, own = _asker(uni, levels, sizes), state()
        assert peak(lambda: [None for _ in ask(own)]) < most
        asked = pa.concat_tables(ask(own))
        found = [
            _answer_grams(asked.filter(pa.compute.equal(asked["bucket"], b)), level, sizes, level == 3, False, half).to_pylist()[0]
            for b in sorted(set(asked["bucket"].to_pylist()))
        ]
        answers.append([r["answer"] for r in found])
        levels.append(Level(half, np.zeros(0, np.int64), np.zeros(0)))
    own = state()
    with np.errstate(all="ignore"):  # these counts are no real model's
        assert peak(lambda: _complete(own, _walked(own, uni, levels, sizes), uni)) < 124


def test_python_gets_one_large_block_at_a_time(spark, tmp_out):
    from loanframe.llm.katz import BATCH_BYTES, _stored

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    path = tmp_out("values")
    value = F.expr(f"cast(repeat('abcd', {BATCH_BYTES // 4 + 1}) as binary)")
    spark.range(0, 5, 1, 1).withColumn("value", value).write.parquet(path)
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(setting)
    out, _ = _stored(spark.read.parquet(path).mapInArrow(rows, "n long"), "sizes")
    assert [r.n for r in out.collect()] == [1] * 5
    assert spark.conf.get(setting) == was
