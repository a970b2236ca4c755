import numpy as np
import pytest
from test_simhash import roots_of

from loanframe.llm import embeddings
from loanframe.llm.embeddings import embedding_groups, spherical_kmeans, unit


def _vectors(seed, n=300, crowd=120, dim=24):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim))
    center = r.normal(size=dim)
    near = center + r.normal(size=(crowd, dim)) * 0.2
    pairs = x[:60] + r.normal(size=(60, dim)) * 0.3 * r.random((60, 1))
    return np.concatenate([x, near, pairs, x[:5], x[:5]]).astype(np.float32)


def brute(ids, vectors, threshold=0.95):
    u = unit(vectors)
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    root = roots_of(list(range(len(ids))), lambda a, b: near[a, b])
    least = {}
    for i, r in root.items():
        least[r] = min(least.get(r, ids[i]), ids[i])
    return {i: (int(near[k].sum()), least[root[k]]) for k, i in enumerate(ids)}, near


@pytest.mark.parametrize("block,cells", [(2048, 4096), (37, 4096), (2048, 1)])
def test_exact_reach_equals_brute_force(spark, monkeypatch, block, cells):
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "MAX_CELLS", cells)
    v = _vectors(1)
    ids = list(range(1000, 1000 + len(v)))
    want, _ = brute(ids, v)
    df = spark.createDataFrame([(i, x.tolist(), 1) for i, x in zip(ids, v)], "vec_id long, embedding array<float>, label int")
    got = embedding_groups(df).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_recall_of_a_short_reach(spark):
    r = np.random.default_rng(7)
    x = r.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = r.normal(size=(500, 64))
    z -= (z * x[:500]).sum(1, keepdims=True) * x[:500]
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    v = np.concatenate([x, 0.951 * x[:500] + np.sqrt(1 - 0.951**2) * z]).astype(np.float32)
    ids = list(range(len(v)))
    want, _ = brute(ids, v)
    df = spark.createDataFrame([(i, e.tolist()) for i, e in zip(ids, v)], "vec_id long, embedding array<float>")
    got = {r.vec_id: r.n_links for r in embedding_groups(df, reach=0.06).collect()}
    assert all(got[i] <= want[i][0] for i in ids)
    assert sum(got.values()) / sum(w[0] for w in want.values()) >= 0.99


def test_odd_vectors(spark):
    a = [1.0, 2.0, 3.0]
    rows = [
        (5, a), (4, a), (4, a), (None, a), (6, [2.0, 4.0, 6.0]), (7, None), (8, []), (9, [0.0, 0.0, 0.0]),
        (10, [1.0, None, 2.0]), (11, [float("nan"), 1.0, 1.0]), (12, [float("inf"), 1.0, 1.0]), (13, [1.0, 2.0]),
        (14, [-1.0, -2.0, -3.0]), (15, [3e38, 3e38, 3e38]), (None, None),
    ]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in embedding_groups(df).collect()), key=str)
    want = [(5, 4, 4, False), (4, 4, 4, True), (4, 4, 4, True), (None, 4, 4, False), (6, 4, 4, False)]
    want += [(i, 0, i, True) for i in range(7, 16)] + [(None, 0, None, True)]
    assert got == sorted(want, key=str)
    assert embedding_groups(df.filter("false")).count() == 0


def test_double_components_keep_their_precision(spark):
    # At cosine 0.95 and a hair below it, which single precision cannot tell apart.
    t = 0.95
    rows = [(0, [1.0, 0.0]), (1, [t * 3, (1 - t * t) ** 0.5 * 3 * (1 - 1e-12)]), (2, [t, -((1 - t * t) ** 0.5) * (1 + 1e-9)])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id) for r in embedding_groups(df).collect()}
    assert got == {0: (1, 0), 1: (1, 0), 2: (0, 2)}


def test_kmeans_gives_unit_centroids():
    x = unit(np.random.default_rng(0).normal(size=(200, 8)))
    c = spherical_kmeans(np.concatenate([x, np.repeat(x[:1], 100, 0)]), 20)
    assert np.allclose(np.linalg.norm(c, axis=1), 1) and len(c) == 20


def test_query_equals_brute_force(spark):
    from loanframe.llm.queries import op2_embedding_near_dedup

    d = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{d}/embeddings.parquet").collect()
    want, _ = brute([r.vec_id for r in rows], [r.embedding for r in rows])
    got = op2_embedding_near_dedup(spark, d).collect()
    assert {r.vec_id: (r.n_links, r.component_id) for r in got} == want
