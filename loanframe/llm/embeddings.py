"""Embedding near-duplicates by spherical k-means cells (operator 2).

Equal vectors are merged first (with their number), so exact copies cost one row.
Spherical k-means, fitted on a bounded sample of the distinct vectors, gives unit
centroids.  Every vector belongs to the cell of its nearest centroid, and visits each
cell from which only a distance of at most ``reach`` to the plane between the two
centroids parts it.  Within a cell the cosines of members with members and with visitors
are computed as blocked matrix products in double precision, and a pair is linked at
cosine ``THRESHOLD`` or more.  A pair that meets in two cells counts once.

No link is missed: unit vectors at cosine t are sqrt(2 - 2t) apart, so when a plane
parts them, one of the two is no further from it than half of that, which is the default
``reach`` (0.158 at 0.95), and visits the other's cell.  A smaller ``reach`` is faster
and misses only pairs whose difference points at the other centroid.

The rows of a cell are split in blocks; every pair of blocks is a task group of its own,
so no cell, however hot, is one task.  A group returns link counts and a spanning forest
of its links, never the pairs themselves.

Defined cases: a vector that is null, empty, zero or holds null, NaN or infinite
components links with nothing; so do vectors of different lengths with each other.
Rows with equal vectors are linked, repeated rows and repeated or null ids included;
``component_id`` is the smallest id that is not null, or null where there is none.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, ship_package, stored
from .components import components

THRESHOLD = 0.95
#: Distinct vectors that k-means is fitted on, and its rounds.
SAMPLE, ROUNDS = 20_000, 8
#: Most centroids; there are half the square root of the distinct vectors otherwise.
MAX_CELLS = 4096
#: Members of a block (a block of visitors has four times as many), and rows that are
#: compared with a block at a time.
BLOCK, CHUNK = 2048, 1024


def _usable(v: Column) -> Column:
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def unit(vectors) -> np.ndarray:
    """Rows of length one, in double precision."""
    x = np.stack([np.asarray(v, np.float64) for v in vectors])
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Unit centroids of unit rows.  It starts from rows that differ, so that a crowd
    of near copies does not take several centroids."""
    order = np.random.default_rng(2).permutation(len(x))
    chosen: list[int] = []
    for i in order:
        if len(chosen) == k:
            break
        if not chosen or (x[chosen] @ x[i]).max() < 0.8:
            chosen.append(int(i))
    c = x[chosen]
    for _ in range(rounds):
        nearest = (x @ c.T).argmax(1)
        sums = np.zeros_like(c)
        np.add.at(sums, nearest, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 1e-9, sums / np.maximum(size, 1e-9), c)
    return c


def fit_centroids(vectors: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Centroids for each vector length, from at most ``SAMPLE`` of ``n`` vectors."""
    share = max(1, math.ceil(n / SAMPLE))
    rows = vectors.filter(F.pmod(F.xxhash64("vector"), F.lit(share)) == 0).select("vector").limit(SAMPLE)
    by_size = defaultdict(list)
    for r in rows.collect():
        by_size[len(r["vector"])].append(r["vector"])
    cells = min(MAX_CELLS, max(1, round(math.sqrt(n) / 2)))
    return {size: spherical_kmeans(unit(v), cells) for size, v in by_size.items()}


def _matrix(vectors: pa.ListArray) -> np.ndarray:
    """Unit rows of lists of one length."""
    x = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(vectors), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _gaps(c: np.ndarray) -> np.ndarray:
    """Distances between centroids."""
    return np.sqrt(np.maximum(2 - 2 * (c @ c.T), 1e-300))


def _in_cells(vectors: DataFrame, centroids, reach: float) -> DataFrame:
    """A row for the cell of every vector and for each cell that it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = pc.list_value_length(batch["vector"])
            for size in pc.unique(sizes).to_pylist():
                part = batch.filter(pc.equal(sizes, size))
                c, at = centroids.value.get(size), np.arange(part.num_rows)
                home, cell = np.zeros(len(at), np.int32), np.zeros(len(at), np.int32)
                if c is not None and len(c) > 1:
                    near = _matrix(part["vector"]) @ c.T
                    home = near.argmax(1)
                    behind = (near[at, home][:, None] - near) / _gaps(c)[home]
                    goes = behind <= reach
                    goes[at, home] = True
                    at, cell = np.nonzero(goes)
                    home = home[at]
                rows = part.take(pa.array(at))
                more = [np.full(len(at), size), cell, home]
                yield pa.RecordBatch.from_arrays(
                    rows.columns + [pa.array(x.astype(np.int32)) for x in more], rows.schema.names + ["size", "cell", "home"]
                )

    kind = vectors.schema["vector"].dataType.simpleString()
    return vectors.select("node", "n", "vector").mapInArrow(
        run, f"node long, n long, vector {kind}, size int, cell int, home int"
    )


def _forest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Rows (node, least node) that connect what the pairs (a, b) connect."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    least = np.arange(len(nodes))
    while True:
        before = least.copy()
        low = np.minimum(least[i], least[j])
        np.minimum.at(least, i, low)
        np.minimum.at(least, j, low)
        least = least[least]
        if (least == before).all():
            break
    moved = least != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[least[moved]]], 1)


def _compare(rows: pa.Table, centroids: dict[int, np.ndarray], threshold: float, reach: float) -> pa.Table:
    """Link counts (b is null) and connecting pairs of a block of members with another
    block of members, or with one of visitors."""
    rows = rows.combine_chunks()
    cell, i, j = (rows[c][0].as_py() for c in ("cell", "i", "j"))
    home, block = rows["home"].to_numpy(), rows["block"].to_numpy()
    left = np.flatnonzero((home == cell) & (block == i))
    right = left if i == j else np.flatnonzero(((home == cell) & (block == j)) | (home != cell))
    node, n = rows["node"].to_numpy(), rows["n"].to_numpy()
    found, links = [], np.zeros(len(rows), np.int64)
    if len(left) and len(right):
        unit_rows = _matrix(rows["vector"].chunk(0))
        c = centroids.get(unit_rows.shape[1])
        for start in range(0, len(right), CHUNK):
            part = right[start : start + CHUNK]
            x, y = np.nonzero(unit_rows[left] @ unit_rows[part].T >= threshold)
            x, y = left[x], part[y]
            if i == j:
                x, y = x[x < y], y[x < y]
            away = np.flatnonzero(home[y] != cell)
            if len(away):
                # The pair also meets in the visitor's cell if the member goes there;
                # it counts in the cell with the lower number.
                mine, other = unit_rows[x[away]], home[y[away]]
                behind = ((mine * (c[cell] - c[other])).sum(1)) / _gaps(c)[cell, other]
                twice = (behind <= reach) & (other < cell)
                keep = np.ones(len(x), bool)
                keep[away[twice]] = False
                x, y = x[keep], y[keep]
            np.add.at(links, x, n[y])
            np.add.at(links, y, n[x])
            if len(x):
                found.append(_forest(node[x], node[y]))
    told = np.flatnonzero(links)
    pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
    return pa.table(
        {
            "a": np.concatenate([node[told], pairs[:, 0]]),
            "b": pa.array(np.concatenate([node[told], pairs[:, 1]]), mask=np.arange(len(told) + len(pairs)) < len(told)),
            "links": np.concatenate([links[told], np.zeros(len(pairs), np.int64)]),
        }
    )


def embedding_links(vectors: DataFrame, threshold: float = THRESHOLD, reach: float | None = None) -> DataFrame:
    """``(a, b, links)`` over distinct ``vectors`` (node, n, vector): with b null, how
    many rows ``a`` is linked with; else that a and b are connected."""
    spark = vectors.sparkSession
    ship_package(spark)
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) / 2 + 1e-9 if reach is None else reach
    centroids = spark.sparkContext.broadcast(fit_centroids(vectors, vectors.count()))
    placed = _in_cells(vectors, centroids, reach)
    # Two numbers a cell come to the driver and go to the tasks, whatever the rows.
    member = F.col("home") == F.col("cell")
    sizes = placed.groupBy("size", "cell").agg(F.count_if(member).alias("members"), F.count_if(~member).alias("visitors"))
    cells = [
        (r["size"], r["cell"], math.ceil(r["members"] / BLOCK), math.ceil(r["visitors"] / (4 * BLOCK)))
        for r in sizes.collect()
    ]
    blocks = spark.createDataFrame(cells, "size int, cell int, members int, visitors int")
    own = F.pmod(F.xxhash64("node"), F.greatest("members", F.lit(1)))
    other = F.pmod(F.xxhash64("node"), F.greatest("visitors", F.lit(1))) + F.col("members")

    def pairs(count: str, left, right) -> Column:
        numbers = F.filter(F.sequence(F.lit(0), F.col(count)), lambda k: k < F.col(count))
        return F.transform(numbers, lambda k: F.struct(left(k).cast("int").alias("i"), right(k).cast("int").alias("j")))

    here = F.col("block")
    with_members = pairs("members", lambda k: F.least(here, k), lambda k: F.greatest(here, k))
    with_visitors = pairs("visitors", lambda k: here, lambda k: k + F.col("members"))
    as_visitor = pairs("members", lambda k: k, lambda k: here)
    dealt = (
        placed.join(F.broadcast(blocks), ["size", "cell"])
        .withColumn("block", F.when(member, own).otherwise(other).cast("int"))
        .withColumn("at", F.explode(F.when(member, F.concat(with_members, with_visitors)).otherwise(as_visitor)))
        .select("node", "n", "vector", "size", "cell", "home", "block", "at.i", "at.j")
    )

    def compare(rows: pa.Table) -> pa.Table:
        return _compare(rows, centroids.value, threshold, reach)

    return dealt.groupBy("size", "cell", "i", "j").applyInArrow(compare, "a long, b long, links long")


def embedding_groups(
    df: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = THRESHOLD,
    reach: float | None = None,
) -> DataFrame:
    """One row per row of ``df``: vec_id, n_links, component_id, kept."""
    kind = df.schema[vector].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    rows = df.select(column(vec_id).alias("vec_id"), column(vector).cast(kind).alias("vector"))
    rows = rows.withColumn("vector", F.when(_usable(F.col("vector")), F.col("vector")))
    distinct = stored(
        rows.filter("vector is not null")
        .groupBy("vector")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("n"))
        .withColumn("node", F.monotonically_increasing_id()),
        "vectors",
    )
    links = stored(embedding_links(distinct, threshold, reach), "links")
    degree = links.filter("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(links.filter("b is not null"))
    rooted = (
        distinct.join(degree, "node", "left")
        .join(roots, "node", "left")
        .select(
            "vector",
            "first_id",
            F.coalesce("root", "node").alias("root"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
        )
    )
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    told = rooted.join(least, "root").select("vector", "n_links", "component_id")
    out = rows.join(told, "vector", "left")
    component = F.when(F.col("vector").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
