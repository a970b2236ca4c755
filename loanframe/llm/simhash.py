"""SimHash near-duplicates by a segment-popcount grid (operator 5).

A text's fingerprint has 64 bits: bit i is set when over half of the XXH64 hashes of
its word shingles have it set.  Two documents are linked when their fingerprints
differ in at most two bits.

The links are found without comparing all pairs.  A fingerprint is mapped to the bit
counts of its 32 two-bit segments.  The Manhattan distance of two such points is never
more than the number of differing bits, so linked fingerprints lie at most two apart,
and two points that far apart share a grid point at distance one or less from both.
Every distinct fingerprint is therefore put in the cell of its own point and of the
neighbouring grid points (49 on average, 65 at most), and all that share a cell are
compared bit by bit.  A cell is so narrow that two random fingerprints meet with a
chance of about 2e-11, so what meets are nearly always near copies, at all sizes.

The rows of the cells are shuffled and sorted by cell and compared as they stream by.  A
cell of more than ``CELL`` rows is passed on instead and compared in pairs of blocks,
each a task group of its own, so no cell is held by one task.  Only links that connect
something new leave a comparison, never all pairs of a cell.

Defined cases: a null text or one without words has fingerprint zero, linked like any
other; fewer words than the shingle length give one shingle of all words.  Repeated
rows and repeated ids are kept as rows.  A null id takes part, but is never the
smallest id while the component holds another (a component of null ids only has a null
id).  Existing columns of the outputs' names are replaced; others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from .bpe import _in_pieces, _placed
from .common import column, packed, ship_package, stored, unpacked, with_fields
from .components import components

SHINGLE = 3
MAX_BITS = 2
#: Hashes counted at a time.
BLOCK = 1 << 18
#: Rows of a cell that are compared by one task.
CELL = 2048
_SEGMENT = 2  # bits of a segment, and those that hold its count


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends[: len(words) - width + 1] - [len(w) + 1 for w in islice(words, len(words) - width + 1)]).tolist()
    ends = (ends[width - 1 :] - 1).tolist()
    digest, n, ones = xxhash.xxh64_intdigest, len(starts), np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        part = [digest(joined[s:e], 42) for s, e in zip(starts[i : i + BLOCK], ends[i : i + BLOCK])]
        raw = np.array(part, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(raw, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def with_fingerprints(df: DataFrame, text: str = "text", out: str = "fingerprint", shingle: int = SHINGLE) -> DataFrame:
    """``df`` with ``out``, the fingerprint's 64 bits as a (signed) long; no shuffle."""
    ship_package(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_pieces(batches, text):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            found = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield _placed(batch, out, pa.array(found))

    return df.mapInArrow(run, with_fields(df, StructField(out, LongType())))


def _cells(fp: str = "fp"):
    """The grid points at distance 0 or 1 of a fingerprint's point: two bits a segment
    hold its bit count."""
    odd = F.lit(0x5555555555555555).cast("bigint")
    at = lambda k, width: F.call_function("shiftleft", k, width)
    half = F.call_function("shiftrightunsigned", F.col(fp), F.lit(1))
    point = F.col(fp).bitwiseXOR(half).bitwiseAND(odd).bitwiseOR(at(F.col(fp).bitwiseAND(half).bitwiseAND(odd), F.lit(1)))
    number = lambda k: F.lit(k).cast("bigint")

    def near(p):
        # 0 <-> 1 changes the lower bit of a count, 1 <-> 2 both; no sum can overflow.
        count = lambda i: F.call_function("shiftrightunsigned", p, i).bitwiseAND(number(3))
        return F.transform(
            F.sequence(F.lit(0), F.lit(62), F.lit(_SEGMENT)),
            lambda i: F.array(
                F.when(count(i) <= 1, p.bitwiseXOR(at(number(1), i))),
                F.when(count(i) >= 1, p.bitwiseXOR(at(number(3), i))),
            ),
        )

    # One element, so that the point is computed once.
    return F.flatten(F.flatten(F.transform(F.array(point), lambda p: F.concat(F.array(F.array(p)), near(p)))))


def spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs (a, b) that connect all that the pairs connect, without
    circles: in rounds, every component takes its first pair to another one."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = at[: len(a)], at[len(a) :]
    label, live, kept = np.arange(len(nodes)), np.arange(len(a)), np.zeros(len(a), bool)
    while True:
        live = live[label[i[live]] != label[j[live]]]
        if not len(live):
            return a[kept], b[kept]
        first = np.full(len(nodes), len(a))
        np.minimum.at(first, label[i[live]], live)
        np.minimum.at(first, label[j[live]], live)
        used = np.unique(first[first < len(a)])
        kept[used] = True
        while True:
            x, y = label[i[used]], label[j[used]]
            if (x == y).all():
                break
            into = np.arange(len(nodes))
            np.minimum.at(into, np.maximum(x, y), np.minimum(x, y))
            label = into[label]


class _Links:
    """Verified pairs, thinned whenever they are many."""

    def __init__(self):
        self.a = self.b = np.zeros(0, np.int64)

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        near = np.bitwise_count((x ^ y).view(np.uint64)) <= MAX_BITS  # of signed numbers it counts the absolute value's
        if near.any():
            self.a, self.b = np.append(self.a, x[near]), np.append(self.b, y[near])
            if len(self.a) > CELL * 64:
                self.a, self.b = spanning(self.a, self.b)

    def rows(self) -> pa.RecordBatch:
        a, b = spanning(self.a, self.b)
        none = pa.nulls(len(a), pa.int64())
        return pa.RecordBatch.from_arrays([none, pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["cell", "a", "b"])


def _full(cell: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    """Rows of cells that are too full for one task."""
    return pa.RecordBatch.from_arrays([pa.array(cell), pa.array(fp), pa.nulls(len(fp), pa.int64())], ["cell", "a", "b"])


def _compare_sorted(batches: Iterator[pa.RecordBatch], block: int) -> Iterator[pa.RecordBatch]:
    """Links within each cell of rows (cell, fp) sorted by cell; the rows of cells with
    more than ``block`` rows as they are."""
    cell, fp, full = np.zeros(0, np.int64), np.zeros(0, np.int64), None

    def done(cell: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        _, start, size = np.unique(cell, return_index=True, return_counts=True)
        many = np.repeat(size > block, size)
        if many.any():
            yield _full(cell[many], fp[many])
            cell, fp = cell[~many], fp[~many]
        links, one, step = _Links(), np.arange(len(cell)), 1
        while len(one := one[one + step < len(cell)]):
            one = one[cell[one] == cell[one + step]]
            links.add(fp[one], fp[one + step])
            step += 1
        yield links.rows()

    for batch in batches:
        new_cell, new_fp = batch["cell"].to_numpy(), batch["fp"].to_numpy()
        if full is not None:
            same = new_cell == full
            if same.any():
                yield _full(new_cell[same], new_fp[same])
            new_cell, new_fp = new_cell[~same], new_fp[~same]
            if not len(new_cell):
                continue
            full = None
        cell, fp = np.append(cell, new_cell), np.append(fp, new_fp)
        if not len(cell):
            continue
        # Sorted as signed numbers, so the last cell's rows are all at the end.
        open_at = int(np.searchsorted(cell, cell[-1]))
        yield from done(cell[:open_at], fp[:open_at])
        cell, fp = cell[open_at:], fp[open_at:]
        if len(cell) > block:
            yield _full(cell, fp)
            full, cell, fp = cell[0], cell[:0], fp[:0]
    yield from done(cell, fp)


def _compare_blocks(rows: pa.Table) -> pa.Table:
    """Links between two blocks of a cell, or within one."""
    i, j, block, fp = (rows[c].to_numpy() for c in ("i", "j", "block", "fp"))
    left, right, links = fp[block == i[0]], fp[block == j[0]], _Links()
    for k in range(0, len(left), 64):
        x = np.repeat(left[k : k + 64], len(right))
        y = np.tile(right, len(left[k : k + 64]))
        once = x < y if i[0] == j[0] else slice(None)
        links.add(x[once], y[once])
    return pa.Table.from_batches([links.rows()])


def near_fingerprints(fingerprints: DataFrame, block: int = CELL) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints ``fp`` that differ in at most
    two bits; as many as connect all that such links connect."""
    ship_package(fingerprints.sparkSession)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _compare_sorted(batches, block)

    cells = fingerprints.select("fp", F.explode(_cells()).alias("cell")).filter("cell is not null")
    schema = "cell long, a long, b long"
    found = cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(compare, schema)
    found = stored(found, "cells")
    full = found.filter("cell is not null").select("cell", F.col("a").alias("fp"))
    sizes = full.groupBy("cell").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    here = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(here, k).alias("i"), F.greatest(here, k).alias("j")),
    )
    met = full.join(sizes, "cell").select("cell", "fp", here.alias("block"), F.inline(others))
    more = met.groupBy("cell", "i", "j").applyInArrow(_compare_blocks, schema)
    return found.filter("cell is null").union(more).select("a", "b")


def least_of_components(rows: DataFrame, value) -> DataFrame:
    """``(fp, least)`` of rows with a fingerprint ``fp``: the least ``value`` (an
    expression over ``rows``) among all rows that links lead to."""
    distinct = stored(rows.groupBy("fp").agg(F.min(value).alias("own")), "fingerprints")
    roots = components(near_fingerprints(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "own", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("own").alias("least"))
    return rooted.join(least, "root").select("fp", "least")


def simhash_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document row: doc_id, fingerprint (long) and component_id (the
    smallest doc_id that links lead to)."""
    rows = with_fingerprints(docs.select(column(doc_id).alias("doc_id"), column(text).alias("text")), out="fp")
    rows = stored(rows.select("doc_id", "fp"), "simhash")
    found = rows.join(least_of_components(rows, F.col("doc_id")), "fp")
    return found.select("doc_id", F.col("fp").alias("fingerprint"), F.col("least").alias("component_id"))


def keep_one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each group of linked documents: that of the smallest
    id (among rows of one id that of the least text hash; of rows with equal id and
    text any one)."""
    keys = ("null_id", "id", "text_hash")
    spread = docs.select(
        packed(docs),
        column(doc_id).isNull().alias("null_id"),
        F.coalesce(column(doc_id), F.lit(0)).cast("bigint").alias("id"),
        F.xxhash64(column(text)).alias("text_hash"),
    )
    rows = with_fingerprints(spread.select(F.col("row").getField(text).alias("text"), *keys), out="fp")
    rows = stored(rows.select(*keys, "fp"), "simhash")
    kept = least_of_components(rows, F.struct(*keys)).select("least.*").distinct()
    return spread.join(kept, list(keys)).dropDuplicates(list(keys)).select(*unpacked(docs.columns))
