"""Source divergence audit (operator 11).

How far do the sources of a language differ in their words?  Every source of a language
gives each kept term (of at least ``min_docs`` documents of the language) a smoothed,
scaled probability ``p``; against another probability ``q`` a term adds
``floor((p - q)^2 / q)``, in exact integers.  Two parts come out: ``pair``, the sum over
all kept terms against every other source of the language, and ``term``, the terms by
which a source exceeds its whole language most.

Pairs of sources are not compared term by term.  Terms with equal counts in every source
become one entry with a length; the entries of a language are put in the order of their
counts, so that equal counts of one source stand together, and every source's column is
stored as runs ``(start, length, count)``, its zeros being the gaps.  Two columns are
compared over the intersections of their runs: f of the two counts, times the length.
Columns are cut into blocks (:data:`BLOCK_RUNS` runs), whose sums add up, so no task
ever holds a whole vocabulary or a whole source.

What is shuffled: one row per language and term from each :data:`HELD_WORDS` words of a
task, with its counts by source; the entries; the blocks.  All counts of a term meet in
one partition, so sums and kept terms need no other shuffle.  A source or a term that holds a third of all
text is a sum in every task.  Blocks times sources of a language rows say which columns
meet, and the sources of one language are compared in pairs, as the result asks: their
number (some hundreds of labels, not pages or hosts) is what this operator assumes to be
small.

Defined cases: null text, language and source are read as empty ones; a language without
kept terms gives pairs with value 0; a source without terms takes part with zero counts;
a language of one source has no pairs.  Repeated rows are documents each.  Texts of any
length are read whole, in blocks.  Empty tables give no rows; other columns are ignored.
Equal values rank by the item's UTF-8 bytes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, ship_package, stored
from .words import BLOCK, LETTERS, byte_texts, word_blocks

#: A kept term occurs in so many documents of the language.
MIN_DOCS = 3
#: Ranks of the part ``term``.
TOP = 200
#: Probabilities are counted in parts of this.
SCALE = 1_000_000_000
#: A block of columns ends after so many runs.
BLOCK_RUNS = 1 << 17
#: A task hands on its partial counts when it holds so many words.
HELD_WORDS = 1 << 21
#: Rows that a task hands on at once.
SENT_ROWS = 1 << 14
#: Counts below this, times SCALE, fit in 64 bits.
LONG_COUNT = 9_000_000_000


def _partial_rows(lang: str, terms: pa.Array, offsets, sources: pa.Array, n, docs) -> Iterator[pa.RecordBatch]:
    """Rows ``(lang, term, cells)``; the cells of row i are those from ``offsets[i]`` on."""
    kinds = pa.struct([("source", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
    cells = pa.StructArray.from_arrays([sources, pa.array(n, pa.int64()), pa.array(docs, pa.int64())], fields=list(kinds))
    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), cells)
    langs = pa.array([lang], pa.string()).take(pa.array(np.zeros(len(terms), np.int64)))
    out = pa.RecordBatch.from_arrays([langs, terms.cast(pa.string()), lists], ["lang", "term", "cells"])
    for at in range(0, out.num_rows, SENT_ROWS):
        yield out.slice(at, SENT_ROWS)


class _Held:
    """The words of some documents of one language, as numbers in the order they were met."""

    def __init__(self) -> None:
        self.numbers: defaultdict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.words: list[np.ndarray] = []
        self.sources: list[str] = []
        self.docs: dict[str, int] = {}

    def add(self, source: str, words: list[bytes]) -> None:
        self.words.append(np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words)))
        self.sources.append(source)

    def rows(self, lang: str) -> Iterator[pa.RecordBatch]:
        none = pa.array([None], pa.binary())
        yield from _partial_rows(lang, none, [0, len(self.docs)], pa.array(list(self.docs), pa.string()),
                                 [0] * len(self.docs), list(self.docs.values()))
        if not self.numbers:
            return
        # Documents are numbered by source: one sort puts all in the order term, source, document.
        names, own = np.unique(np.array(self.sources, object), return_inverse=True)
        place = np.empty(len(own), np.int64)
        place[np.argsort(own, kind="stable")] = np.arange(len(own))
        keys = np.concatenate(self.words) * len(own) + np.repeat(place, [len(w) for w in self.words])
        keys.sort()
        first = np.flatnonzero(np.diff(keys, prepend=-1))
        term, doc = np.divmod(keys[first], len(own))
        source = np.sort(own)[doc]
        cell = np.flatnonzero((np.diff(term, prepend=-1) != 0) | (np.diff(source, prepend=-1) != 0))
        n = np.diff(first[cell], append=len(keys))
        docs = np.diff(cell, append=len(first))
        row = np.flatnonzero(np.diff(term[cell], prepend=-1))
        sources = pa.array(list(names), pa.string()).take(pa.array(source[cell]))
        yield from _partial_rows(lang, pa.array(list(self.numbers), pa.binary()), np.append(row, len(cell)), sources, n, docs)


def term_counts(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """``(lang, source, term, n, docs)``: occurrences, and documents that hold the term.
    Every group has one row with a null term, and its documents.  The rows of a term of
    a language are in one partition."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: defaultdict[str, _Held] = defaultdict(_Held)
        size = 0
        for batch, texts in byte_texts(batches, "text"):
            for a, b, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
                own = held[a]
                own.docs[b] = own.docs.get(b, 0) + 1
                size += 1
                blocks = word_blocks(t, LETTERS)
                words = next(blocks, [])
                if t and len(t) > BLOCK:
                    # A long text is counted by itself, in blocks.
                    counts = Counter(words)
                    for block in blocks:
                        counts.update(block)
                    terms, n = list(counts), np.fromiter(counts.values(), np.int64, len(counts))
                    for at in range(0, len(terms), SENT_ROWS):
                        some = pa.array(terms[at : at + SENT_ROWS], pa.binary())
                        k = len(some)
                        sources, once = pa.array([b] * k, pa.string()), np.ones(k, np.int64)
                        yield from _partial_rows(a, some, np.arange(k + 1), sources, n[at : at + k], once)
                elif words:
                    own.add(b, words)
                    size += len(words)
                if size >= HELD_WORDS:
                    for a, own in held.items():
                        yield from own.rows(a)
                    held.clear()
                    size = 0
        for a, own in held.items():
            yield from own.rows(a)

    read = docs.select(
        F.coalesce(column(lang).cast("string"), F.lit("")).alias("lang"),
        F.coalesce(column(source).cast("string"), F.lit("")).alias("source"),
        column(text).cast("string").alias("text"),
    )
    schema = "lang string, term string, cells array<struct<source: string, n: bigint, docs: bigint>>"
    partial = read.mapInArrow(count, schema).repartition("lang", "term")
    cells = partial.select("lang", "term", F.inline("cells"))
    return cells.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def kept_terms(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``(lang, term, total, cells)``: kept terms with their counts by source, in the
    order of the sources, and for each language a null term with all its sources.  A row
    holds one cell per source of the language at most."""
    cells = F.array_sort(F.collect_list(F.struct("source", "n")))
    summed = counts.groupBy("lang", "term")
    return (
        summed.agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), cells.alias("cells"))
        .filter((F.col("docs") >= min_docs) | F.col("term").isNull())
        .drop("docs")
    )


def group_sizes(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, n, lang_n, v)`` of every group: its and its language's
    occurrences of kept terms, and the number of those."""
    own = kept.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    whole = kept.groupBy("lang").agg(F.sum("total").alias("lang_n"), F.count("*").alias("v"))
    return groups.join(own, ["lang", "source"], "left").join(whole, "lang", "left").na.fill(0, ["n", "lang_n", "v"])


def _share(n: Column, size: Column, v: Column) -> Column:
    """The scaled, smoothed probability, exactly."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(20,0)")
    wide = F.call_function("div", top, (size + v).cast("decimal(20,0)"))
    # Counts whose product fits in 64 bits need no decimals.
    short = F.call_function("div", F.lit(SCALE).cast("bigint") * (n + 1), size + v)
    return F.when(n < LONG_COUNT, short).otherwise(wide) + 1


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.ListArray, np.ndarray]]:
    """Entries of one language, of about :data:`BLOCK_RUNS` cells: it, cells and lengths."""
    langs, cells, terms = batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_numpy()
    ends = np.cumsum(pc.list_value_length(cells).to_numpy())
    at = 0
    while at < len(langs):
        before = ends[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(ends, before + BLOCK_RUNS, "right")))
        if langs[end - 1] != langs[at]:
            end = next(i for i in range(at, end) if langs[i] != langs[at])
        yield langs[at], cells.slice(at, end - at), terms[at:end]
        at = end


def piece_runs(cells: pa.ListArray, terms: np.ndarray, begin: int) -> Iterator[tuple[str, tuple[np.ndarray, ...]]]:
    """The runs ``(starts, lengths, counts)`` of every source in some entries, the first
    of which starts at ``begin``."""
    row = np.repeat(np.arange(len(cells)), pc.list_value_length(cells).to_numpy())
    sources, n = cells.flatten().flatten()
    sources = sources.dictionary_encode()
    own = sources.indices.to_numpy()
    # Sources in turn, the entries of each in their order.
    order = np.argsort(own, kind="stable")
    own, row, n = own[order], row[order], n.to_numpy()[order]
    new = np.ones(len(own), bool)
    new[1:] = (own[1:] != own[:-1]) | (row[1:] != row[:-1] + 1) | (n[1:] != n[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(own)) - 1
    ends = begin + np.cumsum(terms)
    starts = (ends - terms)[row[first]]
    lengths, counts = ends[row[last]] - starts, n[first]
    cuts = np.append(np.flatnonzero(np.diff(own[first], prepend=-1)), len(first))
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield sources.dictionary[int(own[first[a]])].as_py(), (starts[a:b], lengths[a:b], counts[a:b])


def _runs(entries: DataFrame) -> DataFrame:
    """The columns of all blocks: ``(lang, block, size, source, starts, lengths,
    counts)``; ``size`` is the block's number of terms, starts count from its begin."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, blocks = TaskContext.get().partitionId(), 0
        lang, size, runs, held = None, 0, {}, 0

        def flushed() -> pa.RecordBatch:
            names = list(runs)
            columns = [
                pa.array([lang] * len(names), pa.string()),
                pa.array([(task << 32) + blocks] * len(names), pa.int64()),
                pa.array([size] * len(names), pa.int64()),
                pa.array(names, pa.string()),
            ]
            for k in range(3):
                joined = [np.concatenate([part[k] for part in runs[s]]) for s in names]
                columns.append(pa.array(joined, pa.list_(pa.int64())))
            fields = ["lang", "block", "size", "source", "starts", "lengths", "counts"]
            return pa.RecordBatch.from_arrays(columns, fields)

        for batch in batches:
            for own, cells, terms in _pieces(batch):
                if runs and (own != lang or held >= BLOCK_RUNS):
                    yield flushed()
                    blocks, size, runs, held = blocks + 1, 0, {}, 0
                lang = own
                for source, part in piece_runs(cells, terms, size):
                    runs.setdefault(source, []).append(part)
                    held += len(part[0])
                size += int(terms.sum())
        if runs:
            yield flushed()

    schema = "lang string, block bigint, size bigint, source string, starts array<bigint>, lengths array<bigint>, counts array<bigint>"
    ordered = entries.repartitionByRange("lang", "cells").sortWithinPartitions("lang", "cells")
    return ordered.mapInArrow(encode, schema)


def run_shares(starts, lengths, counts, size: int, n: int, v: int) -> tuple[np.ndarray, np.ndarray]:
    """Ends and probabilities of all runs of a column, the zero runs among them."""
    starts, lengths, counts = (np.asarray(x, np.int64) for x in (starts, lengths, counts))
    borders = np.unique(np.concatenate([[0, size], starts, starts + lengths]))
    values = np.zeros(len(borders) - 1, np.int64)
    values[np.searchsorted(borders, starts)] = counts
    distinct, which = np.unique(values, return_inverse=True)
    shares = [1 + SCALE * (int(c) + 1) // (n + v) for c in distinct]
    return borders[1:], np.array(shares, np.int64)[which]


def pair_sums(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[int, int]:
    """The sum of f over one block, of the first column against the second and the other
    way round, from the intersections of their runs."""
    ends = np.union1d(a[0], b[0])
    lengths = np.diff(ends, prepend=0)
    p, q = a[1][np.searchsorted(a[0], ends)], b[1][np.searchsorted(b[0], ends)]
    square = (p - q) ** 2
    out = []
    for of in (q, p):
        f = square // of
        # In two halves, so that no product leaves 64 bits.
        low, high = f & 0xFFFFFFFF, f >> 32
        out.append((int((high * lengths).sum()) << 32) + int((low * lengths).sum()))
    return out[0], out[1]


def pair_values(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for every ordered pair of sources of a language."""
    entries = kept.groupBy("lang", "cells").agg(F.count("*").alias("terms"))
    columns = stored(_runs(entries), "columns")
    # One block without terms for each language: languages without kept terms have pairs.
    blocks = columns.select("lang", "block", "size").distinct()
    none = sizes.select("lang", F.lit(-1).cast("bigint").alias("block"), F.lit(0).cast("bigint").alias("size"))
    blocks = blocks.unionByName(none.distinct())
    placed = sizes.join(blocks, "lang").join(columns.drop("size"), ["lang", "block", "source"], "left")

    def compare(table: pa.Table) -> pa.Table:
        rows = table.sort_by("source").to_pylist()
        done = [
            run_shares(r["starts"] or [], r["lengths"] or [], r["counts"] or [], r["size"], r["n"], r["v"])
            if r["size"]
            else None
            for r in rows
        ]
        lang, names, out = rows[0]["lang"], [r["source"] for r in rows], ([], [], [])
        for i, a in enumerate(done):
            for j in range(i + 1, len(done)):
                forth, back = pair_sums(a, done[j]) if a is not None else (0, 0)
                for source, item, value in ((i, j, forth), (j, i, back)):
                    out[0].append(names[source])
                    out[1].append(names[item])
                    out[2].append(str(value))
        columns = [pa.array([lang] * len(out[0]), pa.string())] + [pa.array(x, pa.string()) for x in out]
        return pa.Table.from_arrays(columns, ["lang", "source", "item", "value"])

    compared = placed.groupBy("lang", "block").applyInArrow(compare, "lang string, source string, item string, value string")
    value = F.sum(F.col("value").cast("decimal(38,0)")).cast("bigint")
    return compared.groupBy("lang", "source", "item").agg(value.alias("value"))


def term_values(kept: DataFrame, sizes: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for every kept term of a source that is more
    likely there than in its language."""
    cells = kept.select("lang", F.col("term").alias("item"), "total", F.inline("cells"))
    cells = cells.withColumnRenamed("n", "here").join(sizes, ["lang", "source"])
    valued = cells.select(
        "lang", "source", "item",
        _share(F.col("here"), F.col("n"), F.col("v")).alias("p"),
        _share(F.col("total"), F.col("lang_n"), F.col("v")).alias("q"),
    )
    return valued.filter("p > q").select("lang", "source", "item", _excess(F.col("p"), F.col("q")).alias("value"))


def divergence_audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    min_docs: int = MIN_DOCS, top: int = TOP,
) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: part ``pair`` with all other sources
    of the language, part ``term`` with the ``top`` terms of the source."""
    counts = term_counts(docs, lang, source, text)
    rows = stored(kept_terms(counts, min_docs), "kept")
    kept = rows.filter("term is not null")
    groups = rows.filter("term is null").select("lang", F.inline("cells")).drop("n")
    sizes = stored(group_sizes(groups, kept), "sizes")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ranked = [
        part.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit(name))
        for name, part in (("pair", pair_values(kept, sizes)), ("term", term_values(kept, sizes)))
    ]
    # The limit is part of the report; each task keeps its own first ones before the shuffle.
    ranked[1] = ranked[1].filter(F.col("rank") <= top)
    return ranked[0].unionByName(ranked[1]).select("lang", "source", "part", "item", "value", "rank")


ORACLE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
),
groups AS (SELECT DISTINCT lang, source FROM docs),
occurring AS (SELECT id, lang, source, unnest(terms) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS total FROM occurring GROUP BY lang, term HAVING count(DISTINCT id) >= {MIN_DOCS}
),
counted AS (
  SELECT lang, source, term, count(*) AS n FROM occurring SEMI JOIN kept USING (lang, term) GROUP BY ALL
),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.total
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counted c USING (lang, source, term)
),
shares AS (
  SELECT lang, source, term, n,
    1 + ({SCALE}::HUGEINT * (n + 1)) // (sum(n) OVER own + count(*) OVER own)::HUGEINT AS p,
    1 + ({SCALE}::HUGEINT * (total + 1)) // (sum(total) OVER own + count(*) OVER own)::HUGEINT AS lang_p
  FROM cells WINDOW own AS (PARTITION BY lang, source)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
    coalesce(CAST(sum((x.p - y.p) * (x.p - y.p) // y.p) AS BIGINT), 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source
),
terms AS (
  SELECT lang, source, term AS item, CAST((p - lang_p) * (p - lang_p) // lang_p AS BIGINT) AS value
  FROM shares WHERE n > 0 AND p > lang_p
),
parts AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL SELECT lang, source, 'term', item, value FROM terms
),
placed AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
  FROM parts
)
SELECT lang, source, part, item, value, rank FROM placed WHERE part = 'pair' OR rank <= {TOP}
"""
