"""Benchmark decontamination by pigeonhole edit matching (operator 1).

Texts and test items are compared in lower case with every run of other characters
than letters and digits read as one blank.  An item of m such characters may occur
with up to ``floor(m * error_rate)`` edits, its error budget.  It is cut into budget
plus one pieces: an occurrence within the budget leaves at least one piece whole.  One
Aho-Corasick automaton over the pieces of all items finds every exact piece hit; the
stretches of text that the hits allow are verified with Myers' bit-parallel distance,
so exactly the occurrences within the budget are reported.

The items are a query set.  Up to ``BLOCK_CHARS`` characters of them are broadcast and
matched against all rows where those are read, without a shuffle.  More items are merged
by equal texts and dealt to blocks of about so many characters (or one item); one pass
over the documents for each block writes the matches found to the shared folder, and the
next block takes its place in the driver and the tasks.  The matches then join the
documents by a digest of the text.  The documents are read once a block, so a plan that
is costly to compute is better stored first.

Items of fewer than ``min_chars`` compared characters, in which one edit can make another
word, have no budget: they match where they occur exactly and as whole words.

Defined cases: items that are null or hold no letter or digit match nothing; items that
occur twice in the table are reported twice.  A null or empty text has no matches.  Repeated rows are
matched each.  The column ``matches`` replaces one of that name; others pass through.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanframe.sources import scratch_path

from .bpe import _in_pieces
from .common import column, ship_package, stored, unused, with_fields

#: Edits allowed per compared character of an item.
ERROR_RATE = 0.08
#: Compared characters from which an item may occur with edits.
MIN_CHARS = 25
#: Item characters matched in one pass.
BLOCK_CHARS = 1_000_000

MATCHES = "array<struct<item_id:bigint,distance:int,start:int,end:int>>"
_ARROW = pa.list_(
    pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
)
_GAPS = re.compile(r"[\W_]+")


def _lower(text: str) -> str:
    """Lower case with every character kept in its place."""
    low = text.lower()
    if len(low) == len(text):
        return low
    return "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def compared(text: str) -> str:
    """The form in which texts and items are compared."""
    return _GAPS.sub(" ", _lower(text)).strip(" ")


def positions(text: str) -> list[int]:
    """For each compared character the offset in ``text`` that it came from."""
    low, at, end = _lower(text), [], 0
    for m in _GAPS.finditer(low):
        at.extend(range(end, m.start()))
        if m.start() and m.end() < len(low):
            at.append(m.start())
        end = m.end()
    at.extend(range(end, len(low)))
    return at


class Item:
    """One test item, ready to be searched."""

    def __init__(self, item_id: int | None, form: str, budget: int, whole_words: bool = False):
        self.item_id, self.form, self.budget, self.whole_words = item_id, form, budget, whole_words
        self.masks = self._masks(form)
        self.backwards = self._masks(form[::-1])

    @staticmethod
    def _masks(form: str) -> dict[str, int]:
        masks: dict[str, int] = {}
        for i, c in enumerate(form):
            masks[c] = masks.get(c, 0) | 1 << i
        return masks

    def pieces(self) -> Iterator[tuple[str, int]]:
        """Budget plus one pieces of even length, with their offsets."""
        m, n = len(self.form), self.budget + 1
        for i in range(n):
            start, end = m * i // n, m * (i + 1) // n
            yield self.form[start:end], start

    def distances(self, text: str, masks: dict[str, int], anchored: bool = False) -> Iterator[int]:
        """Myers' algorithm: after each character the least edits that turn the item
        into a stretch of ``text`` ending there (starting at 0 if ``anchored``)."""
        m = len(self.form)
        full, top = (1 << m) - 1, 1 << (m - 1)
        up, down, score = full, 0, m
        for c in text:
            eq = masks.get(c, 0)
            flat = eq | down
            carry = (((eq & up) + up) ^ up) | eq
            plus = down | (full & ~(carry | up))
            minus = up & carry
            if plus & top:
                score += 1
            elif minus & top:
                score -= 1
            plus = (plus << 1 | anchored) & full
            minus = (minus << 1) & full
            up = minus | (full & ~(flat | plus))
            down = plus & flat
            yield score

    def occurrences(self, text: str, start: int, end: int) -> Iterator[tuple[int, int, int]]:
        """(distance, start, end) of the occurrences that end in ``text[start:end]``: the
        best one, first of its kind, of every run of ends within the budget."""
        best = None
        for at, score in enumerate(self.distances(text[start:end], self.masks), start + 1):
            if score <= self.budget:
                if best is None or score < best[0]:
                    best = (score, at)
            elif best:
                yield self._with_start(text, *best)
                best = None
        if best:
            yield self._with_start(text, *best)

    def _with_start(self, text: str, score: int, end: int) -> tuple[int, int, int]:
        before = text[max(0, end - len(self.form) - score) : end][::-1]
        for back, s in enumerate(self.distances(before, self.backwards, anchored=True), 1):
            if s == score:
                return score, end - back, end
        raise AssertionError("an occurrence has a start")


class Matcher:
    """All items of one block."""

    def __init__(self, items: list[tuple[int | None, str]], error_rate: float, min_chars: int):
        self.items, where = [], {}
        for item_id, text in items:
            form = compared(text or "")
            if form:
                short = len(form) < min_chars
                item = Item(item_id, form, 0 if short else math.floor(len(form) * error_rate), short)
                for piece, offset in item.pieces():
                    where.setdefault(piece, []).append((len(self.items), offset))
                self.items.append(item)
        self.automaton = ahocorasick.Automaton()
        for piece, at in where.items():
            self.automaton.add_word(piece, (len(piece), at))
        self.automaton.make_automaton()

    def find(self, text: str | None) -> list[tuple[int | None, int, int, int]]:
        """(item_id, distance, start, end) by offsets of ``text``."""
        if not text or not self.items:
            return []
        form = compared(text)
        hit: dict[int, set[int]] = {}
        for last, (length, at) in self.automaton.iter(form):
            for i, offset in at:
                # Where the item would begin; near beginnings share a number.
                begin = last - length + 1 - offset
                hit.setdefault(i, set()).add(begin // (self.items[i].budget + 1))
        found = []
        for i, begins in hit.items():
            item, wide = self.items[i], self.items[i].budget + 1
            for first, last in _runs(begins):
                start = max(0, first * wide - item.budget)
                end = (last + 1) * wide + len(item.form) + item.budget
                found += [
                    (i, d, s, e)
                    for d, s, e in item.occurrences(form, start, end)
                    if not item.whole_words or (form[s - 1 : s] in ("", " ") and form[e : e + 1] in ("", " "))
                ]
        if not found:
            return []
        at = positions(text)
        # Stretches of one item that overlap can show the same occurrence twice.
        spans = {(i, d, at[s], at[e - 1] + 1) for i, d, s, e in found}
        ordered = sorted(spans, key=lambda x: (x[2], x[3], x[0]))
        return [(self.items[i].item_id, d, s, e) for i, d, s, e in ordered]


def _runs(numbers: set[int]) -> Iterator[tuple[int, int]]:
    """First and last of every run of consecutive numbers."""
    ordered = sorted(numbers)
    first = last = ordered[0]
    for n in ordered[1:]:
        if n != last + 1:
            yield first, last
            first = n
        last = n
    yield first, last


_worker: dict[str, Matcher] = {}


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    error_rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    block_chars: int = BLOCK_CHARS,
    out: str = "matches",
) -> DataFrame:
    """``docs`` with ``matches`` (or another name ``out``): where test items of
    ``benchmark`` (item_id, text) occur in ``text`` within their error budget."""
    if not 0 <= error_rate < 1:
        raise ValueError("error_rate must be at least 0 and below 1")
    spark = docs.sparkSession
    ship_package(spark)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").filter("text != ''")
    if (items.agg(F.sum(F.length("text"))).first()[0] or 0) > block_chars:
        return _found_in_passes(docs, items, text, error_rate, min_chars, block_chars, out)
    # In the order of ids and texts, whatever the order of tasks.
    rows = sorted(((r["item_id"], r["text"]) for r in items.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    sent, key = spark.sparkContext.broadcast(rows), uuid.uuid4().hex
    schema = with_fields(docs, docs.select(F.array().cast(MATCHES).alias(out)).schema[0])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(key, sent, error_rate, min_chars)
        names = ("item_id", "distance", "start", "end")
        for batch in _in_pieces(batches, text):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            values = [[dict(zip(names, x)) for x in matcher.find(t)] for t in texts]
            keep = [i for i, c in enumerate(batch.schema.names) if c.lower() != out.lower()]
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in keep] + [pa.array(values, _ARROW)], schema.names)

    return docs.mapInArrow(run, schema)


def _matcher(key: str, rows, error_rate: float, min_chars: int) -> Matcher:
    """The matcher of the items in the broadcast ``rows``, built once in a Python worker."""
    if key not in _worker:
        _worker.clear()
        _worker[key] = Matcher(rows.value, error_rate, min_chars)
    return _worker[key]


def _found_in_passes(
    docs: DataFrame, items: DataFrame, text: str, error_rate: float, min_chars: int, block_chars: int, out: str
) -> DataFrame:
    """As ``find_contamination``, for items of more than one block."""
    spark = docs.sparkSession
    different = stored(items.select("text").distinct().withColumn("text_id", F.monotonically_increasing_id()), "items")
    chars = different.agg(F.sum(F.length("text"))).first()[0]
    blocks = math.ceil(chars / block_chars)
    # What is found depends on the text alone, so its digest tells which rows it is of.
    key = unused(docs, "text_key")
    keyed = docs.withColumn(key, F.sha2(column(text).cast("binary"), 256))
    read = keyed.select(F.col(key).alias("key"), column(text).alias("text")).filter("text is not null")
    path = scratch_path(spark, "matches")
    schema = "key string, text_id bigint, distance int, start int, end int"
    for b in range(blocks):
        own = different.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == b)
        sent = spark.sparkContext.broadcast([(r["text_id"], r["text"]) for r in own.collect()])
        passed = read.mapInArrow(_hits(sent, error_rate, min_chars), schema)
        passed.distinct().write.mode("overwrite").parquet(f"{path}/block={b}")
        sent.destroy()
    found = spark.read.schema(schema).parquet(*[f"{path}/block={b}" for b in range(blocks)])
    # An item's text can stand in the table more than once.
    named = items.join(different, "text").select("text_id", "item_id")
    match = F.struct("start", "end", "item_id", "distance")
    ordered = F.array_sort(F.collect_list(match))
    matches = F.transform(ordered, lambda m: F.struct(m["item_id"], m["distance"], m["start"], m["end"])).cast(MATCHES)
    value = unused(keyed, "found")
    made = found.join(named, "text_id").groupBy(F.col("key").alias(key)).agg(matches.alias(value))
    joined = keyed.join(made, key, "left")
    return joined.select(
        *[column(c) for c in docs.columns if c.lower() != out.lower()],
        F.coalesce(F.col(value), F.array().cast(MATCHES)).alias(out),
    )


def _hits(rows, error_rate: float, min_chars: int):
    key = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(key, rows, error_rate, min_chars)
        for batch in _in_pieces(batches, "text"):
            keys, texts = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "text"))
            hits = [(k, *match) for k, t in zip(keys, texts) for match in matcher.find(t)]
            columns = list(zip(*hits)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], ["key", "text_id", "distance", "start", "end"]
            )

    return run


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document row and occurrence: doc_id, item_id, distance, start, end
    (offsets in the text)."""
    found = find_contamination(docs.select(doc_id, options.get("text", "text")), benchmark, **options)
    return found.select(doc_id, F.inline("matches"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows in which a test item occurs."""
    out = unused(docs, "matches")
    kept = find_contamination(docs, benchmark, out=out, **options).filter(F.size(out) == 0)
    return kept.select(*[column(c) for c in docs.columns])
