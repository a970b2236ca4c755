"""N-gram language model with Katz backoff (operator 8).

Tokens are the white-space separated words of a text in lower case (A-Z), then one end.
A token is predicted from the ``order`` - 1 tokens before it, among them a start symbol
at the beginning (fewer where the text begins).  The probability of an n-gram seen in
training is its Good-Turing discounted relative frequency; else the model backs off to
the probability after the context without its first token, times the context's backoff
weight, which makes the probabilities of all tokens after that context sum to exactly
one; and so on, recursively, down to single tokens and the mass that their discounted
counts leave to unknown tokens (one class beside the known tokens).  Counts up to ``K``
are discounted by Good-Turing with Katz's renormalisation, for each order by itself, or
by half a count where the counts of counts do not allow it.  Contexts seen over ``SURE``
times, and those whose n-grams all occur more than ``K`` times, count one more
occurrence in the denominator, so that some mass is always left for what was not seen.

How it runs.  N-grams of the whole corpus are counted and looked up in partitions, and
never gathered in one place:

1. texts are cut into blocks of about ``BLOCK_TOKENS`` tokens, coded by the block's own
   word list (a long text spans several blocks);
2. the word lists are shuffled by word: each bucket adds up its words, numbers them
   (frequent ones first, which packs better) and answers every block with the numbers and
   training counts of its words;
3. then level by level, from pairs to ``order``: each block sends each of its distinct
   n-grams once, with its number of occurrences, to the bucket of its context (the number
   of the n-gram one shorter).  Contexts that hold a large share of all tokens are split
   over several buckets by the last word.  A bucket adds up and numbers its n-grams, and
   answers every block with their counts and with the sums that the backoff weights of
   their contexts need; the level's discounts follow from the counts of counts of all
   buckets;
4. each block completes the probabilities of its tokens, level by level from the answers,
   and adds them up by document.

After each level the blocks are written anew with the answers so far, and the tables and
shuffles that led there are deleted, so the disk holds one level's work at a time.

The number of buckets grows with the bytes of the texts, and what a bucket gets for an
n-gram is one entry a block, however many documents hold it.

With ``tables`` the model is also written there, partitioned by bucket: the counts of
each order, the backoff weights of the contexts, and the discounts.

Defined cases: a null text counts as empty and consists of the end only.  Repeated rows
are read (and learned from) each; a null id is an id.  Without training tokens every
token is unknown and has probability one.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanframe.sources import scratch_path
from loanframe.sources.releases import file_system

from .common import column, partitions, ship_package

#: Counts that are discounted, and the context count from which one is added.
K, SURE = 5, 1000
#: Tokens of a block, and bytes of a text that are split into words at a time.
BLOCK_TOKENS, SEGMENT = 1_500_000, 4 << 20
#: Bytes of a block, or of what it asks for, that go between Spark and Python at a time.
BATCH_BYTES, ASKED_BYTES = 2 << 20, 1 << 20
#: Default order of the model, and bytes of text for which there is a bucket.
ORDER, BUCKET_BYTES = 3, 24 << 20
#: Contexts are split where they hold more than a quarter of a bucket's share of tokens;
#: beyond this many buckets that share stays the same, which bounds their number.
SPLIT_BUCKETS = 1 << 15
#: Symbols of the beginning and the end of a text, and what parts words in word lists;
#: words hold no white space, so none of them can be a word.
_START, _END, _PART = b"\t", b"\x0b", b"\n"
_GAP = re.compile(rb"[\x20\x09-\x0d]")


# --- packing of integer arrays ---------------------------------------------------


def pack(*arrays: np.ndarray) -> bytes:
    """Integer (0 or more) or float arrays as one compressed value."""
    return zstandard.compress(b"".join(map(_laid_out, arrays)), 3)


def _laid_out(a: np.ndarray) -> bytes:
    """One array, bytes of equal weight together: rising integers by their steps, floats
    with many repeats by their distinct values."""
    size, rising = len(a).to_bytes(8, "little"), False
    if a.dtype.kind == "f":
        values, which = np.unique(a, return_inverse=True) if len(a) > 64 else (a, None)
        if len(values) * 2 < len(a):
            return b"v" + size + _laid_out(values) + _laid_out(which)
        code = b"f"
    else:
        rising = len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        if rising:
            a = np.diff(a, prepend=a.dtype.type(0))
        top = int(a.max(initial=0))
        a = a.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64)
        code = bytes([(b"a" if rising else b"0")[0] + a.dtype.itemsize])
    return code + size + np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()


def unpack(value: bytes) -> list[np.ndarray]:
    raw, at, out = zstandard.decompress(value), 0, []
    while at < len(raw):
        a, at = _read(raw, at)
        out.append(a)
    return out


def _read(raw: bytes, at: int) -> tuple[np.ndarray, int]:
    """The array that begins at a place of ``raw``, and where the next begins."""
    code, n = raw[at], int.from_bytes(raw[at + 1 : at + 9], "little")
    at += 9
    if code == b"v"[0]:
        values, at = _read(raw, at)
        which, at = _read(raw, at)
        return values[which], at
    rising = b"a"[0] < code <= b"a"[0] + 8 and code != b"f"[0]
    width = 8 if code == b"f"[0] else code - (b"a" if rising else b"0")[0]
    planes = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n)
    kind = np.float64 if code == b"f"[0] else {1: np.uint8, 2: np.uint16, 4: np.uint32, 8: np.uint64}[width]
    a = np.ascontiguousarray(planes.T).view(kind).reshape(n)
    if rising:
        a = np.cumsum(a, dtype=np.int64)
    return a if code == b"f"[0] else a.astype(np.int64 if a.max(initial=0) >> 31 else np.int32), at + n * width


def _order(*keys: np.ndarray) -> np.ndarray:
    """The order of rows by the keys, the first above all: sorted as one number where
    their bits fit into one."""
    bits = [int(k.max(initial=0)).bit_length() for k in keys]
    if sum(bits) > 63:
        return np.lexsort(keys[::-1])
    whole = keys[0].astype(np.int64)
    for k, n in zip(keys[1:], bits[1:]):
        whole <<= n
        whole |= k
    return np.argsort(whole)


# --- the model -------------------------------------------------------------------


def discounts(n: Sequence[int]) -> np.ndarray:
    """Factors of the counts 0 to ``K`` (that of 0 is unused) from the numbers ``n`` of
    types with count 1 to ``K`` + 1."""
    n = np.asarray(n, np.float64)
    half = np.array([1.0] + [(r - 0.5) / r for r in range(1, K + 1)])
    if (n <= 0).any():
        return half
    common = (K + 1) * n[K] / n[0]
    if common >= 1:
        return half
    r = np.arange(1, K + 1)
    d = ((r + 1) * n[1:] / n[:-1] / r - common) / (1 - common)
    return np.concatenate([[1.0], d]) if ((d > 0) & (d < 1)).all() else half


class Unigrams:
    """What every task knows of the single tokens: numbers of training tokens, distinct
    tokens, texts, and tokens with count 1 to ``K`` + 1; the start symbol's number."""

    def __init__(self, tokens: int, types: int, texts: int, n: Sequence[int], start: int = -1):
        self.tokens, self.types, self.texts, self.start = tokens, types, texts, start
        self.factors = discounts(n)
        left = float((np.asarray(n[:K]) * np.arange(1, K + 1) * (1 - self.factors[1:])).sum())
        self.total = max(1, tokens + (left <= 0))
        #: The probability of the unknown class.
        self.unknown = (left if left > 0 else 1.0) / self.total if tokens else 1.0

    def probability(self, counts: np.ndarray) -> np.ndarray:
        """Of tokens with these training counts; 0 stands for the unknown class."""
        factor = np.where(counts <= K, self.factors[np.minimum(counts, K)], 1.0)
        return np.where(counts > 0, factor * counts / self.total, self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """The contract's plain logarithm, to base 10."""
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.types + 1)))


def denominators(context: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Of contexts with these counts; ``low`` tells whether one of the pairs is
    discounted."""
    return context + ((context > SURE) | ~low)


def backoff_weights(factors: np.ndarray, low: np.ndarray, high: np.ndarray, total: np.ndarray, mass: np.ndarray) -> np.ndarray:
    """Of contexts with ``low`` types of count 1 to ``K`` (a column each), ``high``
    tokens of higher counts, the denominators, and the mass of the seen tokens' own
    probabilities: what the pairs leave over what the single tokens leave."""
    seen = ((low * (np.arange(1, K + 1) * factors[1:])).sum(1) + high) / total
    return (1 - seen) / (1 - mass)


# --- 1: blocks -------------------------------------------------------------------

_BLOCKS = (
    "block long, lists array<struct<bucket:int,words:binary,counts:binary>>, stream binary, "
    "rows array<long>, ids array<long>"
)
_BLOCKS_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("lists", pa.list_(pa.struct([("bucket", pa.int32()), ("words", pa.binary()), ("counts", pa.binary())]))),
        ("stream", pa.binary()),
        ("rows", pa.list_(pa.int64())),
        ("ids", pa.list_(pa.int64())),
    ]
)


def segments(text: str | None, size: int = SEGMENT) -> Iterator[list[bytes]]:
    """The tokens of a text, piece by piece; the last piece ends with the end."""
    raw = (text or "").encode("utf-8", "surrogatepass").lower()
    at = 0
    while len(raw) - at > size:
        gap = _GAP.search(raw, at + size)
        if not gap:
            break
        if words := raw[at : gap.start()].split():
            yield words
        at = gap.end()
    yield [*raw[at:].split(), _END]


class _Block:
    """Tokens of texts, or of parts of long texts."""

    def __init__(self):
        self.stream: list[pa.Array] = []
        self.starts: list[int] = []
        self.size = 0
        self.rows: list[int] = []
        self.ids: list[int | None] = []
        self.held_out: list[bool] = []
        self.lead: list[int] = []

    def add(self, row: int, doc_id: int | None, held_out: bool, before: list[bytes], tokens: list[bytes]) -> None:
        self.starts.append(self.size)
        self.rows.append(row)
        self.ids.append(doc_id)
        self.held_out.append(held_out)
        self.lead.append(len(before))
        self.stream.append(pa.array(before + tokens, pa.binary()))
        self.size += len(self.stream[-1])

    def coded(self, block: int, buckets: int) -> pa.RecordBatch:
        coded = pa.concat_arrays(self.stream).dictionary_encode()
        self.stream.clear()
        words = coded.dictionary.to_pylist()
        bucket = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % buckets
        indices = coded.indices.to_numpy()
        alphabet = np.empty(len(words), np.int64)
        alphabet[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(words))
        times = np.bincount(indices, minlength=len(words))
        order = _order(bucket, times.max(initial=0) - times, alphabet)
        place = np.empty(len(words), np.int32)
        place[order] = np.arange(len(words))
        stream = place[indices]
        del coded, indices
        starts = np.array(self.starts)
        sizes = np.diff(np.append(starts, len(stream)))
        held_out = np.array(self.held_out, np.int64)
        lead = np.array(self.lead, np.int64)
        counted = np.repeat(held_out == 0, sizes) & (_offsets(sizes) >= np.repeat(lead, sizes))
        counts = np.bincount(stream[counted], minlength=len(words))
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        lengths = np.diff(np.append(cuts, len(words)))
        lists = [
            {
                "bucket": int(bucket[order[s]]),
                "words": zstandard.compress(_PART.join(words[k] for k in order[s:e]), 3),
                "counts": pack(counts[s:e]),
            }
            for s, e in zip(cuts, np.append(cuts[1:], len(words)))
        ]
        value = {
            "block": block,
            "lists": lists,
            "stream": pack(_dealt(stream, lengths), sizes, held_out, lead, bucket[order[cuts]], lengths),
            "rows": self.rows,
            "ids": self.ids,
        }
        return pa.RecordBatch.from_pylist([value], _BLOCKS_ARROW)


def _offsets(sizes: np.ndarray) -> np.ndarray:
    """0, 1, 2 ... in each of runs of these sizes, of the tokens of one block."""
    out = np.arange(int(sizes.sum()), dtype=np.int32)
    out -= np.repeat((np.cumsum(sizes) - sizes).astype(np.int32), sizes)
    return out


def _dealt(places: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Places in lists of these lengths, one after the other, as smaller numbers for what
    comes first in any list: frequent words have small numbers, which packs better."""
    ends = np.cumsum(lengths)
    own = np.searchsorted(ends, np.arange(int(lengths.sum())), side="right")
    numbers = (np.arange(len(own)) - (ends - lengths)[own]) * len(lengths) + own
    return (numbers if numbers.max(initial=0) >> 31 else numbers.astype(np.int32))[places]


def _gathered(dealt: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places that ``_dealt`` made these numbers of."""
    within, own = np.divmod(dealt, max(1, len(lengths)))
    within += (np.cumsum(lengths) - lengths).astype(within.dtype)[own]
    return within


def _blocks(docs: DataFrame, buckets: int, block_tokens: int, order: int) -> DataFrame:
    """Coded blocks of rows (row, doc_id, text, held_out).  ``row`` numbers the rows by
    partition, in its upper bits, and place; blocks are numbered alike."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, done = _Block(), 0
        for batch in batches:
            for row, doc_id, text, held_out in zip(*(batch[c] for c in ("row", "doc_id", "text", "held_out"))):
                before = [_START]
                for tokens in segments(text.as_py()):
                    block.add(row.as_py(), doc_id.as_py(), held_out.as_py(), before, tokens)
                    before = [*before, *tokens[-order + 1 :]][-order + 1 :]
                    if block.size >= block_tokens:
                        yield block.coded((block.rows[0] >> 33 << 33) + done, buckets)
                        block, done = _Block(), done + 1
                        pa.default_memory_pool().release_unused()
        if block.rows:
            yield block.coded((block.rows[0] >> 33 << 33) + done, buckets)
        del block
        # Else the idle worker holds it while the next stages run.
        pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, _BLOCKS)


# --- 2: single tokens ------------------------------------------------------------

_ANSWERS = "block long, bucket int, answer binary, sums array<long>, words binary, counts binary"
_ANSWERS_ARROW = pa.schema(
    [
        ("block", pa.int64()),
        ("bucket", pa.int32()),
        ("answer", pa.binary()),
        ("sums", pa.list_(pa.int64())),
        ("words", pa.binary()),
        ("counts", pa.binary()),
    ]
)


def _answer_words(rows: pa.Table, buckets: int, tables: bool) -> pa.Table:
    """Places and counts of the words of one bucket, for each block; and a row (block
    is null) with the bucket's own sums and, for ``tables``, its words."""
    rows = rows.sort_by("block")
    bucket = rows["bucket"][0].as_py()
    lists = [zstandard.decompress(v).split(_PART) for v in rows["words"].to_pylist()]
    coded = pa.array([w for own in lists for w in own], pa.binary()).dictionary_encode()
    code = coded.indices.to_numpy()
    counts = np.concatenate([unpack(v)[0] for v in rows["counts"].to_pylist()])
    total = np.bincount(code, counts, len(coded.dictionary)).astype(np.int64)
    # Frequent words get small numbers, which pack better.
    order = np.argsort(-total, kind="stable")
    place = np.empty(len(total), np.int64)
    place[order] = np.arange(len(total))
    out, at = [], 0
    for block, own in zip(rows["block"].to_pylist(), lists):
        part = code[at : at + len(own)]
        out.append({"block": block, "bucket": bucket, "answer": pack(place[part], total[part])})
        at += len(own)
    end = coded.dictionary.index(_END).as_py()
    texts = int(total[end]) if end >= 0 else 0
    small = [int((total == r).sum()) for r in range(1, K + 2)]
    start = coded.dictionary.index(_START).as_py()
    start = int(place[start] * buckets + bucket) if start >= 0 else -1
    own_sums = {"block": None, "bucket": bucket, "sums": [int(total.sum()), int((total > 0).sum()), texts, *small, start]}
    if tables:
        words = coded.dictionary.take(pa.array(order)).to_pylist()
        own_sums |= {"words": zstandard.compress(_PART.join(words), 3), "counts": pack(total[order])}
    return pa.Table.from_pylist([*out, own_sums], _ANSWERS_ARROW)


# --- 3: n-grams, level by level --------------------------------------------------

_ASKED = "bucket int, block long, value binary"
_ASKED_ARROW = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("value", pa.binary())])
#: Rows for a block have its answer; those without a block a bucket's sums: how many
#: n-grams have count 1 to ``K`` + 1, its parts of split contexts, and the model's rows.
_FOUND = "level int, bucket int, block long, answer binary, sums array<long>, split binary, grams binary, ids binary, contexts binary"
_FOUND_ARROW = pa.schema(
    [
        ("level", pa.int32()),
        ("bucket", pa.int32()),
        ("block", pa.int64()),
        ("answer", pa.binary()),
        ("sums", pa.list_(pa.int64())),
        *((name, pa.binary()) for name in ("split", "grams", "ids", "contexts")),
    ]
)


def _mix(a: np.ndarray) -> np.ndarray:
    return (a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def _ranks(values: np.ndarray) -> np.ndarray:
    """The place of each of a block's values among all of them in order."""
    out = np.empty(len(values), np.int32)
    out[np.argsort(values)] = np.arange(len(values), dtype=np.int32)
    return out


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before in any of the keys."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = False
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    return new


@dataclass
class Level:
    """What every task knows of the n-grams of one length: the discounts, and numbers
    (sorted) and backoff weights of the split contexts."""

    factors: np.ndarray
    split: np.ndarray
    weights: np.ndarray


@dataclass
class Sizes:
    """Numbers of buckets, and the context count from which contexts are split."""

    buckets: int
    hot: int


class _Walk:
    """The tokens of a block, with the probabilities of the n-grams that end at each,
    level by level.  ``local`` numbers the block's distinct n-grams of the level so far
    (one of them for each token); ``id`` has their numbers in the whole corpus, ``count``
    their training counts, ``under`` the denominators of their contexts.  ``known`` has
    the training counts of the block's words."""

    def __init__(self, block: pa.Table, answers: list[list[bytes]], uni: Unigrams, buckets: int = 1):
        stream, self.sizes, self.held_out, lead, bucket, lengths = unpack(block["stream"][0].as_py())
        # Arrays of all tokens are kept as small as they can be.
        self.word = _gathered(stream, lengths).astype(np.int32, copy=False)
        del stream
        self.offset = _offsets(self.sizes)
        self.scored = self.offset >= np.repeat(lead, self.sizes)
        self.counted = self.scored & np.repeat(self.held_out == 0, self.sizes)
        parts = [unpack(v) for v in answers[0]]
        self.number = np.concatenate([p[0].astype(np.int64) * buckets + k for p, k in zip(parts, bucket.tolist())])
        counts = np.concatenate([p[1] for p in parts]).astype(np.int64)
        self.rank = _ranks(self.number)
        self.known = counts
        self.local, self.id, self.level = self.word, self.number, 1
        self.p = uni.probability(counts)[self.word]
        # The start symbol is no training token; it comes before every training text.
        self.count = np.where(self.number == uni.start, uni.texts, counts)
        self.under = np.full(len(counts), uni.total)

    def ask(self, sizes: Sizes) -> None:
        """Gather the distinct n-grams of the next level, by bucket, context and word."""
        self.level += 1
        self.at = np.flatnonzero(self.offset >= self.level - 1).astype(np.int32)
        a, b = self.local[self.at - 1], self.word[self.at]
        splits = np.maximum(1, -(-self.count // sizes.hot))
        bucket = (_mix(self.id) % np.uint64(sizes.buckets)).astype(np.int32)[a]
        if len(hot := np.flatnonzero((splits > 1)[a])):
            bucket[hot] = (bucket[hot] + _mix(self.number).astype(np.int64)[b[hot]] % splits[a[hot]]) % sizes.buckets
        order = _order(bucket, _ranks(self.id)[a], self.rank[b])
        new = _changes(bucket[order], a[order], b[order])
        self.place = np.empty(len(order), np.int32)
        self.place[order] = np.cumsum(new, dtype=np.int32) - 1
        first = order[new]
        del order, new, b
        self.first, self.bucket, own = self.at[first], bucket[first], a[first]
        self.context = _changes(self.bucket, own)
        own = own[self.context]
        self.a, self.c = self.id[own], self.count[own]

    @property
    def b(self) -> np.ndarray:
        """The last words of the n-grams that are asked for."""
        return self.number[self.word[self.first]]

    @property
    def trained(self) -> np.ndarray:
        """Their training counts in this block."""
        return np.bincount(self.place[self.counted[self.at]], minlength=len(self.first))

    def asked(self, block: int, hot: int) -> Iterator[pa.Table]:
        """What the buckets need, in tables of about ``ASKED_BYTES``; of the probability
        one level below, for n-grams that were seen, the count and the denominator."""
        trained, out, size = self.trained, [], 0
        start, cut = np.flatnonzero(self.context), np.flatnonzero(_changes(self.bucket))
        end = np.append(cut[1:], len(self.first))
        for s, e, i, j in zip(cut, end, np.searchsorted(start, cut), np.searchsorted(start, end)):
            first, seen, c = self.first[s:e], trained[s:e], self.c[i:j]
            own = self.local[first]
            value = pack(
                self.a[i:j], np.diff(np.append(start[i:j], e)), np.where(c > hot, c, 0), self.under[own[start[i:j] - s]],
                self.number[self.word[first]], seen, np.where(seen > 0, self.count[own], 0),
            )
            out.append({"bucket": int(self.bucket[s]), "block": block, "value": value})
            size += len(value)
            if size >= ASKED_BYTES:
                yield pa.Table.from_pylist(out, _ASKED_ARROW)
                out, size = [], 0
        yield pa.Table.from_pylist(out, _ASKED_ARROW)

    def learn(self, answers: list[bytes], level: Level, sizes: Sizes) -> None:
        """Take in the answers (by bucket) to what was asked."""
        if not len(self.first):
            return
        own, c = self.a, self.c
        context = np.cumsum(self.context, dtype=np.int32) - 1
        buckets = self.bucket[np.flatnonzero(_changes(self.bucket))].tolist()
        p = self.p[self.first]  # one level below
        del self.a, self.c, self.context, self.bucket, self.first
        parts = [unpack(v) for v in answers]
        flags = np.concatenate([x[2] for x in parts])
        low = np.concatenate([np.stack(x[3 : 3 + K], 1) for x in parts])
        high, mass = (np.concatenate([x[k] for x in parts]) for k in (3 + K, 4 + K))
        total, backs = c + flags % 2, flags >= 2
        weight = np.ones(len(own))
        with np.errstate(invalid="ignore", divide="ignore"):
            weight[backs] = backoff_weights(level.factors, low, high, total[backs], mass)
        split = np.flatnonzero(c > sizes.hot)
        if len(split):
            weight[split] = level.weights[np.searchsorted(level.split, own[split])]
        del own, c, flags, low, high, mass
        count = np.concatenate([x[0] for x in parts])
        ids = [x[1] for x in parts]
        del parts
        total = np.maximum(total, 1)
        p *= weight[context]
        seen = np.flatnonzero(count > 0)
        few = count[seen]
        p[seen] = level.factors[np.where(few <= K, few, 0)] * few / total[context[seen]]
        del seen, few
        self.p[self.at] = p[self.place]
        del p
        if len(ids[0]):
            self.id = np.concatenate([x.astype(np.int64) * sizes.buckets + k for x, k in zip(ids, buckets)])
            self.count, self.under, self.local = count.astype(np.int64), total[context], np.zeros(len(self.p), np.int32)
            self.local[self.at] = self.place
        del self.at, self.place


def _walked(block: pa.Table, uni: Unigrams, levels: list[Level], sizes: Sizes) -> _Walk:
    """The block with the answers of all levels so far taken in."""
    words, *grams = block["answers"][0].as_py()
    walk = _Walk(block, [words], uni, sizes.buckets)
    for own, known in zip(grams, levels):
        walk.ask(sizes)
        walk.learn(own, known, sizes)
    return walk


def _each_block(work: Callable[[pa.Table], Iterator[pa.Table]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                for table in work(pa.Table.from_batches([batch.slice(k, 1)])):
                    yield from table.to_batches()
                pa.default_memory_pool().release_unused()

    return run


def _answer_grams(rows: pa.Table, level: int, sizes: Sizes, last: bool, tables: bool, factors: np.ndarray) -> pa.Table:
    """Counts of the n-grams of one bucket of contexts, for each block, and its sums;
    ``factors`` are the discounts of the level below."""
    rows = rows.sort_by("block")
    bucket = rows["bucket"][0].as_py()
    columns: list[list[np.ndarray]] = [[] for _ in range(6)]
    edges, contexts_of = [0], []
    for value in rows["value"]:
        a, size, c, over, b, trained, below = unpack(value.as_py())
        for part, x in zip(columns, (np.repeat(a, size), np.repeat(c, size), np.repeat(over, size), b, trained, below)):
            part.append(x)
        edges.append(edges[-1] + len(b))
        contexts_of.append(size)
    a, c, over, b, trained, below = (np.concatenate(columns.pop(0)) for _ in range(6))

    order = _order(a, b)
    a, b = a[order], b[order]
    new = _changes(a, b)
    first = np.flatnonzero(new)
    which = np.empty(len(a), np.int64)
    which[order] = np.cumsum(new) - 1
    count = np.add.reduceat(trained[order], first, dtype=np.int64)
    below = np.maximum.reduceat(below[order], first)
    a, b, c, over = a[first], b[first], c[order[first]], over[order[first]]
    own = factors[np.where(below <= K, below, 0)] * below / over
    del order, trained, below, over
    new = _changes(a)
    context = np.cumsum(new) - 1
    n = int(context[-1]) + 1
    a1, c1 = a[new], c[new].astype(np.int64)
    split = c1 > 0
    # All occurrences of a context that is not split are here.
    c1 = np.where(split, c1, np.bincount(context, count, n).astype(np.int64))
    low = np.stack([np.bincount(context[count == r], minlength=n) for r in range(1, K + 1)], 1)
    high = np.bincount(context, np.where(count > K, count, 0), n).astype(np.int64)
    mass = np.bincount(context, np.where(count > 0, own, 0.0), n)
    total = denominators(c1, low.any(1))  # of split contexts too: they are over SURE
    out = []
    for k, (block, size) in enumerate(zip(rows["block"].to_pylist(), contexts_of)):
        mine = which[edges[k] : edges[k + 1]]
        start = np.cumsum(size) - size
        used = context[mine[start]]
        # The sums are needed where the block backs off.
        backs = (np.add.reduceat(count[mine] == 0, start) > 0) & ~split[used] & (c1[used] > 0)
        ids = np.zeros(0, np.int64) if last else mine
        needed = used[backs]
        value = pack(count[mine], ids, (total - c1)[used] + 2 * backs, *low[needed].T, high[needed], mass[needed])
        out.append({"level": level, "bucket": bucket, "block": block, "answer": value})
    sums = {"level": level, "bucket": bucket, "sums": [int((count == r).sum()) for r in range(1, K + 2)]}
    if split.any():
        sums["split"] = pack(a1[split], *low[split].T, high[split], total[split], mass[split])
    if tables:
        known, full = count > 0, (c1 > 0) & ~split
        sums["grams"] = pack(a[known], b[known], count[known])
        sums["ids"] = pack(np.flatnonzero(known) * sizes.buckets + bucket)
        sums["contexts"] = pack(a1[full], *low[full].T, high[full], mass[full])
    return pa.Table.from_pylist([*out, sums], _FOUND_ARROW)


def _asker(uni: Unigrams, levels: list[Level], sizes: Sizes) -> Callable[[pa.Table], Iterator[pa.Table]]:
    def ask(block: pa.Table) -> Iterator[pa.Table]:
        walk = _walked(block, uni, levels, sizes)
        walk.ask(sizes)
        return walk.asked(block["block"][0].as_py(), sizes.hot)

    return ask


def _answerer(level: int, sizes: Sizes, last: bool, tables: bool, factors: np.ndarray) -> Callable[[pa.Table], pa.Table]:
    def answer(rows: pa.Table) -> pa.Table:
        return _answer_grams(rows, level, sizes, last, tables, factors)

    return answer


def _fit_level(found: DataFrame) -> Level:
    """Discounts, from the sums of all buckets, and the weights of the split contexts;
    their parts, which come to the driver, are less than ``SPLIT_BUCKETS`` times 16."""
    sums = found.select([F.sum(F.col("sums")[k]) for k in range(K + 1)]).first()
    factors, parts = discounts([int(x or 0) for x in sums]), {}
    for r in found.filter("split is not null").select("bucket", "split").orderBy("bucket").collect():
        a1, *rest = unpack(bytes(r["split"]))
        for k, a in enumerate(a1.tolist()):
            own = np.array([x[k] for x in rest], np.float64)
            if a in parts:
                own[[*range(K + 1), K + 2]] += parts[a][[*range(K + 1), K + 2]]
            parts[a] = own
    split = np.array(sorted(parts), np.int64)
    x = np.array([parts[a] for a in split.tolist()]).reshape(len(split), K + 3)
    return Level(factors, split, backoff_weights(factors, x[:, :K], x[:, K], x[:, K + 1], x[:, K + 2]))


# --- 4: tables between the levels, and sums of the documents ----------------------------------------------------

#: Settings while a table is written: the files of its shuffles go when it is written, not
#: when the driver next runs out of memory; and Python gets about one block at a time.
_WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(BATCH_BYTES),
}
_SCORES = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _complete(block: pa.Table, walk: _Walk, uni: Unigrams) -> pa.Table:
    """Sums of the documents, or parts of documents, of one block."""
    n = len(walk.sizes)
    doc, word = np.repeat(np.arange(n), walk.sizes)[walk.scored], walk.word[walk.scored]
    return pa.table(
        {
            "row": pa.array(block["rows"][0].as_py(), pa.int64()),
            "doc_id": pa.array(block["ids"][0].as_py(), pa.int64()),
            "held_out": pa.array(walk.held_out == 1),
            "n_tokens": np.bincount(doc, minlength=n).astype(np.int64),
            "n_known": np.bincount(doc[(walk.known > 0)[word]], minlength=n).astype(np.int64),
            "base_score": np.bincount(doc, uni.base(walk.known)[word], n),
            "score": np.bincount(doc, np.log10(walk.p[walk.scored]), n),
        }
    )


#: The answers to a block: a list for each level, by bucket.
_TOLD = "array<array<binary>>"


def _told(blocks: DataFrame, found: DataFrame) -> DataFrame:
    """Blocks with the answers of one more level."""
    answers = found.filter("block is not null").groupBy(F.col("block").alias("for")).agg(
        F.sort_array(F.collect_list(F.struct("bucket", "answer"))).getField("answer").alias("more")
    )
    more = F.array(F.coalesce("more", F.array().cast("array<binary>")))
    joined = blocks.join(answers, F.col("block") == F.col("for"), "left")
    return joined.select("block", "stream", "rows", "ids", F.concat("answers", more).alias("answers"))


def _stored(df: DataFrame, name: str, *parts: str) -> tuple[DataFrame, str]:
    """``df`` written to a new table in the shared folder and read back, and its path."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    before = {k: spark.conf.get(k) for k in _WRITING}
    for k, v in _WRITING.items():
        spark.conf.set(k, v)
    try:
        df.write.partitionBy(*parts).parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path), path


def _delete(spark: SparkSession, *paths: str) -> None:
    """Delete tables, or parts of them, that nothing reads any more."""
    for path in paths:
        fs, at = file_system(spark, path)
        fs.delete(at, True)


@dataclass
class KatzModel:
    """Fitted sums, beside the tables; ``levels`` begins with the pairs."""

    unigrams: Unigrams
    levels: list[Level]
    buckets: int


def _write_level(found: DataFrame, n: int, level: Level, tables: str) -> None:
    spark = found.sparkSession
    name = "pairs" if n == 2 else f"grams_{n}"
    rows = found.filter("grams is not null")
    rows.select("bucket", F.col("grams").alias("value"), "ids").write.partitionBy("bucket").parquet(f"{tables}/{name}")

    def weights(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for value in batch["contexts"]:
                a, *low, high, mass = unpack(value.as_py())
                low = np.stack(low, 1)
                total = denominators(low @ np.arange(1, K + 1) + high, low.any(1))
                out.append(pack(a, backoff_weights(level.factors, low, high, total, mass)))
            yield pa.RecordBatch.from_arrays([batch["bucket"], pa.array(out, pa.binary())], ["bucket", "value"])

    kept = rows.select("bucket", "contexts").mapInArrow(weights, "bucket int, value binary")
    split = spark.createDataFrame([(-1, bytearray(pack(level.split, level.weights)))], "bucket int, value binary")
    kept.union(split).write.partitionBy("bucket").parquet(f"{tables}/contexts_{n}")
    spark.createDataFrame([(level.factors.tolist(),)], "factors array<double>").write.parquet(f"{tables}/discounts_{n}")


def katz_scores(
    docs: DataFrame,
    held_out: Column,
    doc_id: str = "doc_id",
    text: str = "text",
    tables: str | None = None,
    block_tokens: int = BLOCK_TOKENS,
    order: int = ORDER,
) -> tuple[DataFrame, KatzModel]:
    """Scores of all rows of ``docs``, learned from those that are not ``held_out`` with
    n-grams of up to ``order`` (2 or more) tokens, and the fitted sums.

    One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score (logarithms to base 10).  ``tables`` names a folder for the
    model, partitioned by bucket and packed: ``unigrams`` (bucket, words, counts; a
    word's number is its place times the number of buckets plus its bucket), ``pairs``,
    ``grams_3`` and so on (bucket; value: numbers of context and word, and counts; ids:
    the n-grams' own numbers, by which longer ones name them as contexts),
    ``contexts_2`` and so on (bucket, value: numbers and backoff weights; those of split
    contexts with bucket -1), and ``discounts_2`` and so on.
    """
    if order < 2:
        raise ValueError("the order must be 2 or more")
    spark = docs.sparkSession
    ship_package(spark)
    size = docs.agg(F.sum(F.octet_length(column(text)))).first()[0] or 0
    buckets, keep = max(2 * partitions(spark), -(-size // BUCKET_BYTES)), tables is not None
    tasks = max(partitions(spark), -(-size // BUCKET_BYTES))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        column(doc_id).cast("bigint").alias("doc_id"),
        column(text).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held_out"),
    )
    blocks, at = _stored(_blocks(rows, buckets, block_tokens, order), "blocks")

    def answer_words(table: pa.Table) -> pa.Table:
        return _answer_words(table, buckets, keep)

    lists = blocks.select("block", F.inline("lists")).repartition(tasks, "bucket")
    words, words_at = _stored(lists.groupBy("bucket").applyInArrow(answer_words, _ANSWERS), "words")
    own = words.filter("block is null")
    sums = own.select(*[F.sum(F.col("sums")[k]) for k in range(4 + K)], F.max(F.col("sums")[4 + K])).first()
    sums = [int(x or 0) for x in sums]
    uni = Unigrams(sums[0], sums[1], sums[2], sums[3 : 4 + K], sums[4 + K])
    sizes = Sizes(buckets, max(SURE, -(-uni.tokens // (4 * min(buckets, SPLIT_BUCKETS)))))
    if keep:
        own.select("bucket", "words", "counts").write.partitionBy("bucket").parquet(f"{tables}/unigrams")

    told = _told(blocks.select("block", "stream", "rows", "ids", F.array().cast(_TOLD).alias("answers")), words)
    levels: list[Level] = []
    for n in range(2, order + 1):
        # All that the next levels need is in this one table.
        state, state_at = _stored(told, f"blocks_{n}")
        _delete(spark, at, words_at)
        asked = state.select("block", "stream", "answers").mapInArrow(_each_block(_asker(uni, list(levels), sizes)), _ASKED)
        below = levels[-1].factors if levels else uni.factors
        found = asked.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(_answerer(n, sizes, n == order, keep, below), _FOUND)
        found, found_at = _stored(found.withColumn("own", F.col("block").isNull()), f"grams_{n}", "own")
        own = found.filter("own")
        levels.append(_fit_level(own))
        if keep:
            _write_level(own, n, levels[-1], tables)
        _delete(spark, f"{found_at}/own=true")
        told = _told(state, found.filter("not own"))
        at, words_at = state_at, found_at

    def complete(block: pa.Table) -> pa.Table:
        return _complete(block, _walked(block, uni, levels, sizes), uni)

    # A group is one block, so that a task has one at a time in memory.
    done = told.groupBy("block").applyInArrow(complete, _SCORES)
    done = done.groupBy("row", "doc_id", "held_out").agg(
        *[F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base_score", "score")]
    )
    scores = done.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(uni.tokens).cast("bigint").alias("train_tokens"), "base_score", "score"
    )
    return scores, KatzModel(uni, levels, buckets)
