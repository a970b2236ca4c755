"""Document quality from a line-level conditional random field (operator 3).

Every line of a document is good or bad.  A linear-chain conditional random field
gives the probability of the labelling from features of each line and of the lines
before and after it (shares of character kinds, word shapes, length, repetition) and
from the labels of neighbouring lines.  Forward-backward yields each line's marginal
probability of being good; their mean, weighted by the lines' lengths, is the
document's score.

The weights are fitted by gradient ascent on the conditional likelihood of a bounded
sample of labelled documents, whose label stands for all of their lines: at most
``SAMPLE`` documents, spread over the table by a hash, with up to ``SAMPLE_LINES``
neighbouring lines of each, whose place in a longer document a hash of its text tells.
Scoring reads every document whole, where its row is, without a shuffle.  The features
of a document are made for a block of lines at a time; of every line a few numbers stay
(its hash, score, message ratios and length), and long chains are worked on in stretches
side by side, so a very long text costs memory and time in proportion to its lines.

Defined cases: a null or empty text is one empty line and gets its marginal; a document
without any characters to weigh by takes the plain mean.  Labels that are null are not
learned from; where an id has several labels each counts.  With labels of one kind only
the score is near that kind; without labels it is 0.5.  Repeated rows are scored each;
existing columns named like the outputs are replaced, others pass through.
"""

from __future__ import annotations

import math
import unicodedata
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField

from .bpe import _in_pieces, _placed
from .common import column, ship_package, with_fields

#: Labelled documents that the weights are fitted on, and lines of each at most.
SAMPLE, SAMPLE_LINES = 4000, 100
#: Score from which a document counts as good.
GOOD = 0.7
ROUNDS, STEP, RIDGE = 300, 0.05, 1e-3
#: Characters of the lines whose features are held at a time, and lines up to which
#: documents are worked on side by side; a longer one is cut into stretches that are.
BLOCK_CHARS, SIDE_LINES = 1 << 18, 1024

_LOWER, _UPPER, _LETTER, _DIGIT, _SPACE, _STOP, _MARK, _SYMBOL = range(8)
_kinds: np.ndarray | None = None


def _kind_table() -> np.ndarray:
    """The kind of every code point."""
    global _kinds
    if _kinds is None:
        table = np.full(0x110000, _SYMBOL, np.uint8)
        by_category = {"Ll": _LOWER, "Lu": _UPPER, "Lt": _UPPER, "Lm": _LETTER, "Lo": _LETTER, "Mn": _LETTER}
        for i in range(0x110000):
            c = unicodedata.category(chr(i))
            if c in by_category:
                table[i] = by_category[c]
            elif c[0] == "N":
                table[i] = _DIGIT
            elif c[0] == "Z":
                table[i] = _SPACE
            elif c[0] == "P":
                table[i] = _MARK
        for c in "\t\n\x0b\x0c\r":
            table[ord(c)] = _SPACE
        for c in ".,;:?!":
            table[ord(c)] = _STOP
        for c in "*#%&@/\\_":
            table[ord(c)] = _SYMBOL
        _kinds = table
    return _kinds


#: Features of one line, and the place of the one that tells repeated lines.
OWN, REPEATED = 21, 18


def _blocks(text: str) -> Iterator[list[str]]:
    """The lines of ``text`` in blocks of about ``BLOCK_CHARS`` characters."""
    start = 0
    while True:
        end = text.find("\n", start + BLOCK_CHARS)
        if end < 0:
            yield text[start:].split("\n")
            return
        yield text[start:end].split("\n")
        start = end + 1


def _own_features(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of each line by itself (whether it is repeated is left open), and its
    characters."""
    codes = np.frombuffer("\n".join([*lines, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = _kind_table()[codes]
    ends = np.flatnonzero(codes == 10)
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = (ends - starts).astype(np.float64)

    def per_line(flags: np.ndarray) -> np.ndarray:
        # No flag is set on the line feed that ends a line.
        return np.add.reduceat(flags, starts, dtype=np.int64).astype(np.float64)

    visible = kinds != _SPACE
    begin, last = visible.copy(), visible.copy()
    begin[1:] &= ~visible[:-1]
    last[:-1] &= ~visible[1:]
    same = visible.copy()
    same[0] = False
    same[1:] &= codes[1:] == codes[:-1]
    chars = np.maximum(per_line(visible), 1)
    words = np.maximum(per_line(begin), 1)
    letters = per_line(kinds <= _LETTER)
    upper = per_line(kinds == _UPPER)
    again, distinct = np.zeros(len(lines)), np.ones(len(lines))
    for i, line in enumerate(lines):
        own_words = line.split()
        if len(own_words) > 1:
            again[i] = sum(map(eq, own_words, islice(own_words, 1, None))) / (len(own_words) - 1)
            distinct[i] = len(set(own_words)) / len(own_words)
    own = np.stack(
        [
            letters / chars,
            upper / np.maximum(letters, 1),
            upper > 0.6 * np.maximum(letters, 1),
            per_line(kinds == _DIGIT) / chars,
            per_line(kinds == _STOP) / chars,
            per_line(kinds == _MARK) / chars,
            per_line(kinds == _SYMBOL) / chars,
            per_line((kinds == _SYMBOL) & begin & last) / words,
            per_line((kinds == _SYMBOL) & last & ~begin) / words,
            per_line((codes == 33) & last) / words,
            per_line((kinds == _STOP) & last) / words,
            per_line((kinds == _UPPER) & begin) / words,
            per_line(same & (kinds > _LETTER)) / chars,
            per_line(same & (kinds <= _LETTER)) / chars,
            np.minimum(chars / words, 20) / 10,
            np.log1p(words) / 5,
            words < 4,
            size == 0,
            np.zeros(len(lines)),
            again,
            distinct,
        ],
        axis=1,
    ).astype(np.float64)
    return own, size


def _repeated(text: str) -> np.ndarray:
    """1 for each line that is not empty and stands further up too (by 64-bit hashes)."""
    hashes = array("Q")
    for lines in _blocks(text):
        hashes.extend(xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) for line in lines)
    values = np.frombuffer(hashes, np.uint64)
    flags = np.ones(len(values))
    flags[np.unique(values, return_index=True)[1]] = 0
    flags[values == np.uint64(xxhash.xxh3_64_intdigest(b""))] = 0
    return flags


def line_features(text: str | None, first: int = 0, stop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x own, before and after, and a constant) and characters of the
    lines from ``first`` until before ``stop``, read in the whole text."""
    text = text or ""
    repeated = _repeated(text)
    stop = len(repeated) if stop is None else min(stop, len(repeated))
    # One line more on either side, where there is one.
    low, high = max(first - 1, 0), min(stop + 1, len(repeated))
    read, at = [], 0
    for lines in _blocks(text):
        part = lines[max(low - at, 0) : max(high - at, 0)]
        if part:
            read.append(_own_features(part))
        at += len(lines)
    own = np.concatenate([f for f, _ in read])
    size = np.concatenate([n for _, n in read])
    own[:, REPEATED] = repeated[low:high]
    edge = np.zeros((1, OWN))
    rows = np.concatenate([own, np.concatenate([edge, own[:-1]]), np.concatenate([own[1:], edge]), np.ones((len(own), 1))], axis=1)
    return rows[first - low : stop - low], size[first - low : stop - low]


FEATURES = 3 * OWN + 1


@dataclass
class LineField:
    """Weights of the field: ``lean`` of the features towards good, ``move`` of label
    to label (0 bad, 1 good)."""

    lean: np.ndarray
    move: np.ndarray

    def leans(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Score of good against bad, and characters, of every line of a whole text.
        Features are held for a block of lines at a time."""
        own, before, after = self.lean[:-1].reshape(3, OWN)
        weights = np.stack([own, before, after], 1)
        parts, sizes = [], []
        for lines in _blocks(text or ""):
            features, size = _own_features(lines)
            parts.append(features @ weights)
            sizes.append(size)
        each = np.concatenate(parts)
        del parts
        each += _repeated(text or "")[:, None] * weights[REPEATED]
        lean = each[:, 0] + self.lean[-1]
        lean[1:] += each[:-1, 1]
        lean[:-1] += each[1:, 2]
        return lean, np.concatenate(sizes)

    def marginals(self, leans: list[np.ndarray]) -> list[np.ndarray]:
        """Probability of each line to be good, given the lines of its document."""
        out = [np.zeros(0)] * len(leans)
        short = [i for i, lean in enumerate(leans) if len(lean) <= SIDE_LINES]
        if short:
            ends = np.cumsum([len(leans[i]) for i in short]).tolist()
            documents = [slice(e - len(leans[i]), e) for e, i in zip(ends, short)]
            p = _forward_backward(np.concatenate([leans[i] for i in short]), self.move, documents)[0]
            for d, i in zip(documents, short):
                out[i] = p[d]
        for i, lean in enumerate(leans):
            if len(lean) > SIDE_LINES:
                out[i] = _long_marginals(lean, self.move)
        return out


def _logsum(a, b):
    return np.logaddexp(a, b)


def _ratios(lean: np.ndarray, move: np.ndarray) -> np.ndarray:
    """For every line the log of its forward message for good over that for bad.

    The lines are cut into stretches as long as there are stretches, worked on side by
    side: first what each makes of a message (a matrix by logarithms), then the message
    that each really gets, one stretch after the other, then the ratios in all of them.
    """
    n = len(lean)
    length = math.isqrt(n - 1) + 1
    count = -(-n // length)
    rows = np.zeros(count * length)
    rows[:n] = lean
    steps = rows.reshape(count, length).T  # the same step of all stretches is one row

    def step(was: np.ndarray, own: np.ndarray) -> np.ndarray:
        bad = _logsum(was[..., 0] + move[0, 0], was[..., 1] + move[1, 0])
        good = _logsum(was[..., 0] + move[0, 1], was[..., 1] + move[1, 1]) + own
        return np.stack([bad, good], -1)

    whole = np.broadcast_to(np.where(np.eye(2) > 0, 0.0, -np.inf), (count, 2, 2))
    for own in steps:
        whole = step(whole, own[:, None])
        whole = whole - whole.max((1, 2), keepdims=True)
    got = np.zeros((count, 2))
    # The first line has no line before it: both labels start alike.
    message = np.array([0.0, lean[0]])
    for own in steps[1:, 0]:
        message = step(message, own)
        message -= message.max()
    for i in range(1, count):
        got[i] = message
        message = _logsum(message[0] + whole[i, 0], message[1] + whole[i, 1])
        message -= message.max()
    out = np.empty_like(steps)
    for t, own in enumerate(steps):
        got = step(got, own)
        if t == 0:
            got[0] = 0.0, lean[0]
        got -= got.max(-1, keepdims=True)
        out[t] = got[:, 1] - got[:, 0]
    return out.T.ravel()[:n]


def _long_marginals(lean: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Marginals of the lines of one long document.  Read from its end, a chain is a
    chain with the moves turned round; both ratios hold the line's own score."""
    ratio = _ratios(lean, move) + _ratios(lean[::-1], move.T)[::-1] - lean
    return 0.5 * (1 + np.tanh(0.5 * ratio))


def _forward_backward(lean: np.ndarray, move: np.ndarray, documents: list[slice]):
    """Marginals of every line, summed pair marginals, and log normalisers.

    Documents are worked on side by side, line by line; ``lean`` is the score of good
    against bad.
    """
    order = sorted(documents, key=lambda d: d.start - d.stop)
    start = np.array([d.start for d in order])
    length = np.array([d.stop - d.start for d in order])
    steps = int(length.max())
    # Documents still running at each step come first.
    running = [int(np.searchsorted(-length, -t, side="left")) for t in range(steps)]
    a = np.zeros((len(lean), 2))
    a[start, 1] = lean[start]
    for t in range(1, steps):
        at = start[: running[t]] + t
        was = a[at - 1]
        a[at, 0] = _logsum(was[:, 0] + move[0, 0], was[:, 1] + move[1, 0])
        a[at, 1] = _logsum(was[:, 0] + move[0, 1], was[:, 1] + move[1, 1]) + lean[at]
    z = _logsum(a[start + length - 1, 0], a[start + length - 1, 1])
    b = np.zeros((len(lean), 2))
    pairs = np.zeros((2, 2))
    for t in range(steps - 1, 0, -1):
        at = start[: running[t]] + t
        here = b[at] + np.stack([np.zeros(len(at)), lean[at]], 1)
        for i in range(2):
            b[at - 1, i] = _logsum(move[i, 0] + here[:, 0], move[i, 1] + here[:, 1])
            for j in range(2):
                pairs[i, j] += np.exp(a[at - 1, i] + move[i, j] + here[:, j] - z[: running[t]]).sum()
    whole = np.zeros(len(lean))
    for d, value in zip(order, z):
        whole[d] = value
    return np.exp(np.minimum(a[:, 1] + b[:, 1] - whole, 0)), pairs, z


def fit_line_field(sample: list[tuple[np.ndarray, int]]) -> LineField:
    """Weights from (features, label) of documents, every line labelled like its
    document; both labels weigh alike."""
    lean, move = np.zeros(FEATURES), np.zeros((2, 2))
    if not sample:
        return LineField(lean, move)
    x = np.concatenate([f for f, _ in sample])
    ends = np.cumsum([len(f) for f, _ in sample])
    documents = [slice(e - len(f), e) for e, (f, _) in zip(ends, sample)]
    y = np.concatenate([np.full(len(f), label, np.float64) for f, label in sample])
    stays = np.zeros((2, 2))
    for f, label in sample:
        stays[label, label] += len(f) - 1
    weights = np.concatenate([lean, move.ravel()])
    mean, square = np.zeros_like(weights), np.zeros_like(weights)
    for t in range(1, ROUNDS + 1):
        p, pairs, _ = _forward_backward(x @ weights[:FEATURES], weights[FEATURES:].reshape(2, 2), documents)
        slope = np.concatenate([x.T @ (y - p), (stays - pairs).ravel()]) / len(sample) - RIDGE * weights
        mean, square = 0.9 * mean + 0.1 * slope, 0.999 * square + 0.001 * slope**2
        weights = weights + STEP * (mean / (1 - 0.9**t)) / (np.sqrt(square / (1 - 0.999**t)) + 1e-8)
    return LineField(weights[:FEATURES], weights[FEATURES:].reshape(2, 2))


def document_scores(field: LineField, texts: list[str | None]) -> list[float]:
    """Length-weighted mean of the lines' marginals of every text."""
    if not texts:
        return []
    leans, sizes = zip(*[field.leans(t) for t in texts])
    marginals = field.marginals(list(leans))
    means = [(p * size).sum() / size.sum() if size.sum() else p.mean() for p, size in zip(marginals, sizes)]
    return [float(x) for x in np.clip(means, 0, 1)]


def _sampled(text: str | None) -> np.ndarray:
    """Features, read in the whole document, of the lines that are fitted on."""
    text = text or ""
    spare = max(0, text.count("\n") + 1 - SAMPLE_LINES)
    start = zlib.crc32(text.encode("utf-8", "surrogatepass")) % (spare + 1)
    return line_features(text, start, start + SAMPLE_LINES)[0]


def fit_quality(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> LineField:
    """Fit on documents whose id has a label in ``labels`` (doc_id, label)."""
    ship_package(docs.sparkSession)
    known = labels.select(column("doc_id").alias("id"), (column(label) == 1).cast("int").alias("label")).filter(
        "id is not null and label is not null"
    )
    # The least hashes, whatever the order of tasks.  SAMPLE rows of two numbers at most:
    # small enough to send to every task.
    asked = known.orderBy(F.xxhash64("id"), "id", "label").limit(SAMPLE)
    rows = docs.select(column(doc_id).alias("id"), column(text).alias("text")).join(F.broadcast(asked), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_pieces(batches, "text"):
            kept = []
            for t, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                kept.append((_sampled(t).astype(np.float32).tobytes(), y))
            columns = [pa.array([k[0] for k in kept], pa.binary()), pa.array([k[1] for k in kept], pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["features", "label"])

    made = rows.select("text", "label").mapInArrow(run, "features binary, label int")
    # Ids that occur in several rows may give more; the bound holds all the same.
    made = made.orderBy(F.xxhash64("features", "label"), "label").limit(SAMPLE).collect()
    sample = [(np.frombuffer(bytes(r["features"]), np.float32).reshape(-1, FEATURES).astype(float), r["label"]) for r in made]
    sample.sort(key=lambda s: (len(s[0]), s[1], s[0].tobytes()))  # the same sums in any order of arrival
    return fit_line_field(sample)


def score_quality(df: DataFrame, field: LineField, text: str = "text") -> DataFrame:
    """``df`` with ``score`` (0 to 1) and ``predicted`` (1 from ``GOOD`` on)."""
    spark = df.sparkSession
    ship_package(spark)
    sent = spark.sparkContext.broadcast(field)
    schema = with_fields(df, StructField("score", DoubleType()), StructField("predicted", IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _in_pieces(batches, text):
            texts = batch.column(batch.schema.get_field_index(text)).to_pylist()
            scores = document_scores(sent.value, texts)
            batch = _placed(batch, "score", pa.array(scores, pa.float64()))
            yield _placed(batch, "predicted", pa.array([int(s >= GOOD) for s in scores], pa.int32()))

    return df.mapInArrow(run, schema)
