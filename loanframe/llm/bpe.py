"""Byte-level BPE encoding and decoding (operator 6).

A text is split by the pattern of the rank file; every match is encoded on its own.
The tokens of one match are found left to right without running the merges: a
pyahocorasick automaton over all tokens, whose bytes are mapped to Latin-1
characters, gives the longest token at every offset; a candidate is appended when
the pair it forms with its predecessor is one that the merges would leave as two
tokens, else the next shorter token is tried, and when none is left the encoder
steps back.  A dead offset is never tried twice and the pair checks are memoised, so
the work is linear in the match.  The outcome is exactly that of the merges.

Ids and bytes are real columns; digests are left to the caller.

Defined cases: a null text counts as empty and gives an empty list of ids; null ids
decode to null; an existing column of the output's name is replaced; every input row,
repeated rows included, gives one output row and all other columns pass through.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, StructField

from .common import ship_package, with_fields

#: Matches up to this many bytes are kept in a worker's memo, and so many of them.
MEMO_BYTES, MEMO_ENTRIES = 64, 150_000
#: So many pair checks are kept before the memo starts anew.
PAIR_ENTRIES = 250_000
#: Texts over so many characters are matched one match at a time.
LONG_TEXT = 1_000_000


def read_ranks(path: str) -> bytes:
    """The bytes of a rank file (under 1 MB for a 50,000-token vocabulary)."""
    with open(path, "rb") as f:
        return f.read()


class BytePairEncoder:
    """Encodes and decodes by the ranks of one file.

    ``ranks`` holds one ``base64(token) rank`` pair per line; all 256 single bytes
    must be tokens.
    """

    def __init__(self, ranks: bytes, pattern: str):
        self.rank = {base64.b64decode(a): int(b) for a, b in (x.split() for x in ranks.splitlines() if x)}
        missing = [i for i in range(256) if bytes([i]) not in self.rank]
        if missing:
            raise ValueError(f"rank file lacks the single bytes {missing[:5]}")
        self.tokens = [b""] * (max(self.rank.values()) + 1)
        for token, rank in self.rank.items():
            self.tokens[rank] = token
        self.pattern = regex.compile(pattern)
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.rank.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self._sizes = [len(t) for t in self.tokens]
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._shorter: dict[int, int] = {}
        self._apart: dict[int, bool] = {}
        self._memo = _Memo(self)
        self._token_array = pa.array([t or None for t in self.tokens], pa.binary())

    # --- one match -----------------------------------------------------------

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; ``None`` for a single byte."""
        if token not in self._halves:
            parts = [self.rank[bytes([b])] for b in self.tokens[token]]
            while len(parts) > 2:
                best, at = token, -1
                for i in range(len(parts) - 1):
                    r = self.rank.get(self.tokens[parts[i]] + self.tokens[parts[i + 1]], token)
                    if r < best:
                        best, at = r, i
                if at < 0:
                    break
                parts[at : at + 2] = [best]
            self._halves[token] = (parts[0], parts[1]) if len(parts) == 2 else None
        return self._halves[token]

    def apart(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` followed by ``right`` as they are.

        The merges that made the two tokens are undone from the latest to the
        earliest along their common edge.  A merge over the edge that ranks before
        the one just undone would have been made first, so the pair cannot stand.
        """
        key = left << 32 | right
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) >= PAIR_ENTRIES:
                self._apart.clear()
            known = self._apart[key] = self._stays_apart(left, right)
        return known

    def _stays_apart(self, left: int, right: int) -> bool:
        tokens, rank = self.tokens, self.rank
        # made: the rank up to which merges are done at this point.  At equal ranks
        # the merge further left goes first, hence the half steps.
        made = float("inf")
        while True:
            over = rank.get(tokens[left] + tokens[right])
            if over is not None and over < made:
                return False
            undo_left, undo_right = self.halves(left), self.halves(right)
            if undo_left is None and undo_right is None:
                return True
            if undo_right is None or (undo_left is not None and left > right):
                made, left = left, undo_left[1]
            else:
                made, right = right + 0.5, undo_right[0]

    def shorter(self, token: int) -> int:
        """The longest token that is a proper prefix of ``token``; -1 if none."""
        known = self._shorter.get(token)
        if known is None:
            b, known = self.tokens[token], -1
            for end in range(len(b) - 1, 0, -1):
                if b[:end] in self.rank:
                    known = self.rank[b[:end]]
                    break
            self._shorter[token] = known
        return known

    def encode_bytes(self, piece: bytes) -> list[int]:
        """Ids of one match."""
        whole = self.rank.get(piece)
        if whole is not None:
            return [whole]
        n = len(piece)
        if not n:
            return []
        letters, sizes, pairs = piece.decode("latin-1"), self._sizes, self._apart
        # Every single byte is a token, so the longest matches from an offset on begin
        # right there and leave no gap; other offsets are looked up when stepped on.
        longest, start = {}, 0
        for end, token in self.automaton.iter_long(letters):
            longest[start] = token
            start = end + 1
        alive = bytearray(b"\x01") * (n + 1)
        ids, at, before = [], 0, -1
        candidate = longest[0]
        while True:
            end = at + sizes[candidate]
            if alive[end]:
                fits = before < 0 or pairs.get(before << 32 | candidate)
                if fits is None:
                    fits = self.apart(before, candidate)
                if fits:
                    ids.append(candidate)
                    if end == n:
                        return ids
                    before, at = candidate, end
                    candidate = longest.get(at)
                    if candidate is None:
                        candidate = longest[at] = next(self.automaton.iter_long(letters, at))[1]
                    continue
            candidate = self.shorter(candidate)
            while candidate < 0:  # nothing fits here: give the previous token up
                alive[at] = 0
                last = ids.pop()
                at -= sizes[last]
                before = ids[-1] if ids else -1
                candidate = self.shorter(last)

    # --- whole texts ---------------------------------------------------------

    def encode_packed(self, text: str) -> bytes:
        """Ids of a whole text, as 32-bit integers one after the other."""
        if len(text) > LONG_TEXT:
            pieces = (m.group() for m in self.pattern.finditer(text))
        else:
            pieces = self.pattern.findall(text)
        return b"".join(map(self._memo.__getitem__, pieces))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return np.frombuffer(self.encode_packed(text), np.int32).tolist()

    def decode_lists(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes of every list; null for null.  An id outside the vocabulary, or
        a null one, is an error."""
        flat = ids.flatten()
        if flat.null_count:
            raise ValueError("null token id")
        found = self._token_array.take(flat)
        if found.null_count:
            raise ValueError("id without a token")
        offsets = np.frombuffer(found.buffers()[1], np.int32)[found.offset : found.offset + len(found) + 1]
        sizes = pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False)
        ends = offsets[np.concatenate([[0], np.cumsum(sizes)])]
        whole = pa.BinaryArray.from_buffers(
            pa.binary(), len(ids), [None, pa.py_buffer(np.ascontiguousarray(ends, np.int32)), found.buffers()[2]]
        )
        return pc.if_else(ids.is_valid(), whole, pa.scalar(None, pa.binary()))

    def decode(self, ids) -> bytes:
        """The bytes of one list of ids."""
        return self.decode_lists(pa.array([list(ids)], pa.list_(pa.int32())))[0].as_py()


class _Memo(dict):
    """Packed ids of the matches seen lately."""

    def __init__(self, encoder: BytePairEncoder):
        super().__init__()
        self.encode_bytes = encoder.encode_bytes

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode("utf-8", "surrogatepass")
        packed = array("i", self.encode_bytes(raw)).tobytes()
        if len(raw) <= MEMO_BYTES:
            if len(self) >= MEMO_ENTRIES:
                self.clear()
            self[piece] = packed
        return packed


_worker: dict[tuple[int, str], BytePairEncoder] = {}


def _encoder(ranks: bytes, pattern: str) -> BytePairEncoder:
    """One encoder per Python worker and rank file."""
    key = (hash(ranks), pattern)
    if key not in _worker:
        _worker.clear()
        _worker[key] = BytePairEncoder(ranks, pattern)
    return _worker[key]


def _placed(batch: pa.RecordBatch, name: str, values: pa.Array) -> pa.RecordBatch:
    keep = [i for i, c in enumerate(batch.schema.names) if c.lower() != name.lower()]
    return pa.RecordBatch.from_arrays(
        [batch.column(i) for i in keep] + [values], [batch.schema.names[i] for i in keep] + [name]
    )


def _in_pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 4 << 20):
    """The batches cut so that ``column`` holds about ``most`` bytes in each."""
    for batch in batches:
        values = batch.column(batch.schema.get_field_index(column))
        step = max(1, int(batch.num_rows * min(1.0, most / max(1, values.nbytes))))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)
        del batch, values
        pa.default_memory_pool().release_unused()


def encode_texts(
    df: DataFrame, ranks_path: str, pattern: str, text: str = "text", out: str = "ids"
) -> DataFrame:
    """``df`` with ``out``, the token ids (array of int) of the whole ``text``.

    ``ranks_path`` is read on the driver and sent to the executors (its size is that
    of a vocabulary, whatever the data).  No shuffle: every row is encoded where it
    is read.
    """
    spark = df.sparkSession
    ship_package(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in _in_pieces(batches, text):
            lists = [
                encoder.encode_packed(t) if t is not None else b""
                for t in batch.column(batch.schema.get_field_index(text)).to_pylist()
            ]
            offsets = np.zeros(len(lists) + 1, np.int32)
            np.cumsum([len(x) // 4 for x in lists], out=offsets[1:])
            flat = np.frombuffer(b"".join(lists), np.int32)
            yield _placed(batch, out, pa.ListArray.from_arrays(offsets, flat))

    return df.mapInArrow(run, with_fields(df, StructField(out, ArrayType(IntegerType()))))


def decode_ids(
    df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", out: str = "decoded"
) -> DataFrame:
    """``df`` with ``out``, the bytes (binary) that the token ids stand for."""
    spark = df.sparkSession
    ship_package(spark)
    ranks = spark.sparkContext.broadcast(read_ranks(ranks_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(ranks.value, pattern)
        for batch in _in_pieces(batches, ids):
            column = batch.column(batch.schema.get_field_index(ids))
            yield _placed(batch, out, encoder.decode_lists(column))

    return df.mapInArrow(run, with_fields(df, StructField(out, BinaryType())))
