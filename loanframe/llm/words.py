"""Words of UTF-8 texts, read in blocks.

A table of 256 bytes says which bytes are part of a word; all others separate words.
Bytes of 0x80 and above, which spell all characters beyond ASCII, are always part of one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa

from .bpe import _in_pieces

#: Texts are cut into words in blocks of about so many bytes, at the end of a word.
BLOCK = 1 << 20

_LETTERS = bytes(range(ord("a"), ord("z") + 1))
_DIGITS = bytes(range(ord("0"), ord("9") + 1))


def _table(kept: bytes) -> bytes:
    out = bytearray(b" " * 128 + bytes(range(128, 256)))
    for b in kept:
        out[b] = b
    for b in _LETTERS:
        out[b] = out[b - 32] = b
    return bytes(out)


#: Byte tables: A-Z become a-z, bytes outside words a space.
LETTERS, LETTERS_AND_DIGITS = _table(_LETTERS), _table(_LETTERS + _DIGITS)


def word_blocks(text: bytes | None, table: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in order, in lists of bounded size."""
    if not text:
        return
    at, size = 0, len(text)
    while at < size:
        block = text[at : at + BLOCK].translate(table)
        at += BLOCK
        tail = []
        # A word that the border cuts is read to its end.
        while at < size and block[-1:] != b" ":
            more = text[at : at + 4096].translate(table)
            end = more.find(b" ")
            tail.append(more if end < 0 else more[:end])
            at += len(more) if end < 0 else end
            if end >= 0:
                break
        yield (block + b"".join(tail)).split()


def byte_texts(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Batches of bounded size, each with its texts as UTF-8 bytes."""
    for batch in _in_pieces(batches, text):
        values = batch.column(batch.schema.get_field_index(text))
        yield batch, values.cast(pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()).to_pylist()
