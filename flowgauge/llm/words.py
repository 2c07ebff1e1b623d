"""Words of whole Arrow text columns as numpy arrays: byte spans and 64-bit hashes.

A text is never cut: a batch may be worked on in pieces, but the pieces end
between words. Hashes are polynomials over a fixed random byte table, modulo
2**64, then mixed; what must be exact compares the bytes behind equal hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE = 1 << 19

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
WORD_BYTES = ~_SPACE

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BYTES = np.random.default_rng(20_240_601).integers(0, 2**64, 256, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))


_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse; those of a whole piece are kept."""
    if size in _KEPT:
        return _KEPT[size]
    made = tuple(
        np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size - 1, base, np.uint64)]))
        for base in (_STEP, _BACK)
    )
    if size == PIECE:
        _KEPT[size] = made
    return made


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def follow(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a sequence from the hash of its head and that of its last word."""
    return mix(context * np.uint64(0xD6E8FEB86659FD93) + word)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its texts; a null is empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    if not pa.types.is_large_binary(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_large_binary(column.type) else "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]] if len(offsets) else whole, offsets - offsets[0]


@dataclass
class Words:
    """Words of some texts: byte spans in data, and first[i]:first[i + 1] are those of text i."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(data: np.ndarray, offsets: np.ndarray, members: np.ndarray = WORD_BYTES) -> Words:
    """Runs of member bytes; no word goes on past the end of its text."""
    inside = members[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    edge[-1] = True
    change = np.ones(len(data) + 1, bool)
    np.not_equal(inside[1:], inside[:-1], out=change[1:-1])
    change |= edge
    start = np.flatnonzero(inside & change[:-1])
    end = np.flatnonzero(inside & change[1:]) + 1
    return Words(data, start, end, np.searchsorted(start, offsets))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are in order and do not overlap."""
    out = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(end, start[at] + PIECE, "right")))
        origin = start[at]
        piece = data[origin : end[to - 1]]
        size = len(piece)
        up, down = _powers(PIECE) if size <= PIECE else _powers(1 << (size - 1).bit_length())
        sums = np.zeros(size + 1, np.uint64)
        np.cumsum(_BYTES[piece] * up[:size], out=sums[1:])
        a, b = start[at:to] - origin, end[at:to] - origin
        out[at:to] = (sums[b] - sums[a]) * down[a]
        at = to
    return mix(out)


def slices(offsets: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of about `most` bytes; one longer text stands alone."""
    at, n = 0, len(offsets) - 1
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, min(to, n)
        at = to


def pieces(batches: Iterator[pa.RecordBatch], most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut, between rows, to about `most` bytes of text; one longer text stands alone."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        for a, b in slices(offsets, most):
            yield batch.slice(a, b - a)


def expand(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... for length[0] numbers, then the same of start[1], ..."""
    total = int(length.sum())
    if not total:
        return np.empty(0, np.int64)
    skipped = np.cumsum(length) - length
    return np.arange(total, dtype=np.int64) + np.repeat(start.astype(np.int64) - skipped, length)


def gather(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of all spans one after the other, a piece at a time."""
    stop = np.cumsum(length)
    out = np.empty(int(stop[-1]) if len(stop) else 0, np.uint8)
    at = 0
    while at < len(start):
        done = int(stop[at - 1]) if at else 0
        to = max(at + 1, int(np.searchsorted(stop, done + PIECE, "right")))
        out[done : stop[to - 1]] = data[expand(start[at:to], length[at:to])]
        at = to
    return out


def joined_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all words, each followed by one space, and where each word starts and ends in them."""
    length = words.end - words.start + 1
    joined = gather(np.append(words.data, np.uint8(32)), words.start, length)
    end = np.cumsum(length)
    joined[end - 1] = 32
    return joined, end - length, end - 1


def word_numbers(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """A number for each word, equal for equal bytes only, and the hash of each number's word."""
    length = words.end - words.start
    data = gather(words.data, words.start, length)
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    coded = column.dictionary_encode()
    numbers = coded.indices.to_numpy(zero_copy_only=False)
    data, offsets = text_bytes(coded.dictionary)
    return numbers, span_hashes(data, offsets[:-1], offsets[1:])


def window_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """The hash of each run of `width` neighbouring items."""
    if len(hashes) < width:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - width + 1, np.uint64)
    for i, power in enumerate(_powers(width)[0]):
        out += hashes[i : i + len(out)] * power
    return mix(out)
