"""Words and hashes of text columns, computed on whole Arrow buffers.

A word is a maximal run of bytes outside ``0x20`` and ``0x09-0x0D``; UTF-8
continuation bytes are never separators, so working on bytes equals the
pattern ``[^\\x20\\x09-\\x0D]+`` on characters. Every word, line or n-gram is
named by a 64-bit hash (a keyed polynomial of its bytes, then a mixer), so
equality of hashes stands for equality of texts; with 10^9 distinct words a
single collision has a probability of about 3 in 100.

A batch is cut into slices of about ``SLICE_BYTES`` whole rows (a longer row
is a slice of its own), so memory follows the slice and the longest text,
never the batch or the partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 19

_U = np.uint64
_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


with np.errstate(over="ignore"):
    _BYTE = mix(np.arange(1, 257, dtype=_U) * _U(0xD6E8FEB86659FD93))
    #: stands for the end of a text where it counts as a token
    END = int(mix(np.array([0x0E0D], dtype=_U))[0])

_powers: dict[str, np.ndarray] = {}


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n``."""
    if not _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES)
        for name, base in (("up", _BASE), ("down", _BASE_INV)):
            p = np.full(size, base & _MASK, dtype=_U)
            p[0] = 1
            with np.errstate(over="ignore"):
                _powers[name] = np.multiply.accumulate(p)
    return _powers["up"], _powers["down"]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def row_slices(offsets: np.ndarray, most: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose bytes stay within ``most`` (single longer rows alone)."""
    row, n = 0, len(offsets) - 1
    while row < n:
        stop = int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1
        stop = min(max(stop, row + 1), n)
        yield row, stop
        row = stop


def _lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; other bytes as they are."""
    return data + ((data - np.uint8(65) < 26).view(np.uint8) << 5)


def _separates(data: np.ndarray, points: bytes) -> np.ndarray:
    out = (data == 0x20) | (data - np.uint8(9) < 5)
    if points:
        more = np.zeros(256, dtype=bool)
        more[list(points)] = True
        out |= np.take(more, data)
    return out


def _runs(inside: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true values, also cut at ``cuts``."""
    n = len(inside)
    before = np.empty(n, dtype=bool)
    after = np.empty(n, dtype=bool)
    if n:
        before[0], before[1:] = False, inside[:-1]
        after[-1], after[:-1] = False, inside[1:]
        inner = cuts[(cuts > 0) & (cuts < n)]
        before[inner] = False
        after[inner - 1] = False
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


@dataclass
class Slice:
    """Some rows of a batch: their bytes and words."""

    row: int                 # first row in the batch
    data: np.ndarray         # bytes of the rows (lower-cased if asked for)
    text_at: np.ndarray      # row boundaries in data, rows + 1
    starts: np.ndarray       # word starts in data
    ends: np.ndarray
    hashes: np.ndarray       # uint64, one a word
    word_at: np.ndarray      # row boundaries in words, rows + 1

    @property
    def rows(self) -> int:
        return len(self.text_at) - 1

    def word_row(self) -> np.ndarray:
        """Row (within the slice) of each word."""
        return np.repeat(np.arange(self.rows), np.diff(self.word_at))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span ``data[start:end]``."""
    up, down = _powers_to(len(data) + 1)
    with np.errstate(over="ignore"):
        total = np.zeros(len(data) + 1, dtype=_U)
        np.cumsum(np.take(_BYTE, data) * up[:len(data)], out=total[1:])
        return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(_U))


def word_slices(column: pa.Array, lower: bool = True, most: int = SLICE_BYTES, points: bytes = b"") -> Iterator[Slice]:
    """The words of every whole text, slice by slice, in row order; ``points`` are ASCII characters that also separate."""
    data, offsets = text_buffers(column)
    for row, stop in row_slices(offsets, most):
        part = data[offsets[row]:offsets[stop]]
        if lower:
            part = _lowered(part)
        at = offsets[row:stop + 1] - offsets[row]
        starts, ends = _runs(~_separates(part, points), at)
        yield Slice(row, part, at, starts, ends, span_hashes(part, starts, ends), np.searchsorted(starts, at))


def line_spans(piece: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and rows of the lines (split at ``\\n``) that hold a byte."""
    starts, ends = _runs(piece.data != 10, piece.text_at)
    return starts, ends, np.searchsorted(piece.text_at, starts, side="right") - 1


def ngrams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words that start at each place (``len - k + 1``)."""
    n = max(0, len(hashes) - k + 1)
    out = hashes[:n]
    with np.errstate(over="ignore"):
        for j in range(1, k):
            out = mix(out * _U(0x9FB21C651E98DF25) + hashes[j:j + n])
    return out


def ngram_places(word_at: np.ndarray, k: int) -> np.ndarray:
    """Which places of ``ngrams`` lie inside one row."""
    n = max(0, int(word_at[-1] - word_at[0]) - k + 1)
    ok = np.ones(n, dtype=bool)
    for cut in range(1, k):
        at = word_at[1:-1] - word_at[0] - cut
        ok[at[(at >= 0) & (at < n)]] = False
    return ok


def signed(x: np.ndarray) -> pa.Array:
    """uint64 hashes as the bigint column they travel in."""
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def unsigned(x) -> np.ndarray:
    return np.ascontiguousarray(np.asarray(x, dtype=np.int64)).view(_U)
