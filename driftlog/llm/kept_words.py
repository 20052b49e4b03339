"""Texts without some of their words, the others joined by one space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from driftlog.llm.words import Slice


def covered(piece: Slice, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which words of a slice lie in a span ``[start, end)`` of their row's words."""
    edge = np.zeros(len(piece.starts) + 1, dtype=np.int64)
    first = piece.word_at[row]
    np.add.at(edge, first + start, 1)
    np.add.at(edge, first + end, -1)
    return np.cumsum(edge[:-1]) > 0


def joined_words(piece: Slice, kept: np.ndarray) -> pa.Array:
    """The ``kept`` words of each row of a slice, joined by one space."""
    kept = np.flatnonzero(kept)
    row = np.searchsorted(piece.word_at, kept, side="right") - 1
    end = piece.ends[kept]
    data = piece.data.copy()
    edge = np.zeros(len(data) + 1, dtype=np.int8)
    edge[piece.starts[kept]] += 1
    edge[end] -= 1
    mask = np.cumsum(edge[:-1], dtype=np.int8) > 0
    between = end[:-1][row[1:] == row[:-1]]      # what follows a word that is not its row's last kept one separates
    data[between] = 0x20
    mask[between] = True
    size = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(mask, out=size[1:])
    return pa.Array.from_buffers(pa.large_string(), piece.rows,
                                 [None, pa.py_buffer(size[piece.text_at]), pa.py_buffer(data[mask])]).cast(pa.string())
