"""Periodic runs of words, found by minimizers at several scales.

A run is a stretch of consecutive words of one text with smallest period
``q`` (words ``q`` apart are identical) and a length of at least
``max(least, 2 * q)`` that no neighbouring word extends keeping the period.
All runs of every whole text are found:

* Periods below ``lags`` are too short for minimizers: the words are compared
  with themselves at each such lag, and stretches of matches read off.
* Scale ``s`` holds the periods of ``[2**s, 2**(s+1))``. Its grams have
  ``2**(s-2)`` words, its windows ``2**(s-1)`` grams. Inside a run a window
  and the one a period later hold the same grams, so their minima lie a period
  apart; each two equal minima at a distance of the scale seed an extension to
  both sides (binary search on hashes of 2, 4, 8, ... words).
* A gram that is itself periodic, three times its period or more, lies in a
  run of an earlier scale. Such grams are never minima: equal minima are then
  more than a third of a gram apart, at most 24 within the distances of a
  scale, and no text makes the pairs quadratic. A run that holds nothing but
  such grams in its first period is a stretch of a shorter period ``p`` twice
  over: it starts in one ``p``-run and ends in the next, which follows
  directly. Each such neighbouring pair seeds its lags of equal phase.

A stretch that several lags fit has the smallest of them as its period.
Grams are compared by 64-bit hashes (see ``words``).

Each text is worked on in one piece in the task that reads it, in slices of
whole texts of about ``words.SLICE_BYTES``; nothing is shuffled. A null or
empty text has no words and no runs; repeated rows, ids and null ids make no
difference, since every row is judged by itself. The input's other columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm.kept_words import covered, joined_words
from driftlog.llm.words import mix, word_slices

#: shortest run, in words
LEAST = 12
#: periods below are looked for lag by lag; a power of two whose quarter is at least LEAST
LAGS = 64

RESULT = "struct<n_words:bigint, runs:array<struct<start:bigint, length:bigint, period:bigint>>, collapsed:string>"

_U = np.uint64
_JOIN = _U(0x9FB21C651E98DF25)
_NEVER = _U(0xFFFFFFFFFFFFFFFF)


class _Tokens:
    """Texts in one array, each behind a token that occurs nowhere else, and hashes of 2**j tokens."""

    def __init__(self, hashes: np.ndarray, word_at: np.ndarray, rows: np.ndarray):
        lengths = np.diff(word_at)[rows]
        self.row = np.repeat(rows, lengths + 1)
        total = len(self.row)
        self.first = np.cumsum(lengths + 1) - lengths          # place of each text's first word
        place = np.arange(total)
        self.word = place - np.repeat(self.first, lengths + 1) + np.repeat(word_at[rows], lengths + 1)
        with np.errstate(over="ignore"):
            token = mix(self.row.astype(_U) * _U(0xD1B54A32D192ED03) + _U(0x2545F4914F6CDD1D))
        inside = np.ones(total, dtype=bool)
        inside[self.first - 1] = False
        token[inside] = hashes[self.word[inside]]
        self.rows = rows
        self.longest = int(lengths.max(initial=0))
        self.levels = [token]

    def level(self, j: int) -> np.ndarray:
        """Hash of the 2**j tokens from each place; those past the end equal nothing."""
        while len(self.levels) <= j:
            half, step = self.levels[-1], 1 << (len(self.levels) - 1)
            out = np.empty_like(half)
            n = max(0, len(half) - step)
            with np.errstate(over="ignore"):
                out[:n] = mix(half[:n] * _JOIN + half[step:])
                out[n:] = mix(np.arange(n, len(half), dtype=_U) * _U(0xE7037ED1A0B428DB) + _U(len(self.levels)))
            self.levels.append(out)
        return self.levels[j]

    def place(self, rows: np.ndarray) -> np.ndarray:
        """Places of the first words of ``rows``."""
        return self.first[np.searchsorted(self.rows, rows)]

    def common(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many tokens agree before and from ``a`` and ``b`` (``a < b``)."""
        top = max(self.longest, 1).bit_length()
        self.level(top)
        total = len(self.row)
        ahead, back = np.zeros(len(a), dtype=np.int64), np.zeros(len(a), dtype=np.int64)
        for j in range(top, -1, -1):
            hashes, step = self.levels[j], 1 << j
            x, y = a + ahead, b + ahead
            inside = y < total
            same = inside & (hashes[np.where(inside, x, 0)] == hashes[np.where(inside, y, 0)])
            ahead += same.astype(np.int64) << j
            x, y = a - back - step, b - back - step
            inside = x >= 0
            same = inside & (hashes[np.where(inside, x, 0)] == hashes[np.where(inside, y, 0)])
            back += same.astype(np.int64) << j
        return back, ahead


def _smallest(runs: np.ndarray) -> np.ndarray:
    """Of the ``(row, start, end, period)`` with one place the smallest period; sorted by row, start, period."""
    runs = runs[np.lexsort((runs[:, 3], runs[:, 2], runs[:, 1], runs[:, 0]))]
    if len(runs):
        runs = runs[np.append(True, (runs[1:, :3] != runs[:-1, :3]).any(axis=1))]
    return runs[np.lexsort((runs[:, 3], runs[:, 1], runs[:, 0]))]


def _lag_runs(tokens: _Tokens, lags: int, least: int) -> list[np.ndarray]:
    """Runs with periods below ``lags``, by comparing at each lag."""
    level = max(0, ((least + 1) // 2).bit_length() - 1)     # no stretch of matches is shorter than this gram
    grams, width = tokens.level(level), 1 << level
    found = []
    for lag in range(1, min(lags, tokens.longest // 2 + 1)):
        hit = np.flatnonzero(grams[:-lag] == grams[lag:])
        if not len(hit):
            continue
        new = np.flatnonzero(np.diff(hit) != 1) + 1
        first, last = hit[np.append(0, new)], hit[np.append(new - 1, len(hit) - 1)]
        matched = last - first + width
        long = matched >= max(lag, least - lag)
        if long.any():
            found.append(_in_rows(tokens, first[long], matched[long] + lag, np.full(long.sum(), lag)))
    return found


def _in_rows(tokens: _Tokens, first: np.ndarray, length: np.ndarray, period: np.ndarray) -> np.ndarray:
    row = tokens.row[first]
    start = first - tokens.place(row)
    return np.column_stack([row, start, start + length, period])


def _windowed(values: np.ndarray, doublings: int, best) -> np.ndarray:
    """``best`` of each ``2**doublings`` neighbouring values."""
    for j in range(doublings):
        step = 1 << j
        if len(values) <= step:
            return values[:0]
        values = best(values[:-step], values[step:])
    return values


def _minimizer_pairs(tokens: _Tokens, scale: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of equal minima at a distance of ``[2**scale, 2**(scale+1))``, and the distances."""
    gram, window = 1 << (scale - 2), 1 << (scale - 1)
    grams = tokens.level(scale - 2).copy()
    periodic = known[(3 * known[:, 3] <= gram) & (known[:, 2] - known[:, 1] >= gram)]
    if len(periodic):
        first = tokens.place(periodic[:, 0])
        edge = np.zeros(len(grams) + 1, dtype=np.int64)
        np.add.at(edge, first + periodic[:, 1], 1)
        np.add.at(edge, first + periodic[:, 2] - gram + 1, -1)
        grams[np.cumsum(edge[:-1]) > 0] = _NEVER
    least = _windowed(grams, scale - 1, np.minimum)
    if not len(least):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    edge = np.zeros(window - 1, dtype=_U)
    most = _windowed(np.concatenate([edge, least, edge]), scale - 1, np.maximum)
    place = np.flatnonzero((grams == most) & (grams != _NEVER))
    place = place[np.argsort(grams[place], kind="stable")]
    value, row = grams[place], tokens.row[place]
    starts, lags = [], []
    for j in range(1, len(place)):
        lag = place[j:] - place[:-j]
        near = (value[j:] == value[:-j]) & (lag < 2 << scale)
        if not near.any():
            break
        near &= (lag >= 1 << scale) & (row[j:] == row[:-j])
        starts.append(place[:-j][near])
        lags.append(lag[near])
    return (np.concatenate(starts), np.concatenate(lags)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _neighbour_pairs(tokens: _Tokens, scale: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lags of equal phase between a run of a far shorter period and the next run of that period."""
    low, gram = 1 << scale, 1 << (scale - 2)
    long = known[(3 * known[:, 3] <= gram) & (known[:, 2] - known[:, 1] >= low)]
    long = long[np.isin(long[:, 0], tokens.rows)]
    long = long[np.lexsort((long[:, 1], long[:, 3], long[:, 0]))]
    starts, lags = [], []
    if len(long) > 1:
        a, b = long[:-1], long[1:]
        follows = (a[:, 0] == b[:, 0]) & (a[:, 3] == b[:, 3]) & (b[:, 1] <= a[:, 2]) & (b[:, 1] > a[:, 2] - a[:, 3])
        words = tokens.levels[0]
        for i in np.flatnonzero(follows):
            row, start, end, period = map(int, a[i])
            other, stop = int(b[i, 1]), int(b[i, 2])
            at = int(tokens.place(np.array([row]))[0])
            root = words[at + start:at + start + period]
            second = np.lib.stride_tricks.sliding_window_view(words[at + other:at + other + 2 * period - 1], period)
            phases = np.flatnonzero(second[:, 0] == root[0])
            phases = phases[(second[phases] == root).all(axis=1)]
            if not len(phases):
                continue
            least = other + int(phases[0]) - start
            least += -(-(low - least) // period) * period         # the first lag of the phase in the scale
            lag = np.arange(least, min(2 * low - 1, end - start, stop - other) + 1, period)
            starts.append(at + np.maximum(start, other - lag))
            lags.append(lag)
    return (np.concatenate(starts), np.concatenate(lags)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _extended(hashes: np.ndarray, word_at: np.ndarray, tokens: _Tokens, place: np.ndarray, lag: np.ndarray,
              least: int) -> np.ndarray:
    """The runs around seeds; hashes of many words are made only for the texts that have a seed."""
    row = tokens.row[place]
    some = _Tokens(hashes, word_at, np.unique(row))
    place = place - tokens.place(row) + some.place(row)
    back, ahead = some.common(place, place + lag)
    good = (back + ahead >= lag) & (back + ahead + lag >= least)
    return _in_rows(some, (place - back)[good], (back + ahead + lag)[good], lag[good])


def find_runs(hashes: np.ndarray, word_at: np.ndarray, lags: int = LAGS, least: int = LEAST) -> np.ndarray:
    """All runs as ``(row, start, end, period)``, by row, start and period; words of row i: ``word_at[i:i+2]``."""
    lengths = np.diff(word_at)
    rows = np.flatnonzero(lengths >= least)
    if not len(rows):
        return np.zeros((0, 4), dtype=np.int64)
    tokens = _Tokens(hashes, word_at, rows)
    known = _smallest(np.concatenate([np.zeros((0, 4), np.int64), *_lag_runs(tokens, lags, least)]))
    scale = lags.bit_length() - 1
    while len(rows := np.flatnonzero(lengths >= 2 << scale)):
        if len(rows) < len(tokens.rows):
            tokens = _Tokens(hashes, word_at, rows)
        here = known[np.isin(known[:, 0], rows)]
        seeds = [_minimizer_pairs(tokens, scale, here), _neighbour_pairs(tokens, scale, here)]
        place, lag = (np.concatenate(x) for x in zip(*seeds))
        if len(place):
            known = _smallest(np.concatenate([known, _extended(hashes, word_at, tokens, place, lag, least)]))
        scale += 1
    return known


def _judged(column: pa.Array, lags: int, least: int) -> pa.Array:
    n_words, offsets, runs_of, texts = [], [np.zeros(1, np.int64)], [], []
    for piece in word_slices(column, lower=False):
        runs = find_runs(piece.hashes, piece.word_at, lags, least)
        n_words.append(np.diff(piece.word_at))
        offsets.append(np.searchsorted(runs[:, 0], np.arange(1, piece.rows + 1)) + offsets[-1][-1])
        runs_of.append(runs)
        again = covered(piece, runs[:, 0], runs[:, 1] + runs[:, 3], runs[:, 2])
        texts.append(joined_words(piece, ~again))
    runs = np.concatenate([np.zeros((0, 4), np.int64), *runs_of])
    entries = pa.StructArray.from_arrays([pa.array(runs[:, 1]), pa.array(runs[:, 2] - runs[:, 1]), pa.array(runs[:, 3])],
                                         ["start", "length", "period"])
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), entries)
    words = pa.array(np.concatenate([np.zeros(0, np.int64), *n_words]))
    return pa.StructArray.from_arrays([words, lists, pa.concat_arrays(texts) if texts else pa.array([], pa.string())],
                                      ["n_words", "runs", "collapsed"])


def run_finder(lags: int = LAGS, least: int = LEAST):
    """Arrow function text -> ``RESULT``: the number of words, the runs by start and period, the collapsed text."""
    if lags & (lags - 1) or lags < 4 * least:
        raise ValueError("lags must be a power of two, and a quarter of it at least the shortest run")

    @F.arrow_udf(RESULT)
    def judged(text: pa.Array) -> pa.Array:
        return _judged(text, lags, least)

    return judged


def periodic_runs(docs: DataFrame, id_column: str = "doc_id", text: str | Column = "text", **limits) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``runs`` (word number, length and period of every run,
    by start and period) and ``collapsed``, the words joined by one space without those that a run
    contains after its first period."""
    text = F.col(text) if isinstance(text, str) else text
    return docs.select(F.col(id_column), run_finder(**limits)(text).alias("found")).select(id_column, "found.*")
