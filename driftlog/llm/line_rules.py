"""Line-first cleaning: rules per line, then a verdict on what is left.

Lines are what stands between ``\\n``; only lines holding a word count. A line
fails, and is removed, when

* punctuation: neither its end nor any of its words ends a sentence, or
  symbols (``#*$%&|<>``) come to more than ``symbols_per_word`` of its words,
  or more than half of its words end in a doubled ``!`` or ``?``;
* navigation: it holds two or more ``|`` or ``>`` separators standing alone,
  or has at most ``MENU_WORDS`` words, all of them menu words;
* boilerplate: it holds a fixed boilerplate phrase, or repeats an earlier
  line of the text of at least three words.

A document is rejected when the base rules fail it (fewer than ``min_words``
words, or more than half of its words inside three-word windows found twice
or more in the text) or when removed lines hold more than ``most_removed`` of
its words.

Null and empty texts have no words, so the base rules reject them. Repeated
rows are judged each. All counts are over the whole text, however long.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm.words import Slice, line_spans, ngram_places, ngrams, span_hashes, word_slices

# Fixed values of the rules.
SYMBOLS = b"#*$%&|<>"
SENTENCE_ENDS = ".!?:;\"')]}…。！？”’»"
MENU_WORDS = 6
MENU = ("home", "about", "contact", "login", "log in", "sign in", "sign up", "register", "menu", "search",
        "next", "previous", "back to top", "sitemap", "help", "faq", "share", "read more")
BOILERPLATE = ("lorem ipsum", "javascript", "cookie policy", "use of cookies", "privacy policy", "terms of use",
               "terms of service", "all rights reserved", "subscribe to our newsletter", "click here")

RESULT = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
          "n_lines bigint, n_removed_lines bigint, removed_words bigint, base_failed boolean, kept boolean")

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_ENDS = np.array([int.from_bytes(x.encode().rjust(3, b"\0")) for x in SENTENCE_ENDS])
_STOPS = np.array(list(b".!?"))
_BOILER = re.compile(b"|".join(re.escape(x.encode()) for x in BOILERPLATE), re.I)
_MENU_LINE = re.compile(rb"[ \t]*(?:(?:" + b"|".join(re.escape(x.encode()) for x in MENU)
                        + rb")[ \t\x0b-\r.,:;\xc2\xb7]*)+(?:\n|\Z)", re.I)


def _per(row_at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive boundaries."""
    total = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=total[1:])
    return np.diff(total[row_at])


def repeated_words(piece: Slice) -> np.ndarray:
    """Which words stand in a three-word window found twice or more in their text."""
    windows = ngrams(piece.hashes, 3)
    flagged = np.zeros(len(piece.hashes), dtype=bool)
    places = np.flatnonzero(ngram_places(piece.word_at, 3))
    if not len(places):
        return flagged
    row = piece.word_row()[places]
    key = windows[places]
    order = np.lexsort((key, row))
    same = (key[order][1:] == key[order][:-1]) & (row[order][1:] == row[order][:-1])
    twice = np.zeros(len(order), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    at = places[order[twice]]
    for k in range(3):
        flagged[at + k] = True
    return flagged


def _earlier_equal(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which entries equal an earlier one of the same row."""
    order = np.lexsort((np.arange(len(keys)), keys, rows))
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] = (keys[order][1:] == keys[order][:-1]) & (rows[order][1:] == rows[order][:-1])
    return out


def _lines(piece: Slice, symbols_per_word: float):
    """Per line with a word: start, end, row, words, repeat of an earlier line, failed."""
    data = piece.data
    start, end, row = line_spans(piece)
    first = np.searchsorted(piece.starts, start)
    words = np.searchsorted(piece.starts, end) - first
    some = words > 0
    start, end, row, first, words = start[some], end[some], row[some], first[some], words[some]
    again = _earlier_equal(row, span_hashes(data, start, end))
    if not len(start):
        return start, end, row, words, again, again.copy()
    last = piece.ends[first + words - 1]
    tail = np.zeros(len(last), dtype=np.int64)
    for back in (3, 2, 1):   # the last character as its bytes, up to three
        at = np.maximum(last - back, 0)
        tail = (tail << 8) | np.where(last - back >= start, data[at], 0).astype(np.int64)
    ascii_end = (tail & 0xFF) < 0x80
    two = ((tail >> 8) & 0xFF >= 0xC0) & ~ascii_end
    tail = np.where(ascii_end, tail & 0xFF, np.where(two, tail & 0xFFFF, tail))
    stop = np.flatnonzero(np.isin(data[np.maximum(piece.ends - 1, 0)], _STOPS))
    ends_well = np.isin(tail, _ENDS) | (np.searchsorted(stop, first + words) > np.searchsorted(stop, first))

    def in_line(flag_at: np.ndarray) -> np.ndarray:
        return np.searchsorted(flag_at, end) - np.searchsorted(flag_at, start)

    symbols = in_line(np.flatnonzero(_SYMBOL[data]))
    close = data[np.maximum(piece.ends - 1, 0)]
    before = data[np.maximum(piece.ends - 2, 0)]
    shout = (piece.ends - piece.starts > 2) & (close == before) & ((close == 33) | (close == 63))
    shouted = np.searchsorted(wide := np.flatnonzero(shout), first + words) - np.searchsorted(wide, first)
    alone = (piece.ends - piece.starts == 1) & ((data[piece.starts] == 124) | (data[piece.starts] == 62))
    separators = np.searchsorted(alone_at := np.flatnonzero(alone), first + words) - np.searchsorted(alone_at, first)
    raw = data.tobytes()
    boiler = in_line(np.array([m.start() for m in _BOILER.finditer(raw)], dtype=np.int64)) > 0
    menu = np.zeros(len(start), dtype=bool)
    for i in np.flatnonzero(words <= MENU_WORDS):
        menu[i] = _MENU_LINE.fullmatch(raw[start[i]:end[i]]) is not None
    failed = (~ends_well | (symbols > symbols_per_word * words) | (2 * shouted > words)
              | (separators >= 2) | menu | boiler | (again & (words >= 3)))
    return start, end, row, words, again, failed


def _judge(column: pa.Array, min_words: int, symbols_per_word: float, most_removed: float, with_text: bool):
    columns: list[list[np.ndarray]] = [[] for _ in range(10)]
    texts: list[str | None] = []
    for piece in word_slices(column, lower=False):
        n_words = np.diff(piece.word_at)
        inside = np.zeros(len(piece.data) + 1, dtype=np.int64)
        inside[piece.starts] += 1
        inside[piece.ends] -= 1
        char = (np.cumsum(inside[:-1]) > 0) & ((piece.data & 0xC0) != 0x80)
        repeat = _per(piece.word_at, repeated_words(piece))
        start, end, row, words, again, failed = _lines(piece, symbols_per_word)

        def by_row(values: np.ndarray, row=row, rows=piece.rows) -> np.ndarray:
            return np.bincount(row, weights=values, minlength=rows).astype(np.int64)[:rows]

        removed = by_row(words * failed)
        base_failed = (n_words < min_words) | (100 * repeat > 50 * n_words)
        kept = ~base_failed & (removed <= most_removed * n_words)
        for out, x in zip(columns, (n_words, _per(piece.text_at, char), _per(piece.text_at, _SYMBOL[piece.data]),
                                    by_row(again), repeat, by_row(np.ones(len(row))), by_row(failed), removed,
                                    base_failed, kept), strict=True):
            out.append(x)
        if with_text:
            bad_at = np.searchsorted(row[failed], np.arange(piece.rows + 1))
            bad = np.flatnonzero(failed)
            for i in range(piece.rows):
                a, b = piece.text_at[i], piece.text_at[i + 1]
                parts, at = [], a
                for j in bad[bad_at[i]:bad_at[i + 1]]:
                    parts.append(piece.data[at:start[j]].tobytes())
                    at = min(end[j] + 1, b)   # the line and its break
                parts.append(piece.data[at:b].tobytes())
                text = b"".join(parts)
                if bad_at[i] < bad_at[i + 1] and end[bad[bad_at[i + 1] - 1]] == b:
                    text = text.removesuffix(b"\n")      # the last line went: so does the break before it
                texts.append(text.decode())
    arrays = [pa.array(np.concatenate(c)) if c else pa.array([], pa.int64() if i < 8 else pa.bool_())
              for i, c in enumerate(columns)]
    return arrays, texts


def line_verdict(min_words: int = 50, symbols_per_word: float = 0.1, most_removed: float = 0.5,
                 with_text: bool = False):
    """Arrow function text -> struct ``RESULT`` (with ``clean_text`` if asked for)."""
    names = [x.split()[0] for x in RESULT.split(", ")]

    @F.arrow_udf(f"struct<{', '.join(x.replace(' ', ':') for x in RESULT.split(', '))}"
                 + (", clean_text:string>" if with_text else ">"))
    def verdict(text: pa.Array) -> pa.Array:
        arrays, texts = _judge(text, min_words, symbols_per_word, most_removed, with_text)
        if with_text:
            arrays.append(pa.array(texts, pa.string()))
        return pa.StructArray.from_arrays(arrays, names + ["clean_text"] * with_text)

    return verdict


def judge_lines(docs: DataFrame, id_column: str = "doc_id", text: str | Column = "text", with_text: bool = False,
                **limits) -> DataFrame:
    """The id, ``RESULT``'s columns and, if asked for, ``clean_text`` (the text without its failed lines)."""
    text = F.col(text) if isinstance(text, str) else text
    return docs.select(F.col(id_column), line_verdict(with_text=with_text, **limits)(text).alias("verdict")) \
        .select(id_column, "verdict.*")
