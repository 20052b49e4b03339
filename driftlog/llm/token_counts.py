"""Token counts: lengths of each text under a public tokenizer.

An Arrow function encodes and returns lengths only. A batch's texts are cut
at safe boundaries, where the byte-level pre-tokenizer always starts a new
piece: before a space between two ASCII characters that are not white
space, and between an ASCII letter and one of ``.,!?;:*#$%&)`` (none of them
part of a special string). So the sum over the parts equals the count of the
whole text. The distinct parts of a batch are encoded once, in groups
balanced by bytes; a worker remembers the lengths of ``CACHE_PARTS`` parts
by their 64-bit hash. A text without a safe boundary is one part. With a
tokenizer for which these boundaries are not safe (``cuts=False``) every
text is one part.

Null and empty texts count 0 tokens. Repeated rows are counted each. The
input's other columns are never read.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm.words import row_slices, span_hashes, text_buffers

GROUP_BYTES = 1 << 18   # bytes handed to the library at once
CACHE_PARTS = 1 << 20   # lengths a worker remembers (16 MB)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E), *range(0x1C, 0x20)]] = True
_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_POINT = np.zeros(256, dtype=bool)
_POINT[list(b".,!?;:*#$%&)")] = True
_loaded: dict[str, object] = {}
_known: dict[str, tuple[np.ndarray, np.ndarray]] = {}   # by tokenizer: sorted hashes, lengths


def _lengths(path: str):
    """Function from a list of texts to their token counts."""
    if path not in _loaded:
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            _loaded[path] = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            tok = Tokenizer.from_file(path)
            tok.no_truncation()
            tok.no_padding()
            _loaded[path] = lambda texts: [len(x) for x in tok.encode_batch_fast(texts, add_special_tokens=False)]
    return _loaded[path]


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Whether a part may start at each byte (see the module's text)."""
    plain = ~_SPACE[data] & (data < 0x80)
    cut = np.zeros(len(data), dtype=bool)
    cut[1:-1] = (data[1:-1] == 0x20) & plain[:-2] & plain[2:]
    cut[1:] |= _LETTER[data[:-1]] & _POINT[data[1:]]
    return cut


def _count(path: str, data: np.ndarray, at: np.ndarray, cuts: bool) -> np.ndarray:
    """Token counts of the texts ``data[at[i]:at[i + 1]]``."""
    if not len(data):
        return np.zeros(len(at) - 1, dtype=np.int64)
    cut = safe_cuts(data) if cuts else np.zeros(len(data), dtype=bool)
    cut[at[at < len(data)]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], len(data))
    keys, first, inverse = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
    known, lengths = _known.get(path, (np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    place = np.minimum(np.searchsorted(known, keys), max(0, len(known) - 1))
    hit = known[place] == keys if len(known) else np.zeros(len(keys), dtype=bool)
    n = np.zeros(len(keys), dtype=np.int64)
    n[hit] = lengths[place[hit]]
    todo = np.flatnonzero(~hit)
    if len(todo):
        raw = data.tobytes()
        spans = zip(starts[first[todo]], ends[first[todo]], strict=True)
        n[todo] = _encoded(_lengths(path), [raw[a:b].decode() for a, b in spans])
        room = CACHE_PARTS - len(known)
        if room > 0:
            new = todo[:room]
            order = np.argsort(merged := np.concatenate([known, keys[new]]), kind="stable")
            _known[path] = merged[order], np.concatenate([lengths, n[new]])[order]
    total = np.zeros(len(starts) + 1, dtype=np.int64)
    np.cumsum(n[inverse], out=total[1:])
    return np.diff(total[np.searchsorted(starts, at)])


def _encoded(lengths, texts: list[str]) -> list[int]:
    """Token counts, encoded in groups of about GROUP_BYTES."""
    out: list[int] = []
    first, size = 0, 0
    for i, x in enumerate(texts):
        size += len(x)
        if size >= GROUP_BYTES:
            out += lengths(texts[first:i + 1])
            first, size = i + 1, 0
    return out + (lengths(texts[first:]) if first < len(texts) else [])


def token_counter(path: str, cuts: bool = True):
    """Arrow function text -> bigint token count under the tokenizer file."""
    @F.arrow_udf("bigint")
    def n_tokens(texts: pa.Array) -> pa.Array:
        data, offsets = text_buffers(texts)
        out = [np.zeros(0, dtype=np.int64)]
        for row, stop in row_slices(offsets):
            out.append(_count(path, data[offsets[row]:offsets[stop]], offsets[row:stop + 1] - offsets[row], cuts))
        return pa.array(np.concatenate(out))

    return n_tokens


def token_counts(docs: DataFrame, path: str, id_column: str = "doc_id", text: str | Column = "text",
                 limit: int = 1024, cuts: bool = True) -> DataFrame:
    """``id, n_bytes, n_tokens, over_limit`` of every row."""
    text = F.col(text) if isinstance(text, str) else text
    counted = docs.select(F.col(id_column), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"),
                          token_counter(path, cuts)(text).alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
