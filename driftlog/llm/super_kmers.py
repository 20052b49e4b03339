"""Repeated windows of words, found by super-k-mer partitioning.

A window is ``size`` consecutive words of one document. A word goes if a
window covers it whose word sequence also starts earlier: in a document of a
smaller id, or earlier in the same one. Windows are judged on the input.

* A window's minimizer is the least hash of its ``GRAM``-word grams, so equal
  windows have the same. Consecutive windows that share one are a
  super-k-mer: it travels as one string, the stretch of text that holds all
  its windows, to the minimizer's bucket.
* Only minimizers found at two places can have equal windows. A first pass
  counts them (combined in the tasks, one row a bucket shuffled); those met twice
  go into a bitmap, and strings of other buckets stay at home. The bitmap has
  about ``GATE_BITS`` bits a key, at most ``2**MOST_BITS`` (32 MB). With more
  keys than it can tell apart, some strings travel in vain, at the very most
  all of them, some four times the text; the results are the same.
* In a bucket the windows are sorted by hash, document and place; all but the
  first of equal ones are repeats. Hashes have 64 bits besides the bucket's 64.
* A bucket met more than ``HOT`` times (a passage that very many documents
  share) would be a hot group. Its windows do not travel as strings to one
  place but under their own hashes, and only their first places are sought: a
  grouped minimum, combined in the tasks, which hand on each kind of window once
  for every ``HELD`` windows. Every such window but the first is a
  repeat, so its document needs no answer for it: it finds its windows of hot
  buckets again and is told which of them are first.
* Spans and first places come back to their documents by one join.

Defined results: null and empty texts and those with fewer words than a
window lose nothing. Null ids come after all others. Rows that share an id
(or have none) but not the text are documents of their own, in the order of
their texts' hashes; rows with equal id and text lose the same words. Other
columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.kept_words import covered, joined_words
from driftlog.llm.scratch import written
from driftlog.llm.words import Slice, mix, ngram_places, signed, word_slices

#: words of a window
SIZE = 20
#: words of the grams whose least hash names the bucket
GRAM = 8
#: most windows of a super-k-mer
PIECE = 64
#: a bucket met more often deals its windows by their own hashes
HOT = 4096
#: windows of hot buckets that a task combines before it hands them on
HELD = 1 << 16
#: bits of the bitmap for each key it holds, and the logarithm of the most it has
GATE_BITS, MOST_BITS = 32, 28

RESULT = "struct<n_words:bigint, n_removed:bigint, kept:string>"
#: rows of a bucket's partition that are looked at together, at least
ROWS = 20_000

_U = np.uint64
_LAST = (1 << 63) - 1


class _Gate:
    """Bitmap over the first bits of 64-bit keys; it travels compressed."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits
        self.shift = _U(64 - (len(bits) * 64).bit_length() + 1)

    def __reduce__(self):
        return _gate_of, (zlib.compress(self.bits.tobytes(), 1),)

    def passes(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> self.shift
        return (self.bits[(at >> _U(6)).astype(np.int64)] >> (at & _U(63))) & _U(1) != 0


def _gate_of(data: bytes) -> _Gate:
    return _Gate(np.frombuffer(zlib.decompress(data), dtype=np.uint64))


def _gate(keys: DataFrame, column: str, n: int) -> Broadcast:
    """Broadcast bitmap of ``n`` keys; at most ``2**MOST_BITS / 64`` words of it reach the driver."""
    bits = min(max((n * GATE_BITS).bit_length(), 16), MOST_BITS)
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    words = (keys.select(F.shiftright(place, 6).cast("int").alias("at"), (place % 64).cast("int").alias("bit"))
             .groupBy("at").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")).toArrow())
    out = np.zeros(1 << (bits - 6), dtype=np.uint64)
    if words.num_rows:
        out[words.column("at").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(_Gate(out))


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` words from each place (``len - size + 1``), from hashes of 1, 2, 4, ... words."""
    out, width, part, taken = None, 1, hashes, 0
    n = max(0, len(hashes) - size + 1)
    with np.errstate(over="ignore"):
        while width <= size:
            if size & width:
                here = part[taken:taken + n]
                out = here if out is None else mix(out * _U(0xA0761D6478BD642F) + here)
                taken += width
            if 2 * width <= size:
                part = mix(part[:-width] * _U(0x9FB21C651E98DF25) + part[width:]) if len(part) > width else part[:0]
            width *= 2
    return out if len(out) == n else np.zeros(0, dtype=_U)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbouring values."""
    done = 1
    while done < width and len(values):
        step = min(done, width - done)
        values = np.minimum(values[:-step], values[step:]) if len(values) > step else values[:0]
        done += step
    return values


def super_kmers(piece: Slice, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket, first word (in the slice) and number of windows of each super-k-mer."""
    buckets = _least(window_hashes(piece.hashes, GRAM), size - GRAM + 1)
    at = np.flatnonzero(ngram_places(piece.word_at, size))
    bucket = buckets[at]
    if not len(at):
        return bucket, at, at
    new = np.append(True, (bucket[1:] != bucket[:-1]) | (np.diff(at) != 1))
    first = np.flatnonzero(new)
    within = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
    first = np.flatnonzero(within % PIECE == 0)
    return bucket[first], at[first], np.diff(np.append(first, len(at)))


def minimizers(piece: Slice, size: int) -> np.ndarray:
    """The hash at each place of a gram that is the minimizer of a window."""
    grams = window_hashes(piece.hashes, GRAM)
    least = _least(grams, size - GRAM + 1)
    inside = ngram_places(piece.word_at, size)
    edge = np.zeros(size - GRAM, dtype=_U)
    most = ~_least(~np.concatenate([edge, np.where(inside, least, _U(0)), edge]), size - GRAM + 1)
    return grams[(grams == most)] if len(inside) else grams[:0]


def _counts(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in word_slices(batch.column(0), lower=False):
                bucket, times = np.unique(minimizers(piece, size), return_counts=True)
                yield pa.record_batch([signed(bucket), pa.array(times.astype(np.int64))], ["bucket", "n"])

    return run


def _spread(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``first, first + 1, ...`` of each, ``n`` of them."""
    return np.repeat(first - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())


def _strings(size: int, shared: Broadcast, hot: Broadcast):
    """Super-k-mers of the buckets met twice, but not too often."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for piece in word_slices(batch.column(2), lower=False):
                bucket, first, n = super_kmers(piece, size)
                go = shared.value.passes(bucket) & ~hot.value.passes(bucket)
                bucket, first, n = bucket[go], first[go], n[go]
                raw = piece.data.tobytes()
                start, end = piece.starts[first], piece.ends[first + n + size - 2]
                text = pa.array([raw[a:b] for a, b in zip(start.tolist(), end.tolist())], pa.binary()).cast(pa.string())
                row = np.searchsorted(piece.word_at, first, side="right") - 1
                yield pa.record_batch([signed(bucket), text, pa.array(doc[piece.row + row]), pa.array(part[piece.row + row]),
                                       pa.array(first - piece.word_at[row])], ["bucket", "words", "doc", "part", "start"])

    return run


def _hot_places(piece: Slice, size: int, hot: Broadcast) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and place of the windows of buckets met too often."""
    bucket, first, n = super_kmers(piece, size)
    go = hot.value.passes(bucket)
    return np.repeat(bucket[go], n[go]), _spread(first[go], n[go])


def _firsts(found: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """The first place of each kind of window among columns of bucket, hash, doc, part and start."""
    bucket, value, doc, part, start = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((start, part, doc, value, bucket))
    of, val = bucket[order], value[order]
    order = order[np.append(True, (of[1:] != of[:-1]) | (val[1:] != val[:-1]))]
    return tuple(x[order] for x in (bucket, value, doc, part, start))


def _hot_windows(size: int, hot: Broadcast):
    """The windows of the buckets met too often, each kind once for every ``HELD`` of them that a task finds."""

    def handed_on(first: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.record_batch([signed(first[0]), signed(first[1]), *map(pa.array, first[2:])],
                               ["bucket", "hash", "doc", "part", "start"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple[np.ndarray, ...]] = []
        held = 0
        for batch in batches:
            doc, part = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for piece in word_slices(batch.column(2), lower=False):
                bucket, at = _hot_places(piece, size, hot)
                if not len(at):
                    continue
                row = np.searchsorted(piece.word_at, at, side="right") - 1
                found.append((bucket, window_hashes(piece.hashes, size)[at], doc[piece.row + row], part[piece.row + row],
                              at - piece.word_at[row]))
                held += len(at)
                if held > HELD:
                    first = _firsts(found)
                    found, held = [first], len(first[0])
                    if 2 * held > HELD:         # most of them differ: combining more would not pay
                        yield handed_on(first)
                        found, held = [], 0
        if held:
            yield handed_on(_firsts(found))

    return run


def _repeats(table: pa.Table, size: int) -> pa.RecordBatch:
    """Spans of words of the windows of whole buckets that are not the first of their kind."""
    bucket, doc, part, start = (table.column(x).to_numpy() for x in ("bucket", "doc", "part", "start"))
    rows, offsets, hashes = [], [], []
    for piece in word_slices(table.column("words"), lower=False, most=1 << 22):
        at = np.flatnonzero(ngram_places(piece.word_at, size))
        row = np.searchsorted(piece.word_at, at, side="right") - 1
        rows.append(piece.row + row)
        offsets.append(at - piece.word_at[row])
        hashes.append(window_hashes(piece.hashes, size)[at])
    row, offset, value = (np.concatenate(x) for x in (rows, offsets, hashes))
    place = start[row] + offset
    order = np.lexsort((place, part[row], doc[row], value, bucket[row]))
    of, val, d, t, p = bucket[row][order], value[order], doc[row][order], part[row][order], place[order]
    first = np.flatnonzero(np.append(True, (of[1:] != of[:-1]) | (val[1:] != val[:-1])))
    kind = np.repeat(first, np.diff(np.append(first, len(order))))
    again = np.zeros(len(order), dtype=bool)
    again[order] = (d != d[kind]) | (t != t[kind]) | (p != p[kind])
    row, place = row[again], place[again]
    new = np.append(True, (row[1:] != row[:-1]) | (np.diff(place) != 1)) if len(row) else np.zeros(0, dtype=bool)
    head = np.flatnonzero(new)
    last = np.append(head[1:], len(row)) - 1
    return pa.record_batch([pa.array(doc[row[head]]), pa.array(part[row[head]]), pa.array(place[head]),
                            pa.array(place[last] + size)], ["doc", "part", "start", "end"])


def _sorted_buckets(size: int):
    """``_repeats`` of a partition sorted by bucket, some whole buckets at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < ROWS:
                continue
            table = pa.Table.from_batches(held)
            bucket = table.column("bucket").to_numpy()
            whole = int(np.searchsorted(bucket, bucket[-1]))      # the last bucket may go on
            if whole:
                yield _repeats(table.slice(0, whole), size)
                held = table.slice(whole).combine_chunks().to_batches()
        if any(b.num_rows for b in held):
            yield _repeats(pa.Table.from_batches(held), size)

    return run


def _without(size: int, hot: Broadcast | None):
    """Arrow function (text, list of spans) -> ``RESULT``; a span that ends at 0 is the place of a window of a hot
    bucket that is the first of its kind."""

    @F.arrow_udf(RESULT)
    def without(text: pa.Array, spans: pa.Array) -> pa.Array:
        if isinstance(spans, pa.ChunkedArray):
            spans = spans.combine_chunks()
        at = np.append(0, np.cumsum(np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)))
        flat = spans.flatten()
        start, end = (flat.field(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
        words, removed, kept = [], [], []
        for piece in word_slices(text, lower=False):
            a, b = at[piece.row], at[piece.row + piece.rows]
            row = np.repeat(np.arange(piece.rows), np.diff(at[piece.row:piece.row + piece.rows + 1]))
            span, first, last = end[a:b] > 0, start[a:b], end[a:b]
            gone = covered(piece, row[span], first[span], last[span])
            if hot is not None:
                at_hot = _hot_places(piece, size, hot)[1]
                again = at_hot[~np.isin(at_hot, piece.word_at[row[~span]] + first[~span])]
                of = np.searchsorted(piece.word_at, again, side="right") - 1
                again -= piece.word_at[of]
                gone |= covered(piece, of, again, again + size)
            total = np.append(0, np.cumsum(gone))
            words.append(np.diff(piece.word_at))
            removed.append(np.diff(total[piece.word_at]))
            kept.append(joined_words(piece, ~gone))
        none = np.zeros(0, dtype=np.int64)
        return pa.StructArray.from_arrays(
            [pa.array(np.concatenate([none, *words])), pa.array(np.concatenate([none, *removed]).astype(np.int64)),
             pa.concat_arrays(kept) if kept else pa.array([], pa.string())], ["n_words", "n_removed", "kept"])

    return without


def repeat_spans(named: DataFrame, size: int = SIZE, hot: int = HOT) -> tuple[DataFrame, Broadcast | None]:
    """Of rows (doc, part, text): ``doc, part, start, end``, spans of words that windows repeat and, ending at 0, the
    first places of the windows of hot buckets; and the bitmap of those buckets, if there are any."""
    counts = named.select("text").mapInArrow(_counts(size), "bucket bigint, n bigint") \
        .groupBy("bucket").agg(F.sum("n").alias("n")).where("n > 1")
    keys = written(counts, "super-kmer-buckets")
    n, n_hot = keys.agg(F.count("*"), F.count_if(F.col("n") > hot)).first()
    shared, often = _gate(keys, "bucket", n), _gate(keys.where(F.col("n") > hot), "bucket", n_hot)
    strings = named.mapInArrow(_strings(size, shared, often),
                               "bucket bigint, words string, doc bigint, part bigint, start bigint")
    spans = strings.repartition("bucket").sortWithinPartitions("bucket") \
        .mapInArrow(_sorted_buckets(size), "doc bigint, part bigint, start bigint, end bigint")
    if not n_hot:
        return spans, None
    windows = named.mapInArrow(_hot_windows(size, often), "bucket bigint, hash bigint, doc bigint, part bigint, start bigint")
    firsts = windows.groupBy("bucket", "hash").agg(F.min(F.struct("doc", "part", "start")).alias("first"))
    return spans.unionAll(firsts.select("first.*", F.lit(0).cast("bigint").alias("end"))), often


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = SIZE,
                    hot: int = HOT) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_removed`` and ``kept``, the words left joined by one space."""
    if size < GRAM:
        raise ValueError(f"a window has at least {GRAM} words")
    named = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(id_column), F.lit(_LAST)).cast("bigint").alias("doc"),
                        F.xxhash64(text).alias("part"), F.col(text).alias("text"))
    spans, often = repeat_spans(named.select("doc", "part", "text"), size, hot)
    listed = spans.groupBy("doc", "part").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    back = named.join(listed, ["doc", "part"], "left")
    spans = F.coalesce("spans", F.array().cast("array<struct<start:bigint,end:bigint>>"))
    return back.select(F.col("id").alias(id_column), _without(size, often)("text", spans).alias("left")) \
        .select(id_column, "left.*")
