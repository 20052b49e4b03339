"""Benchmark decontamination: word and word-pair seeds, then local alignment.

The score of a text and a test item is their best Smith-Waterman alignment
(match 1, mismatch and gap ``PENALTY``) divided by the item's ``L`` words: 1
for an exact copy, lower for edited or paraphrased ones. Pairs of
``threshold`` or more are returned, all of them:

* An alignment with ``m`` matches, ``b`` of them right after another match in
  both texts, has ``m - b`` runs with a penalty between any two, so it scores
  ``m - (m - b - 1) / 2`` at most. Where that is ``threshold * L`` or more, at
  least ``2 * threshold * L - 1`` of the item's ``L`` words and ``L - 1`` pairs
  of neighbours stand in the text, within ``(3 - 2 * threshold) * L`` words.
* The most frequent words and pairs of each item (text frequencies over the
  whole corpus) are left out, ``1 - 1 / HITS`` of that number; the others are its
  seeds, of which every such alignment still holds a number (``least``).
* Where a text holds that many within that stretch, the words around them are
  aligned with the whole item.

An item of fewer than ``SHORT`` words has to occur whole: it is one seed.

Test items are the query set: they are handed to every task in blocks of at
most ``BLOCK_WORDS`` words (a bounded broadcast), and with more items the
texts are read once a block. No pair of texts is ever formed.

Null and empty texts or items match nothing. Equal items each give their own
pair. Repeated rows of a text repeat their pairs; repeated rows of an item
count once. Words are compared lower-cased and without the ASCII
punctuation around them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.words import ngram_places, ngrams, word_slices

SHORT = 3
HITS = 4          # share of the words and pairs of an alignment that must be seeds, 1 / HITS
PENALTY = 0.5     # the bounds above hold for one half
THRESHOLD = 0.5
BLOCK_WORDS = 2_000_000
ALIGN_CELLS = 1 << 20   # cells of the alignment rows worked on at once
POINTS = rb"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""   # fixed: ASCII punctuation


@dataclass
class Items:
    """Words and seeds of some test items."""

    ids: np.ndarray        # item id
    words: np.ndarray      # uint64 hashes, item after item
    at: np.ndarray         # item boundaries in words
    keys: np.ndarray       # seed hashes, sorted
    item: np.ndarray       # by seed: item index
    times: np.ndarray      # by seed: places in the item
    size: np.ndarray       # by seed: words of the n-gram
    least: np.ndarray      # by item: seeds that an alignment holds
    span: np.ndarray       # by item: words of a text that an alignment takes at most


def _items(ids: list, texts: list, threshold: float = THRESHOLD) -> Items:
    """All words and pairs of the items, as seeds."""
    pieces = list(word_slices(pc.utf8_lower(pa.array(texts, pa.string())), points=POINTS))
    words = np.concatenate([p.hashes for p in pieces]) if pieces else np.zeros(0, np.uint64)
    at = np.append(0, np.cumsum(np.concatenate([np.diff(p.word_at) for p in pieces]) if pieces else np.zeros(0, np.int64)))
    length = np.diff(at)
    least = np.maximum(1, np.ceil(2 * threshold * length - 1 - 1e-9)).astype(np.int64)
    least[length < SHORT] = 1
    span = np.maximum(length, np.ceil((3 - 2 * threshold) * length - 1e-9)).astype(np.int64)
    keys, item, times, size = [], [], [], []
    for i in range(len(ids)):
        w = words[at[i]:at[i + 1]]
        for k in (1, 2) if len(w) >= SHORT else (len(w),) if len(w) else ():
            g, n = np.unique(ngrams(w, k), return_counts=True)
            keys.append(g)
            item.append(np.full(len(g), i))
            times.append(n)
            size.append(np.full(len(g), k))
    if not keys:
        none = np.zeros(0, np.int64)
        return Items(np.array(ids, dtype=object), words, at, np.zeros(0, np.uint64), none, none, none, least, span)
    keys, item, times, size = (np.concatenate(x) for x in (keys, item, times, size))
    order = np.argsort(keys, kind="stable")
    return Items(np.array(ids, dtype=object), words, at, keys[order], item[order], times[order], size[order], least, span)


def _found(items: Items, piece) -> tuple[np.ndarray, np.ndarray]:
    """(word place in the slice, range start in ``items.keys``) of every seed found."""
    places, seeds = [], []
    for k in np.unique(items.size):
        g = ngrams(piece.hashes, int(k))
        at = np.minimum(np.searchsorted(items.keys, g), len(items.keys) - 1)
        hit = np.flatnonzero((items.keys[at] == g) & (items.size[at] == k) & ngram_places(piece.word_at, int(k)))
        places.append(hit)
        seeds.append(at[hit])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(places), np.concatenate(seeds)


def _rarest(items: Items, df: np.ndarray) -> Items:
    """The items without their most frequent seeds; ``df`` is by seed."""
    least = (items.least - 1) // HITS + 1
    order = np.lexsort((items.keys, -df, items.item))
    item = items.item[order]
    total = np.append(0, np.cumsum(items.times[order]))
    first = np.searchsorted(item, item)
    out = total[1:] - total[first] <= (items.least - least)[item]     # no alignment holds more of these than that
    keep = np.sort(order[~out])
    return Items(items.ids, items.words, items.at, items.keys[keep], items.item[keep], items.times[keep], items.size[keep],
                 least, items.span)


def _align(items: Items, item: np.ndarray, words: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Smith-Waterman of each item with ``words[start:stop]``: best score and its last word place."""
    best, end = np.zeros(len(item)), np.zeros(len(item), dtype=np.int64)
    length, width = items.at[item + 1] - items.at[item], stop - start
    order = np.lexsort((width, length))
    k = 0
    while k < len(order):
        wide = int(width[order[k:]].max())
        some = order[k:k + max(1, ALIGN_CELLS // max(1, wide))]
        k += len(some)
        wide = int(width[some].max())
        col = np.arange(wide)
        at = start[some, None] + col
        text = words[np.minimum(at, len(words) - 1)]
        inside = at < stop[some, None]
        row = np.zeros((len(some), wide + 1))
        top, top_at = np.zeros(len(some)), np.zeros(len(some), dtype=np.int64)
        slope = PENALTY * np.arange(wide + 1)
        for i in range(int(length[some].max())):
            here = i < length[some]
            word = items.words[np.minimum(items.at[item[some]] + i, len(items.words) - 1)]
            same = (text == word[:, None]) & inside
            new = np.maximum(row - PENALTY, 0)
            new[:, 1:] = np.maximum(new[:, 1:], row[:, :-1] + np.where(same, 1.0, -PENALTY))
            new = np.maximum.accumulate(new + slope, axis=1) - slope      # gaps along the text
            row = np.where(here[:, None], new, row)
            peak = row.argmax(axis=1)
            value = row[np.arange(len(some)), peak]
            better = here & (value > top)
            top[better], top_at[better] = value[better], peak[better]
        best[some], end[some] = top, start[some] + top_at
    return best, end


def matches(items: Items, column: pa.Array, threshold: float = THRESHOLD):
    """(row, item index, score, seeds, end word place) of every aligned pair in a batch of texts."""
    out = []
    for piece in word_slices(pc.utf8_lower(column), points=POINTS):
        places, seeds = _found(items, piece) if len(items.keys) else (np.zeros(0, np.int64),) * 2
        if not len(places):
            continue
        # a seed may stand in several items: one hit each
        stop = np.searchsorted(items.keys, items.keys[seeds], side="right")
        many = stop - seeds
        entry = np.repeat(seeds, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        place = np.repeat(places, many)
        row = np.searchsorted(piece.word_at, place, side="right") - 1
        item = items.item[entry]
        order = np.lexsort((place, item, row))
        row, item, place, times = row[order], item[order], place[order], items.times[entry[order]]
        new = np.ones(len(row), dtype=bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
        pair, span = np.cumsum(new), items.span[item]
        # the first hit of an alignment has enough others within the span from it
        at = pair * (len(piece.hashes) + int(items.span.max()) + 1) + place
        total = np.append(0, np.cumsum(times))
        some = np.flatnonzero(total[np.searchsorted(at, at + span)] - total[:-1] >= items.least[item])
        if not len(some):
            continue
        row, item, place, pair, span = row[some], item[some], place[some], pair[some], span[some]
        start = np.maximum(place - span + 1, piece.word_at[row])
        stop = np.minimum(place + span, piece.word_at[row + 1])
        new = np.ones(len(row), dtype=bool)
        new[1:] = (pair[1:] != pair[:-1]) | (start[1:] > stop[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(row)) - 1
        row, item, start, stop = row[first], item[first], start[first], stop[last]
        length = items.at[item + 1] - items.at[item]
        score, end = _align(items, item, piece.hashes, start, stop)
        score = score / length
        good = score >= threshold
        row, item, score, n, end = row[good], item[good], score[good], (last - first + 1)[good], end[good] - piece.word_at[row[good]]
        order = np.lexsort((end, -score, item, row))      # the best place of a pair
        row, item, score, n, end = row[order], item[order], score[order], n[order], end[order]
        one = np.ones(len(row), dtype=bool)
        one[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1])
        out.append((row[one] + piece.row, item[one], score[one], n[one], end[one]))
    if not out:
        return tuple(np.zeros(0, t) for t in (np.int64, np.int64, float, np.int64, np.int64))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def indexed_blocks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_column: str = "item_id",
                   block_words: int = BLOCK_WORDS, threshold: float = THRESHOLD) -> list[Items]:
    """The test items in blocks, each with its rarest seeds by their frequency in ``docs``, for scores from ``threshold``."""
    items = benchmark.select(F.col(item_column).alias("item"), F.col("text").alias("text")).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-size // (2 * block_words)))     # a word and its separator take two bytes at least
    blocks = []
    for b in range(n_blocks):
        part = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n_blocks)) == b).orderBy("item", "text").toArrow()
        block = _items(part.column("item").to_pylist(), part.column("text").to_pylist(), threshold)
        blocks.append(_rarest(block, _frequencies(docs, text, block)) if len(block.keys) else block)
    return blocks


def _frequencies(docs: DataFrame, text: str, block: Items) -> np.ndarray:
    """Texts that hold each seed, by seed."""
    shared = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches):
        items = shared.value
        total = np.zeros(len(items.keys), dtype=np.int64)
        for batch in batches:
            for piece in word_slices(pc.utf8_lower(batch.column(0)), points=POINTS):
                places, seeds = _found(items, piece)
                row = np.searchsorted(piece.word_at, places, side="right") - 1
                once = np.unique(row * np.int64(len(items.keys)) + seeds) % len(items.keys)
                total += np.bincount(once, minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"seed": some, "n": total[some]})

    found = docs.select(text).mapInArrow(count, "seed bigint, n bigint").groupBy("seed").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(len(block.keys), dtype=np.int64)
    df[found.column("seed").to_numpy()] = found.column("n").to_numpy()
    return df[np.searchsorted(block.keys, block.keys)]     # equal keys share the first one's count


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text",
                       threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``id, item_id, score, n_seeds, end_word`` of every text and test item that align."""
    pairs = None
    kind = docs.schema[id_column].dataType.simpleString()
    item_kind = benchmark.schema["item_id"].dataType.simpleString()
    for block in indexed_blocks(docs, benchmark, text, block_words=block_words, threshold=threshold):
        shared = docs.sparkSession.sparkContext.broadcast(block)
        types = (docs.schema[id_column].dataType, benchmark.schema["item_id"].dataType)

        def pair(batches, shared=shared, types=types):
            from pyspark.sql.pandas.types import to_arrow_type

            for batch in batches:
                row, item, score, n, end = matches(shared.value, batch.column(1), threshold)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(row)), pa.array(shared.value.ids[item].tolist(), to_arrow_type(types[1])),
                     pa.array(score), pa.array(n), pa.array(end)], [id_column, "item_id", "score", "n_seeds", "end_word"])

        found = docs.select(id_column, text).mapInArrow(
            pair, f"{id_column} {kind}, item_id {item_kind}, score double, n_seeds bigint, end_word bigint")
        pairs = found if pairs is None else pairs.unionAll(found)
    return pairs


def contaminated(docs: DataFrame, blocks: list[Items], threshold: float = THRESHOLD):
    """Arrow function text -> whether the text aligns with any item of the blocks (indexed for ``threshold`` or less)."""
    shared = [docs.sparkSession.sparkContext.broadcast(b) for b in blocks]

    @F.arrow_udf("boolean")
    def found(text: pa.Array) -> pa.Array:
        out = np.zeros(len(text), dtype=bool)
        for b in shared:
            out[matches(b.value, text, threshold)[0]] = True
        return pa.array(out)

    return found
