"""Exact Jaccard join of shingle sets, by pivots in metric space.

The Jaccard distance of two sets is a metric, and so is the size of their
symmetric difference. A text is the set of hashes of its distinct ``k``-word
shingles; equal sets are one node. Two nodes link when their similarity is
``num / den`` or more.

1. **Regions.** Shingle hashes are dealt into as many parts as linked sets can
   differ in elements, and some more, by size band. Linked sets then agree
   on whole parts, in fact on parts of several shingles, so the nodes that
   hold the same part (a cell of distance 0 to that part) form a region, and
   every link lies within some region. Unrelated texts share no such part;
   in the plain Jaccard space they all lie at distance 1 of any pivot, and no
   pivot would part them.
2. **First pivot.** Every region gets a pivot. A node's distance to it is first
   bounded from below by the Hamming distance of their sketches (one parity
   bit per cell of the hash space, about as many cells as shingles: a
   contraction of the symmetric difference), and where that allows a link
   computed exactly. Linked nodes join components; pairs within a component
   need no look from then on. A node outside the pivot's component can link to
   one inside only if their distances to the pivot differ by the radius at
   most, so inside nodes beyond that window leave the region. A region whose
   nodes are all in one component is done; of regions of equal nodes one stays.
3. **Voronoi cells and recursion.** A region of more than ``LEAF`` nodes gets
   ``PIVOTS`` pivots on average; each is held against all of the region
   exactly, as before, and leaves it. Every other node goes to the cell of its
   nearest pivot in the Hamming metric of the sketches, and, by the triangle
   inequality, as a guest to each cell of a smaller pivot that is farther by
   twice the node's largest difference at most: two linked nodes always meet
   in the cell of the smaller of their pivots. Cells are the next regions,
   where they at least halve the pairs of their region.
4. **Leaves.** Regions of ``LEAF`` nodes or fewer, and regions that cells don't
   part (every node within the window of every pivot), are dealt into blocks
   of about ``LEAF`` nodes; each two blocks meet in one bounded group, which
   hands on the pairs of different components that sizes and sketches allow.
   Those are compared exactly.

All steps are exact (64-bit hashes stand for shingles), and none forms all
pairs of a group of copies: each costs a row a region and round. A bitmap of
fixed size keeps parts held by one node only from being shuffled twice.

Only components are produced. Pairs within a component are not compared, so
links are not enumerated and a row's number of links is not known.

Null and empty texts, and texts without a word, have the empty set and link
to nothing. A text with fewer than ``k`` words has one shingle, all its words.
Equal texts link to each other. Rows repeat as given; a row without an id
links others and has no component id unless a linked row has an id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.components import components
from driftlog.llm.gates import build_gate, passes
from driftlog.llm.scratch import written
from driftlog.llm.words import mix, ngram_places, ngrams, signed, word_slices

MOST_BITS = 13        # a sketch has at most 2 ** MOST_BITS bits
PIVOTS = 4            # of a region to be parted, on average
LEAF = 512            # nodes of a region, or of a block, that are compared directly
LEAST_PART = 8        # parts of fewer shingles are left out where enough larger ones remain
SPREAD = 1.4          # parts as a multiple of the differences that links allow, plus one
_U = np.uint64
_SHORT = 0x5B5B5B5B5B5B5B5B


def _sets(column: pa.Array, k: int):
    """Per slice of rows: first row, row boundaries and the sorted distinct shingle hashes."""
    for piece in word_slices(column):
        n_words = np.diff(piece.word_at)
        places = np.flatnonzero(ngram_places(piece.word_at, k)) if len(piece.hashes) >= k else np.zeros(0, np.int64)
        row = np.searchsorted(piece.word_at, places, side="right") - 1
        key = ngrams(piece.hashes, k)[places] if len(places) else np.zeros(0, _U)
        short = np.flatnonzero((n_words > 0) & (n_words < k))
        if len(short):     # the whole row of words, separators aside
            whole = np.zeros(len(short), dtype=_U)
            with np.errstate(over="ignore"):
                for j in range(k - 1):
                    has = n_words[short] > j
                    at = np.minimum(piece.word_at[short] + j, len(piece.hashes) - 1)
                    whole = np.where(has, mix(whole * _U(0x9FB21C651E98DF25) + piece.hashes[at] + _U(1)), whole)
            row, key = np.append(row, short), np.append(key, whole ^ _U(_SHORT))
        order = np.lexsort((key, row))
        row, key = row[order], key[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
        row, key = row[new], key[new]
        yield piece.row, np.searchsorted(row, np.arange(piece.rows + 1)), row, key


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 between boundaries."""
    with np.errstate(over="ignore"):
        total = np.zeros(len(values) + 1, dtype=_U)
        np.cumsum(values, out=total[1:])
        return np.diff(total[at])


def _nodes(at: np.ndarray, key: np.ndarray) -> np.ndarray:
    """A 64-bit name of each whole set."""
    with np.errstate(over="ignore"):
        return mix(_sums(mix(key + _U(0x51)), at) + np.diff(at).astype(_U))


class Bands:
    """Size bands: linked sets lie in one band or in neighbours."""

    def __init__(self, num: int, den: int, largest: int):
        lows, most, parts = [1], [], []
        while lows[-1] <= largest or len(lows) < 3:
            top = lows[-1] * den // num
            most.append((den - num) * 2 * top // (den + num))      # differences of linked sets of this band
            parts.append(int(np.ceil(SPREAD * (most[-1] + 1))))
            lows.append(top + 1)
        self.lows, self.most, self.parts = np.array(lows), np.array(most), np.array(parts)

    def of(self, size: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.lows, size, side="right") - 1


def _parts(bands: Bands, band: np.ndarray, at: np.ndarray, row: np.ndarray, key: np.ndarray):
    """(row, part key) of the parts that each set of ``band`` (by row) offers to that band."""
    size = np.diff(at)
    k = bands.parts[np.minimum(band, len(bands.parts) - 1)]
    part = ((key >> _U(32)) * k[row].astype(_U)) >> _U(32)         # keys are sorted: parts are contiguous
    new = np.ones(len(key), dtype=bool)
    new[1:] = (part[1:] != part[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(new)
    held = np.diff(np.append(first, len(key)))
    part_row, part_no = row[first], part[first]
    with np.errstate(over="ignore"):
        content = _sums(mix(key + _U(0xA7)), np.append(first, len(key))) + held.astype(_U)
        name = mix(content ^ mix(part_no * _U(0xD6E8FEB86659FD93) + band[part_row].astype(_U) + _U(3)))
    need = bands.most[np.minimum(band, len(bands.most) - 1)] + 1
    least = np.zeros(len(size), dtype=np.int64)                     # smallest part a row offers
    for m in range(1, LEAST_PART + 1):
        enough = np.bincount(part_row[held >= m], minlength=len(size)) >= need
        least[enough] = m
    offered = held >= least[part_row]
    rows, names = [part_row[offered]], [name[offered]]
    for r in np.flatnonzero((least == 0) & (size > 0)):             # too few parts hold anything: empty ones count too
        none = np.setdiff1d(np.arange(k[r]), part_no[part_row == r].astype(np.int64)).astype(_U)
        with np.errstate(over="ignore"):
            names.append(mix(mix(none * _U(0xD6E8FEB86659FD93) + _U(int(band[r])) + _U(3))))
        rows.append(np.full(len(none), r))
    return np.concatenate(rows), np.concatenate(names)


def _offers(bands: Bands, at: np.ndarray, row: np.ndarray, key: np.ndarray):
    """(row, part key) over both bands a set may find partners in."""
    band = bands.of(np.diff(at))
    a, b = _parts(bands, band, at, row, key), _parts(bands, band + 1, at, row, key)
    return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])


def _sketches(at: np.ndarray, row: np.ndarray, key: np.ndarray) -> pa.Array:
    """Parity bits of the shingles per cell; a sketch of half the length is the XOR of its halves."""
    n = np.diff(at)
    bits = 1 << np.clip(np.ceil(np.log2(np.maximum(n, 1))).astype(np.int64), 6, MOST_BITS)
    start = np.concatenate([[0], np.cumsum(bits)])
    cell = (mix(key + _U(0x77)) & (bits[row] - 1).astype(_U)).astype(np.int64)
    odd = (np.bincount(start[row] + cell, minlength=start[-1]) & 1).astype(np.uint8)
    data = np.packbits(odd, bitorder="little")
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer((start // 8).astype(np.int32)), pa.py_buffer(data)])


def _folded(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches of one length as rows of 64-bit words, folded to ``width`` bytes."""
    x = np.frombuffer(b"".join(sketches), dtype=_U).reshape(len(sketches), -1)
    while x.shape[1] * 8 > width:
        half = x.shape[1] // 2
        x = x[:, :half] ^ x[:, half:]
    return x


def _by_length(sketches: list[bytes], width: int) -> np.ndarray:
    """Sketches of any lengths, folded to ``width`` bytes."""
    out = np.zeros((len(sketches), width // 8), dtype=_U)
    lengths = np.array([len(s) for s in sketches])
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        out[at] = _folded([sketches[i] for i in at], width)
    return out


def _hamming(*columns):
    """Differing bits of two sketches folded to a width in bytes; at most the symmetric difference of the sets."""
    @F.arrow_udf("bigint")
    def differing(a: pa.Array, b: pa.Array, width: pa.Array) -> pa.Array:
        x, y, width = a.to_pylist(), b.to_pylist(), width.to_numpy(zero_copy_only=False)
        out = np.zeros(len(width), dtype=np.int64)
        for w in np.unique(width):
            at = np.flatnonzero(width == w)
            differ = _by_length([x[i] for i in at], int(w)) ^ _by_length([y[i] for i in at], int(w))
            out[at] = np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
        return pa.array(out)

    return differing(*columns)


def _described(texts: DataFrame, k: int) -> DataFrame:
    """(id, n, node, sketch) of every row."""
    def local(batches):
        for batch in batches:
            for first, at, row, key in _sets(batch.column(1), k):
                rows = len(at) - 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, rows), pa.array(np.diff(at)), signed(_nodes(at, key)),
                     _sketches(at, row, key)], ["id", "n", "node", "sketch"])

    return texts.mapInArrow(local, "id bigint, n bigint, node bigint, sketch binary")


def _region_rows(texts: DataFrame, k: int, bands: Bands) -> DataFrame:
    """(region, node): every part that two nodes or more hold, with its nodes (and some held by one)."""
    def tags(batches):
        for batch in batches:
            for _, at, row, key in _sets(batch.column(0), k):
                r, name = _offers(bands, at, row, key)
                tag = (_nodes(at, key) >> _U(24))[r]
                yield pa.RecordBatch.from_arrays([signed(name), signed(tag)], ["region", "tag"])

    shared = (texts.select("text").mapInArrow(tags, "region bigint, tag bigint").groupBy("region")
              .agg(F.min("tag").alias("a"), F.max("tag").alias("b")).where("a <> b").select("region"))
    gate = build_gate(shared, "region")

    def rows(batches):
        bits = gate.value
        for batch in batches:
            for _, at, row, key in _sets(batch.column(0), k):
                r, name = _offers(bands, at, row, key)
                some = passes(bits, name)
                yield pa.RecordBatch.from_arrays([signed(name[some]), signed(_nodes(at, key)[r[some]])], ["region", "node"])

    return texts.select("text").mapInArrow(rows, "region bigint, node bigint").distinct()


def _measured(pairs: DataFrame, described: DataFrame, texts: DataFrame, k: int, num: int, den: int) -> DataFrame:
    """``a, b, far, linked, distance`` of each distinct pair of nodes; a far pair's distance is a lower bound."""
    one = described.select("node", "n", "sketch")
    near = (pairs.join(one.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), "a")
            .join(one.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb")), "b")
            .withColumn("l1", F.greatest(_hamming("sa", "sb", F.least(F.octet_length("sa"), F.octet_length("sb"))),
                                          F.abs(F.col("na") - F.col("nb"))))
            .select("a", "b", "na", "nb", "l1", (F.col("l1") * (den + num) > (den - num) * (F.col("na") + F.col("nb"))).alias("far")))
    near = written(near, "near")
    wanted = near.where("not far")
    wanted = wanted.select(F.col("a").alias("node")).unionAll(wanted.select(F.col("b").alias("node"))).distinct()
    gate = build_gate(wanted, "node")

    def sets(batches):
        bits = gate.value
        for batch in batches:
            for _, at, row, key in _sets(batch.column(0), k):
                node = _nodes(at, key)
                some = np.flatnonzero(passes(bits, node) & (np.diff(at) > 0))
                lengths = np.diff(at)[some]
                held = np.repeat(at[:-1][some], lengths) + np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lengths)), pa.int32()), signed(key[held]))
                yield pa.RecordBatch.from_arrays([signed(node[some]), lists], ["node", "shingles"])

    held = written(texts.select("text").mapInArrow(sets, "node bigint, shingles array<bigint>").dropDuplicates(["node"]), "sets")
    exact = (near.where("not far").join(held.select(F.col("node").alias("a"), F.col("shingles").alias("x")), "a")
             .join(held.select(F.col("node").alias("b"), F.col("shingles").alias("y")), "b")
             .select("a", "b", F.lit(False).alias("far"), (F.col("na") + F.col("nb")).alias("total"),
                     F.size(F.array_intersect("x", "y")).cast("bigint").alias("common")))
    exact = exact.select("a", "b", "far", (F.col("common") * den >= (F.col("total") - F.col("common")) * num).alias("linked"),
                         (1 - F.col("common") / (F.col("total") - F.col("common"))).alias("distance"))
    # |x u y| is half of the total and the difference, so the distance is at least 2 l1 / (total + l1)
    total = F.col("na") + F.col("nb")
    bound = near.where("far").select("a", "b", "far", F.lit(False).alias("linked"),
                                     (2.0 * F.col("l1") / (total + F.col("l1"))).alias("distance"))
    return written(exact.unionAll(bound), "measured")


def _leaf_pairs(leaves: DataFrame, described: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of the leaves that sizes and sketches allow, of different components; two blocks a group."""
    import pandas as pd

    def close(frame: pd.DataFrame) -> pd.DataFrame:
        n, node, part, block = (frame[c].to_numpy() for c in ("n", "node", "part", "block"))
        sketches = list(frame["sketch"])
        s = _by_length(sketches, min(map(len, sketches)))
        across = block.min() != block.max() or bool(frame["i"].iat[0] != frame["j"].iat[0])
        pairs = [np.zeros((0, 2), dtype=np.int64)]
        step = max(1, (1 << 21) // (s.size or 1))
        for i in range(0, len(n), step):
            k = np.arange(i, min(i + step, len(n)))[:, None]
            may = (part[k] != part) & (n[k] * den >= n * num) & (n * den >= n[k] * num)
            may &= (block[k] < block) if across else (k < np.arange(len(n)))
            x, y = np.nonzero(may)
            x = x + i
            differ = np.bitwise_count(s[x] ^ s[y]).sum(axis=1, dtype=np.int64)
            some = differ * (den + num) <= (den - num) * (n[x] + n[y])
            x, y = node[x[some]], node[y[some]]
            pairs.append(np.stack([np.maximum(x, y), np.minimum(x, y)], axis=1))
        return pd.DataFrame(np.concatenate(pairs), columns=["a", "b"])

    sizes = leaves.groupBy("region").agg(F.ceil(F.count("*") / LEAF).cast("int").alias("blocks"))
    rows = (leaves.join(sizes, "region").join(described.select("node", "n", "sketch"), "node")
            .withColumn("block", F.pmod(F.xxhash64("node", F.lit("block")), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumns({"i": F.least("block", "other"), "j": F.greatest("block", "other")}))
    return rows.select("region", "i", "j", "block", "node", "n", "sketch", "part").groupBy("region", "i", "j") \
        .applyInPandas(close, "a bigint, b bigint").distinct()


def _labelled(rest: DataFrame, roots: DataFrame) -> DataFrame:
    """Region rows with the component (``part``) that each node is in now."""
    return rest.join(roots, "node", "left").select("region", "node", F.coalesce("root", "node").alias("part"))


def _unsettled(rest: DataFrame) -> DataFrame:
    """``region, node, part, size`` of regions with two components or more; of regions of the same nodes one stays."""
    rest = written(rest, "regions")
    open_ = (rest.groupBy("region").agg(F.min("part").alias("a"), F.max("part").alias("b"), F.count("*").alias("size"),
                                        F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
             .where("a <> b").groupBy("size", "x", "y").agg(F.min("region").alias("region")).select("region", "size"))
    return written(rest.join(open_, "region"), "unsettled")


def _first_pivot(rest: DataFrame, described: DataFrame, texts: DataFrame, k: int, num: int,
                 den: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(links to the pivots, rows of the regions that are left, components so far); every node is a component still."""
    radius = 1 - num / den
    first = rest.groupBy("region").agg(F.min(F.struct(F.xxhash64("node").alias("o"), "node")).alias("p")) \
        .select("region", F.col("p.node").alias("first"))
    marked = written(rest.join(first, "region").where("node <> first")
                     .withColumns({"a": F.greatest("node", "first"), "b": F.least("node", "first")}), "marked")
    measured = _measured(marked.select("a", "b").distinct(), described, texts, k, num, den)
    found = measured.where("linked").select("a", "b")
    roots = components(found)
    placed = (marked.join(measured.select("a", "b", "distance", "far"), ["a", "b"])
              .join(roots, "node", "left").withColumn("now", F.coalesce("root", "node")).drop("root")
              .join(roots.select(F.col("node").alias("first"), F.col("root").alias("first_root")), "first", "left")
              .withColumn("inside", F.col("now") == F.coalesce("first_root", "first")))
    placed = written(placed.select("region", "node", "distance", "far", "inside"), "placed")
    edge = placed.where("not inside").groupBy("region").agg(F.min("distance").alias("nearest"))
    # an inside node whose distance is known only from below stays too
    window = ~F.col("inside") | F.col("far") | (F.col("distance") >= F.col("nearest") - radius - 1e-9)
    return found, placed.join(edge, "region").where(window).select("region", "node"), roots


def _voronoi(rest: DataFrame, turn: int, described: DataFrame, texts: DataFrame, k: int, num: int, den: int,
             links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(links to pivots, rows of the cells, rows of regions that cells don't part, components so far)."""
    rows = rest.join(described.select("node", "n", "sketch"), "node")
    one = rows.groupBy("region").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("o"), "node")).alias("p"),
                                     F.min(F.octet_length("sketch")).alias("width"))
    marked = written(rows.join(one, "region").withColumn(
        "is_pivot", (F.col("node") == F.col("p.node"))
        | (F.pmod(F.xxhash64("node", F.lit(turn), F.lit("pivot")), F.col("size")) < PIVOTS - 1)).drop("p"), "marked")
    pivots = marked.where("is_pivot").select("region", F.col("node").alias("pivot"), F.col("part").alias("pivot_part"),
                                             F.col("sketch").alias("pivot_sketch"))
    held = written(marked.join(pivots, "region").where("node <> pivot").select(
        "region", "node", "n", "part", "size", "is_pivot", "pivot", "pivot_part",
        _hamming("sketch", "pivot_sketch", "width").alias("h")), "held")
    pairs = held.where("part <> pivot_part").select(F.greatest("node", "pivot").alias("a"), F.least("node", "pivot").alias("b"))
    found = _measured(pairs.distinct(), described, texts, k, num, den).where("linked").select("a", "b")
    roots = components(links.unionAll(found))
    # linked nodes differ in (den - num) / num of the smaller set's size at most
    most = F.floor((den - num) * F.col("n") / num)
    home = held.groupBy("region", "node").agg(F.min(F.struct("h", "pivot")).alias("home"))
    cells = held.where("not is_pivot").join(home, ["region", "node"]).where(
        (F.col("pivot") == F.col("home.pivot"))
        | ((F.col("pivot") < F.col("home.pivot")) & (F.col("h") <= F.col("home.h") + 2 * most)))
    cells = written(cells.select("region", "node", "size", "pivot"), "cells")
    work = (cells.groupBy("region", "size", "pivot").agg(F.count("*").cast("double").alias("c"))
            .groupBy("region", "size").agg(F.sum(F.col("c") * F.col("c")).alias("pairs")))
    parted = work.where(2 * F.col("pairs") <= F.col("size").cast("double") * F.col("size")).select("region")
    inner = cells.join(parted, "region", "left_semi").select(F.xxhash64("region", "pivot").alias("region"), "node")
    whole = marked.where("not is_pivot").join(parted, "region", "left_anti").select("region", "node")
    return found, inner, written(whole, "whole"), roots


def similar_groups(docs: DataFrame, k: int = 3, num: int = 90, den: int = 100, id_column: str = "doc_id",
                   text: str = "text") -> DataFrame:
    """``id, n_shingles, component_id`` of every row; ``component_id`` is the smallest id reachable by links."""
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    rows = written(_described(texts, k), "described")
    described = rows.where("n > 0").dropDuplicates(["node"])
    largest = rows.agg(F.max("n")).first()[0] or 1
    bands = Bands(num, den, largest)
    rest = _unsettled(_region_rows(texts, k, bands).withColumn("part", F.col("node")))
    links, left, roots = _first_pivot(rest, described, texts, k, num, den)
    rest = _unsettled(_labelled(left, roots))
    leaves, turn = rest.where(F.col("size") <= LEAF).select("region", "node"), 0
    rest = rest.where(F.col("size") > LEAF)
    while not rest.isEmpty():
        turn += 1
        found, inner, whole, roots = _voronoi(rest, turn, described, texts, k, num, den, links)
        links = links.unionAll(found)
        rest = _unsettled(_labelled(inner, roots))
        leaves = leaves.unionAll(whole).unionAll(rest.where(F.col("size") <= LEAF).select("region", "node"))
        rest = rest.where(F.col("size") > LEAF)
    leaves = _unsettled(_labelled(leaves, roots)).drop("size")
    pairs = written(_leaf_pairs(leaves, described, num, den), "pairs")
    if not pairs.isEmpty():
        links = links.unionAll(_measured(pairs, described, texts, k, num, den).where("linked").select("a", "b"))
        roots = components(links)
    named = rows.where("n > 0").groupBy("node").agg(F.min("id").alias("least"))
    labels = (named.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    least = labels.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = labels.select("node", "root").join(least, "root").select("node", "component_id")
    return (rows.join(labels, "node", "left")
            .select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id")))
