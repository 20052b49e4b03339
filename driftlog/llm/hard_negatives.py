"""Hard negatives by angular triangle filtering.

Vectors become integers, ``floor(scale * component)``, and a row's score with
an anchor is their integer inner product. An anchor's positives are its
``positives`` best other rows of the same label; the negatives of an anchor
and a positive are the ``negatives`` best rows of other labels whose score
``s`` satisfies ``low * p <= 100 * s <= high * p``, ``p`` being the
positive's score. Equal scores go by the smaller id.

* Each row stores its norm and its angles to ``DIRECTIONS`` reference
  directions. With the angles ``x`` of an anchor and ``y`` of a row to one
  direction, the angle between the two lies in ``[|x - y|, x + y]``: an
  interval of the cosine and, times the norms, of the score. Intervals are
  widened by ``SLACK`` for rounding. Only rows whose interval meets the
  scores still wanted are scored, exactly and in integers.
* Rows lie in blocks of one label and one nearest direction, sorted by the
  angle to it, at most ``BLOCK_ROWS`` a block: the rows an anchor needs of a
  block are a window of it, and all directions together may rule out a block.
* Anchors travel in chunks of one label to every stripe, a bounded number of
  blocks that a task holds in memory, and pass by them chunk after chunk:
  memory is bounded by a stripe and a chunk, whatever the number of rows of a
  label. The other anchors of its chunk give an anchor its first lower bound;
  a stripe keeps the best few of each anchor. Grouped ranks then choose the
  best of all stripes.
* The directions are spherical k-means centres of the ``SAMPLE`` rows with
  the smallest hashes (a bound at every size). They decide how much is
  scored, never the result.

Defined results: a row takes part if its id, label and vector and all
components are there and finite. Vectors of different lengths have no score
with each other. A row is no positive or negative of an anchor with its own
id; rows that agree in id and score count once for an anchor, repeated equal
anchors count once. Scores beyond the range of a long wrap around. Other
columns of the input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from driftlog.llm.scratch import written

DIRECTIONS = 8
SAMPLE = 4000
BLOCK_ROWS, CHUNK_ROWS = 4096, 512
#: most blocks a task holds at once
STRIPE_BLOCKS = 16
#: radians that an angle may be wrong by, far more than it is
SLACK = 1e-6

_LOCATED = ("id bigint, label bigint, dim int, norm double, cell int, angle double, angles binary, vector binary")
_BLOCK = ("block bigint, label bigint, dim int, n int, ids binary, norms binary, angles binary, vectors binary, cell int")
_NONE = -(1 << 63)


def prepared(vectors: DataFrame, id_column: str, vector: str, label: str | Column, scale: int) -> DataFrame:
    """``id, label, vector`` of the rows that take part, the vector in integers."""
    x = F.col(vector)
    whole = x.isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("bigint").alias("id"),
                          (F.col(label) if isinstance(label, str) else label).cast("bigint").alias("label"),
                          F.when(whole, F.transform(x, lambda v: F.floor(scale * v.cast("double")).cast("bigint"))).alias("vector"))
    return rows.where("id is not null and label is not null and vector is not null")


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


def _centres(x: np.ndarray, n: int) -> np.ndarray:
    """Spherical k-means from far-apart starts."""
    units = _unit(x)
    units = units[units.any(axis=1)]
    out = units[:1]
    while len(out) < min(n, len(units)):
        out = np.vstack([out, units[np.argmin((units @ out.T).max(axis=1))]])
    for _ in range(10 if len(units) else 0):
        cell = np.argmax(units @ out.T, axis=1)
        sums = np.zeros_like(out)
        np.add.at(sums, cell, units)
        out = np.where(np.linalg.norm(sums, axis=1, keepdims=True) > 0, _unit(sums), out)
    return out


def reference_directions(rows: DataFrame) -> dict[int, np.ndarray]:
    """By vector length, centres of the ``SAMPLE`` rows with the smallest hashes."""
    sample = rows.orderBy(F.xxhash64("id"), "id", "label", "vector").limit(SAMPLE).select("vector").collect()
    by_dim: dict[int, list] = {}
    for (vector,) in sample:
        by_dim.setdefault(len(vector), []).append(vector)
    found = {d: _centres(np.array(v, dtype=np.float64), DIRECTIONS) for d, v in by_dim.items()}
    return {d: x for d, x in found.items() if len(x)}


def _directions(known: dict[int, np.ndarray], dim: int) -> np.ndarray:
    """The directions of a vector length, made up where no sampled row has it."""
    if dim not in known:
        known[dim] = _unit(np.random.default_rng(dim).normal(size=(DIRECTIONS, dim)))
    return known[dim]


def _located(known: Broadcast):
    """Adds norm, angles and the nearest direction."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column(2)
            dims = vectors.value_lengths().to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                x = vectors.take(pa.array(at)).flatten().to_numpy().reshape(len(at), dim)
                units = x.astype(np.float64)
                norm = np.linalg.norm(units, axis=1)
                angles = np.arccos(np.clip(_unit(units) @ _directions(known.value, int(dim)).T, -1, 1))
                cell = np.argmin(angles, axis=1)
                yield pa.record_batch(
                    [batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at)),
                     pa.array(np.full(len(at), dim, dtype=np.int32)), pa.array(norm), pa.array(cell.astype(np.int32)),
                     pa.array(angles[np.arange(len(at)), cell]), pa.array([a.tobytes() for a in angles], pa.binary()),
                     pa.array([v.tobytes() for v in np.ascontiguousarray(x)], pa.binary())],
                    names=[c.split()[0] for c in _LOCATED.split(", ")])

    return run


def _packed(most: int, by: tuple[str, ...]):
    """Blocks of at most ``most`` neighbouring rows that agree in ``by``."""
    names = [c.split()[0] for c in _BLOCK.split(", ")]

    def block(number: int, rows: pa.Table) -> pa.RecordBatch:
        joined = [b"".join(rows.column(c).to_pylist()) for c in ("angles", "vector")]
        flat = [rows.column(c).to_numpy().tobytes() for c in ("id", "norm")]
        one = rows.slice(0, 1).to_pylist()[0]
        values = [number, one["label"], one["dim"], rows.num_rows, flat[0], flat[1], *joined, one["cell"]]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 4, pa.int32()]
        return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            keys = list(zip(*(batch.column(c).to_pylist() for c in by)))
            at = 0
            while at < batch.num_rows:
                room = most - sum(b.num_rows for b in held)
                if held and (keys[at] != key or not room):
                    yield block(number, pa.Table.from_batches(held))
                    number, held, room = number + 1, [], most
                key, stop = keys[at], at
                while stop < batch.num_rows and stop - at < room and keys[stop] == key:
                    stop += 1
                held.append(batch.slice(at, stop - at))
                at = stop
        if held:
            yield block(number, pa.Table.from_batches(held))

    return run


@dataclass
class _Block:
    label: int
    dim: int
    cell: int
    ids: np.ndarray
    norms: np.ndarray
    angles: np.ndarray
    vectors: np.ndarray

    @classmethod
    def of(cls, row: dict) -> _Block:
        n = row["n"]
        angles = np.frombuffer(row["angles"], dtype=np.float64)
        return cls(row["label"], row["dim"], row["cell"], np.frombuffer(row["ids"], dtype=np.int64),
                   np.frombuffer(row["norms"], dtype=np.float64), angles.reshape(n, len(angles) // n),
                   np.frombuffer(row["vectors"], dtype=np.int64).reshape(n, row["dim"]))

    def __post_init__(self):
        self.most, self.least = float(self.norms.max()), float(self.norms.min())
        self.low, self.high = self.angles.min(axis=0), self.angles.max(axis=0)
        self.exact = self.vectors.astype(np.float64)

    @property
    def order(self) -> np.ndarray:
        """Angles to the block's own direction, ascending."""
        return self.angles[:, self.cell]

    def scores(self, rows: slice, others: _Block, which: np.ndarray) -> np.ndarray:
        """Integer inner products; by doubles where every partial sum is a whole number they hold."""
        if self.most * others.most < 2 ** 52:
            return (others.exact[which] @ self.exact[rows].T).astype(np.int64)
        with np.errstate(over="ignore"):
            return others.vectors[which] @ self.vectors[rows].T

    def windows(self, anchors: _Block, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each anchor the range of rows whose score may lie in ``[low, high]``."""
        n, everything = len(anchors.ids), len(self.ids)
        if self.most * anchors.most >= 2 ** 52:
            return np.zeros(n, dtype=np.int64), np.full(n, everything)
        low, high = low.astype(np.float64), high.astype(np.float64)
        # the widest angle at which a score can still reach low (a sum of rounded products: one to spare)
        norm = np.where(low > 0, self.most, self.least) * anchors.norms
        reach = np.divide(low - 1, norm, out=np.where(low > 1, np.inf, -np.inf), where=norm > 0)
        widest = np.where(reach > 1 + 1e-9, -1.0, np.arccos(np.clip(reach, -1, 1)) + SLACK)
        gap = np.maximum(self.low - anchors.angles, anchors.angles - self.high).max(axis=1, initial=0)
        own = anchors.angles[:, self.cell] if anchors.angles.shape[1] else np.zeros(n)
        # rows so near the direction that their scores all exceed high
        norm = self.least * anchors.norms
        limit = np.divide(high + 1, norm, out=np.full(n, np.inf), where=norm > 0)
        nearest = np.where((high >= 0) & (limit < 1), np.arccos(np.clip(limit, -1, 1)) - SLACK, 0) - own
        first = np.searchsorted(self.order, np.maximum(own - widest, nearest), side="left")
        last = np.searchsorted(self.order, own + widest, side="right")
        open_ = (widest >= 0) & (gap <= widest) & (first < last) & (low <= high)
        return np.where(open_, first, 0), np.where(open_, last, 0)


def _first(score: np.ndarray, ids: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The best ``n`` pairs, each once: higher scores, then smaller ids."""
    order = np.lexsort((ids, -score))
    score, ids = score[order], ids[order]
    new = np.append(True, (score[1:] != score[:-1]) | (ids[1:] != ids[:-1]))[:len(score)]
    return score[new][:n], ids[new][:n]


class _Best:
    """The best few scores seen of each of some keys."""

    def __init__(self, n: int):
        self.n, self.kept = n, {}

    def add(self, key, score: np.ndarray, ids: np.ndarray) -> None:
        if key in self.kept:
            before = self.kept[key]
            score, ids = np.concatenate([before[0], score]), np.concatenate([before[1], ids])
        self.kept[key] = _first(score, ids, self.n)


def _seen(block: _Block, anchors: _Block, low: np.ndarray, high: np.ndarray):
    """``(anchor, scores, ids)`` of the rows in each anchor's window."""
    first, last = block.windows(anchors, low, high)
    which = np.flatnonzero(last > first)
    if not len(which):
        return
    start = int(first[which].min())
    scores = block.scores(slice(start, int(last[which].max())), anchors, which)
    for row, i in zip(scores, which.tolist()):
        part = slice(first[i] - start, last[i] - start)
        score, ids = row[part], block.ids[first[i]:last[i]]
        good = (score >= low[i]) & (score <= high[i]) & (ids != anchors.ids[i])
        if good.any():
            yield i, score[good], ids[good]


def _positives(n: int):
    def found(chunk: dict, anchors: _Block, blocks: list[_Block]) -> Iterator[tuple]:
        own = anchors.scores(slice(None), anchors, np.arange(len(anchors.ids)))
        low = np.full(len(anchors.ids), _NONE)
        for i, row in enumerate(own):
            best, _ = _first(row[anchors.ids != anchors.ids[i]], anchors.ids[anchors.ids != anchors.ids[i]], n)
            low[i] = best[-1] if len(best) == n else _NONE
        high = np.full(len(low), -_NONE - 1)
        best = _Best(n)
        for block in blocks:
            if block.label == anchors.label and block.dim == anchors.dim:
                for i, score, ids in _seen(block, anchors, low, high):
                    best.add(i, score, ids)
                    if len(best.kept[i][0]) == n:
                        low[i] = max(low[i], best.kept[i][0][-1])
        for i, (score, ids) in best.kept.items():
            for s, other in zip(score.tolist(), ids.tolist()):
                yield chunk["block"], i, int(anchors.ids[i]), other, s

    return found, "chunk bigint, place int, anchor_id bigint, positive_id bigint, positive_score bigint"


def _negatives(n: int, least: int, most: int):
    def found(chunk: dict, anchors: _Block, blocks: list[_Block]) -> Iterator[tuple]:
        pairs: dict[int, list[tuple[int, int, int, int]]] = {}
        for p in chunk["found"]:
            low, high = -(-least * p["positive_score"] // 100), most * p["positive_score"] // 100
            if low <= high:
                pairs.setdefault(p["place"], []).append((p["positive_id"], p["positive_score"], low, high))
        low = np.full(len(anchors.ids), 1)
        high = np.zeros(len(anchors.ids), dtype=np.int64)
        for i, each in pairs.items():
            low[i], high[i] = min(p[2] for p in each), max(p[3] for p in each)
        best = _Best(n)
        for block in blocks:
            if block.label != anchors.label and block.dim == anchors.dim:
                for i, score, ids in _seen(block, anchors, low, high):
                    for p in pairs[i]:
                        good = (score >= p[2]) & (score <= p[3])
                        if good.any():
                            best.add((i, *p[:2]), score[good], ids[good])
        for (i, positive, value), (score, ids) in best.kept.items():
            for s, other in zip(score.tolist(), ids.tolist()):
                yield chunk["block"], i, int(anchors.ids[i]), positive, value, other, s

    return found, ("chunk bigint, place int, anchor_id bigint, positive_id bigint, positive_score bigint, "
                   "negative_id bigint, negative_score bigint")


def _passed(found, schema: str):
    """Blocks of a stripe, then the chunks that pass by them."""
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [{"bigint": pa.int64(), "int": pa.int32()}[c.split()[1]] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripe, blocks = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["stripe"] != stripe:
                    stripe, blocks = row["stripe"], []
                if not row["passes"]:
                    blocks.append(_Block.of(row))
                    continue
                rows = list(found(row, _Block.of(row), blocks))
                if rows:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    return run


def _by_stripes(blocks: DataFrame, chunks: DataFrame, stripes: int, found, schema: str) -> DataFrame:
    """Every chunk past every block, stripe by stripe."""
    rows = blocks.withColumns({"stripe": F.pmod(F.xxhash64("block"), F.lit(stripes)).cast("int"), "passes": F.lit(False)})
    every = chunks.withColumn("stripe", F.explode(F.sequence(F.lit(0), F.lit(stripes - 1))))
    both = rows.unionByName(every.withColumn("passes", F.lit(True)), allowMissingColumns=True)
    return both.repartition(stripes, "stripe").sortWithinPartitions("stripe", "passes", "block") \
        .mapInArrow(_passed(found, schema), schema)


def _ranked(found: DataFrame, by: list[str], score: str, other: str, n: int) -> DataFrame:
    """The best ``n`` of each group, each pair once, with their ``rank``."""
    order = Window.partitionBy(*by).orderBy(F.desc(score), other)
    return found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def hard_negatives(vectors: DataFrame, is_anchor: Column, id_column: str = "vec_id", vector: str = "embedding",
                   label: str | Column = "label", positives: int = 5, negatives: int = 3, low: int = 50,
                   high: int = 95, scale: int = 256) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of the rows where ``is_anchor``
    holds; ``is_anchor`` reads the prepared rows' ``id`` and ``label``."""
    spark = vectors.sparkSession
    rows = prepared(vectors, id_column, vector, label, scale)
    known = spark.sparkContext.broadcast(reference_directions(rows))
    located = rows.mapInArrow(_located(known), _LOCATED)
    blocks = written(located.repartitionByRange("label", "dim", "cell", "angle", "id")
                     .sortWithinPartitions("label", "dim", "cell", "angle", "id")
                     .mapInArrow(_packed(BLOCK_ROWS, ("label", "dim", "cell")), _BLOCK), "vector-blocks")
    anchors = rows.where(is_anchor).distinct().mapInArrow(_located(known), _LOCATED)
    chunks = written(anchors.repartitionByRange("label", "dim", "cell", "angle", "id")
                     .sortWithinPartitions("label", "dim", "cell", "angle", "id")
                     .mapInArrow(_packed(CHUNK_ROWS, ("label", "dim")), _BLOCK), "anchor-chunks")
    stripes = max(-(-blocks.count() // STRIPE_BLOCKS), spark.sparkContext.defaultParallelism)
    best = _by_stripes(blocks, chunks, stripes, *_positives(positives))
    best = written(_ranked(best, ["chunk", "place"], "positive_score", "positive_id", positives), "positives")
    listed = best.groupBy(F.col("chunk").alias("block")) \
        .agg(F.collect_list(F.struct("place", "positive_id", "positive_score")).alias("found"))
    pairs = _by_stripes(blocks, chunks.join(listed, "block"), stripes, *_negatives(negatives, low, high))
    keys = ["chunk", "place", "positive_id", "positive_score"]
    return _ranked(pairs, keys, "negative_score", "negative_id", negatives) \
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
