"""Sharding by a k-d tree over metadata, with leaves of equal bytes.

Every row is a point of integer metadata dimensions. A node holding ``k``
shards is cut along its widest dimension (range within the node against the
range over all rows) at the weighted quantile that leaves ``k // 2`` shards'
worth of bytes on the left; cutting ends at one shard a node. The quantiles
of all nodes of a level are found together by Spark: a histogram of bytes
over ``BINS`` bins per node, then over the bins of the bin that holds the
quantile, until the bin is one value. At most ``shards * BINS`` rows reach
the driver at a time, whatever the table's size, and the rows themselves are
only read.

Equal values at a cut are cut further by the remaining dimensions and at
last by the id, so a value that holds a third of all rows still splits. The
dimensions of ``shard_documents`` depend on the text alone, so equal texts
are neighbours: a cut may part at most one group of equal texts, and moves to
the edge of that group where that costs at most ``SNAP`` of a shard.

Rows are taken as they are: repeated rows and ties are separate rows; a null
or empty text has no bytes and its row still counts ``ROW_BYTES``; a null id
sorts before the others. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.scratch import written

ROW_BYTES = 16
BINS = 1 << 12
SNAP = 0.05


@dataclass
class Node:
    """Some consecutive shards and, once cut, the two halves."""

    first: int
    shards: int
    left: "Node | None" = None
    right: "Node | None" = None
    #: lexicographic bound: rows at or below it go left
    cut: list[tuple[str, int]] = field(default_factory=list)
    # while the cut is searched: dimensions left, values already equal, the range and the bytes wanted left in it
    open: bool = False
    dims: list[str] = field(default_factory=list)
    ranges: dict[str, tuple[int, int]] = field(default_factory=dict)
    equal: list[tuple[str, int]] = field(default_factory=list)
    lo: int = 0
    hi: int = 0
    want: float = 0.0

    @property
    def width(self) -> int:
        """Values a bin covers."""
        return -(-(self.hi - self.lo + 1) // BINS)


def _at_most(columns: dict[str, np.ndarray], rows: np.ndarray, cut: list[tuple[str, int]]) -> np.ndarray:
    """Which rows are lexicographically at most the cut."""
    below = np.zeros(len(rows), dtype=bool)
    equal = np.ones(len(rows), dtype=bool)
    for name, value in cut:
        x = columns[name][rows]
        below |= equal & (x < value)
        equal &= x == value
    return below | equal


def leaves(root: Node, columns: dict[str, np.ndarray], n: int) -> Iterator[tuple[Node, np.ndarray]]:
    """The uncut nodes and the rows (of ``n``) that lie in each."""
    todo = [(root, np.arange(n))]
    while todo:
        node, rows = todo.pop()
        if node.left is None:
            yield node, rows
        else:
            left = _at_most(columns, rows, node.cut)
            todo += [(node.left, rows[left]), (node.right, rows[~left])]


def _columns(batch: pa.RecordBatch, names: list[str]) -> dict[str, np.ndarray]:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}


def _spans(points: DataFrame, dims: list[str], root: Node) -> dict[int, dict]:
    """Bytes, and the range of every dimension, by first shard of each uncut node."""
    def local(batches):
        for batch in batches:
            cols = _columns(batch, dims + ["size"])
            for node, rows in leaves(root, cols, batch.num_rows):
                if len(rows) and node.shards > 1:
                    yield pa.RecordBatch.from_pydict(
                        {"node": [node.first], "bytes": [int(cols["size"][rows].sum())]}
                        | {f"lo_{d}": [int(cols[d][rows].min())] for d in dims}
                        | {f"hi_{d}": [int(cols[d][rows].max())] for d in dims})

    schema = "node bigint, bytes bigint, " + ", ".join([f"lo_{d} bigint" for d in dims] + [f"hi_{d} bigint" for d in dims])
    found = (points.select(*dims, "size").mapInArrow(local, schema).groupBy("node")
             .agg(F.sum("bytes").alias("bytes"), *[F.min(f"lo_{d}").alias(f"lo_{d}") for d in dims],
                  *[F.max(f"hi_{d}").alias(f"hi_{d}") for d in dims]))
    return {r["node"]: r.asDict() for r in found.collect()}


def _histograms(points: DataFrame, names: list[str], root: Node) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(bins, bytes) over the searched range of every open node, by its first shard."""
    def local(batches):
        for batch in batches:
            cols = _columns(batch, names + ["size"])
            for node, rows in leaves(root, cols, batch.num_rows):
                if not node.open:
                    continue
                for name, value in node.equal:
                    rows = rows[cols[name][rows] == value]
                x = cols[node.dims[0]][rows]
                held = (x >= node.lo) & (x <= node.hi)
                # offsets in a range may need all 64 bits: subtract modulo 2**64
                bins = (x[held].view(np.uint64) - np.int64(node.lo).view(np.uint64)) // np.uint64(node.width)
                some, where = np.unique(bins.astype(np.int64), return_inverse=True)
                if len(some):
                    yield pa.RecordBatch.from_pydict({
                        "node": np.full(len(some), node.first), "bin": some,
                        "bytes": np.bincount(where, weights=cols["size"][rows][held]).astype(np.int64)})

    found = (points.select(*names, "size").mapInArrow(local, "node bigint, bin bigint, bytes bigint")
             .groupBy("node", "bin").agg(F.sum("bytes").alias("bytes")).toArrow())
    node, bins, size = (found.column(c).to_numpy() for c in ("node", "bin", "bytes"))
    out = {}
    for first in np.unique(node):
        mine = np.flatnonzero(node == first)
        mine = mine[np.argsort(bins[mine])]
        out[int(first)] = bins[mine], size[mine]
    return out


def _narrow(node: Node, bins: np.ndarray, size: np.ndarray, snap: float) -> None:
    """Go on with the bin that holds the wanted bytes; at a single value, cut."""
    below = np.cumsum(size)
    k = min(int(np.searchsorted(below, node.want)), len(bins) - 1)
    mass, width = float(size[k]), node.width
    node.want -= float(below[k]) - mass
    node.lo += int(bins[k]) * width
    node.hi = node.lo + width - 1
    if width > 1:
        return
    value, name = node.lo, node.dims.pop(0)
    if mass - node.want <= (snap if node.dims else mass / 2):     # nearly all of it (of one row: half): take it whole
        node.cut, node.open = node.equal + [(name, value)], False
    elif node.want <= snap or not node.dims:
        node.cut, node.open = node.equal + [(name, value - 1)], False
    else:
        node.equal = node.equal + [(name, value)]
        node.lo, node.hi = node.ranges[node.dims[0]]


def grow_tree(points: DataFrame, dims: list[str], ties: list[str], shards: int) -> Node:
    """Tree over ``points`` (bigint ``dims`` and ``ties``, bytes in ``size``)."""
    names = dims + ties
    root = Node(0, shards)
    level, whole = [root], None
    while level := [n for n in level if n.shards > 1]:
        spans = _spans(points, names, root)
        whole = whole or spans.get(0)
        for node in level:
            if span := spans.get(node.first):         # else no row came here: its shards stay empty
                node.ranges = {d: (span[f"lo_{d}"], span[f"hi_{d}"]) for d in names}
                share = {d: (span[f"hi_{d}"] - span[f"lo_{d}"]) / max(1, whole[f"hi_{d}"] - whole[f"lo_{d}"]) for d in dims}
                node.dims = sorted(dims, key=lambda d, share=share: -share[d]) + ties
                node.lo, node.hi = node.ranges[node.dims[0]]
                node.want = span["bytes"] * (node.shards // 2) / node.shards
                node.open = True
        while searched := [n for n in level if n.open]:
            found = _histograms(points, names, root)
            for node in searched:
                _narrow(node, *found[node.first], SNAP * whole["bytes"] / shards)
        level = [n for n in level if n.cut]
        for node in level:
            k = node.shards // 2
            node.left, node.right = Node(node.first, k), Node(node.first + k, node.shards - k)
        level = [half for n in level for half in (n.left, n.right)]
    return root


def placed(points: DataFrame, root: Node, names: list[str], keep: list[str]) -> DataFrame:
    """``keep`` and ``shard`` of every row."""
    def local(batches):
        for batch in batches:
            shard = np.zeros(batch.num_rows, dtype=np.int32)
            for node, rows in leaves(root, _columns(batch, names), batch.num_rows):
                shard[rows] = node.first
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(shard)], [*keep, "shard"])

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in points.select(*keep).schema] + ["shard int"])
    return points.select(*dict.fromkeys(names + keep)).mapInArrow(local, schema)


def gapless(rows: DataFrame, shard: str, id_column: str, name: str, cells: int) -> DataFrame:
    """Adds ``name``: 0, 1, 2 ... within each shard, without a task a shard.

    Rows are numbered within cells of a shard (by a hash of the id, so an id
    repeated very often still goes to one cell only); a cell starts where the
    cells before it end.
    """
    from pyspark.sql import Window

    celled = rows.withColumn("_cell", F.pmod(F.xxhash64(F.col(id_column), F.col("_salt")), F.lit(cells)).cast("int"))
    sizes = celled.groupBy(shard, "_cell").agg(F.count("*").alias("_n"))
    starts = sizes.withColumn("_from", F.sum("_n").over(
        Window.partitionBy(shard).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1))) \
        .select(F.col(shard).alias("_s"), F.col("_cell").alias("_c"), F.coalesce("_from", F.lit(0)).alias("_from"))
    numbered = celled.withColumn("_k", F.row_number().over(
        Window.partitionBy(shard, "_cell").orderBy(id_column, "_salt")) - 1)
    return (numbered.join(F.broadcast(starts), (F.col(shard) == F.col("_s")) & (F.col("_cell") == F.col("_c")))
            .withColumn(name, (F.col("_from") + F.col("_k")).cast("bigint"))
            .drop("_cell", "_s", "_c", "_from", "_k"))


def shard_documents(docs: DataFrame, shards: int = 40, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, size, text_crc32, shard, slot`` of every row; sizes of shards are near equal."""
    body = F.coalesce(F.col(text), F.lit(""))
    points = written(docs.select(
        F.col(id_column).cast("bigint").alias("doc_id"),
        (F.octet_length(body) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_salt")), "kd-points")
    points = points.withColumn("_log_size", F.floor(F.log2("size") * F.lit(1 << 24)).cast("bigint")) \
        .withColumn("_id", F.coalesce("doc_id", F.lit(-2**62))) \
        .withColumn("_more", F.crc32(F.col("_salt").cast("string").cast("binary")))
    dims, ties = ["_log_size", "text_crc32"], ["_id", "_more"]
    root = grow_tree(points, dims, ties, shards)
    cells = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = placed(points, root, dims + ties, ["doc_id", "size", "text_crc32", "_salt"])
    return gapless(rows, "shard", "doc_id", "slot", min(max(1, cells), 4096)).drop("_salt")
