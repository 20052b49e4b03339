"""Tables of 64-bit keys inside tasks.

``build_gate``: a bitmap of fixed size over keys, a broadcast pre-filter.

The bitmap has ``2**GATE_BITS`` bits (8 MB) whatever the number of keys, so
it may always be broadcast. It answers "surely not there" or "maybe there":
a key that passes by chance is dropped by the exact join that follows, so a
gate changes what is shuffled and never the result. With very many keys it
passes everything and the join does all the work.

``Table``: values of a bounded number of keys.
"""

from __future__ import annotations

import zlib

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

GATE_BITS = 26


class Gate:
    """The bitmap; it travels compressed, so few keys make a small file."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def __reduce__(self):
        return _unpacked, (zlib.compress(self.bits.tobytes(), 1),)


def _unpacked(data: bytes) -> Gate:
    return Gate(np.frombuffer(zlib.decompress(data), dtype=np.uint64))


def build_gate(keys: DataFrame, column: str) -> Broadcast:
    """Broadcast bitmap of the bigint ``column``; at most 2**20 rows reach the driver."""
    shift = 64 - GATE_BITS
    words = (keys.select(F.shiftrightunsigned(F.col(column), shift).alias("i"))
             .select(F.shiftright("i", 6).cast("int").alias("w"), (F.col("i") % 64).cast("int").alias("b"))
             .groupBy("w").agg(F.expr("bit_or(shiftleft(1L, b))").alias("v")).toArrow())
    bits = np.zeros(1 << (GATE_BITS - 6), dtype=np.uint64)
    if words.num_rows:
        bits[words.column("w").to_numpy()] = words.column("v").to_numpy().view(np.uint64)
    return keys.sparkSession.sparkContext.broadcast(Gate(bits))


def passes(gate: Gate, keys: np.ndarray) -> np.ndarray:
    """Which of the uint64 ``keys`` may be in the gate."""
    bits = gate.bits
    at = keys >> np.uint64(64 - GATE_BITS)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) != 0


class Table:
    """Sorted uint64 keys with a value each; keys are hashes, so their first bits spread evenly."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = 19):
        self.bits = bits
        order = np.argsort(keys)
        self.keys, self.values, self.shift = keys[order], values[order], np.uint64(64 - bits)
        edges = np.arange((1 << bits) + 1, dtype=np.float64) * 2.0 ** (64 - bits)
        edges[-1] = 0
        self.first = np.append(np.searchsorted(self.keys, edges[:-1].astype(np.uint64)), len(keys)).astype(np.int32)

    def __reduce__(self):
        return Table, (self.keys, self.values, self.bits)

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(found, value or 0) of each key."""
        found, value = np.zeros(len(keys), dtype=bool), np.zeros(len(keys))
        cell = (keys >> self.shift).astype(np.int64)
        at, stop = np.take(self.first, cell), np.take(self.first, cell + 1)
        open_ = np.flatnonzero(at < stop)
        at, stop = at[open_], stop[open_]
        while len(open_):
            hit = self.keys[at] == keys[open_]
            found[open_[hit]] = True
            value[open_[hit]] = self.values[at[hit]]
            at = at + 1
            more = np.flatnonzero(~hit & (at < stop))
            open_, at, stop = open_[more], at[more], stop[more]
        return found, value
