"""Sampled segmentations: Gumbel top-k without replacement over a piece lattice.

The vocabulary of a SentencePiece model file spans a lattice over every text:
a node a byte, an edge a piece (or, for a character without a piece of its
own, its byte pieces). A piece's weight is Zipf's law over its merge rank,
sharpened or flattened by ``alpha``; a segmentation's probability is the
product of its weights over the sum for all segmentations, which a backward
pass gives exactly. No piece crosses the start of a blank run or a line
break, so the lattice falls into units there, and equal units of a slice of
rows share one backward pass (and frequent ones over a task's slices); the texts are never cut.

``k`` distinct segmentations are drawn as by Gumbel-perturbed A* search: the
best path follows conditional maxima from the root with its perturbed value;
at each of its nodes the edges not taken are a queue entry whose bound is a
Gumbel value of their whole mass, truncated at that value. The best entry is
completed next, and so on. The value of the first entry left over is the
threshold ``kappa`` of the inclusion score ``1 - exp(-exp(log p - kappa))``.
Every random number is a hash of the row's key, the sample and the place, so a
row's samples do not depend on partitions or retries.

A text with fewer than ``k`` segmentations gives all it has; an empty or null
text gives one empty segmentation. Rows that repeat a key and text repeat
their samples; a null key counts as 0.
"""

from __future__ import annotations

import contextlib
import ctypes
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driftlog.llm.gates import Table
from driftlog.llm.words import _powers_to, mix, row_slices, span_hashes, text_buffers

SAMPLE_SLICE = 1 << 20
STORE_UNITS = 200_000
HEAD = 512              # steps of a path whose queue entries are looked at first
_U = np.uint64
_loaded: dict[tuple[str, float], "Vocabulary"] = {}


class Vocabulary:
    """Pieces of a model file: bytes (blanks for the escape sign), log weights, lookup by hash."""

    def __init__(self, path: str, alpha: float):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.byte_id = np.full(256, -1, dtype=np.int64)
        self.pieces: list[bytes] = [b""] * n
        usable = []
        for i in range(n):
            name = model.id_to_piece(i)
            if model.is_byte(i):
                b = int(name[3:5], 16)
                self.byte_id[b], self.pieces[i] = i, bytes([b])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                self.pieces[i] = name.replace("▁", " ").encode()
                usable.append(i)
        # byte pieces weigh like the last rank
        rank = np.full(n, n, dtype=np.float64)
        order = sorted(usable, key=lambda i: (-model.get_score(i), i))
        rank[order] = np.arange(1, len(order) + 1)
        self.weight = -alpha * np.log(rank + 10.0)
        self.at = np.append(0, np.cumsum([len(p) for p in self.pieces]))
        self.size = np.diff(self.at)
        self.data = np.frombuffer(b"".join(self.pieces), dtype=np.uint8)
        ids = np.array(usable)
        self.longest = int(np.diff(self.at).max())
        self.table = Table(span_hashes(self.data, self.at[ids], self.at[ids + 1]), ids.astype(np.float64), 16)


def vocabulary(path: str, alpha: float) -> Vocabulary:
    if (path, alpha) not in _loaded:
        _loaded[path, alpha] = Vocabulary(path, alpha)
    return _loaded[path, alpha]


def decode(vocab: Vocabulary, ids: np.ndarray) -> bytes:
    """Text of a segmentation; the blank put before every text is taken off."""
    return _decoded(vocab, ids)[0].tobytes()[1:]


def _decoded(vocab: Vocabulary, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all pieces, and where each piece starts in them."""
    size = vocab.size[ids]
    at = np.zeros(len(ids) + 1, dtype=np.int64)
    np.cumsum(size, out=at[1:])
    where = np.repeat(vocab.at[ids] - at[:-1], size)
    where += np.arange(len(where))
    return vocab.data[where], at


class Lattice:
    """Edges of some distinct units, sorted by node and falling probability."""

    def __init__(self, vocab: Vocabulary, data: np.ndarray, at: np.ndarray):
        n = len(at) - 1
        size = np.diff(at)
        unit = np.repeat(np.arange(n), size)
        end = at[1:][unit]
        start = (data & 0xC0) != 0x80
        pos = np.flatnonzero(start)
        width = np.minimum(np.append(pos[1:], len(data)), end[pos]) - pos       # bytes of the character
        up, down = _powers_to(len(data) + 1)
        edge_at, edge_to, piece = [], [], []
        single = np.zeros(len(data), dtype=bool)
        live = pos
        boundary = np.append(start, True)
        char_width = np.zeros(len(data), dtype=np.int64)
        char_width[pos] = width
        for length in range(1, min(vocab.longest, int(size.max(initial=0))) + 1):
            live = live[live + length <= end[live]]
            s = live[boundary[live + length]]
            if not len(s):
                continue
            found, ids = vocab.table.look(span_hashes_at(data, s, length))
            s, ids = s[found], ids[found].astype(np.int64)
            edge_at.append(s)
            edge_to.append(s + length)
            piece.append(ids)
            single[s[char_width[s] == length]] = True
        for s, w in zip(*(x[~single[pos]] for x in (pos, width)), strict=True) if not single[pos].all() else ():
            at_ = np.arange(s, s + w)
            edge_at.append(at_)
            edge_to.append(at_ + 1)
            piece.append(vocab.byte_id[data[s:s + w]])
        a = np.concatenate(edge_at) if edge_at else np.zeros(0, np.int64)
        b = np.concatenate(edge_to) if edge_to else np.zeros(0, np.int64)
        piece = np.concatenate(piece) if piece else np.zeros(0, np.int64)
        weight = vocab.weight[piece]
        left = end[a] - a                                    # bytes from the edge's start to the unit's end
        # nodes: the bytes of a unit and its end, unit after unit
        src, dst = a + unit[a], b + unit[a]
        length = b - a
        order = np.argsort(((left << 28 | src) << 6) | length)
        src, dst, weight, piece, left = src[order], dst[order], weight[order], piece[order], left[order]
        self.log_mass = np.zeros(len(data) + n)              # log weight of all ways from a node to the end
        step_at = np.append(np.flatnonzero(np.append(True, left[1:] != left[:-1])) if len(left) else 0, len(left))
        for i, j in zip(step_at[:-1], step_at[1:], strict=True):
            w = weight[i:j] + self.log_mass[dst[i:j]]
            node = src[i:j]
            first = np.flatnonzero(np.append(True, node[1:] != node[:-1]))
            top = np.maximum.reduceat(w, first)
            total = np.add.reduceat(np.exp(w - np.repeat(top, np.diff(np.append(first, j - i)))), first)
            self.log_mass[node[first]] = top + np.log(total)
        log_p = weight + self.log_mass[dst] - self.log_mass[src]
        length = dst - src
        order = np.argsort(((src << 16 | np.minimum(-log_p * 1024, 65535).astype(np.int64)) << 6) | length)
        self.src, self.dst, self.piece, self.log_p = src[order], dst[order], piece[order], log_p[order]
        self.weight = weight[order]
        # whole numbers: sums do not depend on what else is in the slice
        p = (np.exp(self.log_p) * 2.0**40).astype(np.int64)
        self.first = np.append(0, np.cumsum(np.bincount(self.src, minlength=len(data) + n)))
        total = np.append(0, np.cumsum(p))
        upto = (total[1:] - total[self.first[self.src]]) >> 8        # cumulative probability within the node, of 2**32
        upto[self.first[1:][np.diff(self.first) > 0] - 1] = 2**32 - 1
        self.upto = np.minimum(upto, 2**32 - 1).astype(np.uint32)
        self.root = at[:-1] + np.arange(n)
        self.end = np.zeros(len(data) + n, dtype=bool)
        self.end[at[1:] + np.arange(n)] = True


class Store:
    """Lattices of units by hash: the first ``STORE_UNITS`` a task meets stay, others last a slice.

    A unit's edges are the same whether they were kept or made anew.
    """

    def __init__(self, vocab: Vocabulary):
        self.vocab = vocab
        self.kept = Table(np.zeros(0, _U), np.zeros(0), 17)
        self.nodes = self.edges = 0
        self.first = np.zeros(1, np.int32)
        self.end = np.zeros(0, bool)
        self.src, self.dst, self.piece = (np.zeros(0, np.int32) for _ in range(3))
        self.log_p, self.upto = np.zeros(0), np.zeros(0, np.uint32)

    def roots(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        """Root node of every unit of a slice."""
        hashes = span_hashes(data, starts, stops)
        found, root = self.kept.look(hashes)
        root = root.astype(np.int64)
        missing = np.flatnonzero(~found)
        if len(missing):
            names, one, inverse = np.unique(hashes[missing], return_index=True, return_inverse=True)
            one = missing[one]
            size = (stops - starts)[one]
            at = np.append(0, np.cumsum(size))
            where = np.repeat(starts[one] - at[:-1], size) + np.arange(int(at[-1]))
            new = Lattice(self.vocab, data[where], at)
            self._put(new)
            new_root = new.root + self.nodes
            root[missing] = new_root[inverse]
            if len(self.kept.keys) + len(names) <= STORE_UNITS:
                self.kept = Table(np.append(self.kept.keys, names), np.append(self.kept.values, new_root), 17)
                self.nodes, self.edges = self.nodes + len(new.end), self.edges + len(new.src)
        return root

    def _put(self, new: Lattice) -> None:
        """Writes a lattice behind what is kept."""
        def put(old: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
            if len(old) < at + len(values):
                old = np.resize(old, max(at + len(values), len(old) * 5 // 4)) if len(old) else np.zeros(len(values), old.dtype)
            old[at:at + len(values)] = values
            return old

        self.first = put(self.first, self.nodes, new.first + self.edges)
        self.end = put(self.end, self.nodes, new.end)
        self.src = put(self.src, self.edges, new.src + self.nodes)
        self.dst = put(self.dst, self.edges, new.dst + self.nodes)
        self.piece = put(self.piece, self.edges, new.piece)
        self.log_p = put(self.log_p, self.edges, new.log_p)
        self.upto = put(self.upto, self.edges, new.upto)

    def walk(self, node: np.ndarray, seed: np.ndarray) -> tuple[list, list]:
        """Sampled edges from each node to its unit's end, by step: (entries still on their way, their edges)."""
        which, step, edges = [], 0, []
        live = np.flatnonzero(~self.end[node])
        node, seed = node[live], seed[live]
        while len(live):
            u = (_stirred(seed, step) >> _U(32)).astype(np.uint32)
            edge = self.first[node]
            todo = np.flatnonzero(self.upto[edge] < u)
            while len(todo):
                e = edge[todo] + 1
                edge[todo] = e
                todo = todo[self.upto[e] < u[todo]]
            which.append(live)
            edges.append(edge)
            node = self.dst[edge]
            on = np.flatnonzero(~self.end[node])
            live, node, seed = live[on], node[on], seed[on]
            step += 1
        return which, edges


def span_hashes_at(data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """Hash of ``data[s:s + length]`` at many places, from sums that are kept between calls."""
    global _sums_of
    if _sums_of is None or _sums_of[0] is not data:
        from driftlog.llm.words import _BYTE

        up, _ = _powers_to(len(data) + 1)
        total = np.zeros(len(data) + 1, dtype=_U)
        with np.errstate(over="ignore"):
            np.cumsum(np.take(_BYTE, data) * up[:len(data)], out=total[1:])
        _sums_of = data, total
    total = _sums_of[1]
    _, down = _powers_to(len(data) + 1)
    with np.errstate(over="ignore"):
        return mix((total[starts + length] - total[starts]) * down[starts] + _U(length))


_sums_of = None


def _seeds(seed: np.ndarray, sample: int, place: np.ndarray) -> np.ndarray:
    """Seeds that depend on the row's seed, the sample and the place in the row."""
    with np.errstate(over="ignore"):
        return mix(seed + _U((sample + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1) + place.astype(_U) * _U(0xC2B2AE3D27D4EB4F))


def _stirred(seeds: np.ndarray, step) -> np.ndarray:
    """The seeds' random 64 bits of a step."""
    with np.errstate(over="ignore"):
        return mix(seeds + np.asarray(step).astype(_U) * _U(0x165667B19E3779F9))


def _uniform(seed: np.ndarray, sample: int, place: np.ndarray, step) -> np.ndarray:
    """Numbers in (0, 1) that depend on the arguments alone."""
    return ((_stirred(_seeds(seed, sample, place), step) >> _U(11)).astype(np.float64) + 0.5) * 2.0 ** -53


def _flat(which: list[np.ndarray], edges: list[np.ndarray], n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of ``walk`` in the order of their starting entries, and the boundaries."""
    count = np.zeros(n, dtype=np.int64)
    for w in which:
        count[w] += 1
    at = np.append(0, np.cumsum(count))
    out = np.zeros(int(at[-1]), dtype=np.int64)
    for step, (w, e) in enumerate(zip(which, edges, strict=True)):
        out[at[w] + step] = e
    return out, at


def _units(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit starts of texts that each begin with a blank, and the row boundaries in them."""
    blank, line = data == 0x20, (data == 0x0A) | (data == 0x09)
    cut = np.zeros(len(data), dtype=bool)
    cut[1:] = (blank[1:] & ~blank[:-1]) | line[1:] | line[:-1]
    cut[at[at < len(data)]] = True
    starts = np.flatnonzero(cut)
    return starts, np.searchsorted(starts, at)


def _row_sums(values: np.ndarray, at: np.ndarray, first: np.ndarray | None = None) -> np.ndarray:
    """Sums of each row's values, or of its ``first`` ones."""
    stop = at[1:] if first is None else at[:-1] + first
    out = np.zeros(len(at) - 1)
    some = np.flatnonzero(stop > at[:-1])
    if len(some):
        edges = np.column_stack([at[:-1][some], stop[some]]).ravel()
        padded = np.append(values, 0.0)
        out[some] = np.add.reduceat(padded, edges)[::2]
    return out


def _best(values: np.ndarray, at: np.ndarray, most: int) -> list[list[tuple[float, int]]]:
    """The ``most`` largest finite values of each row with their places."""
    out: list[list[tuple[float, int]]] = [[] for _ in range(len(at) - 1)]
    rows = np.flatnonzero(np.diff(at))
    if not len(rows):
        return out
    values = values.copy()
    lengths = np.diff(at)[rows]
    for _ in range(most):
        top = np.maximum.reduceat(values, at[:-1][rows])
        hit = np.flatnonzero((values == np.repeat(top, lengths)) & np.isfinite(values))
        r = np.searchsorted(at, hit, side="right") - 1
        hit = hit[np.unique(r, return_index=True)[1]]
        r = np.searchsorted(at, hit, side="right") - 1
        for i, place in zip(r.tolist(), hit.tolist(), strict=True):
            out[i].append((float(values[place]), place - int(at[i])))
        values[hit] = -np.inf
    return out


def sample(lattice: Store, data: np.ndarray, at: np.ndarray, keys: np.ndarray, k: int):
    """Per row of a slice, its samples: lists of (piece ids, log p, perturbed value), and ``kappa``.

    ``data[at[i]:at[i + 1]]`` are the texts, each with a blank put before it.
    """
    rows = len(at) - 1
    starts, unit_at = _units(data, at)
    stops = np.append(starts[1:], len(data))
    roots = lattice.roots(data, starts, stops)
    row_of = np.repeat(np.arange(rows), np.diff(unit_at))
    place = np.arange(len(starts)) - unit_at[:-1][row_of]
    with np.errstate(over="ignore"):
        seed = mix(keys.astype(np.int64).view(_U) + _U(0x5EED))
    root = -np.log(-np.log(_uniform(seed, -1, np.zeros(rows, np.int64), 7)))     # a Gumbel value
    chains: list[list] = [[] for _ in range(rows)]       # per row: (edges, unit number of each edge, value)
    queue: list[list] = [[] for _ in range(rows)]        # per row: (bound, chain, step, edges taken there)

    def entries(edges: np.ndarray, edge_at: np.ndarray, values: np.ndarray, seeds: np.ndarray, draw: int, skip: np.ndarray):
        """Best queue bounds of the edges not taken along each row's path, after its first ``skip`` edges.

        A bound is less than 38 over the log mass of its entry (the noise is over 2 ** -54), and masses only fall
        along a path: where the first HEAD entries end that far below the best bounds, no later entry is among them.
        """
        lp = lattice.log_p[edges]
        log_p = _row_sums(lp, edge_at)
        length = np.diff(edge_at)
        head = np.minimum(length, skip + HEAD)
        before_skip = _row_sums(lp, edge_at, skip)
        best: list[list[tuple[float, int]]] = [[] for _ in range(len(length))]
        rows_ = np.arange(len(length))
        while len(rows_):
            count = (head - skip)[rows_]
            at = np.append(0, np.cumsum(count))
            row = np.repeat(rows_, count)
            index = np.arange(int(at[-1])) - np.repeat(at[:-1], count) + skip[row]
            p = lp[edge_at[row] + index]
            total = np.append(0, np.cumsum(p))
            before = total[:-1] - np.repeat(total[at[:-1]], count) + before_skip[row]
            rest = -np.expm1(np.minimum(p, 0))
            with np.errstate(divide="ignore"):
                mu = before + np.where(rest > 1e-12, np.log(rest), -np.inf)
            noise = -np.log(_uniform(seeds[row], 1000 + draw, index, 3))
            with np.errstate(over="ignore", invalid="ignore"):
                bound = mu - np.log(np.exp(np.minimum(mu - values[row], 700)) + noise)
            bound = np.where(np.isfinite(mu), bound, -np.inf)
            again = []
            for r, found, end in zip(rows_.tolist(), _best(bound, at, k - draw), at[1:].tolist(), strict=True):
                best[r] = [(v, s + int(skip[r])) for v, s in found]
                if head[r] < length[r] and (len(found) < k - draw or before[end - 1] + 38 > found[-1][0]):
                    again.append(r)
            rows_ = np.array(again, dtype=np.int64)
            head[rows_] = length[rows_]
        return best, log_p

    which, found = lattice.walk(roots, _seeds(seed[row_of], 0, place))
    edges, by_unit = _flat(which, found, len(starts))
    edge_at = by_unit[unit_at]
    unit_of = np.repeat(place, np.diff(by_unit))
    found, log_p = entries(edges, edge_at, root, seed, 0, np.zeros(rows, np.int64))
    for i, best in enumerate(found):
        a, b = edge_at[i], edge_at[i + 1]
        chains[i].append((edges[a:b], unit_of[a:b], float(log_p[i]), float(root[i])))
        queue[i] = [(v, 0, s, (int(edges[a + s]),)) for v, s in best]

    for draw in range(1, k):
        todo, heads, resume, resume_unit, values, taken = [], [], [], [], [], []
        for i in range(rows):
            if not queue[i]:
                continue
            entry = max(queue[i])
            queue[i].remove(entry)
            value, c, s, gone = entry
            old, units, _, _ = chains[i][c]
            node = lattice.src[gone[0]]
            others = [e for e in range(lattice.first[node], lattice.first[node + 1]) if e not in gone]
            p = np.exp(lattice.log_p[others])
            u = _uniform(seed[i:i + 1], 2000 + draw, np.zeros(1, np.int64), s)[0] * p.sum()
            new = others[min(int(np.searchsorted(np.cumsum(p), u)), len(others) - 1)]
            todo.append(i)
            heads.append((old[:s], units[:s], new, int(units[s])))
            resume.append(lattice.dst[new])
            resume_unit.append(int(units[s]))
            values.append(value)
            taken.append(gone + (new,))
        if not todo:
            break
        # finish the unit of the new edge, then all later units of the row
        rest = [np.arange(unit_at[i] + u + 1, unit_at[i + 1]) for i, u in zip(todo, resume_unit, strict=True)]
        counts = np.array([len(r) + 1 for r in rest])
        first = np.append(0, np.cumsum(counts))
        nodes = np.zeros(int(first[-1]), dtype=np.int64)
        later = np.ones(len(nodes), dtype=bool)
        later[first[:-1]] = False
        flat_rest = np.concatenate(rest)
        nodes[later] = roots[flat_rest]
        nodes[first[:-1]] = resume
        entry_row = np.repeat(np.array(todo), counts)
        entry_place = np.zeros(len(nodes), dtype=np.int64)
        entry_place[later] = place[flat_rest]
        entry_place[first[:-1]] = resume_unit
        which, found = lattice.walk(nodes, _seeds(seed[entry_row], draw, entry_place))
        edges, by_entry = _flat(which, found, len(nodes))
        unit_of = np.repeat(entry_place, np.diff(by_entry))
        tails = by_entry[first]
        paths, units = [], []
        for j, (head, head_units, new, unit) in enumerate(heads):
            a, b = tails[j], tails[j + 1]
            paths.append(np.concatenate([head, [new], edges[a:b]]))
            units.append(np.concatenate([head_units, [unit], unit_of[a:b]]))
        path_at = np.append(0, np.cumsum([len(p) for p in paths]))
        skip = np.array([len(h[0]) + 1 for h in heads])
        value = np.array(values)
        path = np.concatenate(paths).astype(np.int64)
        found, log_p = entries(path, path_at, value, seed[np.array(todo)], draw, skip)
        for j, (i, best) in enumerate(zip(todo, found, strict=True)):
            c = len(chains[i])
            chains[i].append((paths[j].astype(np.int64), units[j], float(log_p[j]), values[j]))
            queue[i] += [(v, c, s, (int(path[path_at[j] + s]),)) for v, s in best]
            left = 1 - np.exp(lattice.log_p[list(taken[j])]).sum()
            if left > 1e-12 and len(taken[j]) < lattice.first[lattice.src[taken[j][0]] + 1] - lattice.first[lattice.src[taken[j][0]]]:
                s = int(skip[j]) - 1
                mu = float(lattice.log_p[heads[j][0].astype(np.int64)].sum()) + np.log(left)
                noise = -np.log(_uniform(seed[i:i + 1], 3000 + draw, np.zeros(1, np.int64), s)[0])
                queue[i].append((mu - np.log(np.exp(min(mu - values[j], 700)) + noise), c, s, taken[j]))
    out = []
    for i in range(rows):
        kappa = max(queue[i])[0] if queue[i] else -np.inf
        out.append(([(lattice.piece[e], lp, v) for e, _, lp, v in chains[i]], kappa))
    return out


SAMPLES = "rank int, n_pieces bigint, log_prob double, perturbed double, inclusion double, ids_crc32 bigint, decoded_crc32 bigint"


def sampled_pieces(docs: DataFrame, path: str, k: int = 2, alpha: float = 1.0, id_column: str = "doc_id", text: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """A row a sample: the id, ``SAMPLES`` and, if asked for, ``ids`` (the pieces).

    ``ids_crc32`` is over the ids as little-endian 32-bit numbers, ``decoded_crc32`` over the decoded text's bytes.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    names = [id_column] + [x.split()[0] for x in SAMPLES.split(", ")] + ["ids"] * with_ids

    def local(batches):
        lattice = Store(vocabulary(path, alpha))
        for batch in batches:
            data, offsets = text_buffers(batch.column(1))
            keys = batch.column(2).to_numpy(zero_copy_only=False)
            for row, stop in row_slices(offsets, SAMPLE_SLICE):
                yield _sample_rows(lattice, data, offsets[row:stop + 1], batch.column(0).slice(row, stop - row),
                                   keys[row:stop], k, with_ids, names)
        del lattice
        _give_back()

    return docs.select(F.col(id_column), F.col(text).alias("text"), F.coalesce(F.col(id_column).cast("bigint"), F.lit(0)).alias("key")) \
        .mapInArrow(local, f"{id_column} {kind}, {SAMPLES}" + (", ids array<int>" if with_ids else ""))


def _give_back() -> None:
    """What the worker has freed goes to the system: it stays for the tasks of other stages, and would hold it there."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):      # of the GNU C library alone
        ctypes.CDLL(None).malloc_trim(0)


def _sample_rows(lattice, data, offsets, ids, keys, k, with_ids, names) -> pa.RecordBatch:
    """Output batch of one slice of rows."""
    size = np.diff(offsets)
    some = np.flatnonzero(size)
    # the texts that hold a byte, each with a blank before it
    at = np.append(0, np.cumsum(size[some] + 1))
    body = np.full(int(at[-1]), 0x20, dtype=np.uint8)
    mask = np.ones(len(body), dtype=bool)
    mask[at[:-1]] = False
    body[mask] = data[offsets[0]:offsets[-1]]
    drawn = sample(lattice, body, at, keys[some], k) if len(some) else []
    empty = [(np.zeros(0, np.int64), 0.0, 0.0)], -np.inf
    found = dict(zip(some.tolist(), drawn, strict=True))
    where, columns, pieces = [], [[] for _ in range(7)], []
    for i in range(len(size)):
        samples, kappa = found.get(i, empty)
        for rank, (piece, log_p, value) in enumerate(samples):
            inclusion = -np.expm1(-np.exp(min(700.0, log_p - kappa))) if np.isfinite(kappa) else 1.0
            for c, x in zip(columns, (rank + 1, len(piece), log_p, value, float(inclusion)), strict=False):
                c.append(x)
            where.append(i)
            pieces.append(piece)
    flat = np.concatenate(pieces).astype("<i4") if pieces else np.zeros(0, "<i4")
    lengths = np.append(0, np.cumsum([len(p) for p in pieces])).astype(np.int64)
    text, piece_at = _decoded(lattice.vocab, flat)
    raw, ids_raw = memoryview(text), memoryview(flat).cast("B")
    for a, b in zip(lengths[:-1].tolist(), lengths[1:].tolist(), strict=True):
        columns[5].append(zlib.crc32(ids_raw[4 * a:4 * b]))
        columns[6].append(zlib.crc32(raw[piece_at[a] + 1:piece_at[b]]) if b > a else 0)
    types = (pa.int32(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64(), pa.int64())
    arrays = [ids.take(pa.array(where, pa.int64()))] + [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
    if with_ids:
        arrays.append(pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(flat, pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, names)
