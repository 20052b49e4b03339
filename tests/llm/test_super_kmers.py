import hashlib
import random
from collections import Counter

import pytest
import xxhash

from driftlog.llm import queries
from driftlog.llm.super_kmers import without_repeats

from .conftest import EDGE, SF, WORD


def brute(rows, size=20):
    """Words left of each (id, text), by a table of every window's first place."""
    def part(text):
        x = xxhash.xxh64_intdigest(text or "", seed=42)
        return x - (x >> 63 << 64)

    texts = [(1 << 63 if i is None else i, part(t), WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, t, w in texts:
        for p in range(len(w) - size + 1):
            key = tuple(w[p:p + size])
            first[key] = min(first.get(key, (i, t, p)), (i, t, p))
    out = []
    for i, t, w in texts:
        gone = {p + j for p in range(len(w) - size + 1) if first[tuple(w[p:p + size])] < (i, t, p) for j in range(size)}
        out.append((len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return out


def check(spark, rows, **limits):
    table = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = Counter(map(tuple, without_repeats(table, **limits).collect()))
    size = limits.get("size", 20)
    assert got == Counter((i, *x) for (i, _), x in zip(rows, brute(rows, size)))


def passages(rng, n, letters):
    """Texts of shared passages, with edits, in any order, some of them repeated in one text."""
    shared = [[f"w{rng.randrange(letters)}" for _ in range(rng.randrange(5, 60))] for _ in range(8)]
    out = []
    for i in range(n):
        text = []
        for _ in range(rng.randrange(6)):
            part = list(rng.choice(shared)) if rng.random() < 0.7 else [f"u{rng.randrange(9999)}" for _ in range(30)]
            if part and rng.random() < 0.3:
                part[rng.randrange(len(part))] = "edit"
            text += part
        out.append((n - i, rng.choice((" ", "\n", " \t ")).join(text)))
    return out


@pytest.mark.parametrize("hot", [4096, 3, 1])
def test_passages_equal_brute_force(spark, hot):
    rng = random.Random(hot)
    check(spark, passages(rng, 60, 5000) + passages(rng, 30, 3), hot=hot)


def test_repeated_words_and_periods(spark):
    tie, two = " ".join(["tie"] * 500), " ".join(["a", "b"] * 200)
    check(spark, [(1, tie), (2, tie + " end"), (3, two), (4, "b " + two), (5, two[2:] + " c"), (6, tie[4:])])


def test_one_group_of_copies_over_the_hot_limit(spark):
    text = " ".join(f"x{i}" for i in range(90))
    check(spark, [(i, f"own{i} " + text + f" tail{i}") for i in range(60)], hot=20)
    check(spark, [(i % 7 or None, f"own{i % 20} " + text + f" tail{i % 3}") for i in range(60)], hot=20)


def test_other_window_sizes(spark):
    check(spark, passages(random.Random(5), 40, 2000), size=8)
    check(spark, passages(random.Random(6), 40, 2000), size=33)
    with pytest.raises(ValueError):
        without_repeats(spark.createDataFrame([(1, "a")], "doc_id bigint, text string"), size=5)


def test_edge_rows(spark, edge, none):
    extra = [(None, "n1 " * 25), (None, "n1 " * 25 + "x"), (30, "same id " * 20), (30, "y same id " * 20), (31, "漢字 かな " * 15)]
    table = edge.unionByName(spark.createDataFrame(extra, "doc_id bigint, text string"), allowMissingColumns=True)
    got = Counter(map(tuple, without_repeats(table).collect()))
    rows = [*EDGE, *extra]
    assert got == Counter((i, *x) for (i, _), x in zip(rows, brute(rows)))
    assert without_repeats(none).collect() == []


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in queries.op12_super_kmers(spark, SF).collect()}
    want = {i: (n, gone, hashlib.sha256(kept.encode()).hexdigest()) for (i, _), (n, gone, kept) in zip(docs, brute(docs))}
    assert got == want and any(x[1] for x in want.values())


def test_hot_windows_leave_a_task_combined(monkeypatch):
    """A task hands on each kind of hot window once, whatever the number of copies, and its first place."""
    import numpy as np
    import pyarrow as pa

    from driftlog.llm import super_kmers
    from driftlog.llm.super_kmers import _hot_windows

    class Every:
        @staticmethod
        def passes(keys):
            return np.ones(len(keys), dtype=bool)

    class Hot:
        value = Every()

    def rows(copies, apart=""):
        text = " ".join(f"x{i}" for i in range(90))
        docs = [pa.record_batch([pa.array(range(b, b + 10)), pa.array([5] * 10),
                                 pa.array([f"{text}{apart and apart + str(i)}" for i in range(b, b + 10)])], ["doc", "part", "text"])
                for b in range(0, copies, 10)]
        return [r for b in _hot_windows(20, Hot)(iter(docs[::-1])) for r in b.to_pylist()]

    assert len(rows(200)) == len(rows(10)) == 71
    assert sorted((r["doc"], r["part"], r["start"]) for r in rows(200)) == [(0, 5, p) for p in range(71)]
    monkeypatch.setattr(super_kmers, "HELD", 500)
    assert {(r["doc"], r["start"]) for r in rows(200)} == {(0, p) for p in range(71)}
    least = {}
    for r in rows(200, apart=" t"):         # one kind of its own a document, more than are held
        least[r["hash"]] = min(least.get(r["hash"], (1000, 0)), (r["doc"], r["start"]))
    assert len(least) == 71 + 200 and sum(v == (0, v[1]) for v in least.values()) == 72
