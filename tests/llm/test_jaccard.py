from collections import Counter, defaultdict

import numpy as np
import pytest

from driftlog.llm import jaccard
from driftlog.llm.components import components
from driftlog.llm.jaccard import Bands, similar_groups

from .conftest import words


def brute(rows, k, num, den):
    """{id: (set size, smallest linked id)} by an inverted index."""
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = frozenset(tuple(w[j:j + k]) for j in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        for j, common in Counter(j for x in s for j in index[x]).items():
            if common * den >= num * (len(s) + len(sets[j]) - common):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            index[x].append(i)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def edited(rng, text, n):
    for _ in range(n):
        i = rng.integers(0, len(text))
        text = text[:i] + [f"e{rng.integers(0, 10**6)}"] + text[i + rng.integers(0, 2):]
    return text


@pytest.fixture(scope="module")
def copies(spark):
    """Groups of near copies of many sizes and lengths, chains, exact copies, a shared passage, small sets."""
    rng = np.random.default_rng(5)
    word = lambda: f"w{int(rng.zipf(1.3)) % 5000}"
    passage = [word() for _ in range(60)]
    texts = []
    for size in (3, 4, 8, 15, 25, 60, 150, 400, 1200):
        for _ in range(4):
            base = [word() for _ in range(size)]
            texts.append(base)
            for _ in range(6):
                texts.append(edited(rng, list(base), int(rng.integers(0, max(2, size // 30) + 1))))
            chain = list(base)
            for _ in range(5):
                chain = edited(rng, chain, max(1, size // 90))
                texts.append(chain)
            texts.append(base + passage)
            texts.append(base * 2)
    big = [word() for _ in range(300)]
    texts += [edited(rng, list(big), int(rng.integers(0, 9))) for _ in range(150)] + [big] * 100
    order = rng.permutation(len(texts))
    return [(int(i), " ".join(texts[j])) for i, j in enumerate(order)]


@pytest.mark.parametrize("k, num, den", [(3, 90, 100), (5, 80, 100), (1, 50, 100), (2, 95, 100)])
def test_equals_brute_force(spark, copies, k, num, den):
    frame = spark.createDataFrame(copies, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(frame, k, num, den).collect()}
    assert got == brute(copies, k, num, den)


@pytest.mark.parametrize("k, num, den", [(3, 90, 100), (1, 50, 100)])
def test_cells_and_blocks_equal_brute_force(spark, copies, monkeypatch, k, num, den):
    """Regions beyond a few nodes go through Voronoi cells and blocks."""
    monkeypatch.setattr(jaccard, "LEAF", 6)
    frame = spark.createDataFrame(copies, "doc_id bigint, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(frame, k, num, den).collect()}
    assert got == brute(copies, k, num, den)


def test_hot_region_of_unlinked_texts(spark, monkeypatch):
    """Copies of one text, each edited alike much: most pairs are near the threshold and few link."""
    rng = np.random.default_rng(11)
    base = [f"w{i}" for i in range(200)]
    texts = [edited(rng, list(base), int(rng.integers(4, 9))) for _ in range(300)]
    texts += [edited(rng, t, 1) for t in texts[:40]] + [[f"v{i}" for i in range(200)] for _ in range(5)]
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    for leaf in (512, 40):
        monkeypatch.setattr(jaccard, "LEAF", leaf)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(frame).collect()}
        assert got == brute(rows, 3, 90, 100)


def test_sketches_bound_the_difference():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 5, 70, 400, 400, 9000]
    sets = [np.unique(rng.integers(0, 20_000, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in sizes]
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    sketches = jaccard._sketches(at, np.repeat(np.arange(len(sets)), np.diff(at)), np.concatenate(sets)).to_pylist()
    assert [len(s) for s in sketches] == [8, 8, 8, 16, 64, 64, 1024]
    for x, a in zip(sets, sketches):
        for y, b in zip(sets, sketches):
            width = min(len(a), len(b))
            u, v = jaccard._by_length([a, b], width)
            differ = int(np.bitwise_count(u ^ v).sum())
            assert differ <= len(np.setxor1d(x, y)) and (differ - len(np.setxor1d(x, y))) % 2 == 0


def test_equals_brute_force_on_documents(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(documents).collect()}
    assert got == brute(rows, 3, 90, 100)


@pytest.mark.parametrize("num, den", [(90, 100), (80, 100), (50, 100)])
def test_bands_allow_every_link(num, den):
    bands = Bands(num, den, 3000)
    for s in range(1, 1500, 7):
        for t in range(s, min(3000, s * den // num) + 1, 3):
            b = int(bands.of(np.array([t]))[0])
            assert int(bands.of(np.array([s]))[0]) in (b, b - 1)
            assert (den - num) * (s + t) // (den + num) <= bands.most[b]


def test_edge_rows(spark, edge, none):
    rows = similar_groups(edge).collect()
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)
    by_id = {i: (n, c) for i, n, c in got if i is not None}
    assert by_id[1] == (by_id[10][0], 1) and by_id[10][1] == 1
    assert by_id[2] == (0, 2) and by_id[3] == (0, 3) and by_id[4] == (0, 4)
    assert by_id[5] == (1, 5) and by_id[6] == (1, 6) and by_id[11] == (1, 11) and by_id[8][0] == 29_998
    assert sorted((n, c) for i, n, c in got if i is None) == [(0, None), (3, None)]
    assert similar_groups(none).collect() == []


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 200 + i) for i in range(50)]
    rows = spark.createDataFrame(path + star, "a bigint, b bigint")
    got = {r.node: r.root for r in components(rows).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100} | {200 + i: 100 for i in range(50)}
