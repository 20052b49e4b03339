import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from driftlog.llm import queries
from driftlog.llm.periodic_runs import find_runs, periodic_runs, run_finder
from driftlog.llm.words import mix

from .conftest import EDGE, SF, WORD


def brute(words, least=12):
    """All runs as (start, length, smallest period), lag by lag."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((i, j - i, q) for (i, j), q in out.items())


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def found(texts, **limits):
    at = np.cumsum([0, *map(len, texts)])
    hashes = mix(np.array([x for t in texts for x in t], dtype=np.uint64) + np.uint64(77))
    out = [[] for _ in texts]
    for row, start, end, period in find_runs(hashes, at, **limits).tolist():
        out[row].append((start, end - start, period))
    return out


def fibonacci(n):
    a, b = [0], [0, 1]
    while len(b) < n:
        a, b = b, b + a
    return b[:n]


def periodic(rng, n, period, letters):
    root = [rng.randrange(letters) for _ in range(period)]
    return (root * (n // period + 1))[:n]


def samples(rng, size):
    """Random words over few and many letters, runs in runs, squares of periodic words, self-similar words."""
    out = [[rng.randrange(k) for _ in range(rng.randrange(size))] for k in (1, 2, 2, 3, 4) for _ in range(8)]
    for _ in range(40):
        text = []
        while len(text) < rng.randrange(20, size):
            part = periodic(rng, rng.randrange(1, size // 3), rng.choice((1, 1, 2, 3, 5, 9, 17, 40)), rng.choice((2, 3, 50)))
            text += part * rng.choice((1, 1, 2, 3)) + [rng.randrange(5)] * rng.randrange(3)
        out.append(text[:size])
    return out + [fibonacci(size), [bin(i).count("1") & 1 for i in range(size)], [], [1], [0] * size,
                  ([0] * 30 + [1]) * (size // 31), ([0, 1] * 20 + [0]) * (size // 41)]


@pytest.mark.parametrize("seed", range(6))
def test_small_scales_equal_brute_force(seed):
    texts = samples(random.Random(seed), 220)
    assert found(texts, lags=16, least=4) == [brute(t, 4) for t in texts]


def test_production_scales_equal_brute_force():
    rng = random.Random(9)
    texts = samples(rng, 900)
    for period in (63, 64, 65, 127, 128, 129, 255, 256, 400):
        text = [rng.randrange(9000) for _ in range(200)]
        texts.append(text + periodic(rng, 2 * period + rng.randrange(period), period, 9000) + text[:50])
        texts.append(text + periodic(rng, period, 7, 9) * 2 + [1])
    assert found(texts) == [brute(t) for t in texts]


def test_long_texts_of_one_word_stay_quick():
    texts = [[0] * 200_000, ([0] * 999 + [1]) * 200, fibonacci(30_000)]
    got = found(texts)
    assert got[0] == [(0, 200_000, 1)] and (0, 200_000, 1000) in got[1] and len(got[1]) == 201
    assert all(n >= max(12, 2 * q) for _, n, q in got[2])


def test_parameters_are_checked():
    with pytest.raises(ValueError):
        run_finder(lags=32, least=12)


def test_edge_rows(spark, edge, none):
    edge = edge.unionByName(spark.createDataFrame([(20, "a  b\tc " * 9)], "doc_id bigint, text string"),
                            allowMissingColumns=True)
    got = periodic_runs(edge).collect()
    want = Counter()
    for i, text in [*EDGE, (20, "a  b\tc " * 9)]:
        w = WORD.findall(text or "")
        runs = brute(w) if len(w) < 5000 else []
        want[i, len(w), tuple(runs), collapsed(w, runs)] += 1
    assert Counter((r.doc_id, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == want
    assert periodic_runs(none).collect() == []


def planted(doc_id, w):
    """The words of a document as the query plants a run into them."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not w:
        return w
    g, n = h // 10, len(w)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SF).collect()}
    assert len(got) == len(docs)
    some = 0
    for doc_id, text in docs:
        w = planted(doc_id, WORD.findall(text or ""))
        if len(w) > 3000:
            continue
        runs, r = brute(w), got[doc_id]
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
        some += bool(runs)
    assert some > 10
