import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from driftlog.llm import hard_negatives as H
from driftlog.llm import queries

from .conftest import SF

SCHEMA = "vec_id bigint, embedding array<float>, label int"


def brute(rows, step=50, positives=5, negatives=3, low=50, high=95, scale=256, relabel=False):
    kept = []
    for i, v, y in rows:
        if i is None or y is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        v = [float(np.float32(x)) for x in v]
        kept.append((i, (y + 1) % 10 if relabel and i % 7 == 0 else y, tuple(math.floor(scale * x) for x in v)))
    out = Counter()
    for i, y, v in {r for r in kept if r[0] % step == 0}:
        scores = {(-sum(a * b for a, b in zip(v, w)), j, z == y) for j, z, w in kept if j != i and len(v) == len(w)}
        best = sorted((s, j) for s, j, same in scores if same)[:positives]
        other = sorted({(s, j) for s, j, same in scores if not same})
        for s, j in best:
            fit = [(t, k) for t, k in other if low * -s <= 100 * -t <= high * -s][:negatives]
            for rank, (t, k) in enumerate(fit, 1):
                out[i, j, rank, k, -s, -t] += 1
    return out


def mined(spark, rows, step=50, **limits):
    table = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("x") for c in ("id", "score", "rank", "block", "cell")})
    return Counter(map(tuple, H.hard_negatives(table.repartition(3), F.col("id") % step == 0, **limits).collect()))


def clustered(rng, n, dim, labels=4, centres=6):
    means = rng.normal(size=(centres, dim))
    return [(i, (means[rng.integers(centres)] * rng.choice([0.01, 1, 3]) + rng.normal(size=dim) * rng.choice([0, .05, .6]))
             .tolist(), int(rng.integers(labels))) for i in range(n)]


@pytest.mark.parametrize("dim", [2, 16])
def test_clusters_equal_brute_force(spark, monkeypatch, dim):
    monkeypatch.setattr(H, "BLOCK_ROWS", 40)
    monkeypatch.setattr(H, "CHUNK_ROWS", 9)
    rows = clustered(np.random.default_rng(dim), 700, dim)
    want = brute(rows, 10)
    assert mined(spark, rows, 10) == want and len(want) > 200


def test_ties_and_repeats(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(40)] + [(i, [0.8, 0.1], 1) for i in range(40, 80)]
    rows += rows[:25] + [(50, [1.0, 0.0], 0), (50, [0.5, 0.5], 1), (51, [0.8, 0.1], 0)]
    assert mined(spark, rows, 10) == brute(rows, 10)


def test_edge_rows(spark):
    random.seed(3)
    rows = [(0, [1.0, 1.0], 1), (1, None, 1), (2, [1.0, None], 1), (3, [float("nan"), 1.0], 1), (4, [1.0, float("inf")], 1),
            (None, [1.0, 1.0], 1), (5, [1.0, 1.0], None), (6, [], 1), (50, [], 2), (7, [0.0, 0.0], 1), (8, [-1.0, -1.0], 2),
            (100, [0.0, 0.0], 1), (9, [0.9, 0.2], 2), (10, [0.7, 0.7], 2), (11, [1.0, 0.9], 1), (12, [1.0, 2.0, 3.0], 1),
            (150, [-0.5, 0.1], 2), (13, [1e6, 1e6], 1), (200, [3e6, -1e6], 2), (14, [2e6, 1e6], 2), (250, [-0.3, -0.2], 1)]
    assert mined(spark, rows) == brute(rows)
    assert mined(spark, []) == Counter()
    assert mined(spark, [(1, [1.0], 1)]) == Counter()


def test_windows_hold_every_score(spark):
    """The score bounds: every row outside an anchor's window has a score outside the wanted ones."""
    rng = np.random.default_rng(7)
    x = np.floor(256 * rng.normal(size=(400, 6)) * rng.choice([0, .1, 1, 9], size=(400, 1))).astype(np.int64)
    directions = H._centres(x.astype(float), H.DIRECTIONS)
    angles = np.arccos(np.clip(H._unit(x.astype(float)) @ directions.T, -1, 1))

    def block(at, cell):
        at = at[np.argsort(angles[at, cell], kind="stable")]
        return H._Block(0, 6, cell, at, np.linalg.norm(x[at].astype(float), axis=1), angles[at], x[at])

    anchors, left = block(np.arange(40), 0), 0
    for cell in np.unique(angles.argmin(axis=1)):
        rows = block(np.flatnonzero(angles.argmin(axis=1) == cell), cell)
        scores = anchors.vectors @ rows.vectors.T
        for part in (0.2, 0.6, 0.9):
            low = np.sort(scores, axis=1)[:, int(part * scores.shape[1])]
            first, last = rows.windows(anchors, low, low + 5000)
            place = np.arange(len(rows.ids))
            outside = (place < first[:, None]) | (place >= last[:, None])
            assert not (outside & (scores >= low[:, None]) & (scores <= low[:, None] + 5000)).any()
            left += outside.sum()
    assert left > 0


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert Counter(map(tuple, queries.op13_hard_negatives(spark, SF).collect())) == brute(rows, relabel=True)
