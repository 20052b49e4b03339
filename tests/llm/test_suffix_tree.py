import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from driftlog.llm.suffix_tree import grow, score_documents, score_texts

from .conftest import EDGE, words


def brute(texts, train, depth, min_count, min_gain, discount=0.75):
    """(n_tokens, n_known, N, base, score) of every text, by dictionaries."""
    texts = [tuple(words(t)) + ("\n",) for t in texts]
    learn = [t for t, ok in zip(texts, train, strict=True) if ok]
    c = [None] + [Counter(t[i:i + k] for t in learn for i in range(len(t) - k + 1)) for k in range(1, depth + 2)]
    total = sum(c[1].values())
    z = total + 0.5 * (len(c[1]) + 1)
    listed = defaultdict(list)
    for k in range(2, depth + 2):
        for g, n in c[k].items():
            if n >= min_count:
                listed[g[:-1]].append((g, n))
    p, parent, left = {}, {}, {}
    for k in range(1, depth + 1):
        for s in [s for s in listed if len(s) == k]:
            n_s = c[k][s]
            left[s] = (discount * len(listed[s]) + n_s - sum(n for _, n in listed[s])) / n_s
            for g, n in listed[s]:
                parent[g] = (c[1][g[-1:]] + 0.5) / z if k == 1 else p[g[1:]]
                p[g] = (n - discount) / n_s + left[s] * parent[g]
    kept = set()
    for s, gs in listed.items():
        gain = sum(n * math.log(p[g] / parent[g]) for g, n in gs) + (c[len(s)][s] - sum(n for _, n in gs)) * math.log(left[s])
        if gain >= min_gain:
            kept |= {s[j:] for j in range(len(s))}
    out = []
    for t in texts:
        base = score = 0.0
        for i, x in enumerate(t):
            q = (c[1][(x,)] + 0.5) / z
            base += math.log10(q)
            for k in range(1, min(i, depth) + 1):
                s = t[i - k:i]
                if s not in kept:
                    break
                q = p.get(s + (x,)) or left[s] * q
            score += math.log10(q)
        out.append((len(t), sum((x,) in c[1] for x in t), total, base, score))
    return out


def fold(c):
    return F.coalesce(F.crc32(F.col(c).cast("string").cast("binary")) % 5 != 1, F.lit(True))


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_scores_equal_brute_force(spark, documents, depth):
    rows = documents.select("doc_id", "text").collect()
    train = [zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for r in rows]
    expected = dict(zip([r.doc_id for r in rows], brute([r.text for r in rows], train, depth, 3, 5.0), strict=True))
    got = score_documents(documents, fold("doc_id"), depth=depth, min_count=3, min_gain=5.0).collect()
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = expected[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and math.isclose(r.score, score, rel_tol=1e-8)


def test_joined_tail_equals_handed_out_tables(spark, documents):
    model = grow(documents.select("text", fold("doc_id").alias("training")), min_count=3, min_gain=5.0)
    rows = documents.select("text", F.col("doc_id").alias("row"), F.col("doc_id").alias("id"))
    a = {r.id: r for r in score_texts(rows, model).collect()}
    b = {r.id: r for r in score_texts(rows, model, hot=(50, 50)).collect()}
    for i, r in a.items():
        assert (r.n_tokens, r.n_known) == (b[i].n_tokens, b[i].n_known)
        assert math.isclose(r.score, b[i].score, rel_tol=1e-9) and math.isclose(r.base_score, b[i].base_score, rel_tol=1e-9)


def test_contexts_help_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = score_documents(docs, fold("doc_id")).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 1]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_the_count_threshold_does_not_rise_with_the_corpus(spark):
    common = spark.range(51, numPartitions=51).select(F.expr("repeat('a ', 1000000)").alias("text"))    # 51 million words
    rare = spark.range(5).select(F.lit("qx qy").alias("text"))
    model = grow(common.unionAll(rare).withColumn("training", F.lit(True)))
    one = spark.createDataFrame([("qx qy", 1, 1)], "text string, row bigint, id bigint")
    got = score_texts(one, model).first()
    assert model["total"] > 50_000_000 and got.score > got.base_score + 5


def test_edge_rows(spark, edge):
    got = score_documents(edge, F.lit(True), min_count=2, min_gain=1.0).collect()
    expected = brute([t for _, t in EDGE], [True] * len(EDGE), 2, 2, 1.0)
    key = lambda r: (r[0] is None, r[0] or 0, round(r[4], 6))
    want = sorted(((i, *e[:2], e[3], e[4]) for (i, _), e in zip(EDGE, expected, strict=True)), key=key)
    have = sorted(((r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score) for r in got), key=key)
    for w, h in zip(want, have, strict=True):
        assert w[:3] == h[:3] and all(math.isclose(x, y, rel_tol=1e-8) for x, y in zip(w[3:], h[3:], strict=True))


def test_empty_table_and_nothing_to_learn_from(spark, none, edge):
    assert score_documents(none, F.lit(True)).collect() == []
    rows = score_documents(edge, F.lit(False)).collect()
    assert len(rows) == len(EDGE) and all(r.n_known == 0 and r.train_tokens == 0 and r.score == r.base_score for r in rows)
