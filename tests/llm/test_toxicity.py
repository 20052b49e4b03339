import numpy as np
from pyspark.sql import functions as F

from driftlog.llm.toxicity import _document_counts, _fit, _gradient, _risk, _Rows, _texts_of, score_documents, train

from .conftest import EDGE


def _auc(score, y):
    rank = np.argsort(np.argsort(score)) + 1.0
    for s in np.unique(score):
        rank[score == s] = rank[score == s].mean()
    p = y == 1
    return (rank[p].sum() - p.sum() * (p.sum() + 1) / 2) / (p.sum() * (~p).sum())


def test_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    held = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 4 == 2
    got = score_documents(docs, labels, training=~held("id"))
    rows = got.join(labels.where("toxic is not null"), "doc_id").where(held("doc_id")).toPandas()
    assert _auc(rows.score.to_numpy(), rows.toxic.to_numpy()) > 0.85
    flagged = rows.predicted == 1
    assert (rows.toxic[flagged] == 1).mean() > 0.9
    assert rows.score.between(0, 1).all()


def test_labels_of_the_other_fold_change_nothing(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    held = lambda c: F.crc32(F.col(c).cast("string").cast("binary")) % 4 == 2
    flipped = labels.withColumn("toxic", F.when(held("doc_id"), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r.doc_id: r.score for r in score_documents(documents, labels, training=~held("id")).collect()}
    b = {r.doc_id: r.score for r in score_documents(documents, flipped, training=~held("id")).collect()}
    assert a == b


def test_words_are_counted_over_all_training_texts(spark):
    # 40 words, each in 50 of 2,000 positives: 1.25 of 50 sampled ones hold one
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 2000, F.concat(F.lit("plain rude"), F.col("id") % 40))
                                    .otherwise(F.lit("plain other")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") < 2000).cast("int").alias("toxic"))
    words, weights, _ = train(docs, labels, max_positive=50, max_unlabelled=200)
    assert len(words) >= 20 and (weights > 0).all()


def test_positives_beyond_the_sample_are_not_unlabelled(spark):
    docs = spark.range(1000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 600, F.lit("plain rude"))
                                    .otherwise(F.lit("plain other")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") < 600).cast("int").alias("toxic"))
    score = {r.doc_id: r.score for r in score_documents(docs, labels, max_positive=20, max_unlabelled=100).collect()}
    assert min(score[i] for i in range(600)) > max(score[i] for i in range(600, 1000)) + 0.1    # "rude" is in the vocabulary


def test_risk_stays_non_negative_and_finds_the_direction():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(3000, 5))
    y = (x[:, 0] > 1).astype(int)
    seen = (y == 1) & (rng.random(3000) < 0.5)
    w, b = _fit(x.astype(np.float32), seen.astype(int), y.mean())
    score = 1 / (1 + np.exp(-(x @ w + b)))
    assert _auc(score, y) > 0.97 and abs(score.mean() - y.mean()) < 0.15


def test_risk_and_gradient_against_the_plain_formula():
    """Loss by loss, and the gradient by differences; where the negative part is below zero, against that part."""
    rng = np.random.default_rng(3)
    signs = set()
    for case in range(12):
        p, u, prior, rest = (rng.normal(size=(30, 4)) + case % 3, rng.normal(size=(50, 4)), (0.05, 0.4, 0.9)[case % 3],
                             (0.04, 0.4, 0.7, 0.0)[case % 4])
        theta = rng.normal(size=5)

        def parts(theta, p=p, u=u, prior=prior, rest=rest):
            f = lambda x: [float(np.dot(r, theta[:-1]) + theta[-1]) for r in x]
            plus = sum(np.log(1 + np.exp(-v)) for v in f(p)) / len(p)
            minus = sum(np.log(1 + np.exp(v)) for v in f(p)) / len(p)
            negative = sum(np.log(1 + np.exp(v)) for v in f(u)) / len(u) - rest * minus
            return prior * plus, (1 - prior) / (1 - rest) * negative

        assert np.allclose(_risk(p @ theta[:-1] + theta[-1], u @ theta[:-1] + theta[-1], prior, rest), parts(theta))
        below = parts(theta)[1] < 0
        signs.add(below)
        steps = np.eye(5) * 1e-6
        slope = lambda part: np.array([(part(parts(theta + s)) - part(parts(theta - s))) / 2e-6 for s in steps])
        want = -slope(lambda x: x[1]) if below else slope(sum)
        assert np.allclose(_gradient(p, u, theta, prior, rest), want, atol=1e-6)
        sparse = [_Rows(*np.nonzero(x), x[np.nonzero(x)], x.shape) for x in (p, u)]
        assert np.allclose(_gradient(*sparse, theta, prior, rest), want, atol=1e-6)
    assert signs == {True, False}


def test_edge_rows(spark, edge, none):
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (6, 0), (99, 1)], "doc_id bigint, toxic int")
    got = score_documents(edge, labels).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (2, 3, 4)}) == 1
    no_labels = labels.limit(0)
    assert all(r.score < 1e-100 and r.predicted == 0 for r in score_documents(edge, no_labels).collect())
    assert score_documents(none, labels).collect() == []


def test_a_task_counts_the_words_of_some_texts_with_one_python_worker(spark, documents):
    texts = documents.select(F.col("doc_id").alias("id"), "text")
    ids = texts.select("id").where("id % 3 = 0").distinct()       # small enough for Spark to hand it out
    counts = _document_counts(_texts_of(texts, ids))
    got = {r.w: r.n for r in counts.collect()}
    assert got == {r.w: r.n for r in _document_counts(texts.where("id % 3 = 0")).collect()}
    plan = counts._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    upper, _, lower = plan.rpartition("MapInArrow")
    assert "MapInArrow" in upper and "Exchange" in upper[upper.rindex("MapInArrow"):] and "Scan" in lower
