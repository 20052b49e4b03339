"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; the unlabelled rows are the training
texts that are no confirmed positives, whatever their label; labelled
negatives serve the priors alone. The class prior ``pi`` is the share of toxic
rows among the labelled training rows. Taking the confirmed positives out of
the unlabelled rows leaves fewer toxic ones there: the share ``rho`` is
``pi * (texts - labelled) / (texts - positives)``. The risk of a scorer is

    pi * E_P[l(f, +1)] + (1 - pi) / (1 - rho) * max(0, E_U[l(f, -1)] - rho * E_P[l(f, -1)])

with the logistic loss ``l``. When the corrected negative part of a
minibatch falls below zero, the step goes against it instead (the
non-negative estimator), so that a flexible scorer can't fit noise.

Features are words, lower-cased (A-Z) and cut at ASCII punctuation too. The vocabulary is every word whose document
frequency is significantly higher (by ``MIN_Z`` deviations at least)
among positives than among unlabelled texts, counted by Spark over all training texts; a text's features are the
presence and the smoothed rate of each. The scorer is linear, so its score is
the logistic function of a sum, from 0 to 1. It is fitted by numpy in one
task on a documented sample: at most ``MAX_POSITIVE`` positives and
``MAX_UNLABELLED`` unlabelled training texts, those with the smallest hash of
their id, drawn from all positives and from all other training texts. Texts that share an id are one sample row. A word
of the vocabulary that none of them holds has no weight. Scoring covers every row, in an Arrow function over whole texts.

Null and empty texts have no words and score the bias alone. Without a
positive in the training rows every score is next to 0. Repeated rows score alike.
Labels, ids and other columns are never inputs of a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm.gates import build_gate, passes
from driftlog.llm.scratch import written
from driftlog.llm.words import signed, unsigned, word_slices

MAX_POSITIVE = 10_000
MAX_UNLABELLED = 30_000
MIN_POSITIVES = 3
MIN_Z = 2.2
POINTS = rb"""!"#$%&'()*+,-./:;<=>?@[\]^_`{|}~"""   # fixed: ASCII punctuation


def _word_rows(docs: DataFrame) -> DataFrame:
    """(id, w, n, total): every distinct word of every text and the text's word count."""
    def local(batches):
        for batch in batches:
            ids = batch.column(0)
            for piece in word_slices(batch.column(1), points=POINTS):
                row = piece.word_row()
                order = np.lexsort((piece.hashes, row))
                h, r = piece.hashes[order], row[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                at = np.flatnonzero(new)
                take = pa.array(r[at] + piece.row)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(take), signed(h[at]), pa.array(np.diff(np.append(at, len(h)))),
                     pa.array(np.diff(piece.word_at)[r[at]])], ["id", "w", "n", "total"])

    return docs.select("id", "text").mapInArrow(local, "id bigint, w bigint, n bigint, total bigint")


def _document_counts(texts: DataFrame) -> DataFrame:
    """(w, n): texts that hold each word."""
    def local(batches):
        for batch in batches:
            for piece in word_slices(batch.column(0), points=POINTS):
                row = piece.word_row()
                order = np.lexsort((row, piece.hashes))
                h, r = piece.hashes[order], row[order]
                new = np.ones(len(h), dtype=bool)
                new[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                key, n = np.unique(h[new], return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(key), pa.array(n)], ["w", "n"])

    return texts.select("text").mapInArrow(local, "w bigint, n bigint").groupBy("w").agg(F.sum("n").alias("n"))


def _texts_of(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of some ids; few others are shuffled.

    Never joined by a handed-out table: what reads the texts in Python would share its tasks with the function here,
    and a task with two of them holds two workers, which stay for the rest of the session.
    """
    gate = build_gate(ids.select(F.xxhash64("id").alias("key")), "key")

    def local(batches):
        bits = gate.value
        for batch in batches:
            yield batch.select(["id", "text"]).filter(pa.array(passes(bits, unsigned(batch.column(0).to_numpy()))))

    return texts.select(F.xxhash64("id").alias("key"), "id", "text").mapInArrow(local, "id bigint, text string") \
        .join(ids.hint("merge"), "id")


def _smallest(ids: DataFrame, most: int) -> DataFrame:
    return ids.orderBy(F.xxhash64("id"), "id").limit(most)


class _Rows:
    """Sparse matrix, ``value`` at (``row``, ``col``) sorted by row, as far as the fit needs one."""

    def __init__(self, row: np.ndarray, col: np.ndarray, value: np.ndarray, shape: tuple[int, int]):
        self.row, self.col, self.value, self.shape = row, col, value, shape
        self.at = np.append(0, np.cumsum(np.bincount(row, minlength=shape[0])))

    @property
    def T(self) -> "_Columns":  # noqa: N802
        return _Columns(self)

    def __getitem__(self, some: np.ndarray) -> "_Rows":
        n = np.diff(self.at)[some]
        held = np.repeat(self.at[some] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return _Rows(np.repeat(np.arange(len(some)), n), self.col[held], self.value[held], (len(some), self.shape[1]))

    def __matmul__(self, by_col: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * by_col[self.col], self.shape[0])


class _Columns:
    """Its transpose."""

    def __init__(self, rows: _Rows):
        self.rows = rows

    def __matmul__(self, by_row: np.ndarray) -> np.ndarray:
        rows = self.rows
        return np.bincount(rows.col, rows.value * by_row[rows.row], rows.shape[1])


def _risk(p: np.ndarray, u: np.ndarray, prior: float, rest: float) -> tuple[float, float]:
    """Positive part and corrected negative part of the risk of scores (logits) of positives and unlabelled rows."""
    loss = lambda f: np.logaddexp(0, f)  # noqa: E731  of label -1; of label +1 with the sign turned
    return prior * loss(-p).mean(), (1 - prior) / (1 - rest) * (loss(u).mean() - rest * loss(p).mean())


def _gradient(x_p, x_u, theta: np.ndarray, prior: float, rest: float) -> np.ndarray:
    """Direction of a step: of the whole risk, or against the corrected negative part where that is below zero."""
    p, u = x_p @ theta[:-1] + theta[-1], x_u @ theta[:-1] + theta[-1]
    chance = lambda f: 1 / (1 + np.exp(-f))

    def grad(rows, w: np.ndarray) -> np.ndarray:
        return np.append(rows.T @ w, w.sum()) / len(w)

    corrected = (1 - prior) / (1 - rest) * (grad(x_u, chance(u)) - rest * grad(x_p, chance(p)))
    if _risk(p, u, prior, rest)[1] < 0:
        return -corrected
    return prior * grad(x_p, chance(p) - 1) + corrected


def _fit(x: np.ndarray | _Rows, y: np.ndarray, prior: float, rest: float | None = None, epochs: int = 30,
         batch: int = 1024, rate: float = 0.05, decay: float = 1e-3) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear scorer, by Adam on the non-negative risk.

    ``rest``: share of toxic rows among the unlabelled ones; the prior itself where they are of the whole.
    """
    rest = prior if rest is None else rest
    rng = np.random.default_rng(11)
    pos, unl = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    theta = np.zeros(x.shape[1] + 1)
    theta[-1] = np.log(prior / (1 - prior)) if 0 < prior < 1 else 0.0
    if not len(pos) or not len(unl):
        return theta[:-1], float(theta[-1])
    m, v, t = np.zeros_like(theta), np.zeros_like(theta), 0
    steps = max(1, -(-len(unl) // batch))
    per_pos = max(1, min(len(pos), batch))
    for epoch in range(epochs):
        order = rng.permutation(len(unl))
        for k in range(steps):
            u = x[unl[order[k * batch:(k + 1) * batch]]]
            p = x[pos[rng.integers(0, len(pos), per_pos)]]
            g = _gradient(p, u, theta, prior, rest)
            g[:-1] += decay * theta[:-1]
            t += 1
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = rate * (1 - epoch / epochs) + rate * 0.02
            theta -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return theta[:-1], float(theta[-1])


def _features(n: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Value of a word found ``n`` times among ``total``: present, plus its smoothed rate."""
    return 1.0 + np.minimum(3.0, 20.0 * n / (total + 50.0))


def train(docs: DataFrame, toxic: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "toxic",
          training: Column | None = None, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED):
    """(words, weights, bias) of the scorer: sorted uint64 word hashes, their weights, the bias.

    ``training`` says, of the id column named ``id``, which rows may be learned from.
    """
    training = F.lit(True) if training is None else training
    texts = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text")).where(training)
    labels = toxic.select(F.col(id_column).cast("bigint").alias("id"), F.col(label).cast("int").alias("l")) \
        .where(training & F.col("l").isNotNull()).groupBy("id").agg(F.max("l").alias("l"))
    counts = labels.agg(F.count("*").alias("n"), F.sum("l").alias("p")).first()
    if not counts["p"]:
        return np.zeros(0, np.uint64), np.zeros(0), -np.inf
    prior = min(0.9, counts["p"] / counts["n"])
    positives = written(labels.where("l = 1").select("id"), "toxic-positives")
    unlabelled = _smallest(texts.select("id").join(positives, "id", "left_anti"), max_unlabelled)
    chosen = _smallest(positives, max_positive).withColumn("y", F.lit(1)).unionAll(unlabelled.withColumn("y", F.lit(0)))
    chosen = written(chosen, "toxic-sample")
    sample = texts.join(F.broadcast(chosen.select("id").distinct()), "id").select("id", "text")
    words = written(_word_rows(sample), "toxic-words")

    known = texts.select("id").join(labels, "id").agg(F.count("*").alias("n"), F.sum("l").alias("p")).first()
    n_pos, n_all = max(1, known["p"] or 0), texts.count()
    n_unl = max(1, n_all - n_pos)
    rest = min(prior * max(0, n_all - known["n"]) / n_unl, 0.9)
    df = (_document_counts(_texts_of(texts, positives)).withColumnRenamed("n", "p").where(F.col("p") >= MIN_POSITIVES)
          .join(_document_counts(texts), "w").withColumn("u", F.col("n") - F.col("p")))
    a, b = F.col("p") / F.lit(n_pos), F.col("u") / F.lit(n_unl)
    z = (a - b) / F.sqrt((a * (1 - a) + F.lit(1.0 / n_pos)) / F.lit(n_pos) + (b * (1 - b) + F.lit(1.0 / n_unl)) / F.lit(n_unl))
    vocabulary = df.where((a > 2 * b) & (z >= MIN_Z)).select("w")
    kept = words.join(vocabulary, "w")
    points = chosen.join(kept.groupBy("id").agg(F.collect_list(F.struct("w", "n", "total")).alias("f")), "id", "left")

    def fit(batches):
        y, row, word, value, rows = [], [], [], [], 0
        for batch in batches:
            y.append(batch.column(0).to_numpy())
            lists = batch.column(1)
            flat = lists.flatten()
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            row.append(np.repeat(np.arange(len(lengths), dtype=np.int32) + np.int32(rows), lengths))
            rows += len(lengths)
            w, n, total = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("w", "n", "total"))
            word.append(w.copy())        # not the batch's memory
            value.append(_features(n, total).astype(np.float32))
        if not rows:
            return
        word = unsigned(np.concatenate(word))
        vocab = np.unique(word)
        col = np.searchsorted(vocab, word).astype(np.int32)
        del word
        x = _Rows(np.concatenate(row), col, np.concatenate(value), (rows, max(1, len(vocab))))
        del row, col, value
        y = np.concatenate(y)
        weights, bias = _fit(x, y, prior, rest)
        yield pa.RecordBatch.from_pydict({"w": signed(vocab), "v": weights[:len(vocab)], "bias": np.full(len(vocab), bias)})

    model = points.select("y", "f").coalesce(1).mapInArrow(fit, "w bigint, v double, bias double").toArrow()
    if not model.num_rows:
        return np.zeros(0, np.uint64), np.zeros(0), float(np.log(prior / (1 - prior)))
    w = unsigned(model.column("w").to_numpy())
    order = np.argsort(w)
    return w[order], model.column("v").to_numpy()[order], float(model.column("bias")[0].as_py())


def toxicity_score(model):
    """Arrow function text -> double, the scorer's probability of label 1."""
    words, weights, bias = model

    @F.arrow_udf("double")
    def score(text: pa.Array) -> pa.Array:
        out = [np.zeros(0)]
        for piece in word_slices(text, points=POINTS):
            logit = np.full(piece.rows, bias)
            if len(words):
                place = np.minimum(np.searchsorted(words, piece.hashes), len(words) - 1)
                hit = np.flatnonzero(words[place] == piece.hashes)
                pairs, n = np.unique(piece.word_row()[hit] * len(words) + place[hit], return_counts=True)
                row, word = pairs // len(words), pairs % len(words)
                np.add.at(logit, row, weights[word] * _features(n, np.diff(piece.word_at)[row]))
            out.append(1 / (1 + np.exp(-np.clip(logit, -700, 700))))
        return pa.array(np.concatenate(out))

    return score


def score_documents(docs: DataFrame, toxic: DataFrame, training: Column | None = None, threshold: float = 0.3,
                    id_column: str = "doc_id", text: str = "text", **sample) -> DataFrame:
    """``id, score, predicted`` of every row."""
    model = train(docs, toxic, id_column, text, training=training, **sample)
    return docs.select(F.col(id_column), toxicity_score(model)(F.col(text)).alias("score")) \
        .withColumn("predicted", (F.col("score") >= threshold).cast("int"))
