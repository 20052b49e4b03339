"""Language-model scores from a probabilistic suffix tree over words.

Symbols are words (A-Z lower-cased) and one end of text. The root's
distribution is the smoothed unigram one, ``(c + 0.5) / (N + 0.5 (V + 1))``.
A context ``s`` of up to ``depth`` words predicts

    P(x | s) = max(n(sx) - D, 0) / n(s) + g(s) * P(x | s without its first word)

over the next symbols ``x`` seen at least ``min_count`` times after it (the same
count at every size), with ``g(s)`` the mass that discounting and rarer next symbols leave, so every
distribution sums to 1. A context is kept when its divergence from its
parent, ``n(s) * KL`` in nats over the training data (rarer next symbols taken
together, which can only lower it), reaches ``min_gain``, or when it is the
suffix of a kept context. A text is scored by the longest kept context at
every place, which is a sum of table values: a word's unigram, ``log g`` of
each kept context there, and a correction where its next symbol is listed.

Counting goes order by order: an n-gram is counted only where both its
(n-1)-grams are frequent enough, judged by a bitmap of fixed size
(``gates``); keys alone are counted first, and only frequent ones a second
time with their parts. Counts cover all training texts. For scoring, the
``HOT`` most frequent values of words and of contexts are handed to the
tasks (a fixed bound) and summed there; the rest are joined by key.

A null or empty text is its end token alone. Repeated rows are separate
rows. Without training rows the unigram is uniform over unknown symbols.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftlog.llm.gates import Table, build_gate, passes
from driftlog.llm.scratch import written
from driftlog.llm.words import END, Slice, mix, ngram_places, signed, unsigned, word_slices

DEPTH = 2
MIN_COUNT = 5
MIN_GAIN = 12.0
DISCOUNT = 0.75
HOT = (1 << 17, 1 << 20)   # words, context values

_U = np.uint64
#: keys of contexts and of pairs of a context and its next symbol, apart from each other and from words
STATE, PAIR = 0x53A7E00000000001, 0x0A1200000000A001


def _tokens(piece: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Words of every text followed by its end, and the row boundaries."""
    at = piece.word_at + np.arange(piece.rows + 1)
    out = np.empty(int(at[-1]), dtype=_U)
    end = np.zeros(len(out), dtype=bool)
    end[at[1:] - 1] = True
    out[end], out[~end] = _U(END), piece.hashes
    return out, at


def _joined(prefix: np.ndarray, suffix: np.ndarray) -> np.ndarray:
    """Key of the n-gram with these two (n-1)-grams."""
    with np.errstate(over="ignore"):
        return mix(prefix * _U(0x9FB21C651E98DF25) + suffix)


def _grams(tokens: np.ndarray, n: int) -> list[np.ndarray]:
    """Keys of the 1- to n-grams that start at each place."""
    out = [tokens]
    for _ in range(n - 1):
        out.append(_joined(out[-1][:-1], out[-1][1:]))
    return out


def _learned(batch: pa.RecordBatch, training: bool = True):
    """Slices of the training rows of (text, training) batches."""
    column = batch.column(0).filter(batch.column(1)) if training else batch.column(0)
    for piece in word_slices(column):
        if piece.rows:
            yield _tokens(piece)


def _word_counts(texts: DataFrame) -> DataFrame:
    def local(batches):
        for batch in batches:
            for tokens, _ in _learned(batch):
                key, n = np.unique(tokens, return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(key), pa.array(n)], ["key", "n"])

    return texts.mapInArrow(local, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def _frequent(tokens: np.ndarray, at: np.ndarray, order: int, bits: np.ndarray):
    """(keys of order, prefix keys, suffix keys) at places whose two shorter n-grams pass the gate."""
    shorter = _grams(tokens, order - 1)[-1]
    if len(shorter) < 2:
        return (np.zeros(0, _U),) * 3
    ok = ngram_places(at, order)
    pass_ = passes(bits, shorter)
    places = np.flatnonzero(ok & pass_[:-1] & pass_[1:])
    prefix, suffix = shorter[places], shorter[places + 1]
    return _joined(prefix, suffix), prefix, suffix


def _gram_counts(texts: DataFrame, order: int, shorter, min_count: int) -> DataFrame:
    """``key, prefix, suffix, n`` of every n-gram of ``order`` with ``n`` of ``min_count`` or more."""
    def keys(batches):
        for batch in batches:
            for tokens, at in _learned(batch):
                key, n = np.unique(_frequent(tokens, at, order, shorter.value)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(key), pa.array(n.astype(np.int32))], ["key", "n"])

    counted = (texts.mapInArrow(keys, "key bigint, n int").groupBy("key").agg(F.sum("n").alias("n"))
               .where(F.col("n") >= min_count))
    counted = written(counted, f"grams-{order}")
    gate = build_gate(counted, "key")

    def parts(batches):
        for batch in batches:
            for tokens, at in _learned(batch):
                key, prefix, suffix = _frequent(tokens, at, order, shorter.value)
                some = np.flatnonzero(passes(gate.value, key))
                key, first = np.unique(key[some], return_index=True)
                first = some[first]
                yield pa.RecordBatch.from_arrays([signed(key), signed(prefix[first]), signed(suffix[first])],
                                                 ["key", "prefix", "suffix"])

    named = texts.mapInArrow(parts, "key bigint, prefix bigint, suffix bigint").dropDuplicates(["key"])
    return written(named.join(counted, "key").select("key", "prefix", "suffix", "n"), f"parts-{order}")


def grow(texts: DataFrame, depth: int = DEPTH, min_count: int = MIN_COUNT, min_gain: float = MIN_GAIN) -> dict:
    """The model of (text, training) rows: ``values`` (key, kind, v, n), and the totals.

    ``kind`` 0 is a word (v: log10 of 2c + 1, over an unknown word's value),
    1 a kept context or a pair of one and its next symbol.
    """
    words = written(_word_counts(texts), "words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    z = total + 0.5 * (distinct + 1)
    gate = build_gate(words.where(F.col("n") >= min_count), "key")
    shorter = words.select("key", "n", ((F.col("n") + 0.5) / F.lit(z)).alias("p"))
    levels = []
    for order in range(2, depth + 2):
        grams = _gram_counts(texts, order, gate, min_count)
        gate = build_gate(grams, "key")
        states = (grams.groupBy("prefix").agg(F.sum("n").alias("listed"), F.count("*").alias("u"))
                  .join(shorter.select(F.col("key").alias("prefix"), F.col("n").alias("total")), "prefix")
                  .select("prefix", "total", "listed",
                          ((DISCOUNT * F.col("u") + F.col("total") - F.col("listed")) / F.col("total")).alias("g")))
        pairs = (grams.join(states, "prefix")
                 .join(shorter.select(F.col("key").alias("suffix"), F.col("p").alias("parent")), "suffix")
                 .withColumn("p", (F.col("n") - DISCOUNT) / F.col("total") + F.col("g") * F.col("parent")))
        pairs = written(pairs.select("key", "prefix", "suffix", "n", "total", "listed", "g", "parent", "p"), f"pairs-{order}")
        levels.append(pairs)
        shorter = pairs.select("key", "n", "p")
    values = words.select("key", F.lit(0).alias("kind"), F.log10(2 * F.col("n") + 1).alias("v"), "n")
    kept = None         # contexts that a longer kept one needs
    for order in range(depth + 1, 1, -1):
        pairs = levels[order - 2]
        gains = pairs.groupBy("prefix").agg(
            F.sum(F.col("n") * F.log(F.col("p") / F.col("parent"))).alias("gain"), F.first("total").alias("total"),
            F.first("listed").alias("listed"), F.first("g").alias("g"))
        passed = gains.where(F.col("gain") + (F.col("total") - F.col("listed")) * F.log("g") >= min_gain)
        chosen = passed.select("prefix") if kept is None else passed.select("prefix").unionAll(kept).distinct()
        chosen = written(gains.join(chosen, "prefix", "left_semi").select("prefix", "total", "g"), f"kept-{order}")
        listed = pairs.join(chosen.select("prefix"), "prefix", "left_semi")
        values = values.unionAll(chosen.select(
            F.col("prefix").bitwiseXOR(F.lit(STATE)), F.lit(1), F.log10("g"), "total")).unionAll(listed.select(
                F.col("key").bitwiseXOR(F.lit(PAIR)), F.lit(1), F.log10(F.col("p") / F.col("parent")) - F.log10("g"), "n"))
        if order > 2:   # the suffix of a kept context of two words or more
            kept = levels[order - 3].join(chosen.select(F.col("prefix").alias("key")), "key", "left_semi") \
                .select(F.col("suffix").alias("prefix")).distinct()
    return {"values": written(values, "values"), "total": total, "distinct": distinct, "z": z, "depth": depth}


def _hottest(values: DataFrame, kind: int, most: int):
    """Table of the most frequent rows of a kind, ``most`` of them at most, and the condition of the others."""
    rows = values.where(F.col("kind") == kind)
    step = F.floor(F.log2("n") * 16).cast("int")
    sizes = sorted(((r["step"], r["count"]) for r in rows.groupBy(step.alias("step")).count().collect()), reverse=True)
    held, least = 0, 1 << 30
    for s, n in sizes:
        if held + n > most:
            break
        held, least = held + n, s
    hot = rows.where(step >= least).select("key", "v").toArrow()
    return Table(unsigned(hot.column("key").to_numpy()), hot.column("v").to_numpy()), (F.col("kind") == kind) & (step < least)


def _sums(at: np.ndarray, values: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return np.diff(total[at])


def score_texts(texts: DataFrame, model: dict, hot: tuple[int, int] = HOT) -> DataFrame:
    """``id, n_tokens, n_known, base_score, score`` of every (text, row, id) row; ``row`` tells rows apart."""
    values, depth = model["values"], model["depth"]
    hot_words, cold_words = _hottest(values, 0, hot[0])
    hot_model, cold_model = _hottest(values, 1, hot[1])
    cold = values.where(cold_words | cold_model)
    gate, all_gate = build_gate(cold, "key"), build_gate(values.where(F.col("kind") == 1), "key")
    spark = texts.sparkSession
    id_type = texts.schema["id"].dataType
    tables = spark.sparkContext.broadcast((hot_words, hot_model))

    names = ["row", "id", "key", "n", "known", "base", "extra"]

    def local(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        bits, all_bits = gate.value, all_gate.value
        words, contexts = tables.value
        for batch in batches:
            for piece in word_slices(batch.column(0)):
                if not piece.rows:
                    continue
                tokens, at = _tokens(piece)
                row = np.repeat(np.arange(piece.rows), np.diff(at))
                found, v = words.look(tokens)
                base, known = _sums(at, v), _sums(at, found)
                tails = [(row, tokens, ~found & passes(bits, tokens))]
                extra = np.zeros(piece.rows)
                grams = _grams(tokens, depth + 1)
                for k in range(1, depth + 1):
                    n = len(grams[k])
                    if not n:
                        continue
                    ok = ngram_places(at, k + 1)
                    for keys in (grams[k - 1][:n] ^ _U(STATE), grams[k] ^ _U(PAIR)):
                        some = np.flatnonzero(passes(all_bits, keys) & ok)
                        found, v = contexts.look(keys[some])
                        extra += np.bincount(row[some], weights=v, minlength=piece.rows)
                        tails.append((row[some], keys[some], ~found & passes(bits, keys[some])))
                ids = batch.column(1).slice(piece.row, piece.rows)
                yield pa.RecordBatch.from_arrays(
                    [ids, batch.column(2).slice(piece.row, piece.rows), pa.nulls(piece.rows, pa.int64()), pa.array(np.diff(at)),
                     pa.array(known), pa.array(base), pa.array(extra)], names)
                r = np.concatenate([a[m] for a, _, m in tails])
                key = np.concatenate([b[m] for _, b, m in tails])
                order = np.lexsort((key, r))
                r, key = r[order], key[order]
                new = np.ones(len(r), dtype=bool)
                new[1:] = (r[1:] != r[:-1]) | (key[1:] != key[:-1])
                first = np.flatnonzero(new)
                n = np.diff(np.append(first, len(r)))
                none = pa.nulls(len(first), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(r[first])), pa.nulls(len(first), to_arrow_type(id_type)), signed(key[first]), pa.array(n),
                     none, none, none], names)

    parts = written(texts.select("text", "row", "id").mapInArrow(
        local, f"row bigint, id {id_type.simpleString()}, key bigint, n bigint, known double, base double, extra double"), "scored")
    tail = (parts.where(F.col("key").isNotNull()).select("row", "key", "n").join(cold.select("key", "kind", "v"), "key")
            .groupBy("row").agg(F.sum(F.when(F.col("kind") == 0, F.col("n"))).alias("t_known"),
                                F.sum(F.when(F.col("kind") == 0, F.col("n") * F.col("v"))).alias("t_base"),
                                F.sum(F.when(F.col("kind") == 1, F.col("n") * F.col("v"))).alias("t_extra")))
    own = parts.where(F.col("key").isNull()).drop("key")
    unknown = math.log10(0.5 / model["z"])
    zero = F.lit(0.0)
    base = F.col("base") + F.coalesce("t_base", zero) + F.col("n") * F.lit(unknown)
    return own.join(tail, "row", "left").select(
        "id", F.col("n").alias("n_tokens"), (F.col("known").cast("bigint") + F.coalesce("t_known", F.lit(0))).alias("n_known"),
        base.alias("base_score"), (base + F.col("extra") + F.coalesce("t_extra", zero)).alias("score"))


def score_documents(docs: DataFrame, training: Column, id_column: str = "doc_id", text: str = "text", depth: int = DEPTH,
                    min_count: int = MIN_COUNT, min_gain: float = MIN_GAIN) -> DataFrame:
    """``id, n_tokens, n_known, train_tokens, base_score, score`` of every row, learned from the ``training`` ones."""
    learn = docs.select(F.col(text).alias("text"), F.coalesce(training, F.lit(False)).alias("training"))
    model = grow(learn, depth, min_count, min_gain)
    rows = docs.select(F.col(text).alias("text"), F.monotonically_increasing_id().alias("row"), F.col(id_column).alias("id"))
    return score_texts(rows, model).select(
        F.col("id").alias(id_column), "n_tokens", "n_known", F.lit(model["total"]).cast("bigint").alias("train_tokens"),
        "base_score", "score")
