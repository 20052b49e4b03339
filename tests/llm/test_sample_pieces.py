import math
import zlib
from collections import Counter

import numpy as np
import pytest

from driftlog.llm import sample_pieces as S
from driftlog.llm.queries import tokenizer_path

from .conftest import EDGE

PATH = tokenizer_path("piece_bpe_32k.model")


def segmentations(vocab, text):
    """Every segmentation of a text of usual characters, with its log weight."""
    ids = {p: i for i, p in enumerate(vocab.pieces) if p and i not in set(vocab.byte_id.tolist())}

    def cut(rest):
        if not rest:
            yield (), 0.0
        for n in range(1, len(rest) + 1):
            if rest[:n] in ids:
                i = ids[rest[:n]]
                for tail, w in cut(rest[n:]):
                    yield (i, *tail), w + vocab.weight[i]

    return dict(cut(b" " + text.encode()))


def test_draws_follow_the_lattice_without_replacement(spark):
    vocab = S.vocabulary(PATH, 1.0)
    weights = segmentations(vocab, "then")
    z = math.log(sum(map(math.exp, weights.values())))
    p = {s: math.exp(w - z) for s, w in weights.items()}
    n = 6000
    rows = spark.range(n).selectExpr("id doc_id", "'then' text")
    got = S.sampled_pieces(rows, PATH, k=3, with_ids=True).collect()
    first, second = (Counter(tuple(r.ids) for r in got if r["rank"] == k) for k in (1, 2))
    after = {s: sum(p[f] * p[s] / (1 - p[f]) for f in p if f != s) for s in p}
    for s in p:
        assert abs(first[s] / n - p[s]) < 4 * math.sqrt(p[s] / n) + 2e-3
        assert abs(second[s] / n - after[s]) < 4 * math.sqrt(after[s] / n) + 2e-3
    by_row = {}
    for r in got:
        assert math.isclose(r.log_prob, math.log(p[tuple(r.ids)]), abs_tol=1e-9)
        by_row.setdefault(r.doc_id, []).append((r.perturbed, tuple(r.ids)))
    assert all(len({ids for _, ids in x}) == 3 and sorted(x, reverse=True) == x for x in by_row.values())
    # 1 / inclusion, summed over the k drawn, estimates the number of segmentations' mass without bias
    estimate = np.mean([sum(math.exp(r.log_prob) / r.inclusion for r in got if r.doc_id == d) for d in range(300)])
    assert abs(estimate - 1) < 0.1


def test_all_segmentations_are_given_when_there_are_few(spark):
    vocab = S.vocabulary(PATH, 1.0)
    rows = spark.createDataFrame([(1, "on")], "doc_id bigint, text string")
    weights = segmentations(vocab, "on")
    got = S.sampled_pieces(rows, PATH, k=len(weights) + 5, with_ids=True).collect()
    assert {tuple(r.ids) for r in got} == set(weights) and len(got) == len(weights)
    assert all(r.inclusion == 1.0 for r in got)


@pytest.mark.parametrize("k", [1, 2, 4])
def test_decoding_gives_the_text_back(spark, edge, k):
    got = S.sampled_pieces(edge, PATH, k=k, with_ids=True).collect()
    vocab = S.vocabulary(PATH, 1.0)
    texts = Counter((i, zlib.crc32((t or "").encode())) for i, t in EDGE)
    assert Counter((r.doc_id, r.decoded_crc32) for r in got if r["rank"] == 1) == texts
    for r in got:
        assert zlib.crc32(S.decode(vocab, np.array(r.ids, dtype=np.int64))) == r.decoded_crc32
        assert len(r.ids) == r.n_pieces and zlib.crc32(np.array(r.ids, "<i4").tobytes()) == r.ids_crc32
        assert (r.doc_id, r.decoded_crc32) in texts


def test_samples_depend_on_the_row_alone(spark, documents, monkeypatch, none):
    key = lambda rows: sorted((r.doc_id, r["rank"], r.ids_crc32) for r in rows)
    a = key(S.sampled_pieces(documents.repartition(7), PATH).collect())
    assert a == key(S.sampled_pieces(documents.repartition(2), PATH).collect())
    assert a == key(S.sampled_pieces(documents.where("doc_id < 50"), PATH).unionAll(
        S.sampled_pieces(documents.where("doc_id >= 50"), PATH)).collect())
    assert len({(i, c) for i, _, c in a}) == len(a)
    assert S.sampled_pieces(none, PATH).collect() == []


def test_model_pieces_cross_no_unit():
    vocab = S.vocabulary(PATH, 1.0)
    for p in vocab.pieces:
        assert b" " not in p.lstrip(b" ") and (len(p) < 2 or not set(p) & set(b"\n\t"))


def test_workers_keep_no_lattices_after_their_tasks(spark, documents):
    def held(batches):
        import gc
        import time

        import pyarrow as pa
        from driftlog.llm.sample_pieces import Store

        rows = sum(b.num_rows for b in batches)
        time.sleep(0.3)                    # every worker gets a task
        yield pa.RecordBatch.from_pydict({"rows": [rows], "stores": [sum(isinstance(o, Store) for o in gc.get_objects())]})

    assert S.sampled_pieces(documents.repartition(8), PATH).count() > 0
    got = spark.range(16, numPartitions=16).mapInArrow(held, "rows bigint, stores bigint").collect()
    assert sum(r.rows for r in got) == 16 and sum(r.stores for r in got) == 0
