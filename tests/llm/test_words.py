import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from driftlog.llm.gates import Table
from driftlog.llm.words import line_spans, ngram_places, ngrams, text_buffers, word_slices

from .conftest import EDGE, LONG, WORD, words

ALPHABET = "aAbB é—漢\u0085  \t\n\x0b\x0c\r"


def cut(texts, lower=True, most=1 << 19):
    """Words of every text, from the bytes the slices point at."""
    out = [[] for _ in texts]
    for p in word_slices(pa.array(texts, pa.string()), lower, most):
        for r in range(p.rows):
            for w in range(p.word_at[r], p.word_at[r + 1]):
                out[p.row + r].append(p.data[p.starts[w]:p.ends[w]].tobytes().decode())
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=30)), max_size=8), st.sampled_from([1, 7, 64, 1 << 19]))
def test_words_equal_the_pattern(texts, most):
    assert cut(texts, most=most) == [words(t) for t in texts]
    assert cut(texts, lower=False, most=most) == [WORD.findall(t or "") for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab \n", max_size=40), max_size=6), st.integers(1, 4))
def test_ngrams_are_equal_where_words_are(texts, k):
    seen = {}
    for p in word_slices(pa.array(texts, pa.string()), most=16):
        g, ok = ngrams(p.hashes, k), ngram_places(p.word_at, k)
        rows = [words(t) for t in texts[p.row:p.row + p.rows]]
        want = [tuple(w[i:i + k]) for w in rows for i in range(len(w) - k + 1)]
        assert ok.sum() == len(want)
        for key, gram in zip(g[ok].tolist(), want, strict=True):
            assert seen.setdefault(key, gram) == gram
    assert len(set(seen.values())) == len(seen)


def test_slices_of_a_sliced_column_and_lines():
    texts = [t for _, t in EDGE]
    column = pa.array(["x"] + texts + ["y"], pa.string()).slice(1, len(texts))
    assert [len(w) for w in cut(column.to_pylist())] == [len(words(t)) for t in texts]
    data, offsets = text_buffers(column)
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:], strict=True)] == [t or "" for t in texts]
    p, = word_slices(pa.array(["a\n\nb c\n", "", "\nd"]))
    start, end, row = line_spans(p)
    assert [(p.data[a:b].tobytes(), int(r)) for a, b, r in zip(start, end, row, strict=True)] == [(b"a", 0), (b"b c", 0), (b"d", 2)]


def test_a_word_has_one_hash_wherever_it_stands():
    a, = word_slices(pa.array(["x the y", LONG + " the"]), most=1 << 30)
    b, = word_slices(pa.array(["The"]))
    assert a.hashes[1] == b.hashes[0] == a.hashes[-1]


def test_table_finds_its_keys():
    rng = np.random.default_rng(2)
    keys = np.unique(np.append(rng.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2), np.array([0, 2**64 - 1], np.uint64)))
    table = Table(keys, np.arange(len(keys), dtype=float), 8)
    ask = np.append(keys, rng.integers(0, 2**63, 5000).astype(np.uint64))
    found, value = table.look(ask)
    assert (found == np.isin(ask, keys)).all() and (value[:len(keys)] == np.arange(len(keys))).all()
    assert not Table(keys[:0], np.zeros(0)).look(ask)[0].any()
