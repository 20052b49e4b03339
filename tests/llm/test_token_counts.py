from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import numpy as np
import pyarrow as pa

from driftlog.llm.queries import tokenizer_path
from driftlog.llm.token_counts import _count, token_counts
from driftlog.llm.words import text_buffers

from .conftest import EDGE

PATH = tokenizer_path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def plain(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False))


def test_counts_equal_the_library(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in token_counts(documents, PATH).collect():
        n = plain(texts[r.doc_id])
        assert (r.n_tokens, r.over_limit, r.n_bytes) == (n, n > 1024, len((texts[r.doc_id] or "").encode()))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"abZ09 .,'|<>!\n\t　\xa0é漢s", "<|endoftext|>", "'s", "  ", " the"]), max_size=25).map("".join),
                max_size=4))
def test_cuts_are_safe(texts):
    data, at = text_buffers(pa.array(texts, pa.string()))
    assert _count(PATH, data, at - at[0], True).tolist() == [plain(t) for t in texts]


@pytest.mark.parametrize("name, cuts", [("byte_bpe_50k.json", True), ("byte_bpe_50k.json", False), ("piece_bpe_32k.model", False)])
def test_edge_rows(spark, edge, none, name, cuts):
    import sentencepiece

    path = tokenizer_path(name)
    if name.endswith(".model"):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = lambda t: len(model.encode(t or ""))
    else:
        count = plain
    got = token_counts(edge, path, cuts=cuts).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, count(t)) for i, t in EDGE)
    assert token_counts(none, path, cuts=cuts).collect() == []


def test_a_full_cache_changes_nothing(monkeypatch):
    from driftlog.llm import token_counts as T

    monkeypatch.setattr(T, "CACHE_PARTS", 3)
    monkeypatch.setattr(T, "_known", {})
    texts = [f"word{i} and more word{i}." for i in range(50)] * 2
    data, at = text_buffers(pa.array(texts))
    assert np.array_equal(_count(PATH, data, at, True), _count(PATH, data, at, True))
    assert _count(PATH, data, at, True).tolist() == [plain(t) for t in texts]
