from collections import Counter

import pytest
from pyspark.sql import functions as F

from driftlog.llm.line_rules import judge_lines, line_verdict

from .conftest import EDGE, WORD


def brute(text):
    """The counts of the base rules."""
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(zip(w, w[1:], w[2:]))
    repeated = {i + j for i in range(len(w) - 2) if windows[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated), failed)


def counts(r):
    return r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed


def test_counts_equal_brute_force(spark, documents):
    texts = {r.doc_id: r.text for r in documents.collect()}
    for r in judge_lines(documents).collect():
        assert counts(r) == brute(texts[r.doc_id])
        assert not (r.kept and r.base_failed)


def test_edge_rows(spark, edge, none):
    got = judge_lines(edge, with_text=True).collect()
    assert Counter((r.doc_id, *counts(r)) for r in got) == Counter((i, *brute(t)) for i, t in EDGE)
    assert judge_lines(none).collect() == []


SENTENCE = "This line has a good many ordinary words in it and it ends well."


@pytest.mark.parametrize("line, stays", [
    (SENTENCE, True), ("Ganz normaler Satz, der mit „Zitat“ endet.»", True), ("No end here", False),
    ("It ends. And then it is cut in the mid", True), ("Home | About | Contact", False), ("Next. Previous.", False),
    ("Please enable JavaScript to go on.", False), ("Buy#### now$$$$ cheap%%%%.", False), ("WOW!! SO!! GOOD!! YES!!", False),
    ("A question?", True), ("漢字の文。", True),
])
def test_rules_by_line(spark, line, stays):
    text = f"{SENTENCE}\n{line}\nAnother line of the same kind, which also ends well."
    row = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    got, = judge_lines(row, with_text=True, min_words=1).collect()
    assert (line in got.clean_text.split("\n")[1:] or line == SENTENCE and got.n_dup_lines == 1) == stays
    if not stays:
        assert got.clean_text == text.replace(line + "\n", "")


def test_documents_that_lose_too_much_go(spark):
    good = "\n".join(" ".join(f"word{i}x{j}" for j in range(14)) + "." for i in range(5))
    junk = "\n".join(f"menu {i} | page {i} | more" for i in range(30))
    rows = spark.createDataFrame([(1, good), (2, good + "\n" + junk)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in judge_lines(rows, with_text=True).collect()}
    assert got[1].kept and got[1].clean_text == good
    assert not got[2].base_failed and not got[2].kept and got[2].clean_text == good


def test_clean_documents_stay_and_junk_goes(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "quality")
    judged = docs.select("doc_id", line_verdict()(F.col("text")).alias("v")).join(labels, "doc_id").where("not v.base_failed")
    got = {r.quality: (r.kept, r.n) for r in judged.groupBy("quality").agg(
        F.sum(F.col("v.kept").cast("int")).alias("kept"), F.count("*").alias("n")).collect() if r.quality is not None}
    assert got[1][0] > 0.995 * got[1][1] and got[0][0] < 0.1 * got[0][1]
