import duckdb
import pytest
from pyspark.sql import functions as F

from driftlog.llm.queries import QUERIES, SQL

from .conftest import EDGE, words
from .test_decontaminate import clean, smith_waterman
from .test_jaccard import brute as groups_of
from .test_line_rules import brute as base_counts

import corpus_pipeline as P

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage at sf0.01."""
    from driftlog.llm.scratch import written

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in P.STAGES:
        result = written(stage(spark, docs, SF), "t")
        out[name] = docs, result
        docs = result
    return out


def rows(frame):
    return {r.doc_id: r for r in frame.collect()}


def test_all_but_the_last_return_the_columns_of_documents(stages):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    assert [list(out.columns) == columns for _, out in stages.values()] == [True] * 4 + [False]


def test_toxic_documents_go_and_others_stay(spark, stages):
    before, after = (rows(x) for x in stages["toxicity"])
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(before) - set(after)
    assert sum(labels.get(i) == 1 for i in gone) >= 0.5 * sum(v == 1 for i, v in labels.items() if i in before)
    assert sum(labels.get(i) == 0 for i in gone) <= 0.02 * len(before)
    assert all(after[i] == before[i] for i in after)


def test_quality_rules(stages):
    before, after = (rows(x) for x in stages["quality rules"])
    assert all(base_counts(r.text)[5] for i, r in before.items() if i not in after and base_counts(r.text)[0] < 50)
    for i, r in after.items():
        assert not base_counts(before[i].text)[5]
        assert set(r.text.split("\n")) <= set(before[i].text.split("\n")) and r.n_chars == len(r.text)
        assert 2 * len(words(r.text)) >= len(words(before[i].text))


def test_one_of_each_group_stays(stages):
    before, after = (rows(x) for x in stages["near duplicates"])
    groups = groups_of([(i, r.text) for i, r in before.items()], 5, 80, 100)
    assert set(after) == {i for i, (_, c) in groups.items() if i == c}


def test_decontamination(spark, stages):
    before, after = (rows(x) for x in stages["benchmark decontamination"])
    items = [clean(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, r in before.items():
        text = clean(r.text)
        whole = any(f" {' '.join(x)} " in f" {' '.join(text)} " for x in items)
        if whole:
            assert i not in after
        elif i not in after:
            assert max(smith_waterman(x, text) for x in items) >= 0.5


def test_samples(stages):
    before, after = stages["sampled segmentations"]
    kept, out = rows(before), after.collect()
    assert {r.doc_id for r in out} == set(kept) and len({(r.doc_id, r.ids_crc32) for r in out}) == len(out)


def test_run_equals_the_stages(spark, stages):
    key = lambda f: sorted((r.doc_id, r["rank"], r.ids_crc32) for r in f.collect())
    assert key(P.run(spark, SF)) == key(stages["sampled segmentations"][1])


def test_edge_rows(spark, edge, none):
    columns = edge.selectExpr("*", "0L n_chars", "lang source")
    for name, stage in P.STAGES:
        empty = none.selectExpr("*", "text lang", "text source", "doc_id n_chars")
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0
        got = stage(spark, columns, "/root/testdata/sf0.001")
        if name != P.STAGES[-1][0]:
            assert got.columns == columns.columns
        got = got.collect()
        if name == "near duplicates":
            ids = [r.doc_id for r in got]
            assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 11, 12] and ids.count(None) == 2
        elif name == "benchmark decontamination":
            assert len(got) == len(EDGE)


def test_repeated_ids_keep_their_different_texts(spark):
    text = {n: " ".join(f"{n}{i}" for i in range(60)) for n in "abcd"}
    rows = [(1, text["a"]), (2, text["b"]), (2, text["a"] + " end"), (3, text["c"]), (3, text["d"]), (None, text["d"]),
            (None, text["a"] + " tail"), (4, None), (4, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = P.drop_near_duplicates(spark, docs, SF).collect()
    assert sorted(map(str, got)) == sorted(map(str, docs.where("text is null").collect()
                                               + [docs.collect()[i] for i in (0, 1, 3, 4)]))


def test_columns_that_stages_might_add(spark):
    text = "\n".join(" ".join(f"word{i}of{j}" for j in range(12)) + "." for i in range(9))
    docs = spark.createDataFrame([(1, text, "x", "y")], "doc_id bigint, text string, verdict string, _verdict string") \
        .withColumns({"row": F.lit("r"), "_row": F.lit("s"), "n_chars": F.lit(0).cast("bigint"), "component_id": F.lit("c")})
    for stage in (P.clean_lines, P.drop_near_duplicates):
        got = stage(spark, docs, SF)
        assert got.columns == docs.columns and [(r.verdict, r._verdict, r.row, r.text) for r in got.collect()] == [("x", "y", "r", text)]


def test_sql_of_the_queries(spark):
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    for name, sql in SQL.items():
        got = QUERIES[name](spark, SF)
        want = con.sql(f"select {', '.join(got.columns)} from ({sql})").fetchall()
        assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
