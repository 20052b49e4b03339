"""FLT-3: keywords promoted at write time, so that term filters skip data."""

import pytest
from pyspark.sql import functions as F

from driftlog.operators.keywords import read_keyword_store, write_keyword_store
from driftlog.operators.search import term_filter


def _docs(spark):
    rows = []
    for i in range(4000):
        objects = [(f"n{i % 7}", i), (f"rare{i}" if i % 500 == 3 else "common", i), (None, 0), (f"n{i % 7}", 1)]
        rows.append((i, f"lang{i % 40}" if i != 77 else "one", None if i % 9 == 0 else objects[: i % 5], "body " * 30 + str(i)))
    return spark.createDataFrame(rows, "id bigint, lang string, actors array<struct<name:string,n:int>>, body string")


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("store"))
    docs = _docs(spark)
    write_keyword_store(docs, path, "id", ["lang", "actors.name"], clusters=16, block_bytes=16_384)
    return path, docs


def scanned(df):
    """Rows that the scans of the documents put out: those of the row groups read."""
    df.collect()
    found = []

    def walk(plan):
        name = plan.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(plan.executedPlan())
        if "QueryStage" in name:
            return walk(plan.plan())
        if name == "FileSourceScanExec" and plan.relation().location().rootPaths().mkString().endswith("/documents"):
            found.append(plan.metrics().apply("numOutputRows").value())
        children = plan.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return sum(found)


@pytest.mark.parametrize("filters", [{}, {"lang": "lang5"}, {"lang": "one"}, {"lang": "none"}, {"actors.name": "rare503"},
                                     {"actors.name": "common"}, {"actors.name": "n3"}, {"actors.name": "n3", "lang": "lang3"},
                                     {"actors.name": "nobody"}])
def test_equals_the_plain_filter(spark, store, filters):
    path, docs = store
    got = read_keyword_store(spark, path, docs.schema, "id", filters)
    want = docs
    for field, value in filters.items():
        want = want.where(term_filter(docs, field, value))
    assert got.columns == docs.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_row_groups_are_skipped(spark, store):
    path, docs = store

    def rows(**filters):
        return scanned(read_keyword_store(spark, path, docs.schema, "id", {k.replace("__", "."): v for k, v in filters.items()}))

    everything = rows()
    assert everything == 4000
    assert 0 < rows(lang="one") < everything / 8           # one row group of one folder holds the term
    assert rows(lang="zzz") == 0
    assert 0 < rows(actors__name="rare503") <= everything / 4     # the folders of its postings alone
    assert rows(actors__name="nobody") == 0


def test_bloom_filters_are_written(spark, store):
    import glob

    import pyarrow.parquet as pq

    path, _ = store
    for folder, column in (("documents/cluster=1", "lang"), ("postings/actors.name", "_term")):
        file = next(f for f in sorted(glob.glob(f"{path}/{folder}/*.parquet")) if pq.ParquetFile(f).metadata.num_rows)
        with open(file, "rb") as f:
            size = len(f.read())
        meta = pq.ParquetFile(file).metadata
        data = sum(meta.row_group(g).column(c).total_compressed_size for g in range(meta.num_row_groups)
                   for c in range(meta.num_columns))
        assert column in meta.schema.names and size - data > 1000       # filters lie between the data and the footer


def test_a_field_of_a_plain_object_is_refused(spark, tmp_dir):
    docs = spark.range(3).select("id", F.struct(F.col("id").alias("x")).alias("s"))
    with pytest.raises(ValueError):
        write_keyword_store(docs, tmp_dir, "id", ["s.x"])


def test_empty_store(spark, tmp_dir):
    docs = _docs(spark).limit(0)
    write_keyword_store(docs, tmp_dir, "id", ["lang", "actors.name"])
    assert read_keyword_store(spark, tmp_dir, docs.schema, "id", {"lang": "x", "actors.name": "y"}).collect() == []
