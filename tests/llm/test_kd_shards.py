import zlib

import pytest
from pyspark.sql import functions as F

from driftlog.llm.kd_shards import shard_documents

from .conftest import EDGE


def held(rows):
    """Rows by shard, with slots checked."""
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    for shard in by.values():
        assert sorted(r.slot for r in shard) == list(range(len(shard)))
    return by


def test_sizes_are_near_equal_and_equal_texts_together(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text or "" for r in docs.select("doc_id", "text").collect()}
    rows = shard_documents(docs, 10).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        body = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(body) + 16, zlib.crc32(body))
    sizes = [sum(r.size for r in s) for s in held(rows).values()]
    assert len(sizes) == 10 and max(sizes) < 1.15 * min(sizes)
    shards = {}
    for r in rows:
        shards.setdefault(r.text_crc32, set()).add(r.shard)
    assert sum(len(s) > 1 for s in shards.values()) <= 9      # at most one group a cut


@pytest.mark.parametrize("third", [1, 3])
def test_a_group_of_copies_heavier_than_a_shard_is_cut(spark, third):
    rows = spark.range(3000).select(F.col("id").alias("doc_id"),
                                    F.when(F.col("id") % 3 < third, "the same text").otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    by = held(shard_documents(rows, 8).collect())
    sizes = [sum(r.size for r in s) for s in by.values()]
    assert len(sizes) == 8 and max(sizes) < 1.2 * min(sizes)


def test_repeated_ids_split_too(spark):
    rows = spark.range(1000).select(F.lit(7).cast("bigint").alias("doc_id"), F.lit("x").alias("text"))
    by = held(shard_documents(rows, 4).collect())
    assert sorted(len(s) for s in by.values()) == [250] * 4 or max(len(s) for s in by.values()) < 300


def test_edge_rows(spark, edge, none):
    rows = shard_documents(edge, 4).collect()
    held(rows)
    assert len(rows) == len(EDGE) and all(0 <= r.shard < 4 for r in rows)
    assert sum(r.doc_id is None for r in rows) == 2 and {r.size for r in rows if r.doc_id in (2, 3)} == {16}
    assert shard_documents(none, 4).collect() == []
    one = shard_documents(edge.where("doc_id = 5"), 40).collect()
    assert len(one) == 1 and one[0].slot == 0
