"""Adapters whose services are not available here: only the option maps are checked."""

import json

import pytest

from driftlog.sources.jdbc import jdbc_options
from driftlog.sources.kafka import kafka_frame, kafka_options, max_offsets_per_trigger


def test_kafka_fresh_start():
    o = kafka_options("b1:9092,b2:9092", "logs", group="etl")
    assert o == {"kafka.bootstrap.servers": "b1:9092,b2:9092", "subscribe": "logs",
                 "startingOffsets": "earliest", "failOnDataLoss": "true",
                 "groupIdPrefix": "etl"}


def test_kafka_resume_missing_partition_from_earliest():
    o = kafka_options("b:9092", "logs", offsets={0: 100, 2: 7}, partitions=4)
    assert json.loads(o["startingOffsets"]) == {"logs": {"0": 100, "1": -2, "2": 7, "3": -2}}


def test_kafka_rate_cap_translation():
    # 2,000 records/s/partition, 1 s batches, 6 partitions -> 12,000 per trigger
    assert max_offsets_per_trigger(2000, 6, 1) == 12000
    o = kafka_options("b:9092", "logs", rate_per_partition=1000, partitions=3, trigger_seconds=3)
    assert o["maxOffsetsPerTrigger"] == "9000"
    with pytest.raises(ValueError):
        kafka_options("b:9092", "logs", rate_per_partition=1000)


def test_jdbc_query_and_partitioned_read():
    o = jdbc_options("jdbc:mysql://db.example.com/app", "SELECT * FROM t", driver="mysql")
    assert o["query"] == "SELECT * FROM t" and o["driver"] == "com.mysql.cj.jdbc.Driver"
    p = jdbc_options("jdbc:phoenix:zk.example.com", "SELECT * FROM t", partition_column="id",
                     lower=0, upper=1000, num_partitions=8, driver="phoenix")
    assert p["dbtable"] == "(SELECT * FROM t) AS q" and p["numPartitions"] == "8"
    assert "query" not in p
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "SELECT 1", partition_column="id")


def test_kafka_frame_key_value(spark):
    df = spark.createDataFrame([(1, "a")], "id long, v string")
    [r] = kafka_frame(df, key_col="id").collect()
    assert r.key == "1" and json.loads(r.value) == {"id": 1, "v": "a"}


def test_search_index_options():
    from driftlog.streaming.sinks import search_index_options
    o = search_index_options("es1.example.com:9200", "docs", id_col="doc_id")
    assert o["es.mapping.id"] == "doc_id" and o["es.write.operation"] == "index"
    assert o["es.batch.size.entries"] == "5000" and o["es.batch.size.bytes"] == "2.5mb"
    assert "es.mapping.id" not in search_index_options("n:9200", "docs")


def test_progress_offsets_kafka_and_files():
    from driftlog.streaming.progress import progress_offsets
    prog = {"sources": [
        {"description": "KafkaV2[Subscribe[logs]]",
         "startOffset": '{"logs":{"0":10,"1":4}}', "endOffset": '{"logs":{"0":25,"1":9}}'},
        {"description": "FileStreamSource[x]", "startOffset": None, "endOffset": {"logOffset": 0}},
    ]}
    got = progress_offsets(prog)
    assert {(g["partition"], g["start"], g["end"]) for g in got if g["topic"]} == \
        {(0, 10, 25), (1, 4, 9)}
    assert any(g["topic"] is None for g in got)


def test_kafka_min_partitions_splits_hot_partitions():
    from driftlog.sources.kafka import kafka_options

    opts = kafka_options("b:9092", "t", min_partitions=2000)
    assert opts["minPartitions"] == "2000"
    assert "minPartitions" not in kafka_options("b:9092", "t")


def test_kafka_offsets_json_fills_unsaved_partitions():
    import json as _json
    from driftlog.sources.kafka import kafka_options

    o = kafka_options("b:9092", "logs", offsets='{"logs": {"1": 40}}', partitions=3)
    assert _json.loads(o["startingOffsets"]) == {"logs": {"0": -2, "1": 40, "2": -2}}
    assert kafka_options("b:9092", "logs", offsets="earliest")["startingOffsets"] == "earliest"
