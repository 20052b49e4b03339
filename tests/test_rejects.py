"""SNK-2: documents that an index would refuse, or has refused."""

import json

from pyspark.sql import functions as F

from driftlog import schemas as S
from driftlog.operators.rejects import HANDLER_EVENT, REJECT_COLUMNS, rejected_documents, split_rejected
from driftlog.sources.records import file_records, records_from_events
from driftlog.streaming import jobs
from driftlog.streaming.sinks import read_store, search_index_options
from conftest import SF_SMALL


def test_limits_in_bytes(spark):
    rows = [("a", "x" * 10, "ok", 1), (None, "x", "no id", 1), ("", "x", "empty id", 1), ("é" * 6, "x", "12 bytes", 1),
            ("é" * 5, "x", "10 bytes", 1), ("b", "é" * 11, "22 bytes", 1), ("c", "é" * 10, "20 bytes", 1), ("d", None, None, None),
            ("e", "y", "z" * 200, 1), ("f", "y", "\x01" * 60, 1)]
    df = spark.createDataFrame(rows, "id string, kw string, body string, n int")
    good, bad = split_rejected(df, "id", ["kw"], max_id=10, max_keyword=20, max_document=200)
    assert good.columns == df.columns and bad.columns == REJECT_COLUMNS
    assert sorted(r.id for r in good.collect()) == ["a", "c", "d", "é" * 5]
    assert sorted(((r.doc_id, r.reason, r.detail) for r in bad.collect()), key=str) == sorted(
        [(None, "missing_id", None), ("", "missing_id", None), ("é" * 6, "id_too_long", None),
         ("b", "keyword_too_long", "kw"), ("e", "document_too_large", None), ("f", "document_too_large", None)], key=str)
    assert {json.loads(r.document)["body"] for r in bad.collect()} >= {"no id", "z" * 200}


def test_every_row_is_on_one_side(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    good, bad = split_rejected(docs, "doc_id", ["text"], max_keyword=2000)
    assert good.count() + bad.count() == docs.count() and bad.count() > 0
    assert good.where(F.octet_length("text") > 2000).isEmpty()
    nested = docs.select("doc_id", F.array("text").alias("texts"))
    good, bad = split_rejected(nested, "doc_id", max_document=2000)
    assert good.count() + bad.count() == docs.count() and bad.count() > 0


def test_handler_options():
    opts = search_index_options("n:9200", "docs", id_col="doc_id", rejects="docs-rejected", label="etl")
    assert opts["es.write.rest.error.handlers"] == "es"
    assert opts["es.write.rest.error.handler.es.client.resource"] == "docs-rejected"
    assert opts["es.write.rest.error.handler.es.return.error"] == "ABORT"
    assert opts["es.write.rest.error.handler.es.label.job"] == "etl"
    assert "es.write.rest.error.handlers" not in search_index_options("n:9200", "docs")


def test_handler_events_become_rejects(spark):
    raw = '{"index":{"_id":"7"}}\n{"oid":"o7","b":"x"}\n'
    events = [((raw,), ("mapper_parsing_exception", "failed to parse field [b]"), {"job": "etl"}),
              (('{"oid":"o8"}',), ("version_conflict", None), {"job": "etl"}),
              ((None,), ("unknown", "m"), {"job": "etl"}), ((raw,), ("other", "job"), {"job": "x"}), (None, None, None)]
    df = spark.createDataFrame(events, HANDLER_EVENT)
    got = [tuple(r) for r in rejected_documents(df, job="etl").collect()]
    assert got == [("7", "mapper_parsing_exception", "failed to parse field [b]", '{"oid":"o7","b":"x"}'),
                   (None, "version_conflict", None, '{"oid":"o8"}'), (None, "unknown", "m", None)]
    assert [r.doc_id for r in rejected_documents(df, "oid", job="etl").collect()] == ["o7", "o8", None]
    assert rejected_documents(df).count() == 5


def test_jobs_set_rejects_aside(spark, tmp_dir, monkeypatch):
    """The index gets what it can take; the rest is kept with its reason, once over a replay."""
    records_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")).write.parquet(f"{tmp_dir}/src")
    monkeypatch.setattr(jobs, "split_rejected", lambda df, id_col, keywords: split_rejected(df, id_col, keywords, max_keyword=4))
    sent = []
    monkeypatch.setattr(jobs, "write_search_index", lambda df, nodes, index, id_col: sent.extend(r.oid for r in df.collect()))
    for job, out in ((jobs.flatten_append, "a"), (jobs.flatten_upsert, "u")):
        sent.clear()
        job(file_records(spark, f"{tmp_dir}/src", stream=True), None, f"{tmp_dir}/ck-{out}", index=("n", "i"),
            rejects_path=f"{tmp_dir}/rej-{out}", keywords=("en",), available_now=True).awaitTermination()
        en = {r.event_id: r.event_type for r in spark.read.parquet(f"{SF_SMALL}/events.parquet").collect()}
        assert sorted(sent, key=int) == sorted((str(i) for i, t in en.items() if len(t) <= 4), key=int)
        kept = read_store(spark, f"{tmp_dir}/rej-{out}")
        assert kept.count() == sum(len(t) > 4 for t in en.values()) > 0
        assert {(r.reason, r.detail) for r in kept.select("reason", "detail").distinct().collect()} == {("keyword_too_long", "en")}


def test_processing_day_is_the_batch_day(spark, tmp_dir):
    """Routed by the day of processing, as the offset log has it, not by the event's day."""
    import os
    from datetime import datetime, timezone

    records_from_events(spark.read.parquet(f"{SF_SMALL}/events.parquet")).write.parquet(f"{tmp_dir}/src")
    jobs.flatten_append(file_records(spark, f"{tmp_dir}/src", stream=True), f"{tmp_dir}/out", f"{tmp_dir}/ck",
                        partition_by=("ingest_dt",), available_now=True).awaitTermination()
    with open(f"{tmp_dir}/ck/offsets/0") as f:
        at = json.loads(f.read().split("\n")[1])["batchTimestampMs"] / 1000
    day = datetime.fromtimestamp(at, timezone.utc).strftime("%Y-%m-%d")
    assert [n for n in os.listdir(f"{tmp_dir}/out") if n.startswith("ingest_dt")] == [f"ingest_dt={day}"]
    got = read_store(spark, f"{tmp_dir}/out")
    assert got.count() == spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert set(got.columns) == set(S.DOC6_COLUMNS) | {"ingest_dt", "run", "batch_id"}
