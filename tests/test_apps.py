"""Command-line jobs over records at rest, with availableNow."""

import pytest
from pyspark.sql import functions as F

from driftlog import schemas as S
from driftlog.apps import run
from driftlog.operators.dedup import daily_first_seen, latest_documents
from driftlog.operators.offsets import latest_offsets
from driftlog.operators.project import decode_fact
from driftlog.sources.records import records_from_events, visitor_events
from driftlog.streaming.jobs import read_visitors
from driftlog.streaming.sinks import read_store
from conftest import SF_SMALL

EVENTS = f"{SF_SMALL}/events.parquet"


def _records(spark, path):
    records_from_events(spark.read.parquet(EVENTS)).repartition(2, "partition").write.parquet(path)
    return spark.read.parquet(path)


def test_append_with_ledger_and_quarantine(spark, tmp_dir):
    recs = _records(spark, f"{tmp_dir}/src")
    q = run(["append", "--files", f"{tmp_dir}/src", "--out", f"{tmp_dir}/docs",
             "--ledger", f"{tmp_dir}/ledger", "--quarantine", f"{tmp_dir}/bad",
             "--checkpoint", f"{tmp_dir}/ck", "--available-now"])
    q.awaitTermination()
    docs = read_store(spark, f"{tmp_dir}/docs")
    assert docs.count() == decode_fact(recs).count() == recs.count()
    assert set(docs.columns) == set(S.DOC6_COLUMNS) | {"dt", "run", "batch_id"}
    got = {r.partition: r.until_offset for r in
           latest_offsets(read_store(spark, f"{tmp_dir}/ledger")).collect()}
    want = {r.partition: r.m + 1 for r in recs.groupBy("partition").agg(F.max("offset").alias("m"))
            .collect()}
    assert got == want


def test_upsert_keys_by_position(spark, tmp_dir):
    recs = _records(spark, f"{tmp_dir}/src")
    run(["upsert", "--files", f"{tmp_dir}/src", "--out", f"{tmp_dir}/kv",
         "--checkpoint", f"{tmp_dir}/ck", "--available-now"]).awaitTermination()
    kv = latest_documents(read_store(spark, f"{tmp_dir}/kv"), "doc_id")
    assert kv.count() == recs.count()


def test_visitors_from_records_with_object_message(spark, tmp_dir):
    ev = spark.read.parquet(EVENTS)
    vis = visitor_events(ev)
    recs = vis.select(
        F.lit("visits").alias("topic"), F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"), F.lit(None).cast("timestamp").alias("timestamp"),
        F.lit(None).cast("string").alias("key"),
        F.to_json(F.struct(F.struct("ts", "common").alias("message"))).alias("value"))
    recs.unionByName(recs.limit(3).withColumn("value", F.lit("not json"))) \
        .write.parquet(f"{tmp_dir}/src")
    run(["visitors", "--files", f"{tmp_dir}/src", "--out", f"{tmp_dir}/vis",
         "--checkpoint", f"{tmp_dir}/ck", "--state-partitions", "2",
         "--available-now"]).awaitTermination()
    got = {(r.dt, r.mid) for r in read_visitors(spark, f"{tmp_dir}/vis").collect()}
    batch = daily_first_seen(vis.withColumn("mid", F.col("common.mid")), "mid", "ts")
    assert got == {(r.dt, r.mid) for r in batch.collect()}


def test_index_sink_and_cadence_arguments(spark, tmp_dir, monkeypatch):
    """``--index`` sends each batch to the index writer, keyed by position; no server here."""
    from driftlog.apps import trigger_seconds
    from driftlog.streaming import jobs

    sent = []
    monkeypatch.setattr(jobs, "write_search_index",
                        lambda df, nodes, index, id_col=None: sent.append((nodes, index, id_col, df.columns, df.count())))
    recs = _records(spark, f"{tmp_dir}/src")
    for job in ("append", "upsert"):
        run([job, "--files", f"{tmp_dir}/src", "--index-nodes", "n:9200", "--index", "docs",
             "--checkpoint", f"{tmp_dir}/ck-{job}", "--available-now"]).awaitTermination()
    assert [s[:3] + s[4:] for s in sent] == [("n:9200", "docs", "doc_id", recs.count())] * 2
    assert sent[0][3] == ["doc_id", *S.DOC6_COLUMNS] and sent[1][3] == ["doc_id", *S.FACT_COLUMNS]
    assert trigger_seconds("append", False) == 3.0 and trigger_seconds("append", True) == 1.0
    assert trigger_seconds("upsert", True) == 3.0
    with pytest.raises(SystemExit):
        run(["append", "--files", tmp_dir, "--index", "docs"])


def test_jobs_seed_a_new_query_from_the_ledger(spark, tmp_dir, monkeypatch):
    """All three jobs start a new query at the ledger's positions (the source itself needs a broker)."""
    from driftlog import apps
    from driftlog.operators.offsets import offset_ranges
    from driftlog.streaming.sinks import append_offsets

    led = f"{tmp_dir}/led"
    append_offsets(offset_ranges(_records(spark, f"{tmp_dir}/src").withColumn("topic", F.lit("logs"))), 0, led, "g")
    seen = []

    class Stop(Exception):
        pass

    def stop(spark, a, starting=None):
        seen.append((a.job, starting))
        raise Stop

    monkeypatch.setattr(apps, "_records", stop)
    for job in ("append", "upsert", "visitors"):
        with pytest.raises(Stop):
            run([job, "--servers", "b:9092", "--topic", "logs", "--group", "g", "--ledger", led, "--out", f"{tmp_dir}/o"])
    assert [j for j, _ in seen] == ["append", "upsert", "visitors"]
    assert all('"logs"' in s for _, s in seen)


def test_visitors_quarantine(spark, tmp_dir):
    import json

    good = {"ts": 1704100000000, "common": {"mid": "m", "uid": "u", "ar": "a", "ch": "c", "vc": "1"}}
    values = [json.dumps({"message": m}) for m in
              (good, {"common": good["common"]}, {"ts": 1}, {"ts": 1, "common": {"uid": "u"}}, "no")] + ["junk"]
    spark.createDataFrame([("visits", 0, i, None, None, v) for i, v in enumerate(values)], S.RECORD) \
        .write.parquet(f"{tmp_dir}/src")
    run(["visitors", "--files", f"{tmp_dir}/src", "--out", f"{tmp_dir}/vis", "--quarantine", f"{tmp_dir}/bad",
         "--checkpoint", f"{tmp_dir}/ck", "--state-partitions", "2", "--available-now"]).awaitTermination()
    assert [r.mid for r in read_visitors(spark, f"{tmp_dir}/vis").collect()] == ["m"]
    bad = {r.offset: r.reason for r in read_store(spark, f"{tmp_dir}/bad").collect()}
    assert bad == {1: "missing_ts", 2: "missing_mid", 3: "missing_mid", 4: "bad_message", 5: "bad_envelope"}


def test_source_is_required(spark, tmp_dir):
    with pytest.raises(SystemExit):
        run(["append", "--out", f"{tmp_dir}/x"])
    with pytest.raises(SystemExit):
        run(["append", "--servers", "b:9092", "--files", tmp_dir, "--topic", "t", "--out", tmp_dir])


def test_archive_with_ledger_cap_and_backpressure(spark, tmp_dir):
    """An archived topic, capped and regulated; then a fresh checkpoint goes on at the ledger's offsets."""
    from driftlog.sources.archive import archive_records, drain

    recs = records_from_events(spark.read.parquet(EVENTS))
    archive_records(recs.where("offset < 100"), f"{tmp_dir}/topic")
    common = ["append", "--archive", f"{tmp_dir}/topic", "--topic", "tracking", "--out", f"{tmp_dir}/docs",
              "--ledger", f"{tmp_dir}/ledger", "--trigger", "0.2"]
    query = run([*common, "--checkpoint", f"{tmp_dir}/ck0", "--cap", "150", "--backpressure"])
    drain(query, f"{tmp_dir}/topic", f"{tmp_dir}/ck0")
    assert read_store(spark, f"{tmp_dir}/docs").count() == 400
    archive_records(recs.where("offset >= 100"), f"{tmp_dir}/topic")
    run([*common, "--checkpoint", f"{tmp_dir}/ck1", "--available-now"]).awaitTermination()
    docs = read_store(spark, f"{tmp_dir}/docs", schema="oid string, run long")
    assert docs.count() == recs.count() and docs.select("oid").distinct().count() == recs.count()
    for wrong in (["--files", "x"], ["--backpressure"]):
        with pytest.raises(SystemExit):
            run([*common, *wrong])
