"""Topic archives as streams: offset order, caps, saved offsets, backpressure."""

import json
import time

import pytest
from pyspark.sql import functions as F

from driftlog import schemas as S
from driftlog.operators.offsets import latest_offsets, seed_offsets
from driftlog.sources.archive import (INDEX, admitted, archive_records, archive_stream, drain, index_archive, logged_offsets)
from driftlog.streaming.backpressure import RateEstimator, regulate, run_regulated
from driftlog.streaming.jobs import daily_visitors, flatten_append
from driftlog.streaming.sinks import append_documents, read_store

LEDGER_ROWS = ("topic", "partition", "from_offset", "until_offset", "batch_id")


def _records(spark, counts, topic="t", first=0):
    """``counts[p]`` records of partition p, offsets from ``first``."""
    rows = [(topic, p, first + o, None, f"k{o}", f"v{p}-{o}") for p, n in enumerate(counts) for o in range(n)]
    return spark.createDataFrame(rows, S.RECORD)


def _drain(stream, path, out, checkpoint):
    """Run to the end of the archive; the batches as lists of (partition, offset)."""
    batches = []

    def handle(batch, n):
        rows = [(r.partition, r.offset) for r in batch.collect()]
        batches.append(rows)
        append_documents(batch, n, out)

    query = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).start()
    drain(query, path, checkpoint)
    return batches


def test_shares_of_a_cap():
    first, until = {"t": {"0": 0, "1": 0, "2": 5}}, {"t": {"0": 100, "1": 1, "2": 5}}
    assert admitted({}, first, until, None) == {"t": {"0": 100, "1": 1, "2": 5}}
    end = admitted({}, first, until, 10)
    assert sum(end["t"].values()) - 5 == 10 and end["t"]["2"] == 5
    at, steps = {}, 0
    while at != until:
        after = admitted(at, first, until, 7)
        moved = sum(after["t"][p] - at.get("t", first["t"])[p] for p in after["t"])
        assert 0 < moved <= 7
        at, steps = after, steps + 1
    assert steps == -(-101 // 7)
    # a start beyond what there is waits; a new partition starts at its first record
    assert admitted({"t": {"0": 200}}, first, until, 3)["t"]["0"] == 200
    assert admitted(until, {"t": {"0": 0, "1": 0, "2": 5, "3": 7}}, {"t": {**until["t"], "3": 9}}, None)["t"]["3"] == 9


def test_archive_in_offset_order_under_a_cap(spark, tmp_dir):
    recs = _records(spark, [50, 7, 0, 20])
    archive_records(recs, f"{tmp_dir}/a", records_per_file=15)
    assert spark.read.parquet(f"{tmp_dir}/a").count() == 77
    stream = archive_stream(spark, f"{tmp_dir}/a", f"{tmp_dir}/ck", cap=20, records_per_task=6)
    batches = _drain(stream, f"{tmp_dir}/a", f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert max(map(len, batches)) <= 20 and len(batches) == 4
    assert sorted(x for b in batches for x in b) == sorted((r.partition, r.offset) for r in recs.collect())
    for p in (0, 1, 3):      # a batch begins where the one before it ended
        seen = [o for b in batches for q, o in sorted(b) if q == p]
        assert seen == list(range(len(seen)))
    got = read_store(spark, f"{tmp_dir}/out").select(*recs.columns)
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, recs.collect()), key=str)


def test_restart_goes_on_and_takes_new_files_and_partitions(spark, tmp_dir):
    a, ck, out = (f"{tmp_dir}/{n}" for n in ("a", "ck", "out"))
    archive_records(_records(spark, [9, 4]), a)
    first = _drain(archive_stream(spark, a, ck, cap=5), a, out, ck)
    assert logged_offsets(ck) == {"t": {"0": 9, "1": 4}}
    archive_records(_records(spark, [3, 0, 2], first=9), a)
    index_archive(spark, a)      # again: adds nothing
    assert spark.read.parquet(f"{a}/{INDEX}").groupBy("path", "partition").count().where("count > 1").isEmpty()
    second = _drain(archive_stream(spark, a, ck, cap=5), a, out, ck)
    got = sorted(x for b in first + second for x in b)
    assert got == sorted([(0, o) for o in range(12)] + [(1, o) for o in range(4)] + [(2, 9), (2, 10)])


def test_starts_at_given_offsets(spark, tmp_dir):
    archive_records(_records(spark, [10, 10, 10]), f"{tmp_dir}/a")
    starting = json.dumps({"t": {"0": 8, "1": -2}})
    stream = archive_stream(spark, f"{tmp_dir}/a", f"{tmp_dir}/ck", starting)
    got = _drain(stream, f"{tmp_dir}/a", f"{tmp_dir}/out", f"{tmp_dir}/ck")
    assert sorted(got[0]) == [(0, 8), (0, 9)] + [(p, o) for p in (1, 2) for o in range(10)] and len(got) == 1


def test_a_new_query_starts_at_the_ledgers_offsets(spark, tmp_dir):
    """SRC-4: the second checkpoint reads nothing of what the first one wrote."""
    a, out, led = (f"{tmp_dir}/{n}" for n in ("a", "out", "ledger"))
    for n, (counts, first) in enumerate((([6, 4], 0), ([5, 5], 6))):
        archive_records(_records(spark, counts, first=first), a)
        stream = archive_stream(spark, a, f"{tmp_dir}/ck{n}", seed_offsets(spark, led, "g", "t"))
        flatten_append(stream, out, f"{tmp_dir}/ck{n}", ledger_path=led, quarantine_path=f"{tmp_dir}/bad", group="g",
                       available_now=True).awaitTermination()
    bad = read_store(spark, f"{tmp_dir}/bad")
    assert bad.groupBy("run").count().orderBy("run").collect() == [(1, 10), (2, 10)]
    assert bad.select("partition", "offset").distinct().count() == 20
    assert {r.partition: r.until_offset for r in latest_offsets(read_store(spark, led, schema=S.LEDGER)).collect()} \
        == {0: 11, 1: 11}


def test_tasks_read_only_the_row_groups_of_their_offsets(spark, tmp_dir):
    from driftlog.sources.archive import OffsetRange, _ArchiveReader

    recs = _records(spark, [4000]).coalesce(1).sortWithinPartitions("offset")
    recs.write.option("parquet.block.size", 4096).option("parquet.page.size", 512).parquet(f"{tmp_dir}/a")
    index_archive(spark, f"{tmp_dir}/a")
    reader = _ArchiveReader({"path": f"{tmp_dir}/a", "checkpoint": f"{tmp_dir}/ck", "recordspertask": "1500"})
    parts = reader.partitions({}, reader.latestOffset())
    assert [(p.start, p.end) for p in parts] == [(0, 1500), (1500, 3000), (3000, 4000)]
    got = [o for b in reader.read(OffsetRange(parts[0].path, "t", 0, 10, 20)) for o in b.column("offset").to_pylist()]
    assert got == list(range(10, 20))
    assert not list(reader.read(OffsetRange(parts[0].path, "t", 1, 10, 20)))


# --- backpressure ---

def test_estimator_follows_the_rate():
    e = RateEstimator(trigger_seconds=2, cap=1000, least=10, headroom=1.0, smoothing=1.0)
    assert e.update(1000, 4.0, 4.0) == 500                # 250 a second, two seconds
    assert e.update(500, 1.0, 2.0) == 500                 # 500 a second, one of the two seconds is around it
    assert e.update(500, 0.05, 0.05) == 1000              # at most doubles
    assert e.update(0, 0.0, 5.0) == 1000                  # an empty batch says nothing
    assert e.update(1000, 1000.0, 1000.0) == 10           # never below the least
    for _ in range(20):
        e.update(e.cap, e.cap / 300, e.cap / 300)
    assert abs(e.cap - 600) <= 1
    with pytest.raises(ValueError):
        RateEstimator(trigger_seconds=0, cap=10)


def test_slow_batches_shrink_and_every_record_is_read_once(spark, tmp_dir):
    """SRC-5: the source asks for the cap at each batch."""
    archive_records(_records(spark, [450, 150]), f"{tmp_dir}/a")
    estimator = RateEstimator(trigger_seconds=0.5, cap=200, least=40)
    control = f"{tmp_dir}/cap.json"
    listener = regulate(spark, "slow", control, estimator)
    sizes = []

    def handle(batch, n):
        rows = batch.collect()
        sizes.append([(r.partition, r.offset) for r in rows])
        time.sleep(0.01 * len(rows))        # 100 records a second

    stream = archive_stream(spark, f"{tmp_dir}/a", f"{tmp_dir}/ck", control=control)
    query = (stream.writeStream.queryName("slow").foreachBatch(handle).option("checkpointLocation", f"{tmp_dir}/ck")
             .trigger(processingTime="500 milliseconds").start())
    try:
        drain(query, f"{tmp_dir}/a", f"{tmp_dir}/ck")
    finally:
        spark.streams.removeListener(listener)
    # a report may come after the next batch is planned: that one may still have the old cap
    assert len(sizes[0]) == 200 and len(sizes) >= 4 and max(map(len, sizes[2:])) < 100
    assert sorted(x for b in sizes for x in b) == [(0, o) for o in range(450)] + [(1, o) for o in range(150)]


def test_a_fixed_cap_is_changed_by_starting_again(spark, tmp_dir):
    """SRC-5 for sources such as Kafka: started again from the checkpoint with the next cap."""
    archive_records(_records(spark, [400]), f"{tmp_dir}/a")
    caps, seen = [], []

    def handle(batch, n):
        offsets = [r.offset for r in batch.collect()]
        time.sleep(0.01 * len(offsets))
        seen.append((n, offsets))

    def start(cap):
        caps.append(cap)
        return (archive_stream(spark, f"{tmp_dir}/a", f"{tmp_dir}/ck", cap=cap).writeStream.foreachBatch(handle)
                .option("checkpointLocation", f"{tmp_dir}/ck").trigger(processingTime="300 milliseconds").start())

    estimator = RateEstimator(trigger_seconds=0.3, cap=150, least=15)
    query = run_regulated(start, estimator, poll_seconds=0.2,
                          ended=lambda q: {o for _, b in seen for o in b} == set(range(400)))
    assert not query.isActive and caps[0] == 150 and min(caps) < 100 and len(caps) >= 2
    last = {n: offsets for n, offsets in seen}      # a batch cut short by the stop is replayed with the same offsets
    assert sorted(o for b in last.values() for o in b) == list(range(400))


# --- the ledger after a lost driver ---

def _visits(spark, path, hours, partition=0, first=0):
    day = 1704067200000
    rows = [("visits", partition, first + i, None, None,
             json.dumps({"message": {"ts": day + h * 3_600_000, "common": {"mid": f"m{i % 3}", "uid": "u"}}}))
            for i, h in enumerate(hours)]
    archive_records(spark.createDataFrame(rows, S.RECORD), path)


def _visitors(spark, tmp_dir, run_listener=True):
    from driftlog.operators.decode import decode_visitor_events

    stream = archive_stream(spark, f"{tmp_dir}/a", f"{tmp_dir}/ck")
    query = daily_visitors(decode_visitor_events(stream), f"{tmp_dir}/out", f"{tmp_dir}/ck", ledger_path=f"{tmp_dir}/led",
                           group="g", available_now=True, state_partitions=2)
    query.awaitTermination()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)


def test_a_batch_that_was_committed_but_not_reported_is_filled_in(spark, tmp_dir, monkeypatch):
    """ST-3: the driver is lost between commit and report; the next start closes the gap."""
    from driftlog.streaming.progress import OffsetLedger

    def ledger():
        rows = read_store(spark, f"{tmp_dir}/led", schema=S.LEDGER).collect()
        return sorted((r.batch_id, r.from_offset, r.until_offset) for r in rows)

    _visits(spark, f"{tmp_dir}/a", [1, 2, 3])
    _visitors(spark, tmp_dir)
    for _ in range(100):
        try:
            if ledger():
                break
        except Exception:
            pass
        time.sleep(0.1)
    assert [x[2] for x in ledger()] == [3]
    _visits(spark, f"{tmp_dir}/a", [4, 5], first=3)
    with monkeypatch.context() as m:
        m.setattr(OffsetLedger, "onQueryProgress", lambda self, event: None)     # committed, never reported
        _visitors(spark, tmp_dir)
        assert [x[2] for x in ledger()] == [3]
    _visitors(spark, tmp_dir)       # nothing new to read: filled from the checkpoint's logs
    assert [x[1:] for x in ledger()] == [(0, 3), (3, 5)] or [x[1:] for x in ledger()] == [(None, 3), (3, 5)]
    assert {r.until_offset for r in latest_offsets(read_store(spark, f"{tmp_dir}/led", schema=S.LEDGER)).collect()} == {5}
    before = ledger()
    _visitors(spark, tmp_dir)
    assert ledger() == before
