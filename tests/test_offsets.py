import json

from driftlog import schemas as S
from driftlog.operators.offsets import (latest_offsets, ledger_rows, offset_ranges, resume_from,
                                        starting_offsets_json)


def _records(spark, spec):
    rows = [("t", p, o, None, None, f"v{p}-{o}") for p, offs in spec.items() for o in offs]
    return spark.createDataFrame(rows, S.RECORD)


def test_offset_ranges(spark):
    df = _records(spark, {0: range(5, 10), 1: [0, 1, 2]})
    got = {(r.partition, r.from_offset, r.until_offset, r.records)
           for r in offset_ranges(df).collect()}
    assert got == {(0, 5, 10, 5), (1, 0, 3, 3)}


def test_latest_offsets_last_batch_wins(spark):
    ledger = spark.createDataFrame(
        [("g", "t", 0, 0, 10, 1, 0), ("g", "t", 0, 10, 25, 2, 0), ("g", "t", 1, 0, 7, 1, 0),
         ("h", "t", 0, 0, 3, 1, 0)], S.LEDGER)
    got = {(r.group, r.partition, r.until_offset) for r in latest_offsets(ledger).collect()}
    assert got == {("g", 0, 25), ("g", 1, 7), ("h", 0, 3)}


def test_ledger_rows(spark):
    ranges = offset_ranges(_records(spark, {0: [1, 2]}))
    [r] = ledger_rows(ranges, "g", 7).collect()
    assert (r.group, r.topic, r.partition, r.from_offset, r.until_offset, r.batch_id) == \
        ("g", "t", 0, 1, 3, 7)


def test_resume_skips_saved_and_reads_unsaved_partition_from_start(spark):
    """Partition 2 has no saved offset and is read from its start."""
    recs = _records(spark, {0: range(10), 1: range(10), 2: range(4)})
    saved = spark.createDataFrame([("t", 0, 7), ("t", 1, 10)], "topic string, partition int, until_offset long")
    out = resume_from(recs, saved)
    got = sorted((r.partition, r.offset) for r in out.collect())
    assert got == [(0, 7), (0, 8), (0, 9), (2, 0), (2, 1), (2, 2), (2, 3)]
    assert out.columns == recs.columns


def test_resume_runs_no_job_while_it_is_built(spark):
    recs = _records(spark, {0: range(10)})
    saved = spark.createDataFrame([("t", 0, 7)], "topic string, partition int, until_offset long")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build-resume", "none expected")
    try:
        out = resume_from(recs, saved)
        assert list(tracker.getJobIdsForGroup("build-resume")) == []
        plan = out._jdf.queryExecution().analyzed().toString()
        assert "ResolvedHint" not in plan
        assert sorted(r.offset for r in out.collect()) == [7, 8, 9]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_latest_offsets_of_a_replacing_run(spark):
    """A query on a new checkpoint counts its batches from 0 again; its positions are the later ones."""
    ledger = spark.createDataFrame(
        [("g", "t", 0, 0, 60, 0, 1), ("g", "t", 0, 60, 100, 1, 1), ("g", "t", 0, 100, 250, 0, 2)], S.LEDGER)
    [r] = latest_offsets(ledger).collect()
    assert (r.until_offset, r.batch_id) == (250, 0)
    out_of_order = spark.createDataFrame([("g", "t", 0, 50, 90, 0, 2), ("g", "t", 0, 0, 50, 1, 2)], S.LEDGER)
    [r] = latest_offsets(out_of_order, order=("run", "until_offset")).collect()
    assert r.until_offset == 90


def test_seed_offsets_needs_a_ledger_or_nothing(spark, tmp_dir):
    """Only a missing path means "no ledger yet"; something else there is an error."""
    import pytest

    from driftlog.operators.offsets import seed_offsets

    assert seed_offsets(spark, f"{tmp_dir}/none", "g", "t") == "earliest"
    with open(f"{tmp_dir}/notes.txt", "w") as f:
        f.write("no parquet")
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        seed_offsets(spark, f"{tmp_dir}/notes.txt", "g", "t")


def test_starting_offsets_json(spark):
    saved = spark.createDataFrame([("t", 0, 7), ("t", 1, 10)], "topic string, partition int, until_offset long")
    assert json.loads(starting_offsets_json(saved)) == {"t": {"0": 7, "1": 10}}


def test_seed_offsets_from_ledger_or_earliest(spark, tmp_dir):
    from driftlog.operators.offsets import seed_offsets
    from driftlog.streaming.sinks import append_offsets

    path = f"{tmp_dir}/ledger"
    assert seed_offsets(spark, path, "g", "t") == "earliest"
    recs = _records(spark, {0: range(5), 1: range(3)})
    append_offsets(offset_ranges(recs), 0, path, "g")
    assert json.loads(seed_offsets(spark, path, "g", "t")) == {"t": {"0": 5, "1": 3}}
    assert seed_offsets(spark, path, "other-group", "t") == "earliest"


def test_spread_only_when_under_partitioned(spark):
    from driftlog.operators.parallel import spread

    one = spark.range(0, 100, numPartitions=1)
    assert spread(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(0, 100, numPartitions=6)
    out = spread(many, 4)
    assert out.rdd.getNumPartitions() == 6
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
