"""Run numbers: from the store, not from a clock."""

import os
import time

from driftlog.streaming.runs import CLAIMS, claim_run, run_number
from driftlog.streaming.sinks import append_documents


def test_numbers_grow_with_the_store_whatever_the_clock_says(spark, tmp_dir, monkeypatch):
    """SNK-2: a later run is the larger one, also on a machine whose clock is behind."""
    out = f"{tmp_dir}/out"
    assert run_number(spark, f"{tmp_dir}/ck0", out) == 1
    monkeypatch.setattr(time, "time", lambda: 0.0)
    monkeypatch.setattr(time, "time_ns", lambda: 0)
    assert run_number(spark, f"{tmp_dir}/ck1", out) == 2
    assert run_number(spark, f"{tmp_dir}/ck0/", out) == 1 and run_number(spark, f"{tmp_dir}/ck1", out) == 2   # restarts
    assert sorted(n for n in os.listdir(f"{out}/{CLAIMS}") if n.isdigit()) == ["1", "2"]


def test_the_later_run_wins_with_the_clock_set_back(spark, tmp_dir, monkeypatch):
    from driftlog.operators.dedup import latest_documents
    from driftlog.streaming.sinks import read_store, upsert_documents

    for n, value in enumerate(("old", "new")):
        run = run_number(spark, f"{tmp_dir}/ck{n}", f"{tmp_dir}/kv")
        upsert_documents(spark.createDataFrame([("a", value, 1)], "doc_id string, v string, offset long"), 0, f"{tmp_dir}/kv",
                         run=run)
        monkeypatch.setattr(time, "time_ns", lambda: 0)
    assert [r.v for r in latest_documents(read_store(spark, f"{tmp_dir}/kv"), "doc_id").collect()] == ["new"]


def test_a_claimed_number_goes_to_one_query(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/b/{CLAIMS}")
    open(f"{tmp_dir}/b/{CLAIMS}/7", "w").close()
    assert claim_run(spark, [f"{tmp_dir}/a", f"{tmp_dir}/b"]) == 8       # the largest of all folders, claimed in all
    assert claim_run(spark, [f"{tmp_dir}/a"]) == 9


def test_stores_written_before_there_were_claims(spark, tmp_dir):
    rows = spark.createDataFrame([("2024-01-01", "x")], "dt string, v string")
    append_documents(rows, 0, f"{tmp_dir}/dated", ("dt",), run=1_700_000_000_000_000)
    append_documents(rows, 0, f"{tmp_dir}/plain", run=41)
    assert run_number(spark, f"{tmp_dir}/c0", f"{tmp_dir}/dated", None) == 1_700_000_000_000_001
    assert run_number(spark, f"{tmp_dir}/c1", f"{tmp_dir}/plain") == 42
    spark.createDataFrame([(5,)], "run long").coalesce(1).write.parquet(f"{tmp_dir}/c2.run")     # kept as a table
    assert run_number(spark, f"{tmp_dir}/c2", f"{tmp_dir}/plain") == 5


def test_without_a_folder_the_checkpoints_are_numbered(spark, tmp_dir):
    assert [run_number(spark, f"{tmp_dir}/c{n}") for n in range(3)] == [1, 2, 3]
