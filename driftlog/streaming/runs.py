"""Run numbers: which checkpoint wrote a batch.

A streaming query's batch ids start again at 0 with every new checkpoint, so
a store or ledger that outlives a checkpoint names a batch by ``(run,
batch_id)``. A run's number is one more than the largest that the folders it
writes to have seen, whatever any clock says: it is claimed by creating a
file of that name in each folder's ``_runs``, an atomic step on HDFS-like
storage, so of two queries that start together one gets the next number. The
number is kept beside the checkpoint: a restart finds it again.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from driftlog.sources.tables import read_if_present

CLAIMS = "_runs"


def _place(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def _claimed(spark: SparkSession, folder: str) -> int:
    """Largest run a folder has seen: of its claims, or (written before there were any) of its partitions."""
    system, at = _place(spark, f"{folder}/{CLAIMS}")
    if system.exists(at):
        return max([0, *(int(s.getPath().getName()) for s in system.listStatus(at) if s.getPath().getName().isdigit())])
    found = [0]
    for between in ("", "*/", "*/*/"):      # below the folders of a day, or of a group and topic
        for status in system.globStatus(_place(spark, f"{folder}/{between}run=*")[1]) or []:
            name = status.getPath().getName().partition("=")[2]
            found += [int(name)] if name.isdigit() else []
    return max(found)


def _create(spark: SparkSession, folder: str, run: int) -> bool:
    """Claim a number; False when another query has it."""
    system, at = _place(spark, f"{folder}/{CLAIMS}/{run}")
    system.mkdirs(at.getParent())
    try:
        return system.createNewFile(at)
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False


def claim_run(spark: SparkSession, folders: list[str]) -> int:
    """A run number larger than any that one of ``folders`` has seen, claimed in all of them."""
    folders = sorted({f.rstrip("/") for f in folders})
    run = 1 + max(_claimed(spark, f) for f in folders)
    while not all(_create(spark, f, run) for f in folders):   # a number claimed in vain is never used
        run += 1
    return run


def run_number(spark: SparkSession, checkpoint: str, *folders: str | None) -> int:
    """The run of a checkpoint that writes to ``folders`` (without any: the checkpoint's own parent)."""
    checkpoint = checkpoint.rstrip("/")
    system, at = _place(spark, f"{checkpoint}.run")
    if system.exists(at):
        if system.getFileStatus(at).isDirectory():     # kept as a table by earlier versions
            return read_if_present(spark, f"{checkpoint}.run", "run long").first()["run"]
        with_text = system.open(at)
        try:
            return int(with_text.readLine())
        finally:
            with_text.close()
    run = claim_run(spark, [f for f in folders if f] or [checkpoint.rpartition("/")[0] or "."])
    _, beside = _place(spark, f"{checkpoint}.run.{run}")
    out = system.create(beside, True)
    try:
        out.writeBytes(f"{run}\n")
    finally:
        out.close()
    system.rename(beside, at)
    return run
