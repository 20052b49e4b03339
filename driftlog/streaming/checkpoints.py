"""What a query's checkpoint says about its batches, read as tables.

``offset_log``: where each batch ends, by topic-partition, of sources that
have their position by topic and partition (Kafka, topic archives).
``fill_ledger``: ledger rows of committed batches that have none, for a
query whose ledger is written after the commit (a stateful query's batches
no longer hold source positions): a driver lost between commit and report
leaves no gap once the query starts again. Spark keeps the logs of the last
``spark.sql.streaming.minBatchesToRetain`` batches (100 unless set).
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftlog import schemas as S
from driftlog.operators.offsets import ledger_rows
from driftlog.sources.tables import read_if_present

_POSITIONS = "map<string,map<string,bigint>>"


def _log(spark: SparkSession, path: str) -> DataFrame | None:
    """``batch_id, value`` of a log folder: one file a batch, its name the number."""
    try:
        files = spark.read.text(path, wholetext=True)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return (files.select(F.col("_metadata.file_name").alias("name"), "value").where(F.col("name").rlike("^[0-9]+$"))
            .select(F.col("name").cast("long").alias("batch_id"), "value"))


def offset_log(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """``batch_id, topic, partition, from_offset, until_offset`` of the planned batches; None without a checkpoint.

    A log file holds a version, the batch's settings and a line per source.
    ``from_offset`` is null in the oldest batch kept.
    """
    log = _log(spark, f"{checkpoint.rstrip('/')}/offsets")
    if log is None:
        return None
    lines = F.slice(F.split("value", "\n"), 3, 1_000_000)
    sources = log.select("batch_id", F.explode(lines).alias("line")) \
        .select("batch_id", F.from_json("line", _POSITIONS).alias("topics")).where("topics is not null")
    parts = sources.select("batch_id", F.explode("topics").alias("topic", "partitions")) \
        .select("batch_id", "topic", F.explode("partitions").alias("partition", "until_offset")) \
        .where(F.col("partition").rlike("^[0-9]+$") & F.col("until_offset").isNotNull())
    before = Window.partitionBy("topic", "partition").orderBy("batch_id")     # a hundred batches a partition
    return parts.select("batch_id", "topic", F.col("partition").cast("int").alias("partition"),
                        F.lag("until_offset").over(before).alias("from_offset"), "until_offset")


def committed_batches(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    log = _log(spark, f"{checkpoint.rstrip('/')}/commits")
    return log.select("batch_id") if log is not None else None


def fill_ledger(spark: SparkSession, checkpoint: str, ledger_path: str, group: str, run: int) -> None:
    """Write the ledger rows of committed batches of this run that the ledger lacks."""
    planned, done = offset_log(spark, checkpoint), committed_batches(spark, checkpoint)
    if planned is None or done is None:
        return
    rows = planned.join(done, "batch_id").where("from_offset is null or until_offset > from_offset")
    ledger = read_if_present(spark, ledger_path, S.LEDGER)
    if ledger is not None:
        known = ledger.where((F.col("group") == group) & (F.col("run") == run)).select("topic", "batch_id").distinct()
        rows = rows.join(known, ["topic", "batch_id"], "left_anti")
    (ledger_rows(rows, group, "batch_id", run).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("group", "topic", "run", "batch_id").parquet(ledger_path))
