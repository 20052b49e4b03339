"""Source positions: per-partition offset ranges, the ledger, resume.

The streaming checkpoint is the authoritative position. The ledger is an
append-only audit table written beside the data; it also seeds the first
start of a new query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftlog import schemas as S
from driftlog.sources.tables import read_if_present


def offset_ranges(records: DataFrame, by: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """``[from_offset, until_offset)`` and row count per topic-partition.

    Audit view: when a batch ends on a gap (compacted or transactional
    topics) the source's own end offset is authoritative.
    """
    return (records.groupBy(*by, "topic", "partition")
            .agg(F.min("offset").alias("from_offset"),
                 (F.max("offset") + 1).alias("until_offset"),
                 F.count(F.lit(1)).alias("records")))


def ledger_rows(ranges: DataFrame, group: str, batch_id: int | str | None = None, run: int = 0) -> DataFrame:
    """Offset ranges -> ledger rows. ``batch_id`` is a number or a column name."""
    if isinstance(batch_id, str):
        bid = F.col(batch_id).cast("long")
    else:
        bid = F.lit(batch_id).cast("long")
    return ranges.select(
        F.lit(group).alias("group"), "topic", F.col("partition").cast("int").alias("partition"),
        "from_offset", "until_offset", bid.alias("batch_id"), F.lit(run).cast("long").alias("run"))


def latest_offsets(ledger: DataFrame, order: tuple[str, ...] = ("run", "batch_id")) -> DataFrame:
    """Next offset per (group, topic, partition): the ``until_offset`` of the last entry by ``order``.

    The default is the last batch of the latest run. With ``("run",
    "until_offset")`` it is the furthest position of the latest run, for
    sources at rest whose batches are not in offset order.
    """
    ledger = ledger if "run" in ledger.columns else ledger.withColumn("run", F.lit(0).cast("long"))
    last = F.max(F.struct(*order, F.col("until_offset").alias("_until"), F.col("batch_id").alias("_batch")))
    return (ledger.groupBy("group", "topic", "partition").agg(last.alias("_last"))
            .select("group", "topic", "partition", F.col("_last._until").alias("until_offset"),
                    F.col("_last._batch").alias("batch_id")))


def resume_from(records: DataFrame, saved: DataFrame, offset_col: str = "until_offset") -> DataFrame:
    """Records at or after the saved next offset of their topic-partition.

    A partition with no saved offset is read from its start. ``saved`` has
    ``topic, partition, <offset_col>`` with one row per topic-partition.
    Nothing runs while the plan is built: adaptive execution picks the join
    by the measured size of ``saved`` and splits a skewed record side.
    """
    side = saved.select("topic", F.col("partition").cast("int").alias("partition"),
                        F.col(offset_col).alias("_resume_at"))
    joined = records.join(side, ["topic", "partition"], "left")
    return (joined.where(F.col("_resume_at").isNull() | (F.col("offset") >= F.col("_resume_at")))
            .select(*records.columns))


def starting_offsets_json(saved: DataFrame, offset_col: str = "until_offset",
                          max_partitions: int = 100_000) -> str:
    """Kafka ``startingOffsets`` JSON from saved offsets (one row per partition).

    Kafka takes the positions as one text, so they are read to the driver;
    more than ``max_partitions`` of them raise an error.
    """
    import json

    rows = saved.select("topic", "partition", offset_col).limit(max_partitions + 1).collect()
    if len(rows) > max_partitions:
        raise ValueError("too many topic-partitions for startingOffsets")
    spec: dict[str, dict[str, int]] = {}
    for topic, partition, off in rows:
        spec.setdefault(topic, {})[str(partition)] = int(off)
    return json.dumps(spec, sort_keys=True)


def seed_offsets(spark, ledger_path: str, group: str, topic: str, max_partitions: int = 100_000) -> str:
    """``startingOffsets`` for a new query: the ledger's next offsets, else ``earliest``.

    Only a query without a checkpoint uses this; a restarted query resumes
    from its checkpoint. Reads one row per partition of ``topic``, at most
    ``max_partitions``. Only a path that does not exist counts as no ledger
    yet; a path that holds something else raises.
    """
    ledger = read_if_present(spark, ledger_path, S.LEDGER)
    if ledger is None:
        return "earliest"
    saved = latest_offsets(ledger.where((F.col("group") == group) & (F.col("topic") == topic)))
    spec = starting_offsets_json(saved, max_partitions=max_partitions)
    return "earliest" if spec == "{}" else spec
