"""Kafka source options and reader.

The Kafka connector is not bundled with PySpark; ``kafka_records`` needs
the ``spark-sql-kafka`` package on the classpath of the cluster. The option
maps are built (and tested) without it.
"""

from __future__ import annotations

import json
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def max_offsets_per_trigger(rate_per_partition: int, partitions: int, trigger_seconds: float) -> int:
    """Per-partition per-second cap -> Spark's total cap per micro-batch."""
    return int(rate_per_partition * partitions * trigger_seconds)


def kafka_options(servers: str, topic: str, group: str | None = None,
                  offsets: dict[int, int] | str | None = None,
                  rate_per_partition: int | None = None, partitions: int | None = None,
                  trigger_seconds: float | None = None,
                  min_partitions: int | None = None, headers: bool = False,
                  max_per_trigger: int | None = None) -> dict[str, str]:
    """Source options. ``headers`` (``includeHeaders``) adds the records' headers.
    ``max_per_trigger``: the records of a micro-batch, in place of a rate.

    ``min_partitions`` (Kafka ``minPartitions``): split each micro-batch's
    offset ranges into at least this many tasks. Set it to about the
    cluster's cores, so a topic-partition carrying a third of the traffic is
    read and decoded by many tasks instead of one.

    ``offsets``: next offset per partition, as a dict or as ``startingOffsets``
    JSON (e.g. from ``seed_offsets``); with ``partitions`` given, partitions
    not listed start from the earliest offset. Without
    it the stream starts from the earliest offset. The checkpoint, not the
    consumer group, decides where a restarted query resumes; ``group`` only
    labels the consumer.
    """
    opts = {"kafka.bootstrap.servers": servers, "subscribe": topic,
            "startingOffsets": "earliest", "failOnDataLoss": "true"}
    if group:
        opts["groupIdPrefix"] = group
    if offsets:
        if isinstance(offsets, str) and not offsets.lstrip().startswith("{"):
            opts["startingOffsets"] = offsets  # "earliest" / "latest"
        else:
            saved = json.loads(offsets).get(topic, {}) if isinstance(offsets, str) else offsets
            spec = {str(p): int(o) for p, o in sorted(saved.items(), key=lambda kv: int(kv[0]))}
            # Spark needs every partition listed: -2 = earliest for those with
            # no saved position (give ``partitions`` to cover them)
            for p in range(partitions or 0):
                spec.setdefault(str(p), -2)
            opts["startingOffsets"] = json.dumps({topic: spec}, sort_keys=True)
    if headers:
        opts["includeHeaders"] = "true"
    if min_partitions:
        opts["minPartitions"] = str(int(min_partitions))
    if max_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(max_per_trigger))
    elif rate_per_partition:
        if not (partitions and trigger_seconds):
            raise ValueError("rate_per_partition needs partitions and trigger_seconds")
        opts["maxOffsetsPerTrigger"] = str(
            max_offsets_per_trigger(rate_per_partition, partitions, trigger_seconds))
    return opts


def kafka_records(spark: SparkSession, servers: str, topic: str, stream: bool = True,
                  **kwargs) -> DataFrame:
    """Records ``(topic, partition, offset, timestamp, key, value)`` with text key/value, and ``headers`` if asked for."""
    from pyspark.errors import AnalysisException

    opts = kafka_options(servers, topic, **kwargs)
    reader = spark.readStream if stream else spark.read
    try:
        df = reader.format("kafka").options(**opts).load()
    except AnalysisException as e:
        if "kafka" in str(e).lower() and "data source" in str(e).lower():
            raise RuntimeError("the Kafka source needs the spark-sql-kafka package on the "
                               "classpath (spark.jars.packages); offline, use file_records") from e
        raise
    return df.select("topic", "partition", "offset", "timestamp",
                     F.col("key").cast("string").alias("key"),
                     F.col("value").cast("string").alias("value"), *["headers"] * bool(kwargs.get("headers")))


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


#: headers of a record written by ``kafka_frame``: which attempt at which source record it is
HEADERS = ("run", "batch_id", "source_topic", "source_partition", "source_offset")


def kafka_frame(df: DataFrame, value_cols: list[str] | None = None, key_col: str | None = None,
                run: int | None = None, batch_id: int | Column | None = None) -> DataFrame:
    """Rows -> ``(key, value)`` text for a topic write; value is the row as JSON.

    With ``run`` and ``batch_id`` also ``headers`` (``HEADERS``, as text) from
    the row's source position (``topic``, ``partition``, ``offset``): a batch
    written again after a failure repeats them, so that readers can drop the
    repetition (``drop_replays``).
    """
    from driftlog.functions.json import to_json_doc

    key = F.col(key_col).cast("string") if key_col else F.lit(None).cast("string")
    out = [key.alias("key"), to_json_doc(value_cols or list(df.columns)).alias("value")]
    if run is not None:
        batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
        told = zip(HEADERS, (F.lit(run), batch, F.col("topic"), F.col("partition"), F.col("offset")))
        out.append(F.array(*[F.struct(F.lit(n).alias("key"), c.cast("string").cast("binary").alias("value"))
                             for n, c in told]).alias("headers"))
    return df.select(*out)


def header_columns(records: DataFrame) -> DataFrame:
    """Records read with ``includeHeaders`` -> ``HEADERS`` as columns in place of ``headers`` (null where missing)."""
    def of(name: str) -> Column:
        return F.get(F.filter("headers", lambda h: h["key"] == name), 0)["value"].cast("string")

    kinds = dict(zip(HEADERS, ("long", "long", "string", "int", "long")))
    kept = [F.col(c) for c in records.columns if c != "headers"]
    return records.select(*kept, *[of(n).cast(kinds[n]).alias(n) for n in HEADERS])


def drop_replays(records: DataFrame, watermark: tuple[str, str] | None = None) -> DataFrame:
    """Each written record once: of records with equal headers the one with the smallest topic position.

    Records of other writers (a header missing) all stay. Batch input: a
    grouped minimum, combined before the shuffle. A stream needs
    ``watermark``, a time column and how much later a replay may come; it
    keeps the first to arrive.
    """
    told = header_columns(records)
    whole = reduce(and_, [F.col(n).isNotNull() for n in HEADERS])
    others, ours = told.where(~whole), told.where(whole)
    if told.isStreaming:
        if not watermark:
            raise ValueError("replays on a stream are dropped within a watermark")
        return (ours.withWatermark(*watermark).dropDuplicatesWithinWatermark(list(HEADERS))
                .unionByName(others.withWatermark(*watermark)))
    from driftlog.operators.dedup import pick_per_key

    return pick_per_key(ours, list(HEADERS), ["topic", "partition", "offset"]).unionByName(others)
