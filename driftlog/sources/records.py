"""Bus records: building them from tables, and reading them from files.

``records_from_events`` turns each ``events`` row into the record a log
shipper would publish for that tracking hit (envelope JSON whose
``message`` is the access-log line as text, whose ``args`` carries the
URL-encoded payload). It is a narrow projection, so it scales with the
table and needs no shuffle. The field mapping:

    user_id -> uid, mid      event_type -> et, en      event_id -> d.oid
    props -> d.gs (text)     ts -> line timestamp      value -> d.st, d.amt

The other fields are filled from these too, each with values of its own, so
that every decoded column can be told from the others.

    partition = event_id mod partitions, offset = event_id div partitions
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from driftlog import schemas as S
from driftlog.functions.time import day_text, iso_text, wall_to_instant, wall_to_millis

DEFAULT_TOPIC = "tracking"
DEFAULT_PARTITIONS = 4


def _money(c: Column) -> Column:
    """A double as fixed two-decimal text (stable across engines)."""
    return c.cast("decimal(18,2)").cast("string")


def _tagged(tag: str, c: Column) -> Column:
    return F.concat(F.lit(tag), c.cast("string"))


def payload_struct() -> Column:
    """Tracking payload for an ``events`` row (before URL encoding)."""
    uid = F.col("user_id").cast("string")
    d = F.struct(
        F.col("props").alias("gs"),
        F.col("event_id").cast("string").alias("oid"),
        _money(F.col("value")).alias("st"),
        _tagged("lv", F.col("event_id") % 7).alias("lvst"),
        _tagged("web", F.col("event_id") % 5).alias("chl"),
        _tagged("po", F.col("event_id")).alias("poid"),
        F.concat(F.lit("c"), F.col("event_type")).alias("catId"),
        _tagged("sh", F.col("user_id") % 11).alias("shopId"),
        # sent by the tracker, dropped by the fact projection
        F.lit("1").alias("sq"),
        _money(F.col("value")).alias("amt"),
    )
    return F.struct(
        _tagged("shop", F.col("user_id") % 3).alias("b"),
        _tagged("h", F.col("event_id") % 2).alias("s"),
        F.col("event_type").alias("en"),
        F.col("event_type").alias("et"),
        F.concat(F.lit("https://shop.example.com/e/"), F.col("event_id").cast("string")).alias("cu"),
        _tagged("https://shop.example.com/u/", F.col("user_id")).alias("pu"),
        uid.alias("uid"),
        F.concat_ws("-", uid, day_text(F.col("ts"))).alias("sid"),
        _tagged("https://ref.example.com/", F.col("event_id") % 97).alias("ref"),
        _tagged("https://land.example.com/", F.col("event_id") % 89).alias("land"),
        d.alias("d"),
    )


def line_struct() -> Column:
    """Access-log line for an ``events`` row; ``args`` = ``params=`` + encoded payload."""
    args = F.concat(F.lit(S.ARGS_PREFIX), F.url_encode(F.to_json(payload_struct())))
    return F.struct(
        iso_text(F.col("ts")).alias("timestamp"),
        F.concat(F.lit("192.0.2."), (F.col("user_id") % 250 + 1).cast("string")).alias("client_ip"),
        F.lit("GET").alias("method"),
        F.lit("200").alias("status"),
        F.lit("track.example.com").alias("domain"),
        F.lit("").alias("http_referer"),
        F.sha2(F.col("event_id").cast("string"), 256).substr(1, 32).alias("request_id"),
        F.lit("Mozilla/5.0").alias("agent"),
        F.lit("/t.gif").alias("uri"),
        args.alias("args"),
    )


def envelope_json(line: Column, topic: str) -> Column:
    """Shipper envelope with the line as text in ``message``."""
    return F.to_json(F.struct(
        iso_text(F.col("ts"), "Z").alias("@timestamp"),
        F.struct(F.lit("shipper").alias("beat"), F.lit("line").alias("type"),
                 F.lit("1.0").alias("version"), F.lit(topic).alias("topic")).alias("@metadata"),
        F.struct(F.lit("node-a").alias("hostname"), F.lit("shipper").alias("type")).alias("agent"),
        F.struct(F.col("event_id").alias("offset"),
                 F.struct(F.lit("/logs/hits.log").alias("path")).alias("file")).alias("log"),
        F.to_json(line).alias("message"),
        F.struct(F.lit("log").alias("type")).alias("input"),
        F.struct(F.lit("node-a").alias("name")).alias("host"),
    ))


def _position(partitions: int) -> tuple[Column, Column]:
    """Partition and offset of the record of an ``events`` row."""
    return ((F.col("event_id") % partitions).cast("int"), F.floor(F.col("event_id") / partitions).cast("long"))


def in_offset_order(events: DataFrame, tasks: int, partitions: int = DEFAULT_PARTITIONS) -> DataFrame:
    """``events`` dealt and sorted as their records lie in a topic: rows of the table travel, not the larger records."""
    at = _position(partitions)
    return events.repartitionByRange(tasks, *at).sortWithinPartitions(*at)


def records_from_events(events: DataFrame, topic: str = DEFAULT_TOPIC,
                        partitions: int = DEFAULT_PARTITIONS) -> DataFrame:
    """``events`` -> bus records ``(topic, partition, offset, timestamp, key, value)``."""
    partition, offset = _position(partitions)
    return events.select(
        F.lit(topic).alias("topic"),
        partition.alias("partition"),
        offset.alias("offset"),
        wall_to_instant(F.col("ts")).alias("timestamp"),
        F.col("user_id").cast("string").alias("key"),
        envelope_json(line_struct(), topic).alias("value"),
    )


def visitor_events(events: DataFrame) -> DataFrame:
    """``events`` -> visitor events ``(ts millis, common{mid, uid, ar, ch, vc}, event_id)``."""
    uid = F.col("user_id").cast("string")
    return events.select(
        wall_to_millis(F.col("ts")).alias("ts"),
        F.struct(uid.alias("mid"), uid.alias("uid"), _tagged("ar", F.col("user_id") % 13).alias("ar"),
                 F.col("event_type").alias("ch"), F.lit("1.0").alias("vc")).alias("common"),
        F.col("event_id"),
    )


def file_records(spark: SparkSession, path: str, stream: bool = False, fmt: str = "parquet",
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """Records at rest (the offline stand-in for a topic), batch or stream.

    The schema is declared, never inferred. ``max_files_per_trigger`` bounds
    the intake per micro-batch.
    """
    if not stream:
        return spark.read.schema(S.RECORD).format(fmt).load(path)
    reader = spark.readStream.schema(S.RECORD).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def table_stream(spark: SparkSession, sf_dir: str, name: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming read of one parquet table file in a folder of tables."""
    schema = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").schema
    reader = (spark.readStream.schema(schema).format("parquet")
              .option("pathGlobFilter", f"{name}.parquet"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(sf_dir)
