"""Sinks. Document writes are idempotent per micro-batch.

Each micro-batch writes into its own ``(run, batch_id)`` partition with
dynamic partition overwrite, so a batch replayed after a failure (same id,
same offsets, by the checkpoint's contract) replaces exactly what its first
attempt wrote, and a query on a new checkpoint (a new run, see
``streaming.runs``) never touches what an earlier one wrote. Upserts are a
read-time view (``latest_documents``): the latest run per id wins, then the
highest ``batch_id``, then the highest source offset.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, functions as F
from pyspark.sql.streaming import DataStreamWriter

from driftlog.operators.offsets import ledger_rows
from driftlog.sources.kafka import kafka_frame, kafka_sink_options


def _write_batch(df: DataFrame, batch_id: int, path: str, partition_by=(), fmt: str = "parquet", run: int = 0,
                 files: int | None = None):
    out = df.withColumn("run", F.lit(run).cast("long")).withColumn("batch_id", F.lit(batch_id).cast("long"))
    if files:
        out = out.coalesce(files)
    (out.write.mode("overwrite")
       .option("partitionOverwriteMode", "dynamic")
       .partitionBy(*partition_by, "run", "batch_id")
       .format(fmt)
       .save(path))


def append_documents(df: DataFrame, batch_id: int, path: str, partition_by=(),
                     fmt: str = "parquet", run: int = 0, files: int | None = None) -> None:
    """Write one micro-batch of documents under ``(run, batch_id)`` (replay-safe).

    ``files`` merges the batch's tasks without a shuffle, so that it leaves
    at most that many files in a partition folder.
    """
    _write_batch(df, batch_id, path, partition_by, fmt, run, files)


def upsert_documents(df: DataFrame, batch_id: int, path: str, id_col: str = "doc_id",
                     partition_by=(), fmt: str = "parquet", run: int = 0, files: int | None = None) -> None:
    """Write a batch of keyed documents; read the current state with ``latest_documents``.

    Keep an ``offset`` column (or another unique order) in ``df`` so ties
    inside one batch resolve deterministically.
    """
    if id_col not in df.columns:
        raise ValueError(f"upsert needs the id column {id_col!r}")
    _write_batch(df, batch_id, path, partition_by, fmt, run, files)


def append_offsets(ranges: DataFrame, batch_id: int, path: str, group: str, run: int = 0) -> None:
    """Ledger rows of one batch (after its data is written); replay-safe.

    A partition folder per group, topic, run and batch: groups and topics may share a ledger.
    """
    ledger = ledger_rows(ranges, group, batch_id).drop("batch_id", "run")
    _write_batch(ledger, batch_id, path, ("group", "topic"), run=run)


def with_write_metrics(df: DataFrame, name: str = "written",
                       more: dict[str, Column] | None = None) -> tuple[DataFrame, Observation | str]:
    """Count rows as they pass, without a second job; ``more`` names further aggregates.

    Batch: returns ``(df, Observation)``; read ``obs.get["rows"]`` after the
    write. Stream: returns ``(df, name)``; the count appears in the
    query progress ``observedMetrics[name]``.
    """
    metrics = [F.count(F.lit(1)).alias("rows"), *[m.alias(n) for n, m in (more or {}).items()]]
    if df.isStreaming:
        return df.observe(name, *metrics), name
    obs = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(obs, *metrics), obs


def console_sink(df: DataFrame, n: int = 20) -> DataStreamWriter | None:
    """Print up to ``n`` rows per batch (stream) or once (batch)."""
    if df.isStreaming:
        return (df.writeStream.format("console").option("numRows", str(n))
                .option("truncate", "false"))
    df.show(n, truncate=False)
    return None


def kafka_sink(df: DataFrame, servers: str, topic: str, key_col: str | None = None,
               checkpoint: str | None = None):
    """Rows as JSON values to a topic. Needs the Kafka connector on the classpath.

    Stream: returns the configured ``DataStreamWriter`` (call ``start()``).
    Batch: writes immediately.
    """
    out = kafka_frame(df, key_col=key_col)
    opts = kafka_sink_options(servers, topic)
    if df.isStreaming:
        if not checkpoint:
            raise ValueError("a streaming topic write needs a checkpoint location")
        return (out.writeStream.format("kafka").options(**opts)
                .option("checkpointLocation", checkpoint))
    out.write.format("kafka").options(**opts).save()
    return None


def publish_batch(df: DataFrame, batch_id: int, servers: str, topic: str, run: int, key_col: str | None = None,
                  value_cols: list[str] | None = None, fmt: str = "kafka") -> None:
    """Write a micro-batch to a topic, each record with the run, batch and source position it comes from.

    A topic cannot be overwritten, so a replayed batch is there twice; readers
    drop the repetition by these headers (``sources.kafka.drop_replays``). ``df``
    keeps its ``topic``, ``partition`` and ``offset``.
    """
    values = value_cols or [c for c in df.columns if c not in ("topic", "partition", "offset")]
    frame = kafka_frame(df, values, key_col, run, batch_id)
    frame.write.format(fmt).options(**kafka_sink_options(servers, topic)).mode("append").save()


# Partition columns the sinks write, with the type they had before writing.
STORE_PARTITION_TYPES = {"dt": "string", "ingest_dt": "string", "group": "string", "topic": "string", "run": "long", "batch_id": "long"}


def read_store(spark, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """Read a store written by these sinks, with a declared ``schema`` where the caller has one.

    Without one, partition discovery would turn a ``dt`` folder value into a date; cast
    the sinks' partition columns back to their written types. Filters on
    them still prune folders.
    """
    if schema is not None:
        return spark.read.schema(schema).format(fmt).load(path)
    df = spark.read.format(fmt).load(path)
    for c, t in STORE_PARTITION_TYPES.items():
        if c in df.columns:
            df = df.withColumn(c, F.col(c).cast(t))
    return df


def search_index_options(nodes: str, index: str, id_col: str | None = None,
                         batch_entries: int = 5000, batch_bytes: str = "2.5mb",
                         refresh: bool = False, auto_create: bool = True,
                         rejects: str | None = None, label: str | None = None) -> dict[str, str]:
    """Options for the Elasticsearch Spark SQL connector (``org.elasticsearch.spark.sql``).

    ``id_col`` maps a column to the document id, so a replayed write
    replaces instead of duplicating. ``rejects`` names an index that takes the
    documents which the server refuses (with ``label`` as their label) in place
    of failing the batch; ``operators.rejects.rejected_documents`` reads it. The
    connector jar is not bundled.
    """
    opts = {"es.nodes": nodes, "es.resource": index,
            "es.batch.size.entries": str(batch_entries), "es.batch.size.bytes": batch_bytes,
            "es.batch.write.refresh": str(refresh).lower(),
            "es.index.auto.create": str(auto_create).lower()}
    if id_col:
        opts["es.mapping.id"] = id_col
        opts["es.write.operation"] = "index"  # the same id replaces the whole document
    if rejects:
        handler = "es.write.rest.error.handler.es"
        opts.update({"es.write.rest.error.handlers": "es", f"{handler}.client.nodes": nodes,
                     f"{handler}.client.resource": rejects, f"{handler}.return.default": "HANDLED",
                     f"{handler}.return.error": "ABORT"})    # a refusal that can't be kept fails the batch
        if label:
            opts[f"{handler}.label.job"] = label
    return opts


def write_search_index(df: DataFrame, nodes: str, index: str, id_col: str | None = None,
                       **kwargs) -> None:
    """Write a (micro-)batch to a search index through the connector."""
    (df.write.format("org.elasticsearch.spark.sql")
       .options(**search_index_options(nodes, index, id_col, **kwargs))
       .mode("append").save())
