"""End-to-end streaming jobs.

``flatten_append``  records -> decode -> fact -> documents (append), quarantine, ledger
``flatten_upsert``  records -> decode -> fact + document id -> keyed documents, ledger
``daily_visitors``  visitor events -> event day -> first seen per (day, visitor) -> records

Each micro-batch runs as: decode the columns that are written and persist
them, skip the batch when empty, write data, write quarantine, then write the
offset ledger, then unpersist. Every write is replay-safe under the run and
batch id, and the checkpoint (in the shared ``spark.checkpoint.dir``) replays
a failed batch with the same offsets, so the stores see each batch exactly
once even when executors or the driver are lost. Records are never shuffled
between the source and the documents; parallelism is the source's (Kafka
``minPartitions``, file splits). The only shuffles are the small
per-partition offset aggregate and, in ``daily_visitors``, the state-store
exchange on ``(dt, id)``.

Documents go to a store (``out_path``), a search index (``index``: nodes and
index name) or both. ``on_written`` is called with the batch id and the
number of documents written. ``rejects_path`` takes the documents that an
index would refuse (``operators.rejects``), which else fail the batch.
"""

from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from driftlog import schemas as S
from driftlog.operators.decode import REASON, decode_records, decode_visitors, quarantined
from driftlog.operators.dedup import latest_documents
from driftlog.operators.offsets import offset_ranges
from driftlog.functions.time import day_text, instant_to_wall
from driftlog.operators.rejects import split_rejected
from driftlog.operators.project import fact_columns, project_visitor, with_doc_id
from driftlog.streaming.checkpoints import fill_ledger
from driftlog.streaming.dedup import OUTPUT_MODE as STREAM_DEDUP_MODE
from driftlog.streaming.dedup import current_first_seen, daily_first_seen_stream, use_rocksdb_state
from driftlog.streaming.progress import OffsetLedger
from driftlog.streaming.runs import run_number
from driftlog.streaming.sinks import (append_documents, append_offsets, read_store, upsert_documents,
                                      with_write_metrics, write_search_index)

log = logging.getLogger(__name__)

DEFAULT_GROUP = "tracking-etl"
SOURCE_COLS = ["topic", "partition", "offset"]
INGEST_DAY = "ingest_dt"


def _start(df: DataFrame, handle, checkpoint: str, trigger_seconds: float,
           available_now: bool, query_name: str | None,
           output_mode: str = "append", state_partitions: int | None = None) -> StreamingQuery:
    w = (df.writeStream.foreachBatch(handle).outputMode(output_mode)
         .option("checkpointLocation", checkpoint))
    if query_name:
        w = w.queryName(query_name)
    w = w.trigger(availableNow=True) if available_now else \
        w.trigger(processingTime=f"{trigger_seconds} seconds")
    if not state_partitions:
        return w.start()
    # The query takes a copy of the session's settings when it starts, and its
    # checkpoint then fixes the state partition count: set it for the start only.
    conf, key = df.sparkSession.conf, "spark.sql.shuffle.partitions"
    before = conf.get(key)
    conf.set(key, str(state_partitions))
    try:
        return w.start()
    finally:
        conf.set(key, before)


def _decoded_batch(batch: DataFrame, mode: str, columns: list[str]) -> DataFrame:
    """Source columns, reason, the fact ``columns`` and (for bad records only)
    the raw value: what the batch's writes need, computed once."""
    dec = decode_records(batch, mode=mode, columns=columns)
    raw = F.when(F.col(REASON).isNotNull(), F.col("value")).alias("value")
    kept = [c for c in (*SOURCE_COLS, INGEST_DAY) if c in batch.columns]
    return dec.select(*kept, raw, REASON, *fact_columns(columns))


def _with_ingest_day(records: DataFrame, tz: str) -> DataFrame:
    """Adds the processing day. It is the micro-batch's time, which the offset log keeps: a replay has the same."""
    return records.withColumn(INGEST_DAY, day_text(instant_to_wall(F.current_timestamp(), tz)))


def _write_index(docs: DataFrame, batch_id: int, index: tuple[str, str], id_col: str, rejects_path: str | None, run: int,
                 keywords: tuple[str, ...]) -> None:
    """Write to the index what it will take; the rest goes to ``rejects_path``, where there is one."""
    if rejects_path:
        docs, bad = split_rejected(docs, id_col, [k for k in keywords if k in docs.columns])
        append_documents(bad, batch_id, rejects_path, run=run)
    write_search_index(docs, *index, id_col=id_col)


def _process(batch: DataFrame, batch_id: int, mode: str, write_good, quarantine_path: str | None,
             ledger_path: str | None, group: str, columns: list[str] | None = None, run: int = 0,
             files: int | None = None, on_written: Callable[[int, int], None] | None = None) -> None:
    if not batch.select(F.lit(1)).take(1):    # looks for one record, undecoded; isEmpty() starts every task
        return
    # decoded once, by the tasks of the first write; the other writes read the result
    dec = _decoded_batch(batch, mode, columns or S.FACT_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good, written = with_write_metrics(dec.where(F.col(REASON).isNull()).drop("value", REASON))
        write_good(good, batch_id)
        n = written.get["rows"]
        log.info("batch %s: %s documents written", batch_id, n)
        if on_written:
            on_written(batch_id, n)
        if quarantine_path:
            bad = dec.where(F.col(REASON).isNotNull()).select(*SOURCE_COLS, "value", REASON)
            append_documents(bad, batch_id, quarantine_path, run=run, files=files)
        if ledger_path:
            append_offsets(offset_ranges(dec), batch_id, ledger_path, group, run)
    finally:
        dec.unpersist()


def _needs_sink(out_path: str | None, index) -> None:
    if not (out_path or index):
        raise ValueError("give out_path, index or both")


def flatten_append(records: DataFrame, out_path: str | None, checkpoint: str,
                   ledger_path: str | None = None, quarantine_path: str | None = None,
                   group: str = DEFAULT_GROUP, columns: list[str] | None = None,
                   partition_by: tuple[str, ...] = ("dt",), mode: str = "permissive",
                   trigger_seconds: float = 1.0, available_now: bool = False,
                   query_name: str | None = None, index: tuple[str, str] | None = None,
                   files_per_batch: int | None = None,
                   on_written: Callable[[int, int], None] | None = None, tz: str = "UTC",
                   rejects_path: str | None = None, keywords: tuple[str, ...] = ()) -> StreamingQuery:
    """Decode records and append documents (default: the six-field document).

    The store has a folder per day (``dt``, the day of the line's time) unless
    ``partition_by`` says otherwise; ``ingest_dt`` there is the day of
    processing, in ``tz``. Index documents have the record's
    position as their id, so a replayed batch replaces what it wrote.
    ``files_per_batch`` bounds the files of a batch in a folder. ``keywords``:
    columns that the index holds as keywords, checked with ``rejects_path``.
    """
    _needs_sink(out_path, index)
    if INGEST_DAY in partition_by:
        records = _with_ingest_day(records, tz)
    cols = columns or S.DOC6_COLUMNS
    need = [*cols, "timestamp"] if "dt" in partition_by and "timestamp" not in cols else list(cols)
    run = run_number(records.sparkSession, checkpoint, out_path, ledger_path, quarantine_path)

    def write_good(fact: DataFrame, batch_id: int) -> None:
        dated = fact.withColumn("dt", F.substring("timestamp", 1, 10)) if "dt" in partition_by else fact
        if out_path:
            append_documents(dated.select(*partition_by, *cols), batch_id, out_path, partition_by, run=run,
                             files=files_per_batch)
        if index:
            _write_index(with_doc_id(dated).select("doc_id", *cols), batch_id, index, "doc_id", rejects_path, run, keywords)

    def handle(batch: DataFrame, batch_id: int) -> None:
        _process(batch, batch_id, mode, write_good, quarantine_path, ledger_path, group, need, run,
                 files_per_batch, on_written)

    return _start(records, handle, checkpoint, trigger_seconds, available_now, query_name)


def flatten_upsert(records: DataFrame, out_path: str | None, checkpoint: str,
                   ledger_path: str | None = None, quarantine_path: str | None = None,
                   group: str = DEFAULT_GROUP, id_col: str = "doc_id", mode: str = "permissive",
                   trigger_seconds: float = 3.0, available_now: bool = False,
                   query_name: str | None = None, index: tuple[str, str] | None = None,
                   key: str | None = None, files_per_batch: int | None = None,
                   on_written: Callable[[int, int], None] | None = None,
                   rejects_path: str | None = None, keywords: tuple[str, ...] = ()) -> StreamingQuery:
    """Decode records and upsert the 19-column fact under a deterministic id:
    the record's position, or the fact column ``key`` (later records then replace earlier ones)."""
    _needs_sink(out_path, index)
    run = run_number(records.sparkSession, checkpoint, out_path, ledger_path, quarantine_path)

    def write_good(fact: DataFrame, batch_id: int) -> None:
        docs = fact.withColumn(id_col, F.col(key)) if key else with_doc_id(fact, id_col)
        docs = docs.select(id_col, "partition", "offset", *S.FACT_COLUMNS)
        if out_path:
            upsert_documents(docs, batch_id, out_path, id_col, run=run, files=files_per_batch)
        if index:
            last = latest_documents(docs, id_col, ["offset", "partition"]) if key else docs
            _write_index(last.drop("partition", "offset"), batch_id, index, id_col, rejects_path, run, keywords)

    def handle(batch: DataFrame, batch_id: int) -> None:
        _process(batch, batch_id, mode, write_good, quarantine_path, ledger_path, group, S.FACT_COLUMNS, run,
                 files_per_batch, on_written)

    return _start(records, handle, checkpoint, trigger_seconds, available_now, query_name)


def quarantine_visitors(records: DataFrame, out_path: str, checkpoint: str, trigger_seconds: float = 3.0,
                        available_now: bool = False) -> StreamingQuery:
    """Records that are no visitor event, with their reason: a query beside ``daily_visitors``,
    whose own batches hold visitors and no longer records."""
    run = run_number(records.sparkSession, checkpoint, out_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        bad = quarantined(decode_visitors(batch), [*SOURCE_COLS, "value", REASON]).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if bad.count():
                append_documents(bad, batch_id, out_path, run=run)
        finally:
            bad.unpersist()

    return _start(records, handle, checkpoint, trigger_seconds, available_now, None)


def daily_visitors(events: DataFrame, out_path: str | None, checkpoint: str, tz: str = "UTC",
                   lateness: str = "1 day", tie_col: str | None = None,
                   trigger_seconds: float = 3.0, available_now: bool = False,
                   query_name: str | None = None, rocksdb: bool = True,
                   state_partitions: int | None = None, ledger_path: str | None = None,
                   group: str = DEFAULT_GROUP, index: tuple[str, str] | None = None,
                   files_per_batch: int | None = None) -> StreamingQuery:
    """Visitor events ``(ts millis, common{...})`` -> visitor record per (day, mid).

    Each batch appends the keys first seen (or seen earlier) in it; read the
    store with ``read_visitors``. Output is partitioned by ``dt`` (then run
    and batch), so a day's readers prune to that day's files. Index documents
    have day and visitor as their id. The ledger is written from the query's
    progress reports, after each batch; what a lost driver did not report is
    filled in from the checkpoint when the query starts again.

    The state holds one row per (day, visitor) for up to ``lateness`` past
    the day, which grows with the audience, so ``rocksdb`` keeps it in
    RocksDB (off the JVM heap) unless the session already names a state
    store provider. A restarted query keeps the provider its checkpoint
    was started with.

    ``state_partitions`` sets the number of state partitions (and tasks per
    micro-batch) of a new query, default the session's
    ``spark.sql.shuffle.partitions``; a restart keeps its checkpoint's count.
    Size it to the cluster's cores or a small multiple: each partition is
    one state store, opened and committed every micro-batch.
    """
    if rocksdb:
        use_rocksdb_state(events.sparkSession)
    ev = events.withColumn("mid", F.col("common.mid"))
    firsts = project_visitor(daily_first_seen_stream(ev, "mid", "ts", tie_col=tie_col, tz=tz,
                                                     lateness=lateness))

    _needs_sink(out_path, index)
    run = run_number(events.sparkSession, checkpoint, out_path, ledger_path)

    def handle(batch: DataFrame, batch_id: int) -> None:
        b = batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            if not b.count():
                return
            if out_path:
                append_documents(b, batch_id, out_path, partition_by=("dt",), run=run, files=files_per_batch)
            if index:
                write_search_index(b.withColumn("doc_id", F.concat_ws("-", "dt", "mid")), *index, id_col="doc_id")
        finally:
            b.unpersist()

    if ledger_path:
        fill_ledger(events.sparkSession, checkpoint, ledger_path, group, run)
        query_name = query_name or f"daily_visitors_{run}"
        events.sparkSession.streams.addListener(OffsetLedger(query_name, ledger_path, group, run))
    return _start(firsts, handle, checkpoint, trigger_seconds, available_now, query_name,
                  output_mode=STREAM_DEDUP_MODE, state_partitions=state_partitions)


def read_visitors(spark, path: str) -> DataFrame:
    """Current visitor records of a ``daily_visitors`` store, one per (dt, mid)."""
    return current_first_seen(read_store(spark, path), "mid").select(*S.VISITOR_COLUMNS)


__all__ = ["flatten_append", "flatten_upsert", "daily_visitors", "quarantine_visitors", "read_visitors"]
