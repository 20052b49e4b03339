"""Query catalog: every operator run over whole tables of a scale-factor folder.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame; the matching
DuckDB SQL is in ``driftlog.plans.oracle``. Bus records are derived from
``events`` by Spark (``records_from_events``), so the work of every query
grows with the tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from driftlog import schemas as S
from driftlog.functions.json import object_check, parse_object
from driftlog.functions.time import day_number, instant_to_wall
from driftlog.functions.url import decode_args, query_string
from driftlog.operators.decode import REASON, access_log_fields, decode_records, split_valid
from driftlog.operators.dedup import daily_first_seen, latest_documents
from driftlog.operators.parallel import spread
from driftlog.operators.offsets import latest_offsets, ledger_rows, offset_ranges, resume_from, seed_offsets
from driftlog.operators.project import (decode_fact, project_doc, project_visitor, rows_to_json,
                                        with_doc_id, with_event_day)
from driftlog.operators.keywords import read_keyword_store, write_keyword_store
from driftlog.operators.rejects import split_rejected
from driftlog.operators.search import page_key, search
from driftlog.sources.kafka import drop_replays, kafka_frame
from driftlog.session import scratch_path
from driftlog.sources.archive import archive_records, archive_stream, drain
from driftlog.streaming.sinks import append_documents, read_store, upsert_documents, with_write_metrics
from driftlog.sources.records import (DEFAULT_PARTITIONS, DEFAULT_TOPIC, file_records, in_offset_order,
                                      records_from_events, visitor_events)
from driftlog.streaming.jobs import daily_visitors, flatten_append, flatten_upsert, read_visitors
from driftlog.sources.tables import read_table

GROUP = "tracking-etl"
# The ledger scenario: the job stopped after the batch of this event day.
RESUME_AFTER_DAY = "2024-01-15"
SEARCH_QUERY = "whst erth"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "events"), cut=True)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records_from_events(_events(spark, sf_dir))


def _tasks(spark: SparkSession, df: DataFrame) -> int:
    return max(df.rdd.getNumPartitions(), spark.sparkContext.defaultParallelism)


def _records_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records, dealt and sorted by offset before their values are built."""
    events = read_table(spark, sf_dir, "events")
    return records_from_events(in_offset_order(events, _tasks(spark, events)))


def _batch_of(ts_col: str = "timestamp"):
    """Micro-batch id of a record in the ledger scenarios: its UTC event day."""
    return day_number(instant_to_wall(F.col(ts_col)))


def q_decode_fact(spark, sf_dir):
    return decode_fact(_records(spark, sf_dir))


def q_doc_projection(spark, sf_dir):
    fact = decode_fact(_records(spark, sf_dir), keep=("topic", "partition", "offset"), columns=S.DOC6_COLUMNS)
    return project_doc(with_doc_id(fact), keep=("doc_id",))


def q_access_log_fields(spark, sf_dir):
    decoded = decode_records(_records(spark, sf_dir), columns=[])
    return access_log_fields(decoded, keep=("partition", "offset"))


def q_json_props(spark, sf_dir):
    schema = T.StructType([T.StructField("k", T.StringType())])
    ev = (_events(spark, sf_dir).select("event_id", "props")
          .withColumn("_p", parse_object(F.col("props"), schema)))  # parsed once, used twice
    return ev.select("event_id", F.col("_p")["k"].alias("k"),
                     object_check(F.col("props"), F.col("_p")).alias("is_object"))


def q_url_args(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    args = query_string(F.col("url"))
    return pages.select("page_id", args.alias("args"), decode_args(args).alias("decoded"))


def _texts(spark, sf_dir) -> DataFrame:
    """Every text column of the given tables as ``(source, id, text)``."""
    parts = [
        _events(spark, sf_dir).select(F.lit("events").alias("source"),
                                      F.col("event_id").cast("string").alias("id"), F.col("props").alias("text")),
        _documents(spark, sf_dir).select(F.lit("documents").alias("source"),
                                         F.col("doc_id").cast("string").alias("id"), "text"),
        read_table(spark, sf_dir, "conversations").select(
            F.lit("conversations").alias("source"),
            F.concat_ws("-", "conv_id", "turn").alias("id"), "text"),
        read_table(spark, sf_dir, "pages").select(F.lit("pages").alias("source"),
                                                  F.col("page_id").cast("string").alias("id"),
                                                  F.col("html").alias("text")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def q_valid_split(spark, sf_dir):
    valid, bad = split_valid(_texts(spark, sf_dir), "text")
    return (valid.select("source", "id", F.lit(True).alias("is_object"))
            .unionAll(bad.select("source", "id", F.lit(False))))


def _mixed_records(spark, sf_dir) -> DataFrame:
    """Good records from events plus broken ones built from other tables.

    documents: the raw text as the value (not an envelope);
    conversations: an envelope without ``message``;
    pages: an envelope whose line carries the URL query as ``args``
    (missing when the URL has none), which is not a JSON payload.
    """
    good_recs = _records(spark, sf_dir).select(F.lit("events").alias("source"), "value")
    docs = _documents(spark, sf_dir).select(F.lit("documents").alias("source"),
                                            F.col("text").alias("value"))
    conv = read_table(spark, sf_dir, "conversations").select(
        F.lit("conversations").alias("source"),
        F.to_json(F.struct("conv_id", "turn", "role", "text")).alias("value"))
    pages = read_table(spark, sf_dir, "pages").select(
        F.lit("pages").alias("source"),
        F.to_json(F.struct(F.to_json(F.struct(F.col("url").alias("uri"),
                                              query_string(F.col("url")).alias("args"))).alias("message"))
                  ).alias("value"))
    return good_recs.unionByName(docs).unionByName(conv).unionByName(pages)


def q_quarantine_reasons(spark, sf_dir):
    dec = decode_records(_mixed_records(spark, sf_dir))
    return (dec.groupBy("source", F.coalesce(F.col(REASON), F.lit("ok")).alias("reason"))
            .agg(F.count(F.lit(1)).alias("n")))


def _visitors(spark, sf_dir) -> DataFrame:
    v = visitor_events(_events(spark, sf_dir))
    return v.withColumn("mid", F.col("common.mid"))


def q_event_day(spark, sf_dir):
    return with_event_day(_visitors(spark, sf_dir)).select("event_id", "ts", "dt", "hr")


def _first_seen(spark, sf_dir) -> DataFrame:
    return daily_first_seen(_visitors(spark, sf_dir), "mid", "ts", tie_col="event_id")


def q_daily_first_seen(spark, sf_dir):
    return _first_seen(spark, sf_dir).select("dt", "mid", "hr", "ts", "event_id",
                                             F.col("common.ch").alias("ch"))


def q_visitor_record(spark, sf_dir):
    return project_visitor(_first_seen(spark, sf_dir))


def q_offset_ranges(spark, sf_dir):
    return offset_ranges(_records(spark, sf_dir))


def _ledger(records: DataFrame) -> DataFrame:
    """Ledger of a job that ran one micro-batch per event day."""
    ranges = offset_ranges(records.withColumn("batch_id", _batch_of()), by=("batch_id",))
    return ledger_rows(ranges, GROUP, "batch_id")


def q_latest_offsets(spark, sf_dir):
    return latest_offsets(_ledger(_records(spark, sf_dir)))


def q_resume_from(spark, sf_dir):
    recs = _records(spark, sf_dir)
    cutoff = int(RESUME_AFTER_DAY.replace("-", ""))
    saved = latest_offsets(_ledger(recs).where(F.col("batch_id") <= cutoff))
    return resume_from(recs, saved).select("topic", "partition", "offset", "key")


UPSERT_ORDER = ["batch_id", "event_time", "partition", "offset"]


def _keyed_docs(spark, sf_dir) -> DataFrame:
    """Documents keyed by ``uid``, one upsert batch per event day."""
    fact = decode_fact(_records(spark, sf_dir), keep=("partition", "offset"),
                       columns=["uid", "timestamp", *S.DOC6_COLUMNS])
    return (fact.withColumn("event_time", F.to_timestamp("timestamp"))
            .withColumn("batch_id", _batch_of("event_time")))


def q_upsert_latest(spark, sf_dir):
    # project first: the per-key pick carries every column it is given
    docs = _keyed_docs(spark, sf_dir).select("uid", *UPSERT_ORDER, *S.DOC6_COLUMNS)
    latest = latest_documents(docs, "uid", order=UPSERT_ORDER)
    return latest.select("uid", "batch_id", *S.DOC6_COLUMNS)


def q_upsert_runs(spark, sf_dir):
    """The view of a keyed store that two runs wrote: the days up to the cutoff
    in the first, the later ones in a second, whose batch ids start again at 0.
    Equals ``upsert_latest``."""
    store = f"{_stream_dir(spark, 'upsert-snapshot')}/store"
    docs = _keyed_docs(spark, sf_dir).withColumnRenamed("batch_id", "day") \
        .select("uid", "day", "event_time", "partition", "offset", *S.DOC6_COLUMNS)
    before = F.col("day") <= int(RESUME_AFTER_DAY.replace("-", ""))
    docs = docs.persist(StorageLevel.MEMORY_AND_DISK)      # decoded once, by the first run's write
    try:
        upsert_documents(docs.where(before), 0, store, "uid", run=1)
        upsert_documents(docs.where(~before), 0, store, "uid", run=2)
    finally:
        docs.unpersist()
    stored = read_store(spark, store, schema=T.StructType([
        *docs.schema.fields, T.StructField("run", T.LongType()), T.StructField("batch_id", T.LongType())]))
    latest = latest_documents(stored, "uid", order=["run", "batch_id", "day", "event_time", "partition", "offset"])
    return latest.select("uid", F.col("day").alias("batch_id"), *S.DOC6_COLUMNS)


def q_rows_to_json(spark, sf_dir):
    cust = read_table(spark, sf_dir, "customer")
    return rows_to_json(cust, key_cols=("c_custkey",))


def q_search_topk(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    res = search(docs, "text", SEARCH_QUERY, filters={"lang": "en"}, sort="n_chars",
                 id_col="doc_id", size=20, offset=0, highlight=True)
    return res.select("doc_id", "lang", "source", "n_chars", "text_highlight")


def q_search_page(spark, sf_dir):
    docs = _documents(spark, sf_dir)
    res = search(docs, "text", "ing", filters={"source": "src3"}, sort="n_chars",
                 descending=False, id_col="doc_id", size=10, offset=5, highlight=False)
    return res.select("doc_id", "source", "n_chars")


# An anchor of a page's markup: ``<a href="(href)">(text)</a>``.
_ANCHOR = r'<a href="([^"]*)">([^<]*)</a>'
LINK_TERM = "de"
LINK_QUERY = "the was"


def _pages_with_links(spark, sf_dir) -> DataFrame:
    """Pages with their anchors as an array of ``{href, text}`` objects (one
    narrow projection per page) and the markup length."""
    pages = spread(read_table(spark, sf_dir, "pages"))
    links = F.zip_with(F.regexp_extract_all("html", F.lit(_ANCHOR), 1),
                       F.regexp_extract_all("html", F.lit(_ANCHOR), 2),
                       lambda h, t: F.struct(h.alias("href"), t.alias("text")))
    return pages.select("page_id", "url", "html", links.alias("links"),
                        F.length("html").alias("html_len"))


def q_search_links(spark, sf_dir):
    """QRY-1 with the keyword filter inside an array of objects (FLT-3):
    pages matching the query whose anchors include one with exactly that text."""
    res = search(_pages_with_links(spark, sf_dir), "html", LINK_QUERY,
                 filters={"links.text": LINK_TERM}, sort="html_len", id_col="page_id",
                 size=10, offset=0, highlight=False)
    return res.select("page_id", "url", "html_len")


def q_search_keywords(spark, sf_dir):
    """FLT-3 with the keywords promoted when the store is written: the pages
    of ``search_links``, found through the postings of the anchor text."""
    base = _stream_dir(spark, "keywords")
    pages = _pages_with_links(spark, sf_dir)
    write_keyword_store(pages, base, "page_id", ["links.text", "url"])
    hits = read_keyword_store(spark, base, pages.schema, "page_id", {"links.text": LINK_TERM})
    res = search(hits, "html", LINK_QUERY, sort="html_len", id_col="page_id", size=10, highlight=False)
    return res.select("page_id", "url", "html_len")


DEEP_PAGE, PAGE_SIZE = 4, 7


def q_search_deep_page(spark, sf_dir):
    """TOP-2 by keyset: each page continues behind the last row of the one before; the fourth."""
    docs = _documents(spark, sf_dir)
    after = None
    for n in range(DEEP_PAGE):
        page = search(docs, "text", "the", filters={"lang": "en"}, sort="n_chars", id_col="doc_id", size=PAGE_SIZE,
                      highlight=False, after=after)
        if n + 1 < DEEP_PAGE:
            after = page_key(page, "n_chars", "doc_id") or after
    return page.select("doc_id", "source", "n_chars")


def q_index_rejects(spark, sf_dir):
    """SNK-2: documents whose text an index could not hold as a keyword, by language and reason, and those it takes."""
    docs = _documents(spark, sf_dir)
    taken, bad = split_rejected(docs, "doc_id", ["lang", "source", "text"])
    langs = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "lang")
    reasons = (taken.select("lang", F.lit("taken").alias("reason"), F.lit(None).cast("string").alias("detail"))
               .unionByName(bad.join(langs, "doc_id").select("lang", "reason", "detail")))
    return reasons.groupBy("lang", "reason", "detail").agg(F.count(F.lit(1)).alias("n"))


def q_topic_replays(spark, sf_dir):
    """SNK-4: records written to a topic by day, the days up to the cutoff twice
    (a replay after a failure); read once by their headers."""
    recs = _records(spark, sf_dir).withColumn("day", _batch_of())
    frame = kafka_frame(recs, ["key", "partition", "offset"], "key", run=1, batch_id=F.col("day"))
    first = frame.withColumns({"topic": F.lit("facts"), "partition": F.lit(0), "timestamp": F.lit(None).cast("timestamp")})
    day = F.filter("headers", lambda h: h["key"] == "batch_id")[0]["value"].cast("string").cast("long")
    again = first.where(day <= int(RESUME_AFTER_DAY.replace("-", ""))).withColumn("partition", F.lit(1))
    topic = first.unionByName(again).withColumn("offset", F.monotonically_increasing_id())
    return drop_replays(topic).select("key", F.col("batch_id").alias("day"), "source_partition", "source_offset")


def q_write_metrics(spark, sf_dir):
    """Documents written, by topic-partition: one write, its counts observed on the way."""
    fact = decode_fact(_records(spark, sf_dir), keep=("partition",), columns=[])
    by = {f"p{p}": F.sum((F.col("partition") == p).cast("int")) for p in range(DEFAULT_PARTITIONS)}
    fact, seen = with_write_metrics(fact, more=by)
    fact.write.format("noop").mode("overwrite").save()
    return spark.createDataFrame([(DEFAULT_TOPIC, p, seen.get[f"p{p}"]) for p in range(DEFAULT_PARTITIONS)],
                                 "topic string, partition int, written long")


# --- streaming forms: run to completion with availableNow, read the store back ---

def _stream_dir(spark, name: str) -> str:
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")


def q_daily_first_seen_stream(spark, sf_dir):
    base = _stream_dir(spark, "daily-visitors")
    # the month in three parts, written one after the other by as many tasks each: a batch each
    events = visitor_events(_events(spark, sf_dir))
    tasks = _tasks(spark, events)
    for low, high in ((0, 11), (11, 21), (21, 99)):
        day = F.dayofmonth(F.timestamp_millis("ts"))
        events.where((day >= low) & (day < high)).repartition(tasks).write.mode("append").parquet(f"{base}/src")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", str(tasks)).parquet(f"{base}/src")
    daily_visitors(stream, f"{base}/out", f"{base}/ckpt", tie_col="event_id",
                   available_now=True,
                   state_partitions=spark.sparkContext.defaultParallelism).awaitTermination()
    return read_visitors(spark, f"{base}/out")


def _records_at_rest(spark, sf_dir, base: str, batches: int = 1) -> str:
    """Write the derived records as files, as the data lies: the offline stand-in for a topic.

    For ``batches`` that each take a share of the files, there is a file for every task of each.
    """
    path = f"{base}/records"
    events = _events(spark, sf_dir)
    if batches > 1:
        events = read_table(spark, sf_dir, "events").repartition(batches * _tasks(spark, events))
    records_from_events(events).write.mode("append").parquet(path)
    return path


def q_flatten_append_stream(spark, sf_dir):
    base = _stream_dir(spark, "flatten-append")
    src = file_records(spark, _records_at_rest(spark, sf_dir, base), stream=True)
    flatten_append(src, f"{base}/docs", f"{base}/ckpt", ledger_path=f"{base}/ledger",
                   quarantine_path=f"{base}/bad", available_now=True).awaitTermination()
    return read_store(spark, f"{base}/docs", schema=_doc6_store()).select(*S.DOC6_COLUMNS)


def _doc6_store() -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in [*S.DOC6_COLUMNS, "dt"]]
                        + [T.StructField(n, T.LongType()) for n in ("run", "batch_id")])


def q_resume_stream(spark, sf_dir):
    """SRC-4 on a stream: one store and ledger over two checkpoints. The first
    query reads the archive while it ends at a middle offset; the second, with
    a fresh checkpoint, starts at the offsets the ledger has saved, when the
    archive holds the rest too. The store has every record once."""
    base = _stream_dir(spark, "resume")
    recs = _records_in_order(spark, sf_dir)
    middle = _records(spark, sf_dir).agg((F.max("offset") / 2).cast("long")).first()[0] or 0
    for n, part in enumerate((F.col("offset") < middle, F.col("offset") >= middle)):
        archive_records(recs.where(part), f"{base}/topic", in_order=True)
        starting = seed_offsets(spark, f"{base}/ledger", GROUP, DEFAULT_TOPIC)
        src = archive_stream(spark, f"{base}/topic", f"{base}/ckpt{n}", starting)
        flatten_append(src, f"{base}/docs", f"{base}/ckpt{n}", ledger_path=f"{base}/ledger", group=GROUP,
                       available_now=True).awaitTermination()
    return read_store(spark, f"{base}/docs", schema=_doc6_store()).select(*S.DOC6_COLUMNS)


def _landed(batch: DataFrame, batch_id: int, path: str) -> None:
    append_documents(batch.select("topic", "partition", "offset", "key"), batch_id, path)


_LANDED = T.StructType([f for f in S.RECORD.fields if f.name in ("topic", "partition", "offset", "key")]
                       + [T.StructField(n, T.LongType()) for n in ("run", "batch_id")])


def q_resume_archive(spark, sf_dir):
    """SRC-3 on a stream: what a stream reads that starts at the ledger's saved
    offsets; equals ``resume_from`` of the same records and ledger at rest."""
    base = _stream_dir(spark, "resume-archive")
    recs = _records(spark, sf_dir)
    archive_records(_records_in_order(spark, sf_dir), f"{base}/topic", in_order=True)
    cutoff = int(RESUME_AFTER_DAY.replace("-", ""))
    ledger = _ledger(recs).where(F.col("batch_id") <= cutoff)
    ledger.write.partitionBy("group", "topic", "run", "batch_id").parquet(f"{base}/ledger")
    starting = seed_offsets(spark, f"{base}/ledger", GROUP, DEFAULT_TOPIC)
    src = archive_stream(spark, f"{base}/topic", f"{base}/ckpt", starting)
    (src.writeStream.foreachBatch(lambda batch, n: _landed(batch, n, f"{base}/landed"))
     .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True).start().awaitTermination())
    return read_store(spark, f"{base}/landed", schema=_LANDED).select("topic", "partition", "offset", "key")


def q_capped_archive(spark, sf_dir):
    """SRC-5: an archive drained in offset order under a cap of a fifth of its
    records a batch; the offset ranges of what arrived, every record once."""
    base = _stream_dir(spark, "capped")
    recs = _records(spark, sf_dir)
    archive_records(_records_in_order(spark, sf_dir), f"{base}/topic", in_order=True)
    cap = -(-recs.count() // 5)
    src = archive_stream(spark, f"{base}/topic", f"{base}/ckpt", cap=cap)
    query = (src.writeStream.foreachBatch(lambda batch, n: _landed(batch, n, f"{base}/landed"))
             .option("checkpointLocation", f"{base}/ckpt").start())
    drain(query, f"{base}/topic", f"{base}/ckpt")
    return offset_ranges(read_store(spark, f"{base}/landed", schema=_LANDED))


def q_flatten_upsert_stream(spark, sf_dir):
    base = _stream_dir(spark, "flatten-upsert")
    src = file_records(spark, _records_at_rest(spark, sf_dir, base), stream=True)
    flatten_upsert(src, f"{base}/docs", f"{base}/ckpt", ledger_path=f"{base}/ledger", key="uid",
                   available_now=True).awaitTermination()
    out = ["doc_id", "uid", "oid", "et", "timestamp"]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in out]
                          + [T.StructField("partition", T.IntegerType())]
                          + [T.StructField(n, T.LongType()) for n in ("offset", "run", "batch_id")])
    store = read_store(spark, f"{base}/docs", schema=schema)
    return latest_documents(store, "doc_id", ["run", "batch_id", "offset", "partition"]).select(*out)


def q_ledger_stream(spark, sf_dir):
    base = _stream_dir(spark, "ledger")
    records = _records_at_rest(spark, sf_dir, base, batches=3)
    third = max(1, len(spark.read.parquet(records).inputFiles()) // 3)
    src = file_records(spark, records, stream=True, max_files_per_trigger=third)
    flatten_append(src, f"{base}/docs", f"{base}/ckpt", ledger_path=f"{base}/ledger",
                   available_now=True).awaitTermination()
    # files at rest are not in offset order: the furthest position counts
    ledger = read_store(spark, f"{base}/ledger", schema=S.LEDGER)
    latest = latest_offsets(ledger, order=("run", "until_offset"))
    return latest.select("group", "topic", "partition", "until_offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "decode_fact": q_decode_fact,
    "doc_projection": q_doc_projection,
    "access_log_fields": q_access_log_fields,
    "json_props": q_json_props,
    "url_args": q_url_args,
    "valid_split": q_valid_split,
    "quarantine_reasons": q_quarantine_reasons,
    "event_day": q_event_day,
    "daily_first_seen": q_daily_first_seen,
    "visitor_record": q_visitor_record,
    "offset_ranges": q_offset_ranges,
    "latest_offsets": q_latest_offsets,
    "resume_from": q_resume_from,
    "upsert_latest": q_upsert_latest,
    "upsert_runs": q_upsert_runs,
    "rows_to_json": q_rows_to_json,
    "search_topk": q_search_topk,
    "search_page": q_search_page,
    "search_links": q_search_links,
    "search_keywords": q_search_keywords,
    "search_deep_page": q_search_deep_page,
    "index_rejects": q_index_rejects,
    "topic_replays": q_topic_replays,
    "write_metrics": q_write_metrics,
    "daily_first_seen_stream": q_daily_first_seen_stream,
    "flatten_append_stream": q_flatten_append_stream,
    "flatten_upsert_stream": q_flatten_upsert_stream,
    "ledger_stream": q_ledger_stream,
    "resume_stream": q_resume_stream,
    "resume_archive": q_resume_archive,
    "capped_archive": q_capped_archive,
}
