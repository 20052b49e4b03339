"""Command-line entry points for the jobs (``spark-submit`` or ``python -m``).

    python -m driftlog.apps append   --servers H:9092 --topic logs --group etl \\
        --out DOCS --ledger LEDGER [--quarantine BAD] [--rate 2000 --partitions 6] [--trigger 1]
    python -m driftlog.apps upsert   --servers ... --topic ... --out DOCS [--ledger LEDGER] [--trigger 3]
    python -m driftlog.apps visitors --servers ... --topic ... --out VISITORS [--tz UTC] [--ledger LEDGER]

Each job writes to a store (``--out``), to a search index (``--index-nodes
H:9200 --index NAME``) or to both. With ``--ledger`` a new query starts at the
ledger's saved offsets and records each batch's offsets after its data;
without it, it starts afresh (``append`` then every 3 s instead of every
second). Either way a restarted query resumes from its checkpoint. Instead of ``--servers/--topic``, ``--files DIR`` reads records
at rest (the same schema as the topic records), and ``--archive DIR --topic T`` an
archived topic in offset order. ``--cap`` bounds a micro-batch of an archive, ``--rate`` one of a
topic; with ``--backpressure`` that is only the first cap, later ones follow the rate
at which batches are processed. ``--rejects`` keeps documents the index would refuse. ``--available-now``
processes what is there and stops. The checkpoint defaults to a folder
under the session's ``spark.checkpoint.dir`` named after the job and source.
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import DataFrame, SparkSession


def _session(master: str | None, ui: bool = False) -> SparkSession:
    builder = SparkSession.builder.appName("driftlog").config("spark.ui.enabled", str(ui).lower())
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def _source_name(a) -> str:
    return a.topic if a.servers else os.path.basename((a.files or a.archive).rstrip("/"))


def _records(spark: SparkSession, a, starting: str | None = None) -> DataFrame:
    """The source; ``a.cap`` is the most records of a batch."""
    from driftlog.sources.archive import archive_stream
    from driftlog.sources.kafka import kafka_records
    from driftlog.sources.records import file_records

    if a.servers:
        opts = dict(group=a.group, min_partitions=a.min_partitions, max_per_trigger=a.cap)
        if starting:
            opts.update(offsets=starting, partitions=a.partitions)
        return kafka_records(spark, a.servers, a.topic, stream=True, **opts)
    if a.archive:
        control = f"{a.checkpoint}.cap" if a.backpressure else None
        return archive_stream(spark, a.archive, a.checkpoint, starting or "earliest", a.cap, control)
    return file_records(spark, a.files, stream=True, max_files_per_trigger=a.max_files)


def _checkpoint(spark: SparkSession, a, job: str) -> str:
    from driftlog.session import scratch_path

    return a.checkpoint or scratch_path(spark, f"{job}-{_source_name(a)}")


def run(argv: list[str]):
    """Parse ``argv`` and start the job; returns the StreamingQuery."""
    ap = argparse.ArgumentParser(prog="driftlog.apps")
    ap.add_argument("job", choices=["append", "upsert", "visitors"])
    ap.add_argument("--master")
    ap.add_argument("--ui", action="store_true", help="serve the Spark web UI (off by default)")
    src = ap.add_argument_group("source")
    src.add_argument("--servers")
    src.add_argument("--topic")
    src.add_argument("--group", default="tracking-etl")
    src.add_argument("--files")
    src.add_argument("--archive")
    src.add_argument("--cap", type=int, help="most records of a micro-batch of an archive")
    src.add_argument("--backpressure", action="store_true", help="let the cap follow the processing rate")
    src.add_argument("--max-files", type=int)
    src.add_argument("--rate", type=int, help="records/s per topic-partition")
    src.add_argument("--partitions", type=int, help="topic partitions (with --rate; unsaved ones start at earliest)")
    src.add_argument("--min-partitions", type=int)
    out = ap.add_argument_group("output")
    out.add_argument("--out")
    out.add_argument("--index-nodes")
    out.add_argument("--index")
    out.add_argument("--files-per-batch", type=int, help="most files a batch leaves in a folder")
    out.add_argument("--ledger")
    out.add_argument("--quarantine")
    out.add_argument("--rejects", help="documents that the index would refuse (append, upsert)")
    out.add_argument("--keywords", default="", help="comma-separated columns that the index holds as keywords")
    out.add_argument("--by-processing-day", action="store_true", help="store folders by the day of processing (append)")
    out.add_argument("--checkpoint")
    out.add_argument("--trigger", type=float)
    out.add_argument("--available-now", action="store_true")
    out.add_argument("--mode", default="permissive", choices=["permissive", "failfast"])
    vis = ap.add_argument_group("visitors")
    vis.add_argument("--tz", default="UTC")
    vis.add_argument("--lateness", default="1 day")
    vis.add_argument("--state-partitions", type=int)
    a = ap.parse_args(argv)

    spark = _session(a.master, a.ui)
    if sum(map(bool, (a.servers, a.files, a.archive))) != 1 or (a.servers and not a.topic):
        ap.error("give either --servers with --topic, or --files, or --archive")
    if a.backpressure and not (a.rate if a.servers else a.archive and a.cap):
        ap.error("--backpressure starts from --rate (a topic) or --cap (an archive)")
    if a.archive and a.ledger and not a.topic:
        ap.error("--archive with --ledger needs --topic")
    if bool(a.index) != bool(a.index_nodes):
        ap.error("--index and --index-nodes go together")
    if not (a.out or a.index):
        ap.error("--out or --index is required")
    if a.rate and not a.partitions:
        ap.error("--rate needs --partitions")
    a.trigger = a.trigger or trigger_seconds(a.job, bool(a.ledger))

    from driftlog.streaming import jobs

    starting = None
    if a.ledger and (a.servers or a.archive):
        from driftlog.operators.offsets import seed_offsets

        # used only when the query has no checkpoint yet
        starting = seed_offsets(spark, a.ledger, a.group, a.topic)
    a.checkpoint = checkpoint = _checkpoint(spark, a, a.job)
    if a.servers and a.rate:
        from driftlog.sources.kafka import max_offsets_per_trigger

        a.cap = max_offsets_per_trigger(a.rate, a.partitions, a.trigger)
    common = dict(ledger_path=a.ledger, group=a.group, available_now=a.available_now, trigger_seconds=a.trigger,
                  index=(a.index_nodes, a.index) if a.index else None, files_per_batch=a.files_per_batch)

    def start(cap: int | None):
        a.cap = cap
        records = _records(spark, a, starting)
        if a.job == "visitors":
            from driftlog.operators.decode import decode_visitor_events

            if a.quarantine:
                # a query of its own, with its own place in the source
                a.checkpoint = f"{checkpoint}-quarantine"
                beside = jobs.quarantine_visitors(_records(spark, a, starting) if a.archive else records, a.quarantine,
                                                  a.checkpoint, a.trigger, a.available_now)
                a.checkpoint = checkpoint
                if a.available_now:
                    beside.awaitTermination()
            return jobs.daily_visitors(decode_visitor_events(records), a.out, checkpoint, tz=a.tz, lateness=a.lateness,
                                       state_partitions=a.state_partitions, query_name=name, **common)
        job = jobs.flatten_append if a.job == "append" else jobs.flatten_upsert
        by_day = dict(partition_by=("ingest_dt",), tz=a.tz) if a.by_processing_day and a.job == "append" else {}
        return job(records, a.out, checkpoint, quarantine_path=a.quarantine, mode=a.mode, query_name=name,
                   rejects_path=a.rejects, keywords=tuple(filter(None, a.keywords.split(","))), **by_day, **common)

    name = f"{a.job}-{_source_name(a)}" if a.backpressure else None
    if not a.backpressure:
        return start(a.cap)
    from driftlog.streaming.backpressure import RateEstimator, regulate, run_regulated

    estimator = RateEstimator(a.trigger, a.cap, least=min(a.cap, 100))
    if a.servers:
        return run_regulated(start, estimator)
    regulate(spark, name, f"{checkpoint}.cap", estimator)
    return start(a.cap)


def trigger_seconds(job: str, resumes: bool) -> float:
    """Micro-batch cadence of the jobs: 1 s for the append job that resumes, else 3 s."""
    return 1.0 if job == "append" and resumes else 3.0


def main(argv: list[str] | None = None) -> int:
    res = run(sys.argv[1:] if argv is None else argv)
    if hasattr(res, "awaitTermination"):
        res.awaitTermination()
    return 0


if __name__ == "__main__":
    # run as a file (spark-submit driftlog/apps.py): import the package beside it
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.exit(main())
