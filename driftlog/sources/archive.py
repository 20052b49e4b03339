"""Archived topic files read as a stream in offset order.

An archive is a folder of Parquet files with the records of topics (the
schema ``schemas.RECORD``) and, in its ``_index`` folder, one row per file
and topic-partition with the range of offsets. ``archive_stream`` reads it
like a topic: positions are next offsets by topic and partition, in the form
that Kafka sources use, so a stream may start at the offsets a ledger has
saved (``operators.offsets.seed_offsets``) and its progress reports can be
written to one. Each micro-batch takes at most ``cap`` records (offsets,
that is: a gap counts), dealt to the partitions in proportion to what waits
in them; a control file may change the cap while the stream runs (see
``streaming.backpressure``).

The source is a Python data source: planning reads only the index and the
offset log, tasks read the row groups that a range of offsets meets, as
Arrow batches. Restarted, it goes on at the last offsets in the query's
offset log. The classes travel to the workers by value.
"""

from __future__ import annotations

import json
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

INDEX = "_index"
INDEX_SCHEMA = "path string, topic string, partition int, from_offset long, until_offset long, records long"
EARLIEST = -2   # in starting offsets: from the first record there is
ROW_GROUP_BYTES = 8 << 20   # a task reads whole row groups: they are smaller than a task's range of offsets

Offsets = dict[str, dict[str, int]]


# --- writing ---

def archive_records(records: DataFrame, path: str, records_per_file: int = 1_000_000, in_order: bool = False) -> None:
    """Append records to an archive, each file a stretch of few partitions' offsets, and index them.

    ``in_order``: the tasks of ``records`` hold such stretches already, sorted;
    they are written as they are. (Else records are computed twice, once to
    find the edges of the stretches.)
    """
    if not in_order:
        at = ("topic", "partition", "offset")
        records = records.repartitionByRange(*at).sortWithinPartitions(*at)
    (records.write.mode("append").option("maxRecordsPerFile", records_per_file)
     .option("parquet.block.size", ROW_GROUP_BYTES).parquet(path))
    index_archive(records.sparkSession, path)


def index_archive(spark: SparkSession, path: str) -> None:
    """Add the files that the archive's index does not know yet (their names and offsets alone are read)."""
    from driftlog import schemas as S
    from driftlog.sources.tables import read_if_present

    files = (spark.read.schema(S.RECORD).parquet(path)
             .groupBy(F.col("_metadata.file_path").alias("path"), "topic", "partition")
             .agg(F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset"),
                  F.count(F.lit(1)).alias("records")))
    known = read_if_present(spark, f"{path}/{INDEX}", INDEX_SCHEMA)
    if known is not None:
        files = files.join(known.select("path").distinct(), "path", "left_anti")
    files.write.mode("append").parquet(f"{path}/{INDEX}")


# --- reading ---

def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def _listed(path: str) -> list[fs.FileInfo]:
    system, at = _opened(path)
    return system.get_file_info(fs.FileSelector(at, allow_not_found=True))


def _text(path: str) -> str | None:
    system, at = _opened(path)
    if system.get_file_info(at).type != fs.FileType.File:
        return None
    with system.open_input_stream(at) as f:
        return f.read().decode()


def logged_offsets(checkpoint: str) -> Offsets | None:
    """Position after the last batch in a checkpoint's offset log; None when there is none."""
    logs = [f.base_name for f in _listed(f"{checkpoint}/offsets") if f.base_name.isdigit()]
    if not logs:
        return None
    for line in _text(f"{checkpoint}/offsets/{max(logs, key=int)}").split("\n")[2:]:
        found = json.loads(line) if line.startswith("{") else None
        if found and all(isinstance(v, dict) for v in found.values()):
            return found
    return None


def admitted(start: Offsets, first: Offsets, until: Offsets, cap: int | None) -> Offsets:
    """Where the next batch ends: all that waits between ``start`` (else ``first``) and ``until``, or ``cap`` of it.

    A partition gets its share of what waits, rounded up, in order, until the
    cap is used up: none waits for ever.
    """
    at = {(t, p): max(start.get(t, {}).get(p, o), 0) for t, ps in first.items() for p, o in ps.items()}
    waits = {k: max(0, until[k[0]][k[1]] - o) for k, o in at.items()}
    total = sum(waits.values())
    end = {t: dict(ps) for t, ps in start.items()}
    left = total if cap is None else min(total, max(1, cap))
    # the longest queue first, so that one record a batch still reaches every partition in turn
    for k in sorted(waits, key=lambda k: (-waits[k], k)):
        share = waits[k] if cap is None or total <= cap else min(-(-waits[k] * max(1, cap) // total), left, waits[k])
        left -= share
        end.setdefault(k[0], {})[k[1]] = at[k] + share
    return end


@dataclass
class OffsetRange(InputPartition):
    """Offsets ``[start, end)`` of a topic-partition in one file."""

    path: str
    topic: str
    partition: int
    start: int
    end: int


class _ArchiveReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.checkpoint = options["path"].rstrip("/"), options["checkpoint"].rstrip("/")
        self.starting = options.get("startingoffsets", "earliest")
        self.cap = int(options["cap"]) if options.get("cap") else None
        self.control, self.rows = options.get("control"), int(options.get("recordspertask", 200_000))
        self.files: dict[tuple[str, str], list[tuple[int, int, str]]] = {}
        self.indexed: set[str] = set()
        self.at = logged_offsets(self.checkpoint)

    def _look(self) -> None:
        """Take in the index files that are new."""
        for f in _listed(f"{self.path}/{INDEX}"):
            if f.base_name in self.indexed or not f.base_name.endswith(".parquet"):
                continue
            self.indexed.add(f.base_name)
            system, at = _opened(f"{self.path}/{INDEX}/{f.base_name}")
            with system.open_input_file(at) as opened:
                for r in pq.read_table(opened).to_pylist():
                    self.files.setdefault((r["topic"], str(r["partition"])), []).append(
                        (r["from_offset"], r["until_offset"], r["path"]))

    def _edges(self, pick) -> Offsets:
        out: Offsets = {}
        for (topic, partition), files in self.files.items():
            out.setdefault(topic, {})[partition] = pick(files)
        return out

    def initialOffset(self) -> dict:
        self._look()
        first = self._edges(lambda files: min(f[0] for f in files))
        asked = json.loads(self.starting) if self.starting.lstrip().startswith("{") else {}
        for topic, partitions in asked.items():
            for partition, offset in partitions.items():
                if offset != EARLIEST:
                    first.setdefault(topic, {})[partition] = offset
        self.at = first
        return first

    def latestOffset(self) -> dict:
        if self.at is None:
            self.initialOffset()
        self._look()
        cap = self.cap
        if self.control:
            said = _text(self.control)
            cap = json.loads(said)["cap"] if said else cap
        self.at = admitted(self.at, self._edges(lambda files: min(f[0] for f in files)),
                           self._edges(lambda files: max(f[1] for f in files)), cap)
        return self.at

    def partitions(self, start: dict, end: dict) -> list[OffsetRange]:
        self._look()
        out = []
        for (topic, partition), files in sorted(self.files.items()):
            low = start.get(topic, {}).get(partition, 0)
            high = end.get(topic, {}).get(partition, 0)
            for first, until, path in sorted(files):
                a, b = max(first, low), min(until, high)
                for at in range(a, b, self.rows):
                    out.append(OffsetRange(path, topic, int(partition), at, min(at + self.rows, b)))
        return out

    def read(self, partition: OffsetRange) -> Iterator[pa.RecordBatch]:
        names = ["topic", "partition", "offset", "timestamp", "key", "value"]
        kinds = [pa.string(), pa.int32(), pa.int64(), pa.timestamp("us", "UTC"), pa.string(), pa.string()]
        system, at = _opened(partition.path)
        with system.open_input_file(at) as opened:
            file = pq.ParquetFile(opened)
            column = file.schema_arrow.get_field_index("offset")
            groups = []
            for g in range(file.num_row_groups):
                stats = file.metadata.row_group(g).column(column).statistics
                if stats is None or not stats.has_min_max or \
                        (stats.min < partition.end and stats.max >= partition.start):
                    groups.append(g)
            for batch in file.iter_batches(row_groups=groups, columns=names, batch_size=10_000):
                offset, of = batch.column("offset"), batch.column("partition")
                mine = pc.and_(pc.and_(pc.greater_equal(offset, partition.start), pc.less(offset, partition.end)),
                               pc.and_(pc.equal(of, partition.partition), pc.equal(batch.column("topic"), partition.topic)))
                batch = batch.filter(mine)
                if batch.num_rows:
                    yield pa.record_batch([_as(batch.column(n), k) for n, k in zip(names, kinds)], names=names)


def _as(column: pa.Array, kind: pa.DataType) -> pa.Array:
    if pa.types.is_timestamp(column.type) and column.type.tz is None and pa.types.is_timestamp(kind):
        column = pc.assume_timezone(column, "UTC")
    return column.cast(kind, safe=False)


class TopicArchive(DataSource):
    """The archive as the streaming format ``topic_archive``."""

    @classmethod
    def name(cls) -> str:
        return "topic_archive"

    def schema(self) -> str:
        return "topic string, partition int, offset long, timestamp timestamp, key string, value string"

    def streamReader(self, schema) -> _ArchiveReader:
        return _ArchiveReader(dict(self.options))


def archive_stream(spark: SparkSession, path: str, checkpoint: str, starting: str = "earliest", cap: int | None = None,
                   control: str | None = None, records_per_task: int = 200_000) -> DataFrame:
    """Records of an archive as a stream in offset order, for the query with this ``checkpoint``.

    ``starting``: ``earliest`` or next offsets as ``startingOffsets`` JSON, for
    a query without a checkpoint; partitions it does not name start at their
    first record. ``cap`` bounds a batch; with ``control`` the file there
    decides, once it exists. ``path``, ``checkpoint`` and ``control`` must lie on
    storage that the driver and the executors reach.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.dataSource.register(TopicArchive)
    options = {"path": path, "checkpoint": checkpoint, "startingoffsets": starting, "recordspertask": str(records_per_task)}
    if cap:
        options["cap"] = str(cap)
    if control:
        options["control"] = control
    return spark.readStream.format("topic_archive").options(**options).load()


def drained(path: str, checkpoint: str) -> bool:
    """Whether the query of this checkpoint has committed all that the archive's index holds."""
    reader = _ArchiveReader({"path": path, "checkpoint": checkpoint})
    reader._look()
    logs, commits = ([int(f.base_name) for f in _listed(f"{checkpoint}/{kind}") if f.base_name.isdigit()]
                     for kind in ("offsets", "commits"))
    at = logged_offsets(checkpoint) or {}
    return max(logs, default=-1) == max(commits, default=-1) and all(
        at.get(topic, {}).get(p, -1) >= until
        for topic, ends in reader._edges(lambda files: max(f[1] for f in files)).items() for p, until in ends.items())


def drain(query: StreamingQuery, path: str, checkpoint: str, poll_seconds: float = 0.2) -> None:
    """Wait until a query has read all that its archive holds, in as many batches as its cap makes of it, and stop it.

    (``availableNow`` asks a Python source once where to end: one batch of a capped source.)
    """
    while query.isActive and not drained(path, checkpoint):
        query.awaitTermination(poll_seconds)
    query.stop()
    if query.exception():
        raise query.exception()


def write_control(path: str, cap: int) -> None:
    """Set the cap in a control file: written beside it, then moved into its place."""
    system, at = _opened(path)
    beside = f"{at}.{uuid.uuid4().hex}"
    with system.open_output_stream(beside) as f:
        f.write(json.dumps({"cap": int(cap)}).encode())
    system.move(beside, at)
