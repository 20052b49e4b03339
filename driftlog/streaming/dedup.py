"""First event per (day, visitor) on a stream.

A streaming aggregation, not a streaming dedup: ``min`` of a struct led by
``(ts, tie)`` per ``(day, id)``. Streaming aggregations combine on the map
side before the state-store shuffle, so a visitor that sends a third of all
events still leaves each map task as one row per micro-batch (a
``dropDuplicates`` would ship every one of its rows to a single task).

The struct also carries the micro-batch time (``current_timestamp()`` is
fixed per micro-batch and replayed with it), so each batch emits only the
keys whose earliest event was set in that batch: new visitors, or a
visitor whose late-arriving event is earlier than the one already stored.
Stores read the current view with ``current_first_seen`` (earliest event per
key over all batches and runs), which then equals the batch operator
``daily_first_seen`` exactly.

State is keyed by the day. The watermark is on the day's start, held back by
``lateness`` and the longest day (25 hours), so an event is kept at least as
long as it is no later than ``lateness`` behind the newest one, also when a
newer event has already begun the next day. Days wholly older are evicted,
and their events dropped, not counted as new visitors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from driftlog.functions.time import wall_to_instant
from driftlog.operators.dedup import pick_per_key
from driftlog.operators.project import with_event_day

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
OUTPUT_MODE = "update"

# the event time rides on the day's start, which lies up to this much before it
LONGEST_DAY = "25 hours"

_DAY, _PICK, _SEEN, _ROW = "_day", "_pick", "_seen_at", "_row"


def use_rocksdb_state(spark) -> None:
    """Keep large key sets off the JVM heap (only if no provider is configured).

    With RocksDB, changelog checkpointing (unless set otherwise) uploads
    only each batch's changes to the checkpoint instead of a full snapshot.
    """
    key = "spark.sql.streaming.stateStore.providerClass"
    if not spark.conf.get(key, None):
        spark.conf.set(key, ROCKSDB)
        changelog = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
        if spark.conf.get(changelog, None) in (None, "false") and \
                not spark.sparkContext.getConf().contains(changelog):
            spark.conf.set(changelog, "true")


def day_start(dt: Column, tz: str = "UTC") -> Column:
    """Instant at which local day ``dt`` (``yyyy-MM-dd``) starts in ``tz``."""
    wall = F.to_timestamp_ntz(dt, F.lit("yyyy-MM-dd"))
    utc = wall if tz == "UTC" else F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)
    return wall_to_instant(utc)


def daily_first_seen_stream(df: DataFrame, id_col: str, ts_col: str = "ts",
                            tie_col: str | None = None, tz: str = "UTC", millis: bool = True,
                            lateness: str = "1 day") -> DataFrame:
    """Streaming first-seen per (``dt``, ``id_col``); adds ``dt`` and ``hr``.

    Write it with output mode ``update`` (the jobs do). Output columns are
    the input's plus ``dt`` and ``hr``, in the batch operator's order.
    """
    dated = with_event_day(df, ts_col, tz, millis)
    out_cols = dated.columns
    rest = [c for c in out_cols if c not in ("dt", id_col)]
    order = [ts_col] + ([tie_col] if tie_col else [c for c in rest if c != ts_col])
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.col(_SEEN), F.struct(*rest).alias(_ROW))
    agg = (dated.withColumn(_DAY, day_start(F.col("dt"), tz))
           .withColumn(_SEEN, F.current_timestamp())  # the micro-batch time
           .withWatermark(_DAY, f"{lateness} {LONGEST_DAY}")
           .groupBy(_DAY, "dt", id_col)
           .agg(F.min(packed).alias(_PICK)))
    changed = agg.where(F.col(f"{_PICK}.{_SEEN}") == F.current_timestamp())
    by_name = {"dt": F.col("dt"), id_col: F.col(id_col)}
    by_name.update({c: F.col(f"{_PICK}.{_ROW}.{c}").alias(c) for c in rest})
    return changed.select(*[by_name[c] for c in out_cols])


def current_first_seen(store: DataFrame, id_col: str, ts_col: str = "ts") -> DataFrame:
    """Current first-seen view of a store written batch by batch.

    The earliest event per key; of equal times the latest correction of the
    latest run.
    """
    run = F.col("run") if "run" in store.columns else F.lit(0)
    newest = store.withColumns({"_r": -run, "_b": -F.col("batch_id")})
    return pick_per_key(newest, ["dt", id_col], [ts_col, "_r", "_b"]).drop("_r", "_b")
