"""Declared schemas. Nothing is inferred at run time.

Every decode step parses JSON against one of these, pruned to the fields
that are read, so Catalyst never has to guess a type and the parquet scan
reads only the columns a query touches.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Field names and their order. They must stay exactly as the
# tracked access-log format names them, or decoded columns come out null.
# ---------------------------------------------------------------------------

# Access-log line carried as text in the envelope's ``message`` field.
# (it has more; these are the fields the decode reads).
LINE_READ_FIELDS = ["timestamp", "client_ip", "domain", "args"]

# Top-level payload fields kept in the fact record.
PAYLOAD_TOP_FIELDS = ["b", "s", "en", "et", "cu", "pu", "uid", "sid", "ref", "land"]
# Fields of the nested payload object ``d`` kept in the fact record.
PAYLOAD_D_FIELDS = ["gs", "oid", "st", "lvst", "chl", "poid", "catId", "shopId"]

# The 19-column fact record, in this order.
FACT_COLUMNS = ["b", "s", "en", "et", "cu", "pu", "uid", "sid", "ref", "land",
                "gs", "oid", "st", "lvst", "timestamp", "chl", "poid", "catId",
                "shopId"]

# The six-field document stored by the append jobs, in this order.
DOC6_COLUMNS = ["oid", "b", "catId", "chl", "cu", "en"]

# Visitor event: ``common`` object fields.
VISITOR_COMMON_FIELDS = ["mid", "uid", "ar", "ch", "vc"]
# Visitor record, in this order; ``mi`` is the constant minute "00".
VISITOR_COLUMNS = ["mid", "uid", "ar", "ch", "vc", "dt", "hr", "mi", "ts"]
VISITOR_MINUTE = "00"

# Prefix stripped (every occurrence) from ``args`` before URL decoding.
ARGS_PREFIX = "params="

# ---------------------------------------------------------------------------


def _strings(names: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Name of the column a JSON parse fills with the raw text when it is malformed.
CORRUPT = "_corrupt"

# Record as a message bus delivers it (Kafka source columns, key/value as text).
RECORD = T.StructType([
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("offset", T.LongType(), True),
    T.StructField("timestamp", T.TimestampType(), True),
    T.StructField("key", T.StringType(), True),
    T.StructField("value", T.StringType(), True),
])

# Outer envelope as read: only ``message`` is used.
ENVELOPE_READ = _strings(["message"])

LINE_READ = _strings(LINE_READ_FIELDS)


def payload_d(columns: list[str] | None = None) -> T.StructType:
    """The nested object ``d``, pruned to the fact ``columns`` wanted (default: all)."""
    return _strings([n for n in PAYLOAD_D_FIELDS if columns is None or n in columns])


def payload_read(columns: list[str] | None = None, d: T.DataType | None = None) -> T.StructType:
    """The payload, pruned to the fact ``columns`` wanted; ``d`` as an object unless typed otherwise."""
    top = _strings([n for n in PAYLOAD_TOP_FIELDS if columns is None or n in columns])
    return T.StructType([*top.fields, T.StructField("d", d or payload_d(columns), True)])


VISITOR_COMMON = _strings(VISITOR_COMMON_FIELDS)
VISITOR_EVENT = T.StructType([
    T.StructField("ts", T.LongType(), True),
    T.StructField("common", VISITOR_COMMON, True),
])

# Offset ledger: one row per (group, topic, run, batch, partition). A run is one
# streaming checkpoint; batch ids start again at 0 with every run.
LEDGER = T.StructType([
    T.StructField("group", T.StringType(), True),
    T.StructField("topic", T.StringType(), True),
    T.StructField("partition", T.IntegerType(), True),
    T.StructField("from_offset", T.LongType(), True),
    T.StructField("until_offset", T.LongType(), True),
    T.StructField("batch_id", T.LongType(), True),
    T.StructField("run", T.LongType(), True),
])


def with_corrupt(schema: T.StructType) -> T.StructType:
    """``schema`` plus the corrupt-record column a permissive parse fills."""
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType(), True)])
