"""Projections: fact record, documents, ids, event day, visitor record, JSON rows.

All narrow (no shuffle); they only select and compute columns, so Catalyst
prunes everything upstream that they do not reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftlog import schemas as S
from driftlog.functions.json import to_json_doc
from driftlog.functions.time import day_text, hour_text, instant_to_wall, millis_to_wall
from driftlog.operators.decode import LINE, PAYLOAD, REASON, decode_records, good


def fact_columns(columns: list[str] | None = None):
    """The fact columns (default: all 19) as expressions over a decoded frame."""
    p = F.col(PAYLOAD)

    def one(name: str):
        if name == "timestamp":
            return F.col(LINE)["timestamp"]
        return p["d"][name] if name in S.PAYLOAD_D_FIELDS else p[name]

    return [one(n).alias(n) for n in (S.FACT_COLUMNS if columns is None else columns)]


def project_fact(decoded: DataFrame, keep: list[str] | tuple[str, ...] = (),
                 columns: list[str] | None = None) -> DataFrame:
    """Good decoded records -> the fact record (all 19 columns, or ``columns``) plus ``keep`` columns.

    Missing keys are null, never ``""``.
    """
    return good(decoded, [*keep, *fact_columns(columns)])


def decode_fact(records: DataFrame, keep: list[str] | tuple[str, ...] = (),
                mode: str = "permissive", columns: list[str] | None = None) -> DataFrame:
    """Records -> fact rows in one narrow stage; bad records are left out.

    Name the fact ``columns`` you need: later projections cannot prune the
    parse, as good rows are emitted through an array (``keep_where``).
    """
    return project_fact(decode_records(records, mode=mode, columns=columns), keep, columns)


def project_doc(fact: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Fact -> the six-field document."""
    return fact.select(*keep, *S.DOC6_COLUMNS)


def with_doc_id(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Deterministic document id, so a retried write replaces, not duplicates.

    ``topic-partition-offset`` when the source position is present, else a
    SHA-256 of the record value.
    """
    cols = set(df.columns)
    if {"topic", "partition", "offset"} <= cols:
        doc_id = F.concat_ws("-", "topic", "partition", "offset")
    elif "value" in cols:
        doc_id = F.sha2(F.col("value"), 256)
    else:
        doc_id = F.sha2(F.to_json(F.struct(*sorted(cols))), 256)
    return df.withColumn(id_col, doc_id)


def with_event_day(df: DataFrame, ts_col: str = "ts", tz: str = "UTC",
                   millis: bool = True) -> DataFrame:
    """Add ``dt`` (``yyyy-MM-dd``) and ``hr`` (``HH``) of the event time in ``tz``.

    ``ts_col`` holds epoch milliseconds (``millis=True``), an instant
    (``timestamp``) or a UTC wall time (``timestamp_ntz``).
    The result does not depend on the session or JVM time zone.
    """
    c = F.col(ts_col)
    if millis:
        wall = millis_to_wall(c, tz)
    elif df.schema[ts_col].dataType.typeName() == "timestamp":
        wall = instant_to_wall(c, tz)
    else:
        wall = c if tz == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(tz), c)
    return df.withColumn("dt", day_text(wall)).withColumn("hr", hour_text(wall))


def project_visitor(df: DataFrame) -> DataFrame:
    """Visitor event with ``dt``/``hr`` -> the nine-field visitor record."""
    c = F.col("common")
    return df.select(
        *[c[n].alias(n) for n in S.VISITOR_COMMON_FIELDS],
        "dt", "hr", F.lit(S.VISITOR_MINUTE).alias("mi"), F.col("ts").cast("long").alias("ts"),
    )


def rows_to_json(df: DataFrame, key_cols: list[str] | tuple[str, ...] = (),
                 json_col: str = "json", keep_nulls: bool = True) -> DataFrame:
    """Each row -> one JSON object keyed by column name (nulls kept by default)."""
    return df.select(*key_cols, to_json_doc(list(df.columns), keep_nulls).alias(json_col))


__all__ = ["project_fact", "decode_fact", "project_doc", "with_doc_id", "with_event_day",
           "project_visitor", "rows_to_json", "REASON"]
