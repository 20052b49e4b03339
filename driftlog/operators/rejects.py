"""Documents that a search index would refuse, or has refused.

``split_rejected`` applies the server's documented limits before the write, in
one narrow pass: a document over one of them would fail its whole bulk
request. ``rejected_documents`` reads what the connector's error handler has
set aside (``streaming.sinks.search_index_options(rejects=)``). Both give
rows of one shape: document id, reason, detail, the document as JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from driftlog.functions.json import to_json_doc

# Limits of the server's documentation, in bytes: an id, a keyword value, a request.
MAX_ID_BYTES = 512
MAX_KEYWORD_BYTES = 32766
MAX_DOCUMENT_BYTES = 100 * 1024 * 1024

REJECT = "reject"
REJECT_COLUMNS = ["doc_id", "reason", "detail", "document"]


def _bytes(c: Column) -> Column:
    return F.octet_length(c)


def reject_reason(df: DataFrame, id_col: str, keywords: list[str], max_id: int = MAX_ID_BYTES,
                  max_keyword: int = MAX_KEYWORD_BYTES, max_document: int = MAX_DOCUMENT_BYTES) -> tuple[Column, Column]:
    """(reason, detail) of a row, null when it may be written; the first check that fails counts.

    ``missing_id``; ``id_too_long``; ``keyword_too_long`` (detail: the first such
    column of ``keywords``); ``document_too_large`` (as JSON).
    """
    key = F.col(id_col).cast("string")
    long = F.coalesce(*[F.when(_bytes(F.col(c).cast("string")) > max_keyword, F.lit(c)) for c in keywords],
                      F.lit(None).cast("string"))
    large = _bytes(to_json_doc(df.columns)) > max_document
    if all(isinstance(f.dataType, T.AtomicType) for f in df.schema.fields):
        # a JSON escape makes at most 6 bytes of one: rows that cannot be too large are never built as JSON
        texts = [F.coalesce(_bytes(F.col(f.name)), F.lit(0)) for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        fixed = sum(len(c.encode()) + 40 for c in df.columns)
        large = (6 * sum(texts, F.lit(0).cast("long")) + fixed > max_document) & large
    reason = (F.when(key.isNull() | (key == ""), "missing_id").when(_bytes(key) > max_id, "id_too_long")
              .when(long.isNotNull(), "keyword_too_long").when(large, "document_too_large"))
    return reason, F.when(reason == "keyword_too_long", long)


def split_rejected(df: DataFrame, id_col: str, keywords: list[str] | None = None, **limits) -> tuple[DataFrame, DataFrame]:
    """(rows to write, rejected rows as ``REJECT_COLUMNS``). ``keywords``: text columns indexed as keywords."""
    reason, detail = reject_reason(df, id_col, keywords or [], **limits)
    judged = df.withColumn(REJECT, F.struct(reason.alias("reason"), detail.alias("detail")))
    bad = judged.where(F.col(f"{REJECT}.reason").isNotNull())
    return (judged.where(F.col(f"{REJECT}.reason").isNull()).drop(REJECT),
            bad.select(F.col(id_col).cast("string").alias("doc_id"), f"{REJECT}.reason", f"{REJECT}.detail",
                       to_json_doc(df.columns).alias("document")))


# An event of the connector's index error handler (the fields read).
HANDLER_EVENT = T.StructType([
    T.StructField("event", T.StructType([T.StructField("raw", T.StringType())])),
    T.StructField("error", T.StructType([T.StructField("code", T.StringType()), T.StructField("message", T.StringType())])),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
])


def rejected_documents(events: DataFrame, id_field: str | None = None, job: str | None = None) -> DataFrame:
    """Handler events -> ``REJECT_COLUMNS``: reason and detail are the error's code and message.

    ``event.raw`` holds the refused document as it was sent: one JSON object,
    or the bulk's action line and the object after it. ``id_field`` names
    the id within the document; without it the action line's ``_id`` counts.
    ``job`` keeps one job's events.
    """
    if job is not None:
        events = events.where(F.col("labels")["job"] == job)
    lines = F.filter(F.split("event.raw", "\n"), lambda x: F.length(F.trim(x)) > 0)
    document = F.try_element_at(lines, F.lit(-1))
    action = F.when(F.size(lines) > 1, F.get(lines, 0))
    named = F.get_json_object(document, f"$.{id_field}") if id_field else F.lit(None).cast("string")
    sent = F.coalesce(F.get_json_object(action, "$.index._id"), F.get_json_object(action, "$.create._id"),
                      F.get_json_object(action, "$.update._id"))
    return events.select(F.coalesce(named, sent).alias("doc_id"), F.col("error.code").alias("reason"),
                         F.col("error.message").alias("detail"), F.when(F.size(lines) > 0, document).alias("document"))
