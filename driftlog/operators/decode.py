"""Decode log envelopes into the tracking payload, with quarantine reasons.

All steps are narrow column expressions: no shuffle, one stage, and each
JSON level is parsed into columns once (``from_json`` against a schema pruned
to the fact columns wanted, plus a corrupt-record column); the strict check
of a level tokenises its text again to count values. Works on batch and
streaming frames alike.

Levels: record ``value`` -> envelope -> ``message`` text -> access-log line
-> ``args`` -> strip ``params=`` -> URL-decode -> payload (with object ``d``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from driftlog import schemas as S
from driftlog.functions.json import object_check, parse_object
from driftlog.functions.url import decode_args as _decode_args_col

# Internal column names; dropped by the projections.
ENV, LINE, PTEXT, PAYLOAD = "_env", "_line", "_payload_text", "_payload"
REASON = "reason"
INTERNAL = [ENV, LINE, PTEXT, PAYLOAD]

MODES = ("permissive", "failfast")


def decode_envelope(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Record value -> envelope (``_env``) and its ``message`` text.

    ``message`` given as an object instead of text comes back as that
    object's JSON text, so both forms decode the same way below.
    """
    return df.withColumn(ENV, parse_object(F.col(value_col), S.ENVELOPE_READ))


def access_log_columns(df: DataFrame) -> DataFrame:
    """``message`` text -> access-log line (``_line``)."""
    return df.withColumn(LINE, parse_object(F.col(ENV)["message"], S.LINE_READ))


def decode_args(df: DataFrame, strict: bool = False) -> DataFrame:
    """``args`` -> payload text: strip every ``params=``, then URL-decode."""
    return df.withColumn(PTEXT, _decode_args_col(F.col(LINE)["args"], strict))


def decode_payload(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Payload text -> payload struct with nested ``d``, pruned to the fact ``columns`` wanted.

    ``d`` may be an object or the text of one. A payload whose ``d`` is text
    does not parse with ``d`` as an object; only such rows are parsed again
    with ``d`` as text, whose object is then parsed by itself. Text that is
    not one object leaves the payload malformed.
    """
    schema = S.payload_read(columns)
    first, again = "_payload_1", "_payload_2"
    out = df.withColumn(first, parse_object(F.col(PTEXT), schema))
    out = out.withColumn(again, F.when(F.col(first)[S.CORRUPT].isNotNull(),
                                       parse_object(F.col(PTEXT), S.payload_read(columns, T.StringType()))))
    out = out.withColumn("_d", F.when(F.col(again).isNotNull(), parse_object(F.col(again)["d"], S.payload_d(columns))))
    alt = F.col(again)
    bad = alt[S.CORRUPT].isNotNull() | ~object_check(alt["d"], F.col("_d"))
    rebuilt = F.struct(*[alt[f.name].alias(f.name) for f in schema.fields[:-1]],
                       F.struct(*[F.col("_d")[f.name].alias(f.name) for f in schema["d"].dataType.fields]).alias("d")
                       if len(schema["d"].dataType.fields) else F.lit(None).cast(schema["d"].dataType).alias("d"),
                       F.lit(None).cast("string").alias(S.CORRUPT))
    payload = F.when(alt.isNull() | bad, F.col(first)).otherwise(rebuilt)
    return out.withColumn(PAYLOAD, payload).drop(first, again, "_d")


def reason_expr(value_col: str = "value") -> Column:
    """First failing check, or null for a good record."""
    env, line, ptext, payload = F.col(ENV), F.col(LINE), F.col(PTEXT), F.col(PAYLOAD)
    message = env["message"]
    return (
        F.when(~object_check(F.col(value_col), env), F.lit("bad_envelope"))
        .when(~object_check(message, line), F.lit("bad_message"))
        .when(line["args"].isNull(), F.lit("missing_args"))
        .when(~object_check(ptext, payload), F.lit("bad_payload"))
    )


def decode_records(df: DataFrame, value_col: str = "value", mode: str = "permissive",
                   columns: list[str] | None = None) -> DataFrame:
    """All decode levels plus a ``reason`` column (null when the record is good).

    ``columns``: the fact columns that will be projected (default: all); the
    payload is parsed for these only.

    ``permissive``: bad records stay, tagged with the first failing check
    (``bad_envelope``, ``bad_message``, ``missing_args``, ``bad_payload``);
    a payload without ``d`` is good and its ``d`` columns are null.
    ``failfast``: the first bad record, a bad URL escape, or a payload
    without ``d`` fails the query.

    Split the result with ``good`` / ``quarantined`` / ``project_fact`` (or
    persist it first), not with ``where`` on ``reason``: see ``keep_where``.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "failfast" and columns is not None:
        columns = [*columns, *S.PAYLOAD_D_FIELDS]   # whether there is a d is looked at
    out = decode_payload(decode_args(access_log_columns(decode_envelope(df, value_col)),
                                     strict=(mode == "failfast")), columns)
    reason = reason_expr(value_col)
    if mode == "failfast":
        reason = F.when(reason.isNotNull(),
                        F.raise_error(F.concat(F.lit("bad record: "), reason)))\
            .when(F.col(PAYLOAD)["d"].isNull(), F.raise_error(F.lit("bad record: missing d")))
    return out.withColumn(REASON, reason)


def decode_visitors(records: DataFrame, value_col: str = "value") -> DataFrame:
    """Records whose envelope ``message`` should be a visitor event (as an object
    or as text), with ``reason``: the first failing check of ``bad_envelope``,
    ``bad_message``, ``missing_ts`` and ``missing_mid``, or null.
    """
    env = parse_object(F.col(value_col), S.ENVELOPE_READ)
    dec = records.withColumn(ENV, env).withColumn(LINE, parse_object(F.col(ENV)["message"], S.VISITOR_EVENT))
    event = F.col(LINE)
    reason = (F.when(~object_check(F.col(value_col), F.col(ENV)), F.lit("bad_envelope"))
              .when(~object_check(F.col(ENV)["message"], event), F.lit("bad_message"))
              .when(event["ts"].isNull(), F.lit("missing_ts"))
              .when(event["common"]["mid"].isNull(), F.lit("missing_mid")))
    return dec.withColumn(REASON, reason)


def decode_visitor_events(records: DataFrame, value_col: str = "value",
                          keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Good visitor events -> ``(ts millis, common{mid, uid, ar, ch, vc})`` plus ``keep``.

    The others are ``quarantined(decode_visitors(records))``.
    """
    return keep_where(decode_visitors(records, value_col), F.col(REASON).isNull(),
                      [*keep, F.col(LINE)["ts"].alias("ts"), F.col(LINE)["common"].alias("common")])


def access_log_fields(decoded: DataFrame, keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """The line fields the jobs read (``timestamp, client_ip, domain, args``) of good records."""
    line = F.col(LINE)
    return keep_where(decoded, F.col(REASON).isNull(),
                      [*keep, *[line[c].alias(c) for c in S.LINE_READ_FIELDS]])


def keep_where(df: DataFrame, cond: Column, cols: list[Column | str]) -> DataFrame:
    """Rows where ``cond`` holds, projected to ``cols``, without a pushable filter.

    A plain ``where`` on a column computed from parsed JSON is pushed by
    Catalyst below the projections that parse, with every alias inlined:
    each JSON level would then be parsed once per reference, multiplying
    with the nesting depth. Emitting each row as a 0- or 1-element array
    and ``inline``-ing it keeps one parse per level and one pass.
    """
    exprs = [F.col(c) if isinstance(c, str) else c for c in cols]
    return df.select(F.inline(F.when(cond, F.array(F.struct(*exprs)))))


def good(decoded: DataFrame, cols: list[Column | str] | None = None) -> DataFrame:
    """Good records (``reason`` null), projected to ``cols`` (default: all)."""
    return keep_where(decoded, F.col(REASON).isNull(), cols or decoded.columns)


def quarantined(decoded: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Bad records with their reason; by default every input column is kept."""
    cols = keep or [c for c in decoded.columns if c not in INTERNAL]
    return keep_where(decoded, F.col(REASON).isNotNull(), cols)


def split_valid(df: DataFrame, col: str) -> tuple[DataFrame, DataFrame]:
    """Split rows on whether ``col`` is exactly one JSON object.

    Returns ``(valid, quarantine)``; the quarantine frame carries
    ``reason = 'not_json_object'``. Rows go to exactly one side (a null text
    is quarantined). Persist ``df`` first if both sides are consumed.
    """
    from driftlog.functions.json import is_json_object

    flag = "_is_object"
    tagged = df.withColumn(flag, is_json_object(F.col(col)))
    valid = keep_where(tagged, F.col(flag), df.columns)
    bad = keep_where(tagged, ~F.col(flag), [*df.columns, F.lit("not_json_object").alias(REASON)])
    return valid, bad
