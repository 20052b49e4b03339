"""JSON column functions: one permissive parse per level plus a strict check."""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from driftlog.schemas import CORRUPT, with_corrupt

# Parse options: a malformed text lands in the corrupt column instead of
# failing the task; single quotes are not JSON.
PARSE_OPTIONS = {
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": CORRUPT,
    "allowSingleQuotes": "false",
}

_OBJECT_ONLY = T.StructType([])


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_object(text: Column | str, schema: T.StructType) -> Column:
    """``from_json`` into ``schema`` plus the corrupt column.

    A non-string JSON value under a string field comes back as its JSON text
    (``7`` -> ``"7"``, an object -> its text). Duplicate keys keep the last.
    """
    return F.from_json(_col(text), with_corrupt(schema), PARSE_OPTIONS)


def object_check(text: Column | str, parsed: Column) -> Column:
    """True when ``text`` is exactly one JSON object, given its parse.

    The text must be non-empty, start with ``{`` and end with ``}``, parse
    without landing in the corrupt column, and hold exactly one top-level
    value. The parse alone stops after the first value and ignores the
    rest, so the count is taken as an array: ``[t]`` must hold one element
    (rejects ``{"a":1} x}`` and ``{"a":1},{"b":2}``). That count also stops
    at the first closing bracket, so a text with a top-level ``]``
    (``{} ] [ {}``) would pass; for a text containing ``]``, ``[t,t]`` must
    then hold two elements, which only a single complete value gives.
    Never null.
    """
    t = _col(text)

    def _count(*parts: Column) -> Column:
        return F.json_array_length(F.concat(F.lit("["), *parts, F.lit("]")))

    # A text that starts with '{' and ends with '}' always parses to a
    # non-null struct, so the parse is referenced once, after the cheap
    # character tests (And short-circuits). The doubled count runs only on
    # texts holding a ']'.
    return F.coalesce(
        t.startswith("{")
        & t.endswith("}")
        & parsed.getField(CORRUPT).isNull()
        & (_count(t) == 1)
        & (~t.contains("]") | (_count(t, F.lit(","), t) == 2)),
        F.lit(False),
    )


def is_json_object(text: Column | str) -> Column:
    """Stand-alone strict check; parses ``text`` with an empty field list."""
    return object_check(text, parse_object(text, _OBJECT_ONLY))


def to_json_doc(cols: list[str] | None = None, keep_nulls: bool = True) -> Column:
    """A JSON object keyed by column name, for every column or ``cols``."""
    target = F.struct(*(cols or ["*"]))
    return F.to_json(target, {"ignoreNullFields": "false" if keep_nulls else "true"})
