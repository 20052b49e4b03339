"""Filtered, sorted, paged text search over a document table.

Deep pages: ``offset`` sorts and merges all rows before the page; ``after``
continues behind the last row of the page before (``page_key``) by a
predicate, whose range on the sort column reaches the scan, so page 1,000
costs what page 1 does. Both give the same pages.

One plan: term filters (pushed to the scan when they are on plain
columns), a whole-text token match, a top-k sort with an id tie-break, an
offset, and highlighting applied only to the rows returned. No relevance
score is produced: results are ordered by an explicit field.
"""

from __future__ import annotations

from functools import reduce
from operator import and_
from typing import Any

from pyspark.sql import Column, DataFrame, functions as F

from driftlog.functions.text import highlight as _highlight
from driftlog.functions.text import matches_any, query_tokens


def term_filter(df: DataFrame, field: str, value: Any) -> Column:
    """Exact match. ``"arr.name"`` on an array of structs matches any element."""
    head, _, rest = field.partition(".")
    if rest and head in df.columns:
        dtype = df.schema[head].dataType.simpleString()
        if dtype.startswith("array<"):
            return F.exists(F.col(head), lambda e: e[rest] == F.lit(value))
    return F.col(field) == F.lit(value)


def _behind(sort: str | None, descending: bool, id_col: str, key: tuple) -> Column:
    """Rows that come after ``key`` (the sort value, nulls last, and the id) in the search order."""
    value, last = key
    later = F.col(id_col) > F.lit(last)
    if sort is None:
        return later
    if value is None:
        return F.col(sort).isNull() & later
    col, value = F.col(sort), F.lit(value)
    beyond, reach = (col < value, col <= value) if descending else (col > value, col >= value)
    # the plain range first: it is what a scan can use
    return (reach | col.isNull()) & (beyond | col.isNull() | ((col == value) & later))


def page_key(page: DataFrame, sort: str | None, id_col: str, descending: bool = True) -> tuple | None:
    """Key of a page's last row, for ``after`` of the next one; None for an empty page. One row is read."""
    columns = [F.col(sort) if sort else F.lit(None), F.col(id_col)]
    back = [] if sort is None else [F.col(sort).asc_nulls_first() if descending else F.col(sort).desc_nulls_first()]
    last = page.orderBy(*back, F.col(id_col).desc()).select(*columns).first()
    return None if last is None else tuple(last)


def search(df: DataFrame, text_col: str, query: str, filters: dict[str, Any] | None = None,
           sort: str | None = None, descending: bool = True, id_col: str | None = None,
           size: int = 20, offset: int = 0, highlight: bool = True,
           highlight_col: str | None = None, after: tuple | None = None) -> DataFrame:
    """Documents whose ``text_col`` holds any query token, filtered and paged.

    Order: ``sort`` (nulls last) then ``id_col`` ascending. The page is
    ``offset``..``offset + size``; Spark plans sort + limit as a per-partition
    top-k followed by one merge of at most ``offset + size`` rows per task.
    ``after``, the ``page_key`` of the page before, takes the place of an offset
    (needs ``id_col``, unique).
    ``highlight`` wraps matched tokens of ``text_col`` in ``<em>`` tags, into
    ``highlight_col`` (default ``<text_col>_highlight``).
    """
    toks = query_tokens(query)
    # the cheap term filters first: conditions run in the order they are given
    conds = [term_filter(df, field, value) for field, value in (filters or {}).items()]
    if after is not None:
        if offset or not id_col:
            raise ValueError("after needs id_col and no offset")
        conds.append(_behind(sort, descending, id_col, after))
    hits = df.where(reduce(and_, [*conds, matches_any(F.col(text_col), toks)]))
    order: list[Column] = []
    if sort:
        order.append(F.col(sort).desc_nulls_last() if descending else F.col(sort).asc_nulls_last())
    if id_col:
        order.append(F.col(id_col).asc())
    if order:
        hits = hits.orderBy(*order)
    page = hits.limit(offset + size)
    if offset:
        page = page.offset(offset)
    if highlight:
        page = page.withColumn(highlight_col or f"{text_col}_highlight",
                               _highlight(F.col(text_col), toks))
    return page
