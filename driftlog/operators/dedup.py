"""Keep one row per key: the first (or last) by an ordering.

Expressed as a grouped ``min``/``max`` of a struct whose leading fields are
the ordering, so Spark aggregates partially on the map side before the
shuffle: a key that holds a third of all rows leaves each map task as a
single row, and no task ever sorts or buffers a whole group. A
``row_number()`` window would instead shuffle and sort every row of the
hot key into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from driftlog.operators.project import with_event_day

_PICK = "_pick"
_ROW = "_row"


def pick_per_key(df: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """One row per ``keys``: the smallest (``last=False``) or largest ``order`` tuple.

    Make ``order`` unique within a key (end it with a unique column) for a
    deterministic pick. Null order values sort first. Output keeps the
    input's columns and column order. Select only the columns you need
    first: the packed struct carries every column it is given through the
    shuffle, and Catalyst cannot prune fields out of it afterwards.
    """
    rest = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      F.struct(*rest).alias(_ROW))
    agg = (F.max if last else F.min)(packed).alias(_PICK)
    picked = df.groupBy(*keys).agg(agg)
    by_name = {k: F.col(k) for k in keys}
    by_name.update({c: F.col(f"{_PICK}.{_ROW}.{c}").alias(c) for c in rest})
    return picked.select(*[by_name[c] for c in df.columns])


def daily_first_seen(df: DataFrame, id_col: str, ts_col: str = "ts", tie_col: str | None = None,
                     tz: str = "UTC", millis: bool = True) -> DataFrame:
    """First event per (event day, ``id_col``), day taken in ``tz``.

    Adds ``dt`` and ``hr``. Ties on ``ts_col`` are broken by ``tie_col``
    (use a unique column, e.g. the source offset), else by every column.
    """
    dated = with_event_day(df, ts_col, tz, millis)
    order = [ts_col] + ([tie_col] if tie_col else [c for c in dated.columns if c != ts_col])
    return pick_per_key(dated, ["dt", id_col], order)


def latest_documents(docs: DataFrame, id_col: str, order: list[str] | None = None) -> DataFrame:
    """Current state of a keyed document store: the last version per id.

    ``order`` defaults to ``["run", "batch_id", "offset"]``, those present: a
    later run replaces an earlier one, then a later batch, and inside a batch
    the later source offset wins.
    """
    if order is None:
        order = [c for c in ("run", "batch_id", "offset") if c in docs.columns]
        if not order:
            raise ValueError("pass order=, e.g. ['batch_id', <unique column>]")
    return pick_per_key(docs, [id_col], order, last=True)
