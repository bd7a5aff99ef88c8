"""Keep-first / last-wins dedup on a key in arrival order (DD-1, DD-2, DD-3).

Written as a grouped ``min_by``/``max_by`` over a struct of the row, not as
``row_number()`` over a window: the aggregate runs a partial (map-side) step,
so a key holding a third of all rows is reduced to one row per map task
before the shuffle instead of being sorted whole in one task. NULL keys group
together (one survivor), matching pandas ``drop_duplicates``.

``order`` must be a total order of the rows (for landed records: the arrival
position ``_parent, _page, _pos``); ties between rows that differ outside
``order`` would otherwise be broken arbitrarily.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[str], first: bool) -> DataFrame:
    keys, order = list(keys), list(order)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    # the order's own columns are not carried a second time: they are left out of the plan where nothing asks for them
    placed = [c for c in rest if c in order]
    payload = [c for c in rest if c not in order] or rest
    chooser, end = (F.min_by, F.min) if first else (F.max_by, F.max)
    picked = df.groupBy(*keys).agg(
        chooser(F.struct(*payload), F.struct(*order)).alias("_row"), end(F.struct(*order)).alias("_place"))
    return picked.select(*keys, *[F.col("_row")[c].alias(c) for c in payload],
                         *[F.col("_place")[c].alias(c) for c in placed if c not in payload]).select(*df.columns)


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """DD-1: first row per key in ``order``."""
    return _pick(df, keys, order, first=True)


def dedup_last(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """DD-2: last row per key in ``order`` (later rows overwrite earlier)."""
    return _pick(df, keys, order, first=False)


def distinct_values(df: DataFrame, *cols: str) -> DataFrame:
    """DD-3: ``SELECT DISTINCT cols``."""
    return df.select(*cols).distinct()
