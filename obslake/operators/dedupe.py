"""First-wins dedupe per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_wins(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the row with the smallest ``order_by`` tuple (nulls last, ties
    broken by the remaining columns, so the answer is deterministic).

    Written as ``min(struct(order..., rest...))`` per key rather than
    ``row_number()`` over a window: the aggregate runs partially on the map
    side, so a key holding a third of all rows is reduced to one candidate per
    map task before the shuffle, where a window would sort all of its rows in
    one task.
    """
    keys = list(keys)
    order_by = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    # A null sorts first in a struct: its flag before it puts it last.
    ranked = [x for i, c in enumerate(order_by) for x in (F.col(c).isNull().alias(f"_null_{i}"), F.col(c))]
    winner = F.min(F.struct(*ranked, *[F.col(c) for c in rest])).alias("_first")
    out = df.groupBy(*keys).agg(winner)
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in order_by + rest]) \
              .select(*df.columns)
