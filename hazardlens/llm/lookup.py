"""Joins with a table that has one row per key, where some keys may hold a large part of the other side's rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazardlens.llm.storage import save

#: A key with more than one in so many rows is met by a broadcast; fewer keys than this can be that frequent.
HOT = 256
#: Rows of a key that need no such care.
LEAST = 1000


def lookup(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` with the columns of ``table``, which has one row per key; rows of absent or null keys are left out.

    Both are read more than once, so they should be saved tables. The rows of a frequent key stay where they are.
    """
    least = max(LEAST, rows.count() // HOT)
    hot = rows.groupBy(keys).count().where(F.col("count") > least).select(keys)
    hot = save(hot.coalesce(1), "hot-keys")
    if hot.isEmpty():
        return rows.join(table, keys)
    few = F.broadcast(table.join(F.broadcast(hot), keys, "left_semi"))
    rest = rows.join(F.broadcast(hot), keys, "left_anti").join(table, keys)
    return rest.unionByName(rows.join(few, keys))
