"""Joins on keys that may hold a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_KEYS = 10_000


def join_counted(rows: DataFrame, table: DataFrame, keys: Sequence[str], n: str, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Inner join of `rows` with `table`, which has one row per key and in `n` the number of `rows` with that key.

    Keys with more than a `hot_keys`-th of all counted rows are broadcast: there are fewer than `hot_keys` of them,
    whatever the input. The rest meet in a shuffle, where no key holds more than that share. Both inputs are read twice,
    so they should be stored tables. No key is dropped: NULL keys and keys of one side only match nothing, as in any
    inner join.
    """
    names = list(keys)
    total = table.agg(F.sum(n)).first()[0] or 0
    is_hot = F.col(n) > total // hot_keys
    hot, cold = table.where(is_hot), table.where(~is_hot)
    met = rows.join(F.broadcast(hot), names)
    others = rows.join(F.broadcast(hot.select(*names)), names, "left_anti")
    return met.unionByName(others.join(cold, names))
