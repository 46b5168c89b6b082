"""Rows without a match in a much larger table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def without_match(rows: DataFrame, seen: DataFrame, key: list[str]) -> DataFrame:
    """Rows, unique by ``key``, whose key is not in ``seen``; two null key parts are equal.

    ``seen`` may be far larger than ``rows``: only its key columns are read, and a semi-join first
    keeps what the rows can meet. While the rows are small enough for Spark to broadcast, ``seen`` is
    not shuffled at all; beyond that both joins work on one partitioning by key.
    """

    def keys_of(df: DataFrame, prefix: str) -> DataFrame:
        # Names of their own, so that both sides may come from one table.
        return df.select(*[F.col(name).alias(prefix + name) for name in key])

    def same(left: str, right: str) -> Column:
        parts = [F.col(left + name).eqNullSafe(F.col(right + name)) for name in key]
        return reduce(Column.__and__, parts)

    met = keys_of(seen, "_seen_").join(keys_of(rows, "_new_"), same("_seen_", "_new_"), "left_semi")
    return rows.join(met, same("", "_seen_"), "left_anti")
