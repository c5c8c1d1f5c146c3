"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from tessera.operators.aggregates import dedup_by_key


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union matched by column name (no shuffle)."""
    return reduce(lambda a, b: a.unionByName(b), frames)


def union_distinct_on_key(frames: Sequence[DataFrame], keys, order_by: Sequence[str] | None = None) -> DataFrame:
    """Union then keep one row per key (deterministic choice, see ``dedup_by_key``)."""
    return dedup_by_key(union_all(frames), keys, order_by)
