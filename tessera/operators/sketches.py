"""Distinct counts that merge (A3): HyperLogLog sketches kept as a column.

A sketch per key (a day, say) is a few kilobytes whatever the rows behind it.  Kept in a table,
sketches answer any union of keys later without the rows: the union of two sketches is the
sketch of both inputs.  Building them is an aggregate with map-side partial merge.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12


def distinct_sketches(rows: DataFrame, keys: Sequence[str | Column], value: str, lg_k: int = LG_K, name: str = "sketch") -> DataFrame:
    """One sketch of ``value``'s distinct values per key; NULL values do not count, a key without any has an empty sketch."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(value, lg_k).alias(name))


def merged_estimate(sketches: DataFrame, keys: Sequence[str | Column], name: str = "distinct_values", sketch: str = "sketch") -> DataFrame:
    """The estimate of the union of sketches per key."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg(sketch)).alias(name))


def range_estimates(sketches: DataFrame, ranges: DataFrame, key: str, name: str = "distinct_values", sketch: str = "sketch") -> DataFrame:
    """The estimate for every range ``range_start <= key <= range_end`` of dates.

    Each range is told its days by a sequence and meets them by equality: a row per (range, day), never per event.
    A range without any stored day has no row.
    """
    days = ranges.select("range_start", "range_end", F.explode(F.sequence("range_start", "range_end", F.expr("INTERVAL 1 DAY"))).alias(key))
    return merged_estimate(days.join(sketches, key), ["range_start", "range_end"], name, sketch)


def relative_error(lg_k: int = LG_K) -> float:
    """The sketch's standard error, with merged sketches' (higher) constant."""
    return 1.04 / math.sqrt(1 << lg_k)


__all__ = ["LG_K", "distinct_sketches", "merged_estimate", "range_estimates", "relative_error"]
