"""Grouped and global aggregates.

Everything is expressed with ``groupBy().agg`` so Spark plans a partial (map-side)
hash aggregate before the shuffle: a hot key that holds a third of all rows is
reduced to one partial row per task before anything moves.  Comparisons with a
global aggregate use a scalar subquery (``DataFrame.scalar()``): Spark computes
the one-row aggregate once and uses it as a value -- no join, no driver-side
``collect``, no unpartitioned window over the raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.buckets import fixed_width_bin
from tessera.functions.numeric import as_col


def _keys(keys) -> list:
    return [keys] if isinstance(keys, (str, Column)) else list(keys)


def group_count(df: DataFrame, keys, name: str = "count") -> DataFrame:
    """A1/A2: rows per key (multi-key allowed)."""
    return df.groupBy(*_keys(keys)).agg(F.count(F.lit(1)).alias(name))


def group_agg(df: DataFrame, keys, aggs: Mapping[str, Column]) -> DataFrame:
    """Several aggregates per key in one pass, each aliased."""
    return df.groupBy(*_keys(keys)).agg(*[expr.alias(name) for name, expr in aggs.items()])


def distinct_count(df: DataFrame, col: str, name: str = "distinct_count",
                   approx: bool = False, rsd: float = 0.05) -> DataFrame:
    """A3: exact ``count(distinct)`` or HyperLogLog++ ``approx_count_distinct``.

    The exact form is planned as a two-level aggregate (dedupe per key, then
    count), so it partitions by the column; the approximate form merges fixed
    size sketches and never shuffles the raw values.
    """
    if approx:
        return df.agg(F.approx_count_distinct(col, rsd).alias(name))
    return df.agg(F.count_distinct(F.col(col)).alias(name))


def share_of_total(grouped: DataFrame, count_col: str = "count", pct_col: str = "percentage",
                   scale: float = 100.0) -> DataFrame:
    """``count / total * 100`` per group, in one job.

    ``total`` is the sum of the grouped counts (equal to the raw row count),
    a scalar subquery over the grouped frame; no driver-side ``count()``.
    """
    total = grouped.agg(F.sum(count_col)).scalar()
    return grouped.withColumn(pct_col, F.col(count_col) / total * F.lit(scale))


def compare_with_global(df: DataFrame, value_col: str, agg: str = "avg", op: str = ">",
                        stat_name: str | None = None) -> DataFrame:
    """Keep rows whose ``value_col`` compares ``op`` to a global aggregate.

    The aggregate is a scalar subquery (the reference collected it to the
    driver first).  ``stat_name`` keeps the statistic as a column when given.
    ``median`` is the bounded-memory ``percentile_approx`` sketch: an exact
    global median would buffer every value in one task.
    """
    fn = {"avg": F.avg, "max": F.max, "min": F.min, "sum": F.sum,
          "median": lambda c: F.percentile_approx(c, 0.5, 10000)}[agg]
    stat = df.agg(fn(value_col)).scalar()
    v = F.col(value_col)
    cond = {">": v > stat, ">=": v >= stat, "<": v < stat, "<=": v <= stat, "=": v == stat, "!=": v != stat}[op]
    out = df.filter(cond)
    return out.withColumn(stat_name, stat) if stat_name else out


def summary_stats(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A10: typed ``describe``: one row per column with count, mean, stddev, min, max.

    One aggregate pass computes all statistics for all columns; the wide row is
    then unpivoted with ``stack`` (a narrow projection on a single row).
    """
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__stddev"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    stack_args = ", ".join(
        f"'{c}', `{c}__count`, `{c}__mean`, `{c}__stddev`, `{c}__min`, `{c}__max`" for c in cols)
    return wide.selectExpr(
        f"stack({len(cols)}, {stack_args}) AS (column_name, count, mean, stddev, min, max)")


def dedup_by_key(df: DataFrame, keys, order_by: Sequence[str] | None = None) -> DataFrame:
    """One row per key, chosen deterministically.

    The kept row is the one with the smallest ``order_by`` values (then the
    remaining columns); a NULL sorts after every value, so attributes that some
    row has are not lost to a row without them.  Implemented as ``min(struct(...))`` per key: a hash
    aggregate with map-side partial merge, so a hot key never lands whole in one
    task (a ``row_number`` window would sort the hot key in one task).
    """
    keys = _keys(keys)
    key_names = [k if isinstance(k, str) else None for k in keys]
    rest = [c for c in df.columns if c not in key_names]
    order = [c for c in (order_by or []) if c in rest]
    packed = order + [c for c in rest if c not in order]
    if not packed:
        return df.select(*keys).distinct()
    fields = [f for i, c in enumerate(packed) for f in (F.col(c).isNull().alias(f"_n{i}"), F.col(c).alias(f"_{i}"))]
    best = F.min(F.struct(*fields)).alias("__best")
    out = df.groupBy(*keys).agg(best)
    return out.select(*keys, *[F.col(f"__best._{i}").alias(c) for i, c in enumerate(packed)]).select(df.columns)


def binned_average(df: DataFrame, value_col, target_col: str, width: float, low: float, high: float,
                   bin_name: str = "bin_start", avg_name: str = "avg_value",
                   count_name: str | None = "n") -> DataFrame:
    """Average of ``target_col`` per left-closed fixed-width bin of ``value_col``.

    Rows outside ``[low, high)`` (and NULL) are excluded, like ``pd.cut`` with
    ``observed=True``.  The range filter sits before the aggregate, and reaches
    the scan where the value is a plain column.
    """
    v = as_col(value_col)
    binned = df.filter((v >= F.lit(low)) & (v < F.lit(high))).withColumn(
        bin_name, fixed_width_bin(v, width, low, high))
    aggs = [F.avg(target_col).alias(avg_name)]
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    return binned.groupBy(bin_name).agg(*aggs)
