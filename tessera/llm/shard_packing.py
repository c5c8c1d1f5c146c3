"""Sharding by vector bin packing.

Every group of equal texts is a vector (bytes, tokens, rows).  Groups are placed
on the shard where the dot product of that vector with the shard's residual
capacity is highest, largest groups first, so bytes, tokens and rows are balanced
together.  The placement itself works on a bounded number of units, whatever the
input size:

* a *heavy* group (at least ``1/units`` of all bytes, tokens or rows; there can be
  at most ``3 * units``) is a unit of its own;
* all other groups fall into ``units`` bundles by the hash of their text;
* a *giant* group (at least ``1/256`` of bytes, tokens or rows) is cut into slices by
  the row's place in the staged table, so no task ever holds it, also where its rows repeat an id.  It stays on one shard
  while it is no larger than a shard; beyond that its slices are placed one by one.

Law: ``bytes``.  The shards' sizes differ by about one unit (1/1024 of a shard at
the default of 16,384 units for 16 shards).

Defined cases: a NULL text has size 1 and the token count and checksum of the empty
text, with which it forms a group; repeated rows are packed as separate rows of one
group; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import staged

UNITS = 16384
GIANT_PARTS = 256
SLICE_ROWS = 1_000_000
MIN_SLICES = 64


def place(vectors: np.ndarray, n_shards: int) -> np.ndarray:
    """Shard of each unit: the highest dot product with the residual capacity, among shards it fits.

    ``vectors`` is (units, dims); the capacity of a shard is the mean load.  A unit that
    fits nowhere goes where the most capacity is left in its tightest dimension.
    """
    totals = vectors.sum(axis=0)
    demand = vectors / np.where(totals > 0, totals / n_shards, 1.0)
    residual = np.ones((n_shards, vectors.shape[1]))
    out = np.empty(len(vectors), dtype=np.int32)
    for i in np.argsort(-demand.max(axis=1), kind="stable"):
        left = residual - demand[i]
        slack = left.min(axis=1)
        score = residual @ demand[i]
        fits = slack >= 0
        shard = int(np.argmax(np.where(fits, score, -np.inf))) if fits.any() else int(np.argmax(slack))
        residual[shard] = left[shard]
        out[i] = shard
    return out


def pack_shards(spark: SparkSession, docs: DataFrame, n_shards: int = 16, units: int = UNITS,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard, tokens`` for every row of ``docs``."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = staged(spark, docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.regexp_count(text, F.lit("[^ \\t-\\r]+")).cast("long").alias("tokens"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("g"),
        # Task and place in it: told once, when the table is written.
        F.monotonically_increasing_id().alias("place")), "shard-rows")
    groups = staged(spark, rows.groupBy("g").agg(
        F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")), "shard-groups")
    total = groups.agg(*(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in "btr")).first()

    def at_least(parts: int):
        shares = [F.col(c) * parts >= F.lit(total[c]) for c in "btr" if total[c] > 0]
        cond = F.lit(False)
        for s in shares:
            cond = cond | s
        return cond

    # Bounded by construction: at most 3 * units heavy groups and `units` bundles.
    heavy = groups.filter(at_least(units)).withColumn("giant", at_least(GIANT_PARTS)).toPandas()
    light = (groups.filter(~at_least(units)).groupBy(F.pmod(F.xxhash64("g"), F.lit(units)).alias("bundle"))
             .agg(*(F.sum(c).alias(c) for c in "btr")).toPandas())
    giants = heavy[heavy.giant]
    parts = spark.createDataFrame(
        pd.DataFrame({"g": giants.g.astype(str), "n": np.maximum(MIN_SLICES, -(-giants.r.astype("int64") // SLICE_ROWS))}),
        "g string, n long")
    sliced = (rows.join(F.broadcast(parts), "g")
              .groupBy("g", F.pmod(F.xxhash64("place"), F.col("n")).alias("slice"))
              .agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count("*").alias("r")).toPandas())

    # Placement: whole groups where they fit a shard, slices of larger ones.
    capacity = np.array([max(1, total[c]) / n_shards for c in "btr"])
    oversize = set(giants.g[(giants[["b", "t", "r"]].to_numpy(float) > capacity).any(axis=1)])
    whole = heavy[~heavy.g.isin(oversize)]
    cut = sliced[sliced.g.isin(oversize)]
    chosen = place(np.concatenate([f[["b", "t", "r"]].to_numpy(float) for f in (whole, cut, light)]), n_shards)
    whole = whole.assign(shard=chosen[:len(whole)], slice=0)
    cut = cut.assign(shard=chosen[len(whole):len(whole) + len(cut)])
    light = light.assign(shard=chosen[len(whole) + len(cut):], slice=0, g=None)
    kept = sliced[~sliced.g.isin(oversize)].merge(whole[["g", "shard"]], on="g")
    cols = ["g", "slice", "bundle", "shard", "r"]
    unit = pd.concat([f.reindex(columns=cols) for f in (whole[~whole.giant], kept, cut, light)], ignore_index=True)
    unit["slice"], unit["bundle"] = unit["slice"].astype("int64"), unit["bundle"].fillna(-1).astype("int64")
    unit["first"] = unit.groupby("shard").r.cumsum() - unit.r
    unit["g"] = unit.g.where(unit.g.notna(), "").astype(str)
    unit = unit.astype({"shard": "int32", "first": "int64"})
    table = spark.createDataFrame(unit[["g", "slice", "bundle", "shard", "first"]],
                                  "g string, slice long, bundle long, shard int, first long")
    own = spark.createDataFrame(
        pd.DataFrame({"g": heavy.g.astype(str)}).merge(
            pd.DataFrame({"g": giants.g.astype(str), "n": np.maximum(MIN_SLICES, -(-giants.r.astype("int64") // SLICE_ROWS))}),
            on="g", how="left").fillna({"n": 1}).astype({"n": "int64"}), "g string, n long")
    placed = (rows.join(F.broadcast(own), "g", "left")
              .withColumn("bundle", F.when(F.col("n").isNull(), F.pmod(F.xxhash64("g"), F.lit(units))).otherwise(F.lit(-1)))
              .withColumn("slice", F.when(F.col("n") > 1, F.pmod(F.xxhash64("place"), F.col("n"))).otherwise(F.lit(0)))
              .withColumn("g", F.when(F.col("n").isNull(), F.lit("")).otherwise(F.col("g")))
              .join(F.broadcast(table), ["g", "slice", "bundle"]))
    in_unit = Window.partitionBy("g", "slice", "bundle").orderBy("doc_id", "text_crc32", "size", "place")
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.row_number().over(in_unit) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "tokens")


__all__ = ["place", "pack_shards"]
