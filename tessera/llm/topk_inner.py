"""Exact top-k by inner product over norm-sorted vectors.

Vectors are made integer (``floor(scale * x)``) and sorted by descending length into
blocks; a rotation from the singular vectors of the whole table (eigenvectors of the
Gram matrix, a sum over all rows) concentrates the mass in the leading dimensions.  A
block of queries meets a block of vectors in one task:

* a chunk of vectors is skipped when ``|q| * |v|`` cannot reach the query's k-th best;
* the partial sum over the leading rotated dimensions plus the Cauchy-Schwarz bound
  ``|q_rest| * |v_rest|`` prunes single vectors;
* what remains is scored exactly: in doubles while ``|q| * |v|`` keeps every sum below 2^53,
  else in integers.

The longest vectors are searched first; their k-th best scores are the starting
thresholds of all other blocks.  Bounds carry a slack for rounding, so nothing that could
tie is pruned.

Defined cases: rows with a NULL vector, a NULL or non-finite component or a NULL id take no
part; a shorter vector counts as padded with zeros; repeated ids are separate candidates
(never of a query with the same id), and equal rows of one query id answer once; ties go to
the smaller id; a component or score that does not fit 64 bits fails; fewer than k candidates give fewer rows; empty tables give none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import staged

K = 10
SCALE = 1024
QUERY_STRIDE = 100
BLOCK_ROWS = 8192
QUERY_ROWS = 2048
CHUNK_ROWS = 1024
LEAD_SHARE = 0.8
_EXACT_DOUBLE, _EXACT_LONG = 2.0 ** 52, 2.0 ** 62  # a little room for the rounding of lengths
_RESULT = "query_id long, vec_id long, score long"


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """``vec_id, v array<long>, len2``: the rows that take part; a component beyond 64 bits fails."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (vectors.filter(F.col(vec_col).isNotNull() & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v")).filter(F.coalesce(ok, F.lit(False)))
            .select("vec_id", F.transform("v", lambda x: F.when(F.abs(x * scale) < 2.0 ** 63, F.floor(x * scale))
                                          .otherwise(F.raise_error(F.lit("a component is beyond 64 bits")).cast("long"))).alias("v"))
            .withColumn("len2", F.aggregate("v", F.lit(0).cast("double"), lambda a, x: a + x.cast("double") * x)))


def gram_matrix(rows: DataFrame, dims: int) -> np.ndarray:
    """Sum of outer products over all rows: one small matrix per task, added up by the driver's aggregate."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            m = matrix(batch.column(0), dims)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims * dims)), pa.array(total.ravel())], names=["cell", "s"])

    cells = rows.select("v").mapInArrow(partial, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s"))
    out = np.zeros(dims * dims)
    for r in cells.collect():  # dims * dims cells
        out[r.cell] = r.s
    return out.reshape(dims, dims)


def principal_axes(spark: SparkSession, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and eigenvectors of a symmetric matrix, largest first, computed in a task.

    Python workers run LAPACK with the threads that Spark allows them; in a driver that has
    started a JVM, its own threads can lock up.
    """
    dims = len(gram)

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cells in batch.column(0):
                values, vectors = np.linalg.eigh(np.array(cells.as_py()).reshape(dims, dims))
                order = np.argsort(-values)
                yield pa.RecordBatch.from_arrays([pa.array([values[order].tolist()]), pa.array([vectors[:, order].ravel().tolist()])],
                                                 names=["values", "axes"])

    row = (spark.createDataFrame([(gram.ravel().tolist(),)], "cells array<double>").coalesce(1)
           .mapInArrow(solve, "values array<double>, axes array<double>").first())
    return np.array(row[0]), np.array(row.axes).reshape(dims, dims)


def matrix(column, dims: int, dtype=np.float64) -> np.ndarray:
    """A list column as a matrix of ``dims`` columns, shorter rows padded with zeros."""
    if isinstance(column, pd.Series):
        column = pa.array(column)
    lengths = np.diff(np.asarray(column.offsets))
    flat = np.asarray(column.flatten(), dtype=dtype)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(lengths), dims), dtype=dtype)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def best_of(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def exact_scores(v: np.ndarray, q: np.ndarray, longest: float) -> np.ndarray:
    """Inner products of integer vectors; ``longest`` bounds their size."""
    if longest < _EXACT_DOUBLE:
        return (v.astype(np.float64) @ q.astype(np.float64)).astype(np.int64)
    if longest < _EXACT_LONG:
        return v @ q
    return np.array((v.astype(object) @ q.astype(object)).tolist(), dtype=np.int64)


def search_block(query_ids: np.ndarray, q: np.ndarray, floor: np.ndarray, vec_ids: np.ndarray, v: np.ndarray,
                 rotation: np.ndarray, lead: int, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query number, ids, scores) of the block's candidates that may be among the query's k best.

    ``q`` and ``v`` hold integers; ``v`` is sorted by descending length; ``floor`` holds k-th best scores known before.
    """
    qf, vf = q.astype(np.float64), v.astype(np.float64)
    qr, vr = qf @ rotation, vf @ rotation
    q_len, v_len = np.linalg.norm(qf, axis=1), np.linalg.norm(vf, axis=1)
    del qf, vf
    q_rest, v_rest = np.linalg.norm(qr[:, lead:], axis=1), np.linalg.norm(vr[:, lead:], axis=1)
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.int64), np.empty(0, np.int64))] * len(q)
    floor = floor.copy()
    for at in range(0, len(v), CHUNK_ROWS):
        part = slice(at, at + CHUNK_ROWS)
        slack = 1.0 + 1e-9 * q_len * v_len[at]
        live = np.flatnonzero(q_len * v_len[at] + slack >= floor)
        if not len(live):
            break  # every later vector is no longer than these
        bound = (qr[live, :lead] @ vr[part, :lead].T + np.outer(q_rest[live], v_rest[part]) + slack[live, None])
        keep = (bound >= floor[live, None]) & (vec_ids[part][None, :] != query_ids[live, None])
        for row in np.flatnonzero(keep.any(axis=1)):
            i = live[row]
            cand = at + np.flatnonzero(keep[row])
            scores = exact_scores(v[cand], q[i], q_len[i] * v_len[at])
            cand, scores = cand[scores >= floor[i]], scores[scores >= floor[i]]
            ids = np.concatenate([best[i][0], vec_ids[cand]])
            best[i] = best_of(ids, np.concatenate([best[i][1], scores]), k)
            if len(best[i][0]) == k:
                floor[i] = max(floor[i], best[i][1][-1])
    for i, (ids, scores) in enumerate(best):
        if len(ids):
            yield i, ids, scores


def top_k_inner(spark: SparkSession, vectors: DataFrame, k: int = K, scale: int = SCALE, query_stride: int = QUERY_STRIDE,
                block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS, id_col: str = "vec_id",
                vec_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's k highest integer inner products."""
    rows = staged(spark, integer_vectors(vectors, scale, id_col, vec_col), "topk-vectors")
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"),
                     F.count(F.when(F.pmod("vec_id", F.lit(query_stride)) == 0, 1)).alias("queries")).first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if not shape.queries or not shape.dims:
        return empty
    dims = shape.dims
    values, rotation = principal_axes(spark, gram_matrix(rows, dims))
    mass = np.cumsum(np.maximum(values, 0))
    lead = int(min(dims, 1 + np.searchsorted(mass, LEAD_SHARE * mass[-1])))

    # Blocks of equal size by descending length; the id breaks ties, so equal vectors spread over blocks.
    n_blocks = max(1, -(-shape.n // block_rows))
    n_sets = max(1, -(-shape.queries // query_rows))
    blocks = staged(spark, rows.repartitionByRange(n_blocks, F.desc("len2"), F.asc("vec_id"))
                    .withColumn("block", F.spark_partition_id().cast("long")), "topk-blocks")
    n_blocks = 1 + blocks.agg(F.max("block")).first()[0]
    queries = (rows.filter(F.pmod("vec_id", F.lit(query_stride)) == 0)
               .select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).distinct()
               .withColumn("set", F.pmod(F.xxhash64("query_id"), F.lit(n_sets))))

    def search(key, q_rows: pd.DataFrame, v_rows: pd.DataFrame) -> pd.DataFrame:
        if not len(q_rows) or not len(v_rows):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
        v_rows = v_rows.sort_values(["len2", "vec_id"], ascending=[False, True])
        ids = q_rows.query_id.to_numpy()
        found = list(search_block(ids, matrix(q_rows.q, dims, np.int64), q_rows["floor"].to_numpy(float), v_rows.vec_id.to_numpy(),
                                  matrix(v_rows.v, dims, np.int64), rotation, lead, k))
        return pd.DataFrame({"query_id": np.concatenate([np.repeat(ids[i], len(x)) for i, x, _ in found] or [[]]),
                             "vec_id": np.concatenate([x for _, x, _ in found] or [[]]),
                             "score": np.concatenate([s for _, _, s in found] or [[]])}).astype("int64")

    def run(q: DataFrame, v: DataFrame, block_ids: list[int]) -> DataFrame:
        spread = q.withColumn("block", F.explode(F.array(*(F.lit(b).cast("long") for b in block_ids)))
                              if len(block_ids) < 64 else F.explode(F.sequence(F.lit(block_ids[0]).cast("long"),
                                                                               F.lit(block_ids[-1]).cast("long"))))
        dealt = v.withColumn("set", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_sets - 1).cast("long"))))
        return (spread.groupBy("block", "set").cogroup(dealt.groupBy("block", "set"))
                .applyInPandas(search, _RESULT))

    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    head = staged(spark, run(queries.withColumn("floor", F.lit(-float("inf"))), blocks.filter("block = 0"), [0]), "topk-head")
    found = head
    if n_blocks > 1:
        reached = (head.withColumn("r", F.row_number().over(by_query)).filter(F.col("r") == k)
                   .select("query_id", F.col("score").cast("double").alias("floor")))
        rest = queries.join(reached, "query_id", "left").fillna({"floor": -float("inf")})
        found = head.unionByName(run(rest, blocks.filter("block > 0"), list(range(1, n_blocks))))
    return (found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def oracle_sql(k: int = K, scale: int = SCALE, query_stride: int = QUERY_STRIDE) -> str:
    """DuckDB SQL for :func:`top_k_inner` (vectors of one length)."""
    return f"""
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
               FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
          FROM (SELECT * FROM v WHERE vec_id % {query_stride} = 0) q JOIN v c ON c.vec_id <> q.vec_id)
    SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
    FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
    WHERE rank <= {k}"""


__all__ = ["integer_vectors", "gram_matrix", "principal_axes", "search_block", "top_k_inner", "oracle_sql"]
