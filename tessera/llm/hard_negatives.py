"""Hard negatives by angular triangle filtering.

Vectors are made integer (``floor(scale * x)``).  Every row stores its length and its angles to a
few reference directions (leading eigenvectors of the whole table's Gram matrix).  For an
anchor and a row, the angles to one reference bound the angle between the two from both sides
(spherical triangle inequality); over all references that is an interval of cosines, and times
both lengths an interval of scores, widened by a slack for rounding.  Only rows whose interval
meets the wanted window of scores are scored, in integers:

* positives: rows of the anchor's label that can still reach its ``positives``-th best;
* negatives: rows of other labels whose interval meets one of the windows from ``low`` to
  ``high`` percent of a positive's score.

Rows lie in blocks by (label, angle to the first reference), so equal labels are neighbours, a
hot label fills many blocks, and a block's rows near an anchor's angle are one slice.  An
anchor's positives come first from its own block, whose result is the threshold for the other
blocks of its label; its negatives are searched in the square root of all blocks first, whose
``per_positive``-th best scores in each window are the thresholds for the others.  Anchors are a stated
query set, so (anchors x blocks) tasks are what the result asks for; each holds one block of
rows and one set of anchors.

Defined cases: rows with a NULL id, label or vector, or with a NULL or non-finite component take
no part; a shorter vector counts as padded with zeros; a row is never its own anchor's
candidate, nor is another row of the same id; other rows that repeat an id are separate
candidates, and equal rows of one anchor id answer once; a vector of zeros scores 0 with all; a
component beyond 64 bits or a score beyond them fails; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import staged
from tessera.llm.topk_inner import exact_scores, gram_matrix, matrix

SCALE = 256
ANCHOR_STRIDE = 50
POSITIVES = 5
PER_POSITIVE = 3
LOW, HIGH = 50, 95
REFERENCES = 8
BLOCK_ROWS = 8192
ANCHOR_ROWS = 2048
_SLACK = 1e-9
_EXACT_DOUBLE = 2.0 ** 52  # a little room for the rounding of lengths
_ANGLE_SLACK = 1e-6  # the arc cosine loses half the digits near its ends
_FOUND = "anchor long, a_x long, vec_id long, score long"
_PAIRS = "anchor long, a_x long, p long, positive long, positive_score long, vec_id long, score long"


def labelled_vectors(vectors: DataFrame, scale: int, id_col: str, vec_col: str, label_col: str, label: F.Column | None = None) -> DataFrame:
    """``vec_id, label, v array<long>``: the rows that take part; a component that does not fit fails."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform("v", lambda x: F.when(F.abs(x * scale) < 2.0 ** 63, F.floor(x * scale))
                        .otherwise(F.raise_error(F.lit("a component is beyond 64 bits")).cast("long")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), (F.col(label_col) if label is None else label).cast("long").alias("label"),
                           v.alias("v"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull()).filter(F.coalesce(ok, F.lit(False)))
            .select("vec_id", "label", whole.alias("v")))


def angles_to(v: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lengths of the rows, and their angles to each reference direction (a vector of zeros: right angles)."""
    f = v.astype(np.float64)
    length = np.linalg.norm(f, axis=1)
    cos = (f @ references) / np.where(length > 0, length, 1.0)[:, None]
    return length, np.arccos(np.clip(cos, -1.0, 1.0))


def leading_directions(gram: np.ndarray, k: int, rounds: int = 60) -> np.ndarray:
    """``k`` orthonormal directions near the leading eigenvectors, by power iteration.

    Any directions give right bounds, so a rough answer will do; without LAPACK, whose threads
    can lock up in a driver that has started a JVM.
    """
    dims = len(gram)
    out = np.zeros((dims, k))
    rng = np.random.default_rng(0)
    for j in range(k):
        x = rng.normal(size=dims)
        for r in range(rounds + 2):
            if r < rounds:
                x = np.einsum("ij,j->i", gram, x)
            x -= np.einsum("ij,j->i", out, np.einsum("ij,i->j", out, x))
            norm = np.sqrt((x * x).sum())
            x = x / norm if norm > 1e-12 * (1 + np.abs(gram).max()) or r >= rounds and norm > 0 else rng.normal(size=dims)
        out[:, j] = x
    return out


def score_bounds(length: float, angles: np.ndarray, lengths: np.ndarray, row_angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score that each row can have with the anchor, rounding included."""
    apart = np.abs(row_angles - angles).max(axis=1) - _ANGLE_SLACK
    joint = row_angles + angles
    most = np.minimum(joint, 2 * np.pi - joint).min(axis=1) + _ANGLE_SLACK
    product = length * lengths
    slack = 1.0 + _SLACK * product
    return product * np.cos(np.clip(most, 0, np.pi)) - slack, product * np.cos(np.clip(apart, 0, np.pi)) + slack


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    return np.lexsort((ids, -scores))[:k]


class Block:
    """A block's rows in order of their angle to the first reference."""

    def __init__(self, rows: pd.DataFrame, dims: int):
        rows = rows.sort_values("angle", kind="stable")
        self.ids, self.labels = rows.vec_id.to_numpy(), rows.label.to_numpy()
        self.v = matrix(rows.v, dims, np.int64)
        self.lengths = rows.length.to_numpy()
        self.angles = np.stack(rows.angles.to_numpy())
        self.longest = float(self.lengths.max())
        self._floats = self.v.astype(np.float64)

    def slice(self, length: float, angle: float, floor: float) -> slice:
        """Rows whose angle to the first reference leaves a score of ``floor`` possible."""
        reach = length * self.longest
        if floor > reach * (1 + _SLACK) + 1:
            return slice(0, 0)
        # Below zero, a short vector may stand at any angle.
        wide = np.pi if not reach or floor <= 0 else np.arccos(np.clip(floor / reach - 2 / reach - _SLACK, -1.0, 1.0)) + 2 * _ANGLE_SLACK
        first = self.angles[:, 0]
        return slice(int(np.searchsorted(first, angle - wide)), int(np.searchsorted(first, angle + wide, side="right")))

    def scores(self, rows: np.ndarray, v: np.ndarray, length: float) -> np.ndarray:
        """Integer inner products; by doubles where no sum can leave the integers that they hold."""
        if length * self.longest < _EXACT_DOUBLE:
            return (self._floats[rows] @ v.astype(np.float64)).astype(np.int64)
        return exact_scores(self.v[rows], v, length * float(self.lengths[rows].max())) if len(rows) else np.empty(0, np.int64)


def search_positives(anchors: pd.DataFrame, block: Block, dims: int, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor number, ids, scores) of the block's best ``k`` rows of the anchor's label that reach its ``floor``."""
    q, q_angles = matrix(anchors.v, dims, np.int64), np.stack(anchors.angles.to_numpy())
    for i, (anchor, label, length, floor) in enumerate(zip(anchors.anchor, anchors.label, anchors.length, anchors.floor)):
        near = block.slice(length, q_angles[i, 0], floor)
        _, high = score_bounds(length, q_angles[i], block.lengths[near], block.angles[near])
        rows = near.start + np.flatnonzero((high >= floor) & (block.labels[near] == label) & (block.ids[near] != anchor))
        order = rows[np.argsort(-high[rows - near.start], kind="stable")]
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        for at in range(0, len(order), 512):  # the highest bounds first: they raise the floor for the rest
            part = order[at:at + 512]
            part = part[high[part - near.start] >= floor]
            if not len(part):
                break
            ids, scores = np.concatenate([ids, block.ids[part]]), np.concatenate([scores, block.scores(part, q[i], length)])
            top = _best(ids, scores, k)
            ids, scores = ids[top], scores[top]
            floor = max(floor, float(scores[-1])) if len(scores) == k else floor
        if len(ids):
            yield i, ids, scores


def search_negatives(anchors: pd.DataFrame, block: Block, dims: int, k: int, low: int, high: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor number, positive number, ids, scores) of the block's best ``k`` rows of other labels in the positive's window."""
    q, q_angles = matrix(anchors.v, dims, np.int64), np.stack(anchors.angles.to_numpy())
    for i, (anchor, label, length, scores_, floors) in enumerate(zip(anchors.anchor, anchors.label, anchors.length, anchors.positive_scores,
                                                                     anchors.floors)):
        # low * p <= 100 * n <= high * p, in whole numbers, and at least the score that the window's best already reach.
        known = {} if floors is None else dict(zip(floors["p"], floors["floor"]))
        windows = [(max(-(-low * int(p) // 100), int(known.get(j, -(1 << 63)))), high * int(p) // 100) for j, p in enumerate(scores_)]
        open_ = [w for w in windows if w[0] <= w[1]]
        if not open_:
            continue
        near = block.slice(length, q_angles[i, 0], float(min(w[0] for w in open_)))
        least, most = score_bounds(length, q_angles[i], block.lengths[near], block.angles[near])
        fit = np.zeros(len(least), dtype=bool)
        for lo, hi in set(open_):
            fit |= (most >= lo) & (least <= hi)
        rows = near.start + np.flatnonzero(fit & (block.labels[near] != label) & (block.ids[near] != anchor))
        scores = block.scores(rows, q[i], length)
        inside = (scores >= min(w[0] for w in open_)) & (scores <= max(w[1] for w in open_))
        rows, scores = rows[inside], scores[inside]
        order = np.lexsort((block.ids[rows], -scores))
        rows, falling = rows[order], -scores[order]
        for p, (lo, hi) in enumerate(windows):
            if lo <= hi:
                a, b = np.searchsorted(falling, -hi), np.searchsorted(falling, -lo, side="right")
                b = min(b, a + k)
                if b > a:
                    yield i, p, block.ids[rows[a:b]], -falling[a:b]


def hard_negatives(spark: SparkSession, vectors: DataFrame, label: F.Column | None = None, scale: int = SCALE,
                   anchor_stride: int = ANCHOR_STRIDE, positives: int = POSITIVES, per_positive: int = PER_POSITIVE,
                   low: int = LOW, high: int = HIGH, references: int = REFERENCES, block_rows: int = BLOCK_ROWS,
                   anchor_rows: int = ANCHOR_ROWS, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``label``: the label's expression, if not the column itself.  Anchors are the rows whose id ``anchor_stride`` divides.
    """
    rows = staged(spark, labelled_vectors(vectors, scale, id_col, vec_col, label_col, label), "negatives-vectors")
    is_anchor = F.pmod("vec_id", F.lit(anchor_stride)) == 0
    shape = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dims"), F.count(F.when(is_anchor, 1)).alias("anchors")).first()
    if not shape.anchors or not shape.dims:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dims = shape.dims
    refs = leading_directions(gram_matrix(rows, dims), min(references, dims))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, angles = angles_to(matrix(batch.column(2), dims, np.int64), refs)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(length), pa.array(angles[:, 0].copy()), pa.array(list(angles), pa.list_(pa.float64()))],
                names=["vec_id", "label", "v", "length", "angle", "angles"])

    measured = rows.select("vec_id", "label", "v").mapInArrow(
        measure, "vec_id long, label long, v array<long>, length double, angle double, angles array<double>")
    n_blocks, n_sets = max(1, -(-shape.n // block_rows)), max(1, -(-shape.anchors // anchor_rows))
    blocks = staged(spark, measured.repartitionByRange(n_blocks, "label", "angle", "vec_id")
                    .withColumn("block", F.spark_partition_id().cast("long")), "negatives-blocks")
    n_blocks = 1 + blocks.agg(F.max("block")).first()[0]
    # Two anchors of one id with different vectors or labels are told apart by a hash of both.
    anchors = staged(spark, blocks.filter(is_anchor)
                     .select(F.col("vec_id").alias("anchor"), F.xxhash64("label", "v").alias("a_x"), "label", "v", "length", "angles", "block")
                     .dropDuplicates(["anchor", "a_x"]), "negatives-anchors")
    anchors = anchors.withColumn("set", F.pmod(F.xxhash64("anchor", "a_x"), F.lit(n_sets)))

    def positives_in(key, a: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(v):
            return pd.DataFrame({"anchor": [], "a_x": [], "vec_id": [], "score": []}, dtype="int64")
        found = list(search_positives(a, Block(v, dims), dims, positives))
        return pd.DataFrame({"anchor": _repeat(a.anchor, [(i, len(x)) for i, x, _ in found]), "a_x": _repeat(a.a_x, [(i, len(x)) for i, x, _ in found]),
                             "vec_id": np.concatenate([x for _, x, _ in found] or [[]]),
                             "score": np.concatenate([s for _, _, s in found] or [[]])}).astype("int64")

    def negatives_in(key, a: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        names = [c.split(" ")[0] for c in _PAIRS.split(", ")]
        if not len(a) or not len(v):
            return pd.DataFrame({c: [] for c in names}, dtype="int64")
        found = list(search_negatives(a, Block(v, dims), dims, per_positive, low, high))
        times = [(i, len(x)) for i, _, x, _ in found]
        return pd.DataFrame({
            "anchor": _repeat(a.anchor, times), "a_x": _repeat(a.a_x, times),
            "p": np.concatenate([np.repeat(p, len(x)) for _, p, x, _ in found] or [[]]),
            "positive": np.concatenate([np.repeat(a.positive_ids.iloc[i][p], len(x)) for i, p, x, _ in found] or [[]]),
            "positive_score": np.concatenate([np.repeat(a.positive_scores.iloc[i][p], len(x)) for i, p, x, _ in found] or [[]]),
            "vec_id": np.concatenate([x for _, _, x, _ in found] or [[]]),
            "score": np.concatenate([s for _, _, _, s in found] or [[]])}).astype("int64")[names]

    # Positives: the own block first, then the label's other blocks with its threshold.
    by_anchor = Window.partitionBy("anchor", "a_x").orderBy(F.desc("score"), F.asc("vec_id"))
    rows_of = blocks.withColumn("set", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_sets - 1).cast("long"))))
    own = staged(spark, anchors.withColumn("floor", F.lit(-float("inf"))).groupBy("block", "set")
                 .cogroup(rows_of.groupBy("block", "set")).applyInPandas(positives_in, _FOUND), "negatives-own")
    found = own
    if n_blocks > 1:
        spans = blocks.groupBy("label").agg(F.min("block").alias("from"), F.max("block").alias("to"))
        reached = (own.withColumn("r", F.row_number().over(by_anchor)).filter(F.col("r") == positives)
                   .select("anchor", "a_x", F.col("score").cast("double").alias("floor")))
        others = (anchors.join(spans, "label").join(reached, ["anchor", "a_x"], "left").fillna({"floor": -float("inf")})
                  .withColumn("home", F.col("block")).withColumn("block", F.explode(F.sequence("from", "to")))
                  .filter("block <> home").drop("from", "to", "home"))
        found = own.unionByName(others.groupBy("block", "set").cogroup(rows_of.groupBy("block", "set")).applyInPandas(positives_in, _FOUND))
    chosen = staged(spark, found.withColumn("r", F.row_number().over(by_anchor)).filter(F.col("r") <= positives)
                    .groupBy("anchor", "a_x").agg(F.collect_list(F.struct("vec_id", "score")).alias("p"))  # at most `positives`
                    .select("anchor", "a_x", F.col("p.vec_id").alias("positive_ids"), F.col("p.score").alias("positive_scores")), "negatives-positives")

    # Negatives: every `stride`-th block first, another start for each anchor, then the others with what those have reached.
    stride = math.isqrt(n_blocks - 1) + 1
    asked = (anchors.join(chosen, ["anchor", "a_x"]).drop("block")
             .withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long")))))
    in_first = F.pmod(F.col("block") + F.xxhash64("anchor", "a_x"), F.lit(stride)) == 0
    by_pair = Window.partitionBy("anchor", "a_x", "p").orderBy(F.desc("score"), F.asc("vec_id"))

    def mine(a: DataFrame) -> DataFrame:
        return a.groupBy("block", "set").cogroup(rows_of.groupBy("block", "set")).applyInPandas(negatives_in, _PAIRS)

    no_floors = F.lit(None).cast("struct<p:array<bigint>,floor:array<bigint>>")
    mined = mine(asked.filter(in_first).withColumn("floors", no_floors))
    if n_blocks > 1:
        mined = staged(spark, mined, "negatives-first")
        reached = (mined.withColumn("r", F.row_number().over(by_pair)).filter(F.col("r") == per_positive)
                   .groupBy("anchor", "a_x").agg(F.collect_list(F.struct("p", F.col("score").alias("floor"))).alias("f"))  # one per positive
                   .select("anchor", "a_x", F.struct(F.col("f.p").alias("p"), F.col("f.floor").alias("floor")).alias("floors")))
        mined = mined.unionByName(mine(asked.filter(~in_first).join(reached, ["anchor", "a_x"], "left")))
    return (mined.withColumn("rank", F.row_number().over(by_pair)).filter(F.col("rank") <= per_positive)
            .select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), F.col("rank").cast("int").alias("rank"),
                    F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))


def _repeat(column: pd.Series, times: list[tuple[int, int]]) -> np.ndarray:
    values = column.to_numpy()
    return np.repeat(values[[i for i, _ in times]], [n for _, n in times]) if times else np.empty(0, np.int64)


def shifted_label(id_col: str = "vec_id", label_col: str = "label") -> F.Column:
    """The contract's labels: moved on by one where 7 divides the id."""
    return F.when(F.pmod(F.col(id_col), F.lit(7)) == 0, (F.col(label_col).cast("long") + 1) % 10).otherwise(F.col(label_col))


def oracle_sql() -> str:
    """DuckDB SQL for the registered query (vectors of one length)."""
    return f"""
    WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                      list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
               FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
                 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
          FROM (SELECT * FROM v WHERE vec_id % {ANCHOR_STRIDE} = 0) a JOIN v c ON c.vec_id <> a.vec_id),
    p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score
          FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS r FROM s WHERE same)
          WHERE r <= {POSITIVES}),
    n AS (SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
          FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
           AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
    SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
    FROM n WHERE rank <= {PER_POSITIVE}"""


__all__ = ["labelled_vectors", "angles_to", "leading_directions", "score_bounds", "search_positives", "search_negatives", "hard_negatives", "shifted_label", "oracle_sql"]
