"""Quality by positive-unlabelled learning with the non-negative risk.

Trusted positives are labelled good training rows; the unlabelled set is every document.
The class prior is estimated from scores (the least ratio of unlabelled to positive mass
in the upper tail bounds the share of positives), then the non-negative unbiased risk

    prior * E_P[l(f)] + max(0, E_U[l(-f)] - prior * E_P[l(-f)])

is minimised by full-batch gradient steps: each is one Spark aggregation over all rows.
The model is additive: every feature of the text's form is cut at its quantiles, and each
interval has a weight.

Defined cases: NULL and empty texts have the features of no text and get a score; NULL
labels and labels without a document are ignored; an id labelled both ways is not trusted;
without trusted positives every score is 0.5; repeated rows are scored one by one; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fold, staged

FOLDS = 3
HELD_OUT = 1
BINS = 16
FIRST_STEPS = 10
STEPS = 25
RATE = 0.2
PENALTY = 3e-3
TAIL = 0.5       # least share of positives above a threshold that the prior may be read from
SCORE_CELLS = 512

FEATURES = ("log_bytes", "log_words", "mean_word", "long_words", "distinct_words", "top_word", "repeated_next", "upper",
            "lower", "digits", "spaces", "line_breaks", "stops", "marks", "symbols", "brackets", "beyond_ascii",
            "words_per_line", "distinct_lines", "wordless", "marked_ends", "single_letters", "longest_run", "byte_entropy")


def _class_table() -> np.ndarray:
    """Byte classes: upper, lower, digit, space, line break, stop, mark, bracket, beyond ASCII, other symbol."""
    table = np.full(256, 9, dtype=np.uint8)
    for number, members in enumerate((b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b" \t",
                                      b"\n\r", b".,", b"!?;:'\"-", b"()[]{}<>", bytes(range(128, 256)))):
        for c in members:
            table[c] = number
    return table


_CLASS = _class_table()
_LETTER = np.isin(_CLASS, (0, 1, 8))


def features(text: str | None) -> np.ndarray:
    """The feature vector of a whole text."""
    raw = (text or "").encode()
    n = len(raw)
    words = raw.split()
    w = len(words)
    counts = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=256) if n else np.zeros(256, dtype=np.int64)
    share = np.bincount(_CLASS, weights=counts, minlength=10) / max(1, n)
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=w)
    seen = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    ends = np.fromiter((x[-1] for x in words), dtype=np.uint8, count=w)
    starts = np.fromiter((x[0] for x in words), dtype=np.uint8, count=w)
    lettered = _LETTER[starts] | _LETTER[ends]
    same = [a == b for a, b in zip(words, words[1:])]
    run = longest = 0
    if any(same):
        for s in same:
            run = run + 1 if s else 0
            longest = max(longest, run)
    p = counts[counts > 0] / max(1, n)
    return np.array([
        np.log1p(n), np.log1p(w), sizes.mean() if w else 0, (sizes > 12).mean() if w else 0, len(seen) / max(1, w),
        max(seen.values(), default=0) / max(1, w), sum(same) / max(1, w), share[0], share[1], share[2], share[3], share[4],
        share[5], share[6], share[9], share[7], share[8], np.log1p(w / max(1, len(lines))), len(set(lines)) / max(1, len(lines)),
        1 - lettered.mean() if w else 0, (~_LETTER[ends]).mean() if w else 0, (sizes == 1).mean() if w else 0,
        np.log1p(longest), -(p * np.log(p)).sum()], dtype=np.float32)


def feature_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, f`` (little-endian 32-bit floats) for every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t.as_py()).astype("<f4").tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["doc_id", "f"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, f binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype="<f4").reshape(-1, len(FEATURES))


def quantile_edges(table: DataFrame, bins: int) -> np.ndarray:
    """Inner quantiles of every feature over all rows, (features, bins - 1)."""
    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(0)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(x[:, i]) for i in range(len(FEATURES))], names=list(FEATURES))

    wide = table.select("f").mapInArrow(spread, ", ".join(f"{n} double" for n in FEATURES))
    cuts = [i / bins for i in range(1, bins)]
    return np.array(wide.approxQuantile(list(FEATURES), cuts, 0.002), dtype=np.float64)


class Additive:
    """An additive model: a weight for each feature's interval."""

    def __init__(self, edges: np.ndarray):
        self.edges = edges
        self.bins = edges.shape[1] + 1
        self.size = len(edges) * self.bins + 1

    def cells(self, x: np.ndarray) -> np.ndarray:
        """The weight numbers of each row (the last weight is the intercept)."""
        return np.column_stack([np.searchsorted(e, x[:, i], side="left") + i * self.bins for i, e in enumerate(self.edges)])

    def value(self, cells: np.ndarray, weights: np.ndarray) -> np.ndarray:
        return weights[cells].sum(axis=1) + weights[-1]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def risk_sums(rows: DataFrame, spark: SparkSession, model: Additive, weights: np.ndarray, group: int) -> list[np.ndarray]:
    """Gradient, loss and count over the positives as positives, as negatives, and over all rows as negatives.

    ``rows`` has ``f`` and ``part``: 0 for rows that are not trusted positives, else 1 or 2.
    Only positives whose part has a bit of ``group`` count as such.
    """
    shared = spark.sparkContext.broadcast((model.edges, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, w = shared.value
        own = Additive(edges)
        total = np.zeros((3, own.size + 2))
        for batch in batches:
            if not batch.num_rows:
                continue
            cells = own.cells(_matrix(batch.column(0)))
            value = own.value(cells, w)
            positive = (batch.column(1).to_numpy() & group) > 0
            for k, (mask, sign) in enumerate(((positive, 1), (positive, -1), (slice(None), -1))):
                z, c = sign * value[mask], cells[mask]
                slope = -sign * _sigmoid(-z)
                for i in range(c.shape[1]):
                    total[k, :own.size] += np.bincount(c[:, i], weights=slope, minlength=own.size)
                total[k, own.size - 1] += slope.sum()
                total[k, -2] += np.logaddexp(0, -z).sum()
                total[k, -1] += len(z)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "s"])

    # A fixed number of cells per task, added up before they reach the driver.
    out = np.zeros(3 * (model.size + 2))
    for r in rows.select("f", "part").mapInArrow(run, "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).collect():
        out[r.cell] = r.s
    return list(out.reshape(3, -1))


def minimise(sums: Callable[[np.ndarray], list[np.ndarray]], size: int, prior: float, steps: int) -> np.ndarray:
    """Adam steps on the non-negative risk; while the estimated negative risk is below zero it has no gradient."""
    weights, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        p, n, u = (x[:-1] / max(1.0, x[-1]) for x in sums(weights))
        gradient = prior * p[:-1] + PENALTY * weights
        if u[-1] - prior * n[-1] >= 0:
            gradient += u[:-1] - prior * n[:-1]
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient ** 2
        rate = RATE * min(1.0, 3 * (1 - step / (steps + 1)))
        weights = weights - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    return weights


def score_histograms(rows: DataFrame, spark: SparkSession, model: Additive, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Scores of the positives of part 2 and of all rows, in ``SCORE_CELLS`` cells each."""
    shared = spark.sparkContext.broadcast((model.edges, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, w = shared.value
        own, total = Additive(edges), np.zeros((2, SCORE_CELLS), dtype=np.int64)
        for batch in batches:
            if batch.num_rows:
                cell = (_sigmoid(own.value(own.cells(_matrix(batch.column(0))), w)) * (SCORE_CELLS - 1)).astype(np.int64)
                total[0] += np.bincount(cell[batch.column(1).to_numpy() == 2], minlength=SCORE_CELLS)
                total[1] += np.bincount(cell, minlength=SCORE_CELLS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["cell", "n"])

    out = np.zeros(2 * SCORE_CELLS)
    for r in rows.select("f", "part").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out[:SCORE_CELLS], out[SCORE_CELLS:]


def class_prior(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """The largest share of positives that the unlabelled scores allow, from two score histograms."""
    above_p = np.cumsum(positives[::-1]) / max(1, positives.sum())
    above_u = np.cumsum(unlabelled[::-1]) / max(1, unlabelled.sum())
    ok = above_p >= TAIL
    return float(np.clip((above_u[ok] / above_p[ok]).min(), 0.05, 0.95)) if ok.any() else 0.5


def score_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, training: Callable, label: str = "quality",
                  bins: int = BINS, steps: int = STEPS) -> DataFrame:
    """``doc_id, score`` for every document."""
    trusted = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & training("doc_id"))
               .groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.min(label).alias("lo")).filter("lo = 1")
               .select("id", F.when(F.pmod(F.xxhash64("id"), F.lit(3)) == 0, 2).otherwise(1).alias("part")))
    rows = staged(spark, feature_table(docs), "pu-features")
    table = staged(spark, rows.join(trusted, rows.doc_id == trusted.id, "left").select(
        "doc_id", "f", F.coalesce("part", F.lit(0)).alias("part")), "pu-rows")
    if table.filter("part > 0").isEmpty():
        return table.select("doc_id", F.lit(0.5).alias("score"))
    model = Additive(quantile_edges(table, bins))
    # Two thirds of the positives against everything first; the others' scores are free to show the prior.
    weights = minimise(lambda w: risk_sums(table, spark, model, w, 1), model.size, 0.5, FIRST_STEPS)
    prior = class_prior(*score_histograms(table, spark, model, weights))
    weights = minimise(lambda w: risk_sums(table, spark, model, w, 3), model.size, prior, steps)
    shared = spark.sparkContext.broadcast((model.edges, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges, w = shared.value
        own = Additive(edges)
        for batch in batches:
            p = _sigmoid(own.value(own.cells(_matrix(batch.column(1))), w)) if batch.num_rows else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], names=["doc_id", "score"])

    return table.select("doc_id", "f").mapInArrow(run, "doc_id long, score double")


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, steps: int = STEPS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    scored = score_quality(spark, docs, labels, lambda c: fold(c, FOLDS) != HELD_OUT, steps=steps)
    return scored.select("doc_id", (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


__all__ = ["FEATURES", "features", "feature_table", "Additive", "minimise", "class_prior", "score_quality", "score_documents"]
