"""Substring deduplication by level-wise doubling of repeated word windows.

Windows grow from a quarter of the final length to a half to the whole (13, 25, 50 words):

* level 1: sampled 13-word windows (each 50-word window chooses one, see ``segments``) that
  occur in two documents survive;
* level 2: a survivor is extended to 25 words on either side; extensions that occur in two
  documents survive;
* level 3: 50-word windows all of whose level-2 windows survive are compared.  A word is
  removed if it lies in a 50-word window that also starts in a document before.

A window can only repeat if every window inside it does, so no level loses a repeat, and
each level hashes and shuffles what the level below left.  Segments of one content are
settled whole at level 1.

"Before" is by document id; rows that share an id are ordered by a hash of their text, and
rows that repeat id and text are one document.

Defined cases: NULL and wordless texts have no words; texts shorter than a window keep all
words; a NULL id sorts first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.llm.segments import (RangeHash, Segments, cut_segments, document_rows, group_segments, merge_spans, packed_texts,
                                  per_document, segment_rows)

WINDOW = 50


def levels(window: int) -> tuple[int, int]:
    """Lengths below the final one: a quarter and a half, rounded up."""
    half = -(-window // 2)
    return -(-half // 2), half


def _units(parts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words between single spaces: the bytes, and where each word begins and ends."""
    whole = b" ".join([b" ".join(p) for p in parts if p])
    raw = np.frombuffer(whole, dtype=np.uint8)
    gaps = np.flatnonzero(raw == 32)
    if not len(raw):
        return raw, np.empty(0, np.int64), np.empty(0, np.int64)
    return raw, np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [len(raw)]))


def word_segments(window: int):
    """The scan of ``segment_rows`` over words."""
    gram, _ = levels(window)

    def scan(texts: list[bytes]) -> tuple[Segments, np.ndarray]:
        parts = [t.split() for t in texts]
        counts = np.array([len(p) for p in parts], dtype=np.int64)
        raw, first, last = _units(parts)
        ends = np.cumsum(counts)
        return (cut_segments(RangeHash(raw), first, last, np.repeat(np.arange(len(parts)), counts), ends, gram, window),
                ends - counts)

    return scan


_LEVELS = ("anchor long, k long, x long, start long, place long, left long, right long, windows array<long>")


def level_table(joined: DataFrame, window: int) -> DataFrame:
    """For each undecided segment: hashes of the half-length windows around its anchor and of its full windows."""
    gram, half = levels(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts, at, (start, run_, place, anchor) in document_rows(batches, "start", "run", "place", "anchor"):
            left, right = np.zeros(len(start), dtype=np.int64), np.zeros(len(start), dtype=np.int64)
            no_left, no_right = place + gram < half, np.zeros(len(start), dtype=bool)
            windows = [np.empty(0, dtype=np.int64)]
            for i, text in enumerate(texts):
                r = slice(at[i], at[i + 1])
                if at[i] == at[i + 1]:
                    continue
                raw, first, last = _units([text.split()])
                h, n = RangeHash(raw), len(first)
                low, high = np.maximum(0, place[r] + gram - half), np.minimum(n, place[r] + half)
                left[r] = h.of(first[low], last[place[r] + gram - 1]).view(np.int64)
                right[r] = h.of(first[place[r]], last[high - 1]).view(np.int64)
                no_right[r] = place[r] + half > n
                ends = np.cumsum(run_[r])
                s = np.arange(ends[-1]) + np.repeat(start[r] - ends + run_[r], run_[r])
                windows.append(h.of(first[s], last[s + window - 1]).view(np.int64))
            ends = np.concatenate(([0], np.cumsum(run_))).astype(np.int32)
            per_doc = np.repeat(np.arange(len(texts)), np.diff(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), *(batch.column(c).take(pa.array(per_doc)) for c in ("k", "x")), pa.array(start), pa.array(place),
                 pa.array(left, mask=no_left), pa.array(right, mask=no_right),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(windows)))],
                names=["anchor", "k", "x", "start", "place", "left", "right", "windows"])

    return joined.select("k", "x", "z", "rows").mapInArrow(run, _LEVELS)


def _in_two(rows: DataFrame, *key: str) -> DataFrame:
    """Keys that occur in two documents, with the first of them."""
    doc = F.struct("k", "x")
    return (rows.groupBy(*key).agg(F.min(doc).alias("low"), F.max(doc).alias("high"))
            .filter("low < high").drop("high"))


def removed_words(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """The packed texts, and ``k, x, start, end``: ranges of words to remove (they may overlap)."""
    gram, half = levels(window)
    texts = packed_texts(docs)
    grouped = staged(spark, group_segments(segment_rows(docs, word_segments(window), window, False), window, False), "doubling-1")
    undecided = grouped.filter("place >= 0").select("k", "x", "start", "run", "place", "anchor")
    table = staged(spark, level_table(per_document(texts.drop("doc_id", "rest"), undecided, ["start", "run", "place", "anchor"], "inner"), window),
                   "doubling-2")
    sides = table.select("k", "x", "start", "anchor", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("left").alias("h")), F.struct(F.lit(1).alias("side"), F.col("right").alias("h")))).alias("s")
    ).select("k", "x", "start", "anchor", "s.side", "s.h").filter("h IS NOT NULL")
    halves = staged(spark, _in_two(sides, "side", "h").select("side", "h"), "doubling-halves")
    alive = (sides.join(halves, ["side", "h"]).groupBy("k", "x", "start", "anchor")
             .agg(F.max(F.col("side") == 0).alias("l"), F.max(F.col("side") == 1).alias("r")))
    windows = (table.join(alive, ["k", "x", "start", "anchor"])
               .select("anchor", "k", "x", "start", "place", "l", "r", F.posexplode("windows").alias("i", "w"))
               .withColumn("s", F.col("start") + F.col("i"))
               # A half-length window inside this one that does not repeat rules it out.
               .filter((F.col("l") | (F.col("s") > F.col("place") + gram - half))
                       & (F.col("r") | (F.col("s") + window < F.col("place") + half)))
               .select("anchor", "w", "k", "x", "s"))
    windows = staged(spark, windows, "doubling-3")
    repeated = staged(spark, _in_two(windows, "anchor", "w"), "doubling-full")
    marks = (windows.join(repeated, ["anchor", "w"]).filter(F.struct("k", "x") > F.col("low"))
             .select("k", "x", F.col("s").alias("start"), (F.col("s") + window).alias("end")))
    settled = grouped.filter("place < 0").select("k", "x", "start", (F.col("start") + F.col("run")).alias("end"))
    return texts, settled.unionByName(marks)


def dedup_words(spark: SparkSession, docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: every document without its repeated words (joined by one space)."""
    texts, spans = removed_words(spark, docs, window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws, at, (starts, ends) in document_rows(batches, "start", "end"):
            n_words, n_removed, kept = [], [], []
            for i, raw in enumerate(raws):
                words = raw.split()
                start, end = merge_spans(starts[at[i]:at[i + 1]], ends[at[i]:at[i + 1]])
                n_words.append(len(words))
                n_removed.append(int((end - start).sum()))
                left = [words[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(words)])]
                kept.append(b" ".join([w for part in left for w in part]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "n_removed", "kept"])

    return (per_document(texts, spans, ["start", "end"], "left").select("doc_id", "z", "rows")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string"))


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


__all__ = ["WINDOW", "levels", "word_segments", "removed_words", "dedup_words", "digests"]
