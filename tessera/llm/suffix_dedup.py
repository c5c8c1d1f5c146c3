"""Suffix-array deduplication of long byte strings with run-length compressed indexes.

A byte is removed if it lies in a ``window``-byte string that also starts earlier (in a
document with a smaller id, or earlier in the same one); strings are judged on the input.

* Segments that share an anchor come together (see ``segments``): equal windows always do.
  Segments whose whole content occurs earlier are settled there.
* What is left, first occurrences that differ somewhere around a shared anchor, is sent to
  tasks by anchor, in chunks of about ``CHUNK_BYTES``.  Each chunk builds a run-length
  compressed Burrows-Wheeler transform with sampled run ends of all but the first segment
  of every anchor, streams the matching statistics of all its segments against it, and
  marks each window that matches, but for the earliest of its class.
* An anchor of very many contents comes in pieces; the windows that remain first in their
  piece are compared across pieces by a 128-bit hash, one row per piece and window.

Rows that share an id are ordered by a hash of their text; rows that repeat id and text
are one document, with one result each.

Defined cases: NULL text counts as empty; texts shorter than the window keep all bytes; a
NULL id sorts first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged
from tessera.llm.runlength_index import RunLengthIndex
from tessera.llm.segments import (RangeHash, Segments, cut_segments, document_rows, group_segments, merge_spans, packed_texts,
                                  per_document, segment_rows)

WINDOW = 100
GRAM = 32
CHUNK_BYTES = 1 << 20
PIECE_ROWS = 1 << 14


def byte_segments(window: int, gram: int):
    """The scan of ``segment_rows`` over bytes."""
    def scan(texts: list[bytes]) -> tuple[Segments, np.ndarray]:
        raw = np.frombuffer(b"".join(texts), dtype=np.uint8)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends, unit = np.cumsum(sizes), np.arange(len(raw) + 1)
        return (cut_segments(RangeHash(raw), unit[:-1], unit[1:], np.repeat(np.arange(len(texts)), sizes), ends, gram, window),
                ends - sizes)

    return scan


_CONTENT = "anchor long, piece long, k long, x long, start long, run long, content binary"


def segment_contents(joined: DataFrame, window: int) -> DataFrame:
    """The bytes of each undecided segment."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws, at, (start, run_, anchor, piece) in document_rows(batches, "start", "run", "anchor", "piece"):
            owner = np.repeat(np.arange(len(raws)), np.diff(at))
            contents = [raws[i][a:b] for i, a, b in zip(owner.tolist(), start.tolist(), (start + run_ + window - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(piece), *(batch.column(c).take(pa.array(owner)) for c in ("k", "x")), pa.array(start),
                 pa.array(run_), pa.array(contents, pa.binary())],
                names=["anchor", "piece", "k", "x", "start", "run", "content"])

    return joined.select("k", "x", "z", "rows").mapInArrow(run, _CONTENT)


def mark_chunk(anchor: np.ndarray, k: np.ndarray, x: np.ndarray, start: np.ndarray, run: np.ndarray, contents: list[bytes],
               window: int) -> tuple[np.ndarray, np.ndarray]:
    """(segment, place) of each window that occurs earlier in the chunk, sorted."""
    later = np.zeros(len(anchor), dtype=bool)
    later[1:] = anchor[1:] == anchor[:-1]
    none = np.empty(0, dtype=np.int64)
    if not later.any():
        return none, none
    index = RunLengthIndex([contents[i] for i in np.flatnonzero(later)], window)
    segment, place, kind = index.matches(contents, run)
    order = np.lexsort((start[segment] + place, x[segment], k[segment], kind))
    repeat = np.zeros(len(order), dtype=bool)
    repeat[1:] = kind[order[1:]] == kind[order[:-1]]
    segment, place = segment[order[repeat]], place[order[repeat]]
    order = np.lexsort((place, segment))
    return segment[order], place[order]


_MARKS = "k long, x long, start long, end long, w1 long, w2 long"


def _verify(window: int, chunk_bytes: int):
    def marks(rows: list[tuple]) -> pa.RecordBatch:
        anchor, k, x, start, run = (np.array([r[i] for r in rows], dtype=np.int64) for i in (0, 2, 3, 4, 5))
        contents = [r[6] for r in rows]
        segment, place = mark_chunk(anchor, k, x, start, run, contents, window)
        cut = np.ones(len(segment), dtype=bool)
        cut[1:] = (segment[1:] != segment[:-1]) | (place[1:] != place[:-1] + 1)
        at = np.flatnonzero(cut)
        last = place[np.append(at[1:] - 1, len(place) - 1)] if len(at) else place
        s = segment[at]
        out = [k[s], x[s], start[s] + place[at], start[s] + last + window]
        hashes: list[tuple[int, int]] = []
        hot = [i for i, r in enumerate(rows) if r[7]]
        if hot:  # windows that are first here may be later in another piece of the anchor
            marked = set(zip(segment.tolist(), place.tolist()))
            first = [(i, p) for i in hot for p in range(run[i]) if (i, p) not in marked]
            hashes = [divmod(xxhash.xxh3_128_intdigest(contents[i][p:p + window]), 1 << 64) for i, p in first]
            i, p = np.array(first, dtype=np.int64).reshape(-1, 2).T
            out = [np.concatenate(c) for c in zip(out, [k[i], x[i], start[i] + p, start[i] + p + window])]
        w = np.array(hashes, dtype=np.uint64).reshape(-1, 2).view(np.int64)
        blank = pa.nulls(len(at), pa.int64())
        return pa.RecordBatch.from_arrays(
            [*(pa.array(c) for c in out), *(pa.concat_arrays([blank, pa.array(w[:, c])]) for c in (0, 1))],
            names=["k", "x", "start", "end", "w1", "w2"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, group = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= chunk_bytes and row[:2] != group:
                    yield marks(held)
                    held, size = [], 0
                group = row[:2]
                held.append(row)
                size += len(row[6])
        if held:
            yield marks(held)

    return verify


def removed_ranges(spark: SparkSession, docs: DataFrame, window: int = WINDOW, gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES,
                   piece_rows: int = PIECE_ROWS, with_rest: bool = False) -> tuple[DataFrame, DataFrame]:
    """The packed texts, and ``k, x, start, end``: byte ranges to remove (they may overlap)."""
    texts = packed_texts(docs, with_rest)
    grouped = staged(spark, group_segments(segment_rows(docs, byte_segments(window, gram), window, True), window, True, piece_rows),
                     "suffix-segments")
    undecided = grouped.filter("place >= 0").select("k", "x", "start", "run", "anchor", "piece")
    contents = segment_contents(per_document(texts.drop("doc_id", "rest"), undecided, ["start", "run", "anchor", "piece"], "inner"), window)
    hot = undecided.filter("piece > 0").select("anchor").distinct()
    any_hot = not hot.isEmpty()
    if any_hot:
        contents = contents.join(hot.withColumn("hot", F.lit(True)), "anchor", "left").fillna({"hot": False})
    else:
        contents = contents.withColumn("hot", F.lit(False))
    marks = (contents.select("anchor", "piece", "k", "x", "start", "run", "content", "hot")
             .repartition("anchor", "piece").sortWithinPartitions("anchor", "piece", "k", "x", "start")
             .mapInArrow(_verify(window, chunk_bytes), _MARKS))
    spans = grouped.filter("place < 0").select("k", "x", "start", (F.col("start") + F.col("run")).alias("end"))
    if not any_hot:
        return texts, spans.unionByName(marks.select("k", "x", "start", "end"))
    marks = staged(spark, marks, "suffix-marks")
    open_ = marks.filter("w1 IS NOT NULL")
    spot = F.struct("k", "x", "start")
    least = staged(spark, open_.groupBy("w1", "w2").agg(F.min(spot).alias("least"), F.count("*").alias("n"))
                   .filter("n > 1").drop("n"), "suffix-least")
    across = open_.join(least, ["w1", "w2"]).filter(spot > F.col("least"))
    keep = ["k", "x", "start", "end"]
    return texts, spans.unionByName(marks.filter("w1 IS NULL").select(*keep)).unionByName(across.select(*keep))


def dedup_bytes(spark: SparkSession, docs: DataFrame, window: int = WINDOW, whole_characters: bool = False,
                gram: int = GRAM, chunk_bytes: int = CHUNK_BYTES, piece_rows: int = PIECE_ROWS, with_rest: bool = False) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept, rest``: every document without its repeated bytes.

    ``rest`` is a struct of the other columns with ``with_rest``, else NULL.

    With ``whole_characters`` a range shrinks to the UTF-8 characters that lie in it whole,
    so what is kept is valid text.
    """
    texts, spans = removed_ranges(spark, docs, window, gram, chunk_bytes, piece_rows, with_rest)
    rest = texts.schema["rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, raws, at, (starts, ends) in document_rows(batches, "start", "end"):
            counts, kept = np.zeros((len(raws), 3), dtype=np.int64), []
            for i, raw in enumerate(raws):
                start, end = merge_spans(starts[at[i]:at[i + 1]], ends[at[i]:at[i + 1]])
                if whole_characters and len(start):
                    start, end = _whole(raw, start, end)
                counts[i] = len(raw), (end - start).sum(), len(start)
                kept.append(b"".join([raw[a:b] for a, b in zip([0, *end.tolist()], [*start.tolist(), len(raw)])]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(counts[:, i]) for i in range(3)), pa.array(kept, pa.binary()), batch.column("rest")],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "rest"])

    return (per_document(texts, spans, ["start", "end"], "left").select("doc_id", "z", "rows", "rest")
            .mapInArrow(run, f"doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, rest {rest}"))


def _whole(raw: bytes, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = (np.frombuffer(raw + b" ", dtype=np.uint8) & 0xC0) == 0x80  # not the first byte of a character
    for _ in range(3):
        start = np.where((start < end) & inside[start], start + 1, start)
        end = np.where((start < end) & inside[end], end - 1, end)
    some = start < end
    return start[some], end[some]


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


__all__ = ["WINDOW", "byte_segments", "mark_chunk", "removed_ranges", "dedup_bytes", "digests"]
