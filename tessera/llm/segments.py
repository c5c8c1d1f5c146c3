"""Anchored segments of long repeated windows.

A text is a sequence of units (bytes or words).  Every window of ``window`` units chooses
the leftmost lowest-hashed gram of ``gram`` units in it, its anchor; consecutive windows
with one anchor form a segment.  Equal windows choose equal anchors at equal places, so
all that repeats at window length can be found within groups of one anchor, with one row
per segment instead of one per window.

``group_segments`` brings the segments of an anchor together.  A segment whose whole
content occurs earlier is decided there; where an anchor has several contents, their first
occurrences are left to the caller's own method.  Repeats inside one batch are settled
before the shuffle, so a passage of many documents costs a row per batch, and a hot
anchor's rows are streamed, never gathered.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import keyed_texts

BUFFER_BYTES = 1 << 20
_PLACE_BITS = 22  # units of a chunk are numbered within one order key
_MAX_UNITS = 1 << 21
_SLICE_ROWS = 256

_rng = np.random.default_rng(20240229)  # fixed: hashes must agree between tasks
_BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0xD1342543DE82EF95)
_BASE_INVERSE = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out)


class RangeHash:
    """64-bit hashes of any byte range of a buffer, from one pass of prefix sums."""

    _up = _powers(_BASE, 1)
    _down = _powers(_BASE_INVERSE, 1)

    def __init__(self, raw: np.ndarray):
        cls = type(self)
        if len(cls._up) <= len(raw):
            n = max(len(raw) + 1, 1 << 16)
            cls._up, cls._down = _powers(_BASE, n), _powers(_BASE_INVERSE, n)
        self._sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_CODE[raw] * cls._up[:len(raw)], out=self._sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        z = (self._sums[end] - self._sums[start]) * self._down[start]
        z ^= z >> np.uint64(31)
        z *= np.uint64(0x9E3779B97F4A7C15)
        z ^= z >> np.uint64(29)
        return z


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    out, covered = values, 1
    while covered < width:
        step = min(covered, width - covered)
        out = np.minimum(out[:len(out) - step], out[step:])
        covered += step
    return out


@dataclass
class Segments:
    """Segments of a buffer: document number, first window, windows, anchor place (units of the buffer) and hashes."""

    doc: np.ndarray
    start: np.ndarray
    run: np.ndarray
    place: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def cut_segments(hashes: RangeHash, first: np.ndarray, last: np.ndarray, doc_of: np.ndarray, doc_end: np.ndarray,
                 gram: int, window: int) -> Segments:
    """Segments of a buffer whose unit ``i`` covers bytes ``first[i]:last[i]`` of document ``doc_of[i]``.

    ``doc_end[d]`` is the unit after document ``d``; windows never cross it.
    """
    parts = []
    n = len(first)
    for base in range(0, max(1, n - window + 1), _MAX_UNITS):
        stop = min(n, base + _MAX_UNITS + window - 1)
        grams = stop - base - gram + 1
        if stop - base < window:
            break
        at = np.arange(base, base + grams)
        h = hashes.of(first[at], last[at + gram - 1])
        low = np.uint64((1 << _PLACE_BITS) - 1)
        order = (h & ~low) | np.arange(grams, dtype=np.uint64)
        chosen = (sliding_min(order, window - gram + 1) & low).astype(np.int64)
        start = np.arange(base, base + len(chosen))
        inside = start + window <= doc_end[doc_of[start]]
        cut = np.ones(len(chosen), dtype=bool)
        cut[1:] = (chosen[1:] != chosen[:-1]) | (doc_of[start[1:]] != doc_of[start[:-1]])
        cut &= inside
        heads = np.flatnonzero(cut)
        # A segment ends where the next one begins or its document has no further window.
        tails = np.minimum(np.append(heads[1:], len(chosen)), doc_end[doc_of[start[heads]]] - window + 1 - base)
        parts.append((doc_of[start[heads]], start[heads], tails - heads, chosen[heads] + base, h[chosen[heads]]))
    if not parts:
        none = np.empty(0, dtype=np.int64)
        return Segments(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    doc, start, run, place, anchor = (np.concatenate(x) for x in zip(*parts))
    return Segments(doc, start, run, place, anchor, hashes.of(first[start], last[start + run + window - 2]))


def buffers(batches: Iterator[pa.RecordBatch], size: int = BUFFER_BYTES) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Groups of documents (k, x, texts as bytes) of about ``size`` bytes, each sorted by (k, x)."""
    rows: list[tuple[int, int, bytes]] = []
    held = 0

    def close() -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        rows.sort(key=lambda r: r[:2])
        return (np.array([r[0] for r in rows], dtype=np.int64), np.array([r[1] for r in rows], dtype=np.int64),
                [r[2] for r in rows])

    for batch in batches:
        for k, x, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            rows.append((k, x, text.as_py().encode()))
            held += len(rows[-1][2])
            if held >= size:
                yield close()
                rows, held = [], 0
    if rows:
        yield close()


_ROW = "route long, anchor long, content long, k long, x long, start long, run long, place long"
_OUT = "k long, x long, start long, run long, place long, anchor long, piece long"


def segment_rows(docs: DataFrame, scan: Callable[[list[bytes]], tuple[Segments, np.ndarray]], window: int, by_place: bool) -> DataFrame:
    """One row per segment that may be a first occurrence, and one per stretch that a batch has settled.

    ``scan`` gives the segments of some documents and each document's first unit.  Settled
    stretches have place -1 and ``run`` units.  With ``by_place`` any earlier occurrence
    counts, otherwise only one in another document.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ks, xs, texts in buffers(batches):
            s, origin = scan(texts)
            k, x, start, place = ks[s.doc], xs[s.doc], s.start - origin[s.doc], s.place - origin[s.doc]
            key = s.anchor ^ (s.content * np.uint64(0x9E3779B97F4A7C15))
            order = np.argsort(key, kind="stable")  # documents are in order already
            same = np.zeros(len(order), dtype=bool)
            a, b = order[1:], order[:-1]
            same[1:] = (s.anchor[a] == s.anchor[b]) & (s.content[a] == s.content[b])
            head = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))] if len(order) else order
            other = (k[order] != k[head]) | (x[order] != x[head])
            if by_place:
                other |= start[order] != start[head]
            settled = np.zeros(len(order), dtype=bool)
            settled[order] = same & other
            keep = ~settled
            if by_place and len(order):  # a repeated row is the same document
                keep[order] &= ~same
            # Settled segments of a document that touch become one stretch.
            hit = np.flatnonzero(settled)
            low, high = start[hit], start[hit] + s.run[hit] + window - 1
            joined = np.ones(len(hit), dtype=bool)
            joined[1:] = (s.doc[hit[1:]] != s.doc[hit[:-1]]) | (low[1:] > high[:-1])
            at = np.flatnonzero(joined)
            top = np.maximum.reduceat(high, at) if len(at) else high
            n = len(at)
            spread = ((k[hit[at]].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ low[at].view(np.uint64)).view(np.int64)
            zero = np.zeros(n, dtype=np.int64)

            def both(x: np.ndarray, y: np.ndarray) -> pa.Array:
                return pa.array(np.concatenate([x.astype(np.int64) if x.dtype != np.uint64 else x.view(np.int64), y]))

            yield pa.RecordBatch.from_arrays(
                [both(s.anchor[keep], spread), both(s.anchor[keep], spread), both(s.content[keep], zero), both(k[keep], k[hit[at]]),
                 both(x[keep], x[hit[at]]), both(start[keep], low[at]), both(s.run[keep], top - low[at]),
                 both(place[keep], zero - 1)],
                names=["route", "anchor", "content", "k", "x", "start", "run", "place"])

    return keyed_texts(docs).select("k", "x", "text").mapInArrow(run, _ROW)


class _Groups:
    """Streams rows sorted by (anchor, content, k, x, start); its memory does not grow with a group."""

    def __init__(self, window: int, by_place: bool, piece_rows: int):
        self.window, self.by_place, self.piece_rows = window, by_place, piece_rows
        self.last: tuple[int, int, int, int, int] | None = None  # anchor, content, k, x, start of the current content's first
        self.index = 0                                           # contents of the current anchor before the current one
        self.waiting: list[np.ndarray] = []                      # first rows of an anchor with one content so far

    def take(self, rows: np.ndarray) -> list[np.ndarray]:
        """``rows``: (8, n) as in ``_ROW``.  Returns blocks of ``_OUT``."""
        out = []
        settled = rows[7] < 0
        if settled.any():
            done = rows[:, settled]
            out.append(np.stack([done[3], done[4], done[5], done[6], done[7], done[1], np.zeros(done.shape[1], np.int64)]))
            rows = rows[:, ~settled]
        if not rows.shape[1]:
            return out
        _, anchor, content, k, x, start, run, place = rows
        last = self.last
        new_anchor = np.ones(len(anchor), dtype=bool)
        new_anchor[1:] = anchor[1:] != anchor[:-1]
        new = new_anchor.copy()
        new[1:] |= content[1:] != content[:-1]
        if last is not None and anchor[0] == last[0]:
            new_anchor[0] = False
            new[0] = content[0] != last[1]
        group = np.cumsum(new)
        heads = np.flatnonzero(new)

        def of_first(column: np.ndarray, number: int) -> np.ndarray:
            return np.concatenate(([last[number] if last else 0], column[heads]))[group]

        first = (k == of_first(k, 2)) & (x == of_first(x, 3))
        if self.by_place:
            first &= start == of_first(start, 4)
        # Number of the content within its anchor; the first anchor may go on from the last batch.
        series = np.cumsum(new_anchor)
        before = np.concatenate(([-self.index], group[new_anchor] - 1))[series]
        index = group - before
        contents = np.zeros(series[-1] + 1, dtype=np.int64)
        np.maximum.at(contents, series, index)
        many = contents[series] >= 2
        if self.waiting:
            if not new_anchor[0] and contents[0] >= 2:
                out += self.waiting
            if new_anchor[0] or contents[0] >= 2 or series[-1] > 0:
                self.waiting = []
        late = ~first
        out.append(np.stack([k[late], x[late], start[late], run[late] + self.window - 1, np.full(late.sum(), -1),
                             anchor[late], np.zeros(late.sum(), np.int64)]))
        piece = (index - 1) // self.piece_rows
        block = np.stack([k, x, start, run, place, anchor, piece])
        out.append(block[:, first & many])
        open_ = first & ~many & (series == series[-1])
        if open_.any():
            self.waiting.append(block[:, open_])
        g = heads[-1] if len(heads) else None
        self.last = ((anchor[g], content[g], k[g], x[g], start[g]) if g is not None else last)
        self.index = int(index[-1])
        return out


def group_segments(rows: DataFrame, window: int, by_place: bool, piece_rows: int = 1 << 14) -> DataFrame:
    """Decided stretches (place -1, ``run`` units) and undecided first occurrences, per document.

    An anchor of more than ``piece_rows`` contents is cut into pieces by the order of its
    contents; everything else has piece 0.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = _Groups(window, by_place, piece_rows)
        for batch in batches:
            if batch.num_rows:
                blocks = groups.take(np.stack([c.to_numpy() for c in batch.columns]))
                if blocks:
                    table = np.concatenate(blocks, axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in table],
                                                     names=["k", "x", "start", "run", "place", "anchor", "piece"])

    return (rows.repartition("route").sortWithinPartitions("anchor", "content", "k", "x", "start")
            .mapInArrow(run, _OUT))


def packed_texts(docs: DataFrame, with_rest: bool = False) -> DataFrame:
    """``doc_id, k, x, z``: texts compressed before they are shuffled by document.

    With ``with_rest`` a struct ``rest`` carries the other columns along.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] if with_rest else []
    source = keyed_texts(docs, rest=F.struct(*others) if others else F.lit(None).cast("struct<none:boolean>"))
    rest = source.schema["rest"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            packed = [squeeze(t.as_py().encode()) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary()), batch.column(4)],
                                             names=["doc_id", "k", "x", "z", "rest"])

    return source.mapInArrow(run, f"doc_id long, k long, x long, z binary, rest {rest}")


def unpack(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


def per_document(texts: DataFrame, rows: DataFrame, columns: list[str], how: str) -> DataFrame:
    """Join each document's rows (as one list, bounded by the document's length) to its packed text."""
    lists = rows.groupBy("k", "x").agg(F.collect_set(F.struct(*columns)).alias("rows"))
    return texts.join(lists, ["k", "x"], how)


def document_rows(batches: Iterator[pa.RecordBatch], *fields: str) -> Iterator[tuple[pa.RecordBatch, list[bytes], np.ndarray, list[np.ndarray]]]:
    """Some documents at a time: the rows, their texts, and the listed rows as columns with the documents' offsets."""
    for whole in batches:
        for at in range(0, whole.num_rows, _SLICE_ROWS):
            batch = whole.slice(at, _SLICE_ROWS)
            rows = batch.column("rows")
            flat, offsets = rows.flatten(), np.asarray(rows.offsets)
            yield batch, [unpack(z) for z in batch.column("z").to_pylist()], offsets - offsets[0], [
                flat.field(f).to_numpy(zero_copy_only=False) for f in fields]


def merge_spans(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of ranges as maximal ranges (touching ones are joined)."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    head = np.ones(len(start), dtype=bool)
    head[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(head)
    return start[at], end[np.append(at[1:] - 1, len(end) - 1)]


__all__ = ["RangeHash", "Segments", "sliding_min", "cut_segments", "segment_rows", "group_segments", "packed_texts", "unpack",
           "per_document", "document_rows", "merge_spans"]
