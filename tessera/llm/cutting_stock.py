"""Packing token sequences by cutting-stock column generation.

Documents are encoded and cut into whole sequences and a remainder shorter than one.  The
remainders' length histogram (at most ``width - 1`` numbers, whatever the input) is a
cutting-stock problem: a pattern is a set of lengths that fill a sequence exactly, and the
linear program makes as many filled sequences as the histogram allows.  Columns are priced by
a knapsack over the duals: the cheapest exact fill of every width, by dynamic programming.
The program's pattern counts are rounded to whole sequences; the documents of each length,
ranked over all tasks, take the patterns' slots in turn.  What no whole pattern takes is laid
end to end and cut at sequence ends, the last rest at powers of two, so no token is padding.

Two passes over the documents' ids and none over their texts but the first: ranks come from
counts by (task, length), so no length, however common, meets in one task.  The second pass
looks the tasks' rank offsets up in a broadcast of ``TASKS_PER_BLOCK`` tasks at a time (at most
``width`` short rows a task), one block after the other.

Defined cases: NULL text counts as empty, and an empty document is its end id alone; rows that
repeat are packed as separate documents; an empty table gives no pieces; other columns are
ignored unless named in ``keep``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.bpe import _MASK, _SHIFT, PATTERN, Encoder, Vocabulary
from tessera.llm.common import by_bytes, hand_back
from tessera.session import scratch_path

WIDTH = 2048
END_ID = 1
GAP = 0.002
TASKS_PER_BLOCK = 512
_STALL = 16
_COLUMNS_A_ROUND = 96
_EPS = 1e-7
_LONG_TEXT, _LONG_WORD = 200_000, 4_000  # characters: beyond, merges are made by the heap of `bpe.Encoder`
_GROUP_BYTES = 1 << 20


# The linear program.

@dataclass
class Patterns:
    """Whole sequences: pattern ``p`` is cut ``counts[p]`` times and holds ``uses[p]``, lengths with their numbers."""

    uses: list[list[tuple[int, int]]]
    counts: list[int]


def cheapest_fills(price: np.ndarray, lengths: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """For every ``w`` the least price of lengths that sum to ``w`` exactly, and the length taken last (0: none)."""
    best, last = np.full(width + 1, np.inf), np.zeros(width + 1, dtype=np.int64)
    best[0] = 0.0
    ends = np.searchsorted(lengths, np.arange(width + 1), side="right")
    for w in range(1, width + 1):
        n = ends[w]
        if n:
            cost = best[w - lengths[:n]] + price[:n]
            i = int(cost.argmin())
            best[w], last[w] = cost[i], lengths[i]
    return best, last


def _fill(w: int, last: np.ndarray) -> list[int]:
    out = []
    while w:
        out.append(int(last[w]))
        w -= out[-1]
    return out


class FillProgram:
    """max sum x, A x <= n, x >= 0 over exact fills, by the revised simplex method with columns made on demand."""

    def __init__(self, lengths: np.ndarray, numbers: np.ndarray, width: int):
        self.lengths, self.width, m = lengths, width, len(lengths)
        self.row = {int(v): i for i, v in enumerate(lengths)}
        self.numbers = numbers.astype(float)
        # A little more of each length, a different share for each, so that no two ratios tie.
        self.x = self.numbers + 1e-5 * (1.0 + np.arange(m) * 0.6180339887 % 1.0)
        self.start = self.x.copy()
        self.inverse = np.eye(m)
        self.duals = np.zeros(m)
        self.basis: list[tuple[tuple[int, int], ...] | None] = [None] * m  # None: the length's own slack

    def column(self, parts: list[int]) -> tuple[tuple[int, int], ...]:
        counts: dict[int, int] = {}
        for v in parts:
            i = self.row[v]
            counts[i] = counts.get(i, 0) + 1
        return tuple(sorted(counts.items()))

    def profit(self, column: tuple[tuple[int, int], ...]) -> float:
        return 1.0 - sum(self.duals[i] * a for i, a in column)

    def _step(self, column: tuple[tuple[int, int], ...]) -> np.ndarray:
        return sum(self.inverse[:, i] * a for i, a in column)

    def _pivot(self, column: tuple[tuple[int, int], ...], step: np.ndarray, out: int) -> np.ndarray:
        """Put the column into row ``out`` of the basis; returns the row of the inverse."""
        pivot = self.inverse[out] / step[out]
        moved, cols = np.flatnonzero(np.abs(step) > 1e-13), np.flatnonzero(pivot)
        self.inverse[np.ix_(moved, cols)] -= np.outer(step[moved], pivot[cols])
        self.inverse[out] = pivot
        self.basis[out] = column
        return pivot

    def enter(self, column: tuple[tuple[int, int], ...]) -> None:
        profit, step = self.profit(column), self._step(column)
        up = np.flatnonzero(step > _EPS)
        if not len(up):
            return
        out = int(up[(self.x[up] / step[up]).argmin()])
        theta = self.x[out] / step[out]
        self.x -= theta * step
        self.x[out] = theta
        np.maximum(self.x, 0.0, out=self.x)
        self.duals += profit * self._pivot(column, step, out)

    def refresh(self) -> None:
        """The inverse, the solution and the duals anew from the basis: takes back what rounding has added up.

        By the same pivots, not by LAPACK: its threads can lock up in a driver that has started a JVM.
        """
        m = len(self.lengths)
        columns = sorted((c for c in self.basis if c is not None), key=len)
        open_ = np.array([c is not None for c in self.basis])
        self.inverse, self.basis = np.eye(m), [None] * m
        for column in columns:
            step = self._step(column)
            out = int(np.where(open_, np.abs(step), -1.0).argmax())
            if abs(step[out]) > _EPS:  # else the column depends on the others
                self._pivot(column, step, out)
                open_[out] = False
        self.x = np.maximum(np.einsum("ij,j->i", self.inverse, self.start), 0.0)
        self.duals = self.inverse[[c is not None for c in self.basis]].sum(axis=0)

    def solve(self, gap: float) -> None:
        """Until the duals prove that no more than a share ``gap`` is missing to the best number of filled sequences,
        or ``_STALL`` rounds without surcharge add less than that.

        Lengths that are plentiful have no price at first, so ties would be broken for columns that
        use a rare length many times.  A surcharge in proportion to ``1 / number`` leads to
        columns that can be used often; it falls as it stops finding any, to nothing at the end.
        """
        pool: list[tuple[tuple[int, int], ...]] = [
            self.column([v, self.width - v]) for v in self.lengths.tolist() if 2 * v <= self.width and self.width - v in self.row]
        rare = float(np.median(self.numbers)) / self.numbers
        surcharge, reached = 0.25, []
        for column in pool:
            self.enter(column)
        for round_ in itertools.count():
            price = np.maximum(self.duals, 0.0) + surcharge * rare
            cost, last = cheapest_fills(price, self.lengths, self.width)
            if not surcharge and cost[self.width] >= 1.0 - gap:
                return
            through = price + cost[self.width - self.lengths]
            found: dict[tuple[tuple[int, int], ...], float] = {}
            for i in np.argsort(through, kind="stable"):
                if not np.isfinite(through[i]) or len(found) == _COLUMNS_A_ROUND:
                    break
                v = int(self.lengths[i])
                column = self.column([v, *_fill(self.width - v, last)])
                if self.profit(column) > max(_EPS, gap / 4):
                    found[column] = 0.0
            reached.append(sum(x for x, c in zip(self.x.tolist(), self.basis) if c is not None))
            if not found or len(reached) > _STALL and reached[-1] - reached[-1 - _STALL] <= gap * reached[-1]:
                if not surcharge:
                    return
                surcharge, reached = 0.0 if surcharge < 1e-3 else surcharge / 8, []
            pool = list(found)
            while pool:
                gains = [self.profit(c) for c in pool]
                best = int(np.argmax(gains))
                if gains[best] <= _EPS:
                    break
                self.enter(pool.pop(best))
            if round_ % 64 == 63:
                self.refresh()


def plan_fills(histogram: dict[int, int], width: int = WIDTH, gap: float = GAP) -> Patterns:
    """Patterns that fill sequences exactly with the lengths of ``histogram``, each length used as often as it occurs at most."""
    lengths = np.array(sorted(v for v, n in histogram.items() if n > 0 and 0 < v < width), dtype=np.int64)
    if not len(lengths):
        return Patterns([], [])
    program = FillProgram(lengths, np.array([histogram[int(v)] for v in lengths]), width)
    program.solve(gap)
    program.refresh()
    left = program.numbers.astype(np.int64)
    chosen = [(column, x) for column, x in zip(program.basis, program.x.tolist()) if column is not None]
    counts: dict[tuple[tuple[int, int], ...], int] = {}

    def take(column, most) -> None:
        n = min([most, *(int(left[i]) // a for i, a in column)])
        if n > 0:
            counts[column] = counts.get(column, 0) + n
            for i, a in column:
                left[i] -= n * a

    for column, x in chosen:
        take(column, int(x))
    for column, _ in sorted(chosen, key=lambda c: int(c[1]) - c[1]):  # what the fractions leave, largest fraction first
        take(column, 1 << 62)
    return Patterns([[(int(lengths[i]), a) for i, a in column] for column in counts], list(counts.values()))


# Where each ranked remainder goes.

class Slots:
    """Sequence and offset of the remainders by (length, rank); arithmetic on tables of at most a few entries a pattern."""

    def __init__(self, patterns: Patterns, histogram: dict[int, int], width: int):
        self.width = width
        self.filled = sum(patterns.counts)
        entries: list[list[tuple[int, int, int, int]]] = [[] for _ in range(width + 1)]
        taken = np.zeros(width + 1, dtype=np.int64)
        sequence = 0
        for uses, count in zip(patterns.uses, patterns.counts):
            at = 0
            for length, number in uses:
                entries[length].append((int(taken[length]), number, sequence, at))
                taken[length] += number * count
                at += number * length
            sequence += count
        self.entries = [np.array(e, dtype=np.int64).reshape(-1, 4) for e in entries]
        self.taken = taken
        # The rest of each length lies on a tape, in order of length and rank.
        rest = np.array([(histogram.get(v, 0) - int(taken[v])) * v if 0 < v < width else 0 for v in range(width + 1)], dtype=np.int64)
        self.tape_start = np.cumsum(rest) - rest
        self.tape = int(rest.sum())
        whole = self.tape // width * width
        tail = [1 << b for b in range(width.bit_length() - 1, -1, -1) if self.tape - whole >> b & 1]
        self.tail_ends = whole + np.cumsum([0, *tail])
        self.tape_whole = whole
        self.first_whole = self.filled + whole // width + len(tail)  # sequences that hold one whole cut of a document

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int]]:
        """(tokens, sequence, offset) of the pieces that the remainder is cut into."""
        if rank < self.taken[length]:
            e = self.entries[length]
            first, number, sequence, at = e[np.searchsorted(e[:, 0], rank, side="right") - 1].tolist()
            copy, slot = divmod(rank - first, number)
            return [(length, sequence + copy, at + slot * length)]
        at = int(self.tape_start[length]) + (rank - int(self.taken[length])) * length
        end, out = at + length, []
        while at < end:
            if at < self.tape_whole:
                start, sequence = at // self.width * self.width, at // self.width
                stop = start + self.width
            else:
                k = int(np.searchsorted(self.tail_ends, at, side="right")) - 1
                start, stop, sequence = int(self.tail_ends[k]), int(self.tail_ends[k + 1]), self.tape_whole // self.width + k
            out.append((min(end, stop) - at, self.filled + sequence, at - start))
            at = min(end, stop)
        return out


# Encoding.

class TextEncoder:
    """Ids of whole texts, as little-endian unsigned 32-bit integers.

    The public ``tiktoken`` library merges the pair whose *joined bytes* rank lowest, where the vocabulary
    lists pairs.  Both give the same ids if each merged token comes from one listed pair, and
    only tokens that merge to themselves are ranked: a pair of other halves of such a token can
    then never stand side by side when the token's turn comes, since the same bytes alone would have
    gone the same way.  ``__init__`` checks this for the vocabulary at hand; where it does not hold, and for very long
    texts or words, the listed pairs are merged by ``bpe.Encoder``.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.exact = Encoder(vocabulary)
        merged = sorted((m >> _SHIFT, m & _MASK) for m in vocabulary.merges.values())
        pieces = vocabulary.pieces
        ids = vocabulary.byte_ids + [i for _, i in merged]
        self.fast = None
        if len(set(ids)) == len(ids):
            ranks = {pieces[i]: r for r, i in enumerate(ids)}
            own = _merged_alone(self.exact, [pieces[i] for _, i in merged])
            for (_, i), alone in zip(merged, own):
                if alone != np.uint32(i).tobytes():
                    del ranks[pieces[i]]
            special = {t: len(ids) + k for k, t in enumerate(vocabulary.special)}
            self.fast = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
            self.to_id = np.array([*ids, *vocabulary.special.values()], dtype="<u4")

    def encode(self, text: str) -> bytes:
        if self.fast is None or len(text) > _LONG_TEXT or max(map(len, text.split()), default=0) > _LONG_WORD:
            return self.exact.encode(text)
        return self.to_id[self.fast.encode_to_numpy(text, allowed_special="all")].tobytes()


def _merged_alone(encoder: Encoder, pieces: list[bytes]) -> list[bytes]:
    """What the listed merges make of each piece's bytes by themselves."""
    out: list[bytes] = [b""] * len(pieces)
    by_length: dict[int, list[int]] = {}
    for i, p in enumerate(pieces):
        by_length.setdefault(len(p), []).append(i)
    byte_ids = np.array(encoder.vocabulary.byte_ids, dtype=np.int64)
    for length, members in by_length.items():
        rows = byte_ids[np.frombuffer(b"".join([pieces[i] for i in members]), dtype=np.uint8)].reshape(len(members), length)
        for at, ids in encoder._table.merge(rows):
            for row, line in zip(at.tolist(), ids.astype("<u4")):
                out[members[row]] = line.tobytes()
    return out


_WORKER: dict[int, TextEncoder] = {}


def _worker_encoder(shared) -> TextEncoder:
    """The Python worker's encoder: its next task goes on with it."""
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) else id(shared.value)
    if key not in _WORKER:
        _WORKER.clear()
        _WORKER[key] = TextEncoder(shared.value)
    return _WORKER[key]


def encode_remainders(spark: SparkSession, docs: DataFrame, tokenizer_path: str, width: int, end_id: int,
                      text_col: str, keep: tuple[str, ...]) -> DataFrame:
    """Staged: ``keep``, ``ids`` (with the end id), ``task``, and the row's rank among its task's rows of its remainder's length
    (``rem``, ``rem_rank``) and among its task's whole cuts (``full_rank``)."""
    shared = spark.sparkContext.broadcast(Vocabulary.load(tokenizer_path))  # bounded by the vocabulary
    source = docs.select(*keep, F.col(text_col).alias("__text"))
    n_keep, end = len(keep), np.uint32(end_id).tobytes()
    own = ["ids", "task", "rem", "rem_rank", "full_rank"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()  # what earlier stages left in this worker
        encoder = _worker_encoder(shared)
        task, seen = TaskContext.get().partitionId(), np.zeros(width + 1, dtype=np.int64)
        for whole in batches:
            for batch in by_bytes(whole, n_keep, _GROUP_BYTES):
                ids = [encoder.encode(t or "") + end for t in batch.column(n_keep).to_pylist()]
                encoder.exact.forget()
                rem, rem_rank, full_rank = [], [], []
                for i in ids:
                    full, r = divmod(len(i) // 4, width)
                    rem.append(r)
                    rem_rank.append(int(seen[r]))
                    full_rank.append(int(seen[width]))
                    seen[r] += r > 0
                    seen[width] += full
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(n_keep)]
                    + [pa.array(ids, pa.binary()), pa.array([task] * len(ids), pa.int32()), pa.array(rem, pa.int32()),
                       pa.array(rem_rank, pa.int64()), pa.array(full_rank, pa.int64())], names=[*keep, *own])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:n_keep]]
    coded = source.mapInArrow(run, ", ".join(fields + ["ids binary, task int, rem int, rem_rank long, full_rank long"]))
    path = scratch_path(spark, "packing-ids")
    coded.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(coded.schema).parquet(path)


# The operator.

def pack_tokens(spark: SparkSession, docs: DataFrame, tokenizer_path: str, width: int = WIDTH, end_id: int = END_ID,
                gap: float = GAP, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``start, length, ids`` (little-endian unsigned 32 bit), ``doc_tokens, sequence_id, offset``: one row per piece.

    ``gap``: the linear program stops when at most this share of the exactly filled sequences
    can be missing, or a number of rounds adds less than this share.
    """
    coded = encode_remainders(spark, docs, tokenizer_path, width, end_id, text_col, keep)
    n = (F.octet_length("ids") / 4).cast("long")
    counts = (coded.select("task", F.explode(F.array(F.struct("rem", F.lit(1).cast("long").alias("n")),
                                                     F.struct(F.lit(width).alias("rem"), F.floor(n / width).alias("n")))).alias("c"))
              .filter("c.rem > 0 AND c.n > 0").groupBy("task", "c.rem").agg(F.sum("c.n").alias("n")))
    path = scratch_path(spark, "packing-ranks")
    before = Window.partitionBy("rem").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    (counts.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
     .withColumn("block", F.floor(F.col("task") / TASKS_PER_BLOCK)).write.parquet(path))
    ranks = spark.read.parquet(path)
    histogram = {r.rem: int(r.n) for r in ranks.groupBy("rem").agg(F.sum("n").alias("n")).collect()}  # at most `width` rows
    slots = Slots(plan_fills(histogram, width, gap), histogram, width)
    blocks = [r.block for r in ranks.select("block").distinct().orderBy("block").collect()]  # one number per 512 tasks
    if len(blocks) < 2:
        return _cut(spark, coded, ranks, slots, width, keep)
    out = scratch_path(spark, "packing-pieces")
    for b in blocks:
        part = coded.filter(F.floor(F.col("task") / TASKS_PER_BLOCK) == b)
        _cut(spark, part, ranks.filter(F.col("block") == b), slots, width, keep).write.option("compression", "zstd").mode("append").parquet(out)
    return spark.read.parquet(out)


def _cut(spark: SparkSession, coded: DataFrame, ranks: DataFrame, slots: Slots, width: int, keep: tuple[str, ...]) -> DataFrame:
    first = ranks.select("task", "rem", "first")
    rem = first.filter(F.col("rem") < width)
    full = first.filter(F.col("rem") == width).select("task", F.col("first").alias("__first_full"))
    placed = (coded.join(F.broadcast(rem), ["task", "rem"], "left").join(F.broadcast(full), "task", "left")
              .select(*keep, F.col("ids").alias("__ids"), (F.col("first") + F.col("rem_rank")).alias("__rank"),
                      (F.col("__first_full") + F.col("full_rank")).alias("__full")))
    n_keep = len(keep)
    shared = spark.sparkContext.broadcast(slots)  # bounded: patterns of `width` lengths at most
    names = [*keep, "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = shared.value
        for batch in batches:
            ranks_, fulls = batch.column(n_keep + 1).to_pylist(), batch.column(n_keep + 2).to_pylist()
            at: list[int] = []
            cuts: list[tuple[int, bytes, int, int, int]] = []
            start: list[int] = []
            for row, ids in enumerate(batch.column(n_keep).to_pylist()):
                total, done = len(ids) // 4, 0
                whole, r = divmod(total, width)
                parts = [(width, slots.first_whole + fulls[row] + k, 0) for k in range(whole)]
                parts += slots.pieces(r, ranks_[row]) if r else []
                for length, sequence, offset in parts:
                    at.append(row)
                    start.append(done)
                    cuts.append((length, ids[4 * done:4 * (done + length)], total, sequence, offset))
                    done += length
            length, ids, total, sequence, offset = zip(*cuts) if cuts else ((),) * 5
            picked = batch.select(list(range(n_keep))).take(pa.array(at, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary()),
                 pa.array(total, pa.int64()), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())], names=names)

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in placed.schema.fields[:n_keep]]
    return placed.mapInArrow(run, ", ".join(fields + ["start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"]))


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


__all__ = ["WIDTH", "END_ID", "Patterns", "cheapest_fills", "plan_fills", "Slots", "TextEncoder", "pack_tokens", "digests"]
