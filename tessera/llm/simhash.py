"""SimHash near-duplicates through a segment-popcount embedding.

A fingerprint's 64 bits are cut into 32 segments of two; the vector of their bit counts
is the embedding.  The Manhattan distance of two embeddings never exceeds the Hamming
distance of the fingerprints, so a range join under it loses no link: with distance d or
less, at most d of ``blocks`` groups of segments can differ, and the two vectors lie in
one grid cell of at least one subspace of ``blocks - d`` groups.  Every distinct
fingerprint is sent to its cell in each of those subspaces; in a cell, the Manhattan
bound and then the exact bit distance decide.

A cell reports links as stars, not as pairs: a search from a member visits what it
reaches and never looks at it again, so thousands of near copies cost a few passes and
one row each.  Cells of more than ``CELL_ROWS`` fingerprints are cut into pieces, and
every two pieces meet in a task of their own.  Components of the stars are found over
fingerprints, not documents.

Defined cases: NULL, empty and wordless texts have fingerprint zero and link like any
other; repeated rows share fingerprint and component; a component whose ids are all NULL
has a NULL id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import keyed_texts, staged
from tessera.llm.components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
CELL_ROWS = 1 << 20
_ONES = 0x5555555555555555  # the low bit of every two-bit segment
_CHUNK = 1 << 17
_UPPER = bytes(range(256)).lower()


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of a text's word shingles as a signed 64-bit integer."""
    words = (text or "").encode().translate(_UPPER).split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    digest, total = xxhash.xxh64_digest, np.zeros(64, dtype=np.int64)
    hashes = [digest(g, SEED) for g in grams]
    for at in range(0, len(hashes), _CHUNK):
        raw = np.frombuffer(b"".join(hashes[at:at + _CHUNK]), dtype=np.uint8).reshape(-1, 8)
        total += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(hashes)).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, k, x, fp`` per document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(fps, pa.int64())], names=["doc_id", "k", "x", "fp"])

    return keyed_texts(docs).mapInArrow(run, "doc_id long, k long, x long, fp long")


def embedding(fp: Column) -> Column:
    """Bit counts of the two-bit segments, each written as that many ones in its segment.

    In this form the Manhattan distance of two embeddings is the bit count of their XOR.
    """
    ones = F.lit(_ONES)
    high = F.shiftrightunsigned(fp, 1)
    either = fp.bitwiseOR(high).bitwiseAND(ones)
    both = fp.bitwiseAND(high).bitwiseAND(ones)
    return either.bitwiseOR(F.shiftleft(both, 1))


def subspace_masks(blocks: int, max_bits: int) -> list[int]:
    """Bit masks of all subspaces of ``blocks - max_bits`` groups of segments (signed)."""
    edges = [2 * round(32 * i / blocks) for i in range(blocks + 1)]
    group = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    masks = [sum(c) for c in combinations(group, blocks - max_bits)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _embed(fps: np.ndarray) -> np.ndarray:
    ones, one = np.uint64(_ONES), np.uint64(1)
    high = fps >> one
    return ((fps | high) & ones) | ((fps & high & ones) << one)


def stars(fps: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.uint64]]:
    """Components of one cell's fingerprints: (members without the root, root)."""
    embedded = _embed(fps)
    left = np.arange(len(fps))  # not reached yet
    while len(left) > 1:
        root, left = left[0], left[1:]
        queue, members = [root], []
        while queue and len(left):
            i = queue.pop()
            near = np.bitwise_count(embedded[left] ^ embedded[i]) <= max_bits  # the lower bound
            near[near] = np.bitwise_count(fps[left[near]] ^ fps[i]) <= max_bits  # exact
            if near.any():
                hit = left[near]
                left = left[~near]
                queue.extend(hit.tolist())
                members.append(hit)
        if members:
            yield fps[np.concatenate(members)], fps[root]


_LINKS = "u long, v long, cell long, piece long"


def _link_cells(max_bits: int, cell_rows: int):
    """Links of sorted cells; rows of oversized cells come out as ``(fp, NULL, cell, piece)``."""
    def links(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        u = np.concatenate([f[0] for f in found]) if found else np.empty(0, np.uint64)
        v = np.concatenate([f[1] for f in found]) if found else np.empty(0, np.uint64)
        none = pa.nulls(len(u), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), none, none],
                                          names=["u", "v", "cell", "piece"])

    def overflow(fps: np.ndarray, cell: int, piece: int) -> pa.RecordBatch:
        n = len(fps)
        return pa.RecordBatch.from_arrays([pa.array(fps.view(np.int64)), pa.nulls(n, pa.int64()),
                                           pa.array(np.full(n, cell)), pa.array(np.full(n, piece))],
                                          names=["u", "v", "cell", "piece"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, held_cell, piece = np.empty(0, np.uint64), None, 0

        def close() -> list:
            if piece:
                return []
            return [(m, np.full(len(m), r)) for m, r in stars(held, max_bits)]

        for batch in batches:
            if not batch.num_rows:
                continue
            cell = batch.column(0).to_numpy()
            fps = batch.column(1).to_numpy().view(np.uint64)
            cuts = np.concatenate(([0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]))
            sizes = np.diff(cuts)
            found: list = []
            for g in np.flatnonzero((sizes > 1) | (np.arange(len(sizes)) == 0) | (np.arange(len(sizes)) == len(sizes) - 1)):
                part, own = fps[cuts[g]:cuts[g + 1]], cell[cuts[g]]
                if own == held_cell:
                    held = np.concatenate([held, part])
                else:
                    found += close()
                    if piece and len(held):
                        yield overflow(held, held_cell, piece)
                    held, held_cell, piece = part, own, 0
                while len(held) > cell_rows:
                    yield overflow(held[:cell_rows], held_cell, piece)
                    held, piece = held[cell_rows:], piece + 1
            yield links(found)
        yield links(close())
        if piece and len(held):
            yield overflow(held, held_cell, piece)

    return run


def near_links(spark: SparkSession, fps: DataFrame, max_bits: int = MAX_BITS, blocks: int | None = None,
               cell_rows: int = CELL_ROWS) -> DataFrame:
    """``u, v``: stars that connect all of the distinct fingerprints ``fp`` within ``max_bits`` of each other."""
    masks = subspace_masks(blocks or 2 * max_bits, max_bits) if max_bits else [-1]
    cells = fps.select("fp", embedding(F.col("fp")).alias("e")).select(
        "fp", F.explode(F.array(*(F.xxhash64(F.lit(i), F.col("e").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)))).alias("cell"))
    # Cells are told apart by a 64-bit hash: two that fall together are merely checked together.
    linked = staged(spark, cells.repartition("cell").sortWithinPartitions("cell").select("cell", "fp")
                    .mapInArrow(_link_cells(max_bits, cell_rows), _LINKS), "simhash-links")
    edges = linked.filter("v IS NOT NULL").select("u", "v")
    pieces = linked.filter("piece IS NOT NULL").select(F.col("u").alias("fp"), "cell", "piece")
    if pieces.isEmpty():
        return edges

    def meet(pdf: pd.DataFrame) -> pd.DataFrame:
        found = list(stars(pdf.fp.to_numpy().view(np.uint64), max_bits))
        return pd.DataFrame({"u": np.concatenate([m for m, _ in found] or [np.empty(0, np.uint64)]).view(np.int64),
                             "v": np.concatenate([np.full(len(m), r) for m, r in found] or [np.empty(0, np.uint64)]).view(np.int64)})

    counts = pieces.groupBy("cell").agg((F.max("piece") + 1).alias("n"))
    met = (pieces.join(counts, "cell").withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
           .groupBy("cell", F.least("piece", "other").alias("a"), F.greatest("piece", "other").alias("b"))
           .applyInPandas(lambda pdf: meet(pdf), "u long, v long"))
    return edges.unionByName(met)


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    cell_rows: int = CELL_ROWS) -> DataFrame:
    """``doc_id, fingerprint, component_id, k, x, root`` per document (``root``: the component's smallest fingerprint)."""
    prints = staged(spark, fingerprints(docs, shingle), "simhash-prints")
    n = prints.count()
    first = staged(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-first", n)
    nodes = connected_components(spark, near_links(spark, first, max_bits, cell_rows=cell_rows))
    roots = first.join(nodes, first.fp == nodes.node, "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = roots.groupBy("root").agg(F.min("first").alias("component_id"))
    named = staged(spark, roots.join(least, "root").select("fp", "root", "component_id"), "simhash-named", n)
    # Both sides come from a shuffle of their own, so a fingerprint with a third of the documents can be split.
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id", "k", "x", "root")


__all__ = ["SHINGLE", "MAX_BITS", "fingerprint", "fingerprints", "embedding", "subspace_masks", "stars", "near_links",
           "near_duplicates"]
