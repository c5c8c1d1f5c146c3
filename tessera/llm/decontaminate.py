"""Benchmark decontamination with one Aho-Corasick automaton.

Benchmark items and documents are normalised alike: A-Z lower-cased, every other run of
ASCII characters that are neither letters nor digits becomes one space.  Each window of
``window`` consecutive item words (a shorter item is one window) is a pattern of a single
automaton; each document is scanned once, and every occurrence is mapped back to word
numbers and to character offsets of the original text.

The automaton goes to the tasks only while its patterns stay under ``max_pattern_bytes``
(a benchmark suite is small: a few hundred bytes an item).  Larger suites are cut into
that many blocks of items; the text is then scanned once per block and the hits are
combined, so the result does not depend on the bound.

Defined cases: NULL text has no words; NULL item text has no windows; a NULL item id marks
words but is not listed; items with one id count once; a document of no words is clean;
empty tables give empty or all-clean results; repeated rows are judged one by one; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import staged

WINDOW = 13
MAX_PATTERN_BYTES = 64 << 20
HIT_SHARE = 20  # contaminated if HIT_SHARE * n_hit >= n_words
_SLICE_ROWS = 1000


def _normaliser() -> bytes:
    """A translation table: letters lower-cased, digits and bytes beyond ASCII kept, the rest a space."""
    table = bytearray(b" " * 128 + bytes(range(128, 256)))
    for c in b"0123456789abcdefghijklmnopqrstuvwxyz":
        table[c] = c
    for c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
        table[c] = c + 32
    return bytes(table)


_TABLE = _normaliser()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


def windows_of(text: str | None, window: int) -> set[bytes]:
    """The item's windows as patterns: words between single spaces, with a space at both ends."""
    words = words_of(text)
    if not words:
        return set()
    return {b" " + b" ".join(words[i:i + window]) + b" " for i in range(max(1, len(words) - window + 1))}


def build_automaton(items: list[tuple[object, str | None]], window: int) -> ahocorasick.Automaton | None:
    """An automaton over all windows; the value of a pattern is (number of words, characters, item ids)."""
    owners: dict[bytes, set[str]] = {}
    for item_id, text in items:
        for w in windows_of(text, window):
            owners.setdefault(w, set()).update([] if item_id is None else [str(item_id)])
    if not owners:
        return None
    automaton = ahocorasick.Automaton()
    for w, ids in owners.items():
        # latin-1 maps each byte to one character, so automaton offsets are byte offsets.
        automaton.add_word(w.decode("latin-1"), (w.count(b" ") - 1, len(w), tuple(sorted(ids))))
    automaton.make_automaton()
    return automaton


def scan(automaton: ahocorasick.Automaton, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
    """Merged ranges of hit words, and the ids of the items with occurring windows."""
    joined = b" " + b" ".join(words) + b" "
    ids: set[str] = set()
    spans: list[tuple[int, int]] = []
    counted, space = 0, 0  # spaces before `counted`
    for end, (n_words, length, owners) in automaton.iter(joined.decode("latin-1")):
        start = end - length + 1
        if start >= counted:
            space += joined.count(b" ", counted, start)
            counted = start
            first = space
        else:
            first = space - joined.count(b" ", start, counted)
        spans.append((first, first + n_words))
        ids.update(owners)
    spans.sort()
    merged: list[tuple[int, int]] = []
    for a, b in spans:
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged, ids


def original_offsets(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character ranges of the original text for ranges of its words."""
    if not spans:
        return []
    raw = text.encode()
    flat = np.frombuffer(raw.translate(_TABLE), dtype=np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate(([False], flat, [False])).astype(np.int8)))
    starts, ends = edges[::2], edges[1::2]
    char_at = np.concatenate(([0], np.cumsum((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80)))
    return [(int(char_at[starts[a]]), int(char_at[ends[b - 1]])) for a, b in spans]


_HITS = ("n_words long, word_spans array<struct<first:long,last:long>>, "
         "spans array<struct<start:long,end:long>>, items array<string>")


def find_passages(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  max_pattern_bytes: int = MAX_PATTERN_BYTES, keep: tuple[str, ...] = ("doc_id",),
                  text_col: str = "text") -> DataFrame:
    """``keep`` columns, ``n_words``, ranges of hit words and of original characters, and item ids, per document."""
    items = benchmark.select("item_id", "text")
    # A window of each item word repeats up to `window` words: the patterns' size is proven before any broadcast.
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n * window
    blocks = max(1, -(-size // max_pattern_bytes))
    out = docs.select(*keep, F.col(text_col).alias("__text"))
    if blocks == 1:
        return _scan_block(spark, out, items, window, keep)
    numbered = docs.select(*keep, F.col(text_col).alias("__text"), F.monotonically_increasing_id().alias("__row"))
    numbered = staged(spark, numbered, "decontaminate-docs")
    parts = [_scan_block(spark, numbered.select(*keep, "__row", "__text"),
                         items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b), window, (*keep, "__row"))
             for b in range(blocks)]
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p)
    return (merged.groupBy("__row").agg(
        *(F.first(c).alias(c) for c in keep), F.max("n_words").alias("n_words"),
        F.flatten(F.collect_list("word_spans")).alias("word_spans"), F.flatten(F.collect_list("spans")).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items")).drop("__row"))


def _scan_block(spark: SparkSession, docs: DataFrame, items: DataFrame, window: int, keep: tuple[str, ...]) -> DataFrame:
    automaton = build_automaton([(r.item_id, r.text) for r in items.collect()], window)
    shared = spark.sparkContext.broadcast(automaton)
    n_keep = len(keep)
    spans_type = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))
    chars_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = shared.value
        for whole in batches:
            for at in range(0, whole.num_rows, _SLICE_ROWS):
                batch = whole.slice(at, _SLICE_ROWS)
                n_words, word_spans, spans, ids = [], [], [], []
                for text in batch.column(n_keep).to_pylist():
                    words = words_of(text)
                    hit, owners = scan(automaton, words) if automaton is not None and words else ([], set())
                    n_words.append(len(words))
                    word_spans.append([{"first": a, "last": b} for a, b in hit])
                    spans.append([{"start": a, "end": b} for a, b in original_offsets(text or "", hit)])
                    ids.append(sorted(owners))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(i) for i in range(n_keep)]
                    + [pa.array(n_words, pa.int64()), pa.array(word_spans, spans_type), pa.array(spans, chars_type),
                       pa.array(ids, pa.list_(pa.string()))],
                    names=[*keep, "n_words", "word_spans", "spans", "items"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields[:n_keep])
    return docs.mapInArrow(run, f"{fields}, {_HITS}")


def judged(found: DataFrame) -> DataFrame:
    """Adds ``n_hit`` (words in any hit range, each once), ``n_items``, ``items_sha256`` and ``contaminated``."""
    # Ranges of different blocks may overlap: sum what each adds beyond the ones before it.
    ordered = F.array_sort("word_spans")
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end"))
    n_hit = F.aggregate(
        ordered, zero,
        lambda acc, s: F.struct(
            (acc["n"] + F.greatest(F.lit(0), s["last"] - F.greatest(s["first"], acc["end"]))).cast("long").alias("n"),
            F.greatest(acc["end"], s["last"]).cast("long").alias("end")), lambda acc: acc["n"])
    return (found.withColumn("n_hit", n_hit)
            .withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items").cast("binary"), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * HIT_SHARE >= F.col("n_words"))))


def contamination(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per document."""
    return judged(find_passages(spark, docs, benchmark, window)).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def oracle_sql(window: int = WINDOW) -> str:
    """DuckDB SQL for :func:`contamination`."""
    words = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
             "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row, doc_id, {words} AS w FROM documents),
    b AS (SELECT item_id, {words} AS w FROM benchmark),
    win AS (SELECT DISTINCT item_id, least(len(w), {window}) AS n,
                   array_to_string(w[i:i + least(len(w), {window}) - 1], ' ') AS g
            FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {window} + 1, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
    sizes AS (SELECT DISTINCT n FROM win),
    grams AS (SELECT row, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
              FROM (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
    hits AS (SELECT grams.row, i, grams.n, item_id FROM grams JOIN win ON grams.n = win.n AND grams.g = win.g),
    covered AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM hits) GROUP BY row),
    items AS (SELECT row, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
              FROM (SELECT DISTINCT row, CAST(item_id AS VARCHAR) AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY row)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
           CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND {HIT_SHARE} * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM d LEFT JOIN covered USING (row) LEFT JOIN items USING (row)"""


__all__ = ["WINDOW", "words_of", "windows_of", "build_automaton", "scan", "original_offsets", "find_passages",
           "judged", "contamination", "oracle_sql"]
