"""Byte-level BPE encoding and decoding with a transducer lexicon.

Two passes over the texts.  The first counts the space-led words of all documents and
keeps those that make up at least ``1 / lexicon_words`` of them (the only thing the driver
collects: a bounded list).  They are encoded once and compiled into a minimal acyclic transducer whose
outputs are their token ids; tasks memory-map it.  The second pass cuts each text by the
vocabulary's pattern, looks each new word of a group of texts up in the transducer, and merges
the words that it does not hold by the vocabulary's merge ranks, exactly and in one batch.

Defined cases: NULL text counts as empty (no ids, empty decoded text); the special
token's text inside a document becomes its id; repeated rows give repeated results; an
empty table gives an empty result; other columns are ignored unless named in ``keep``.
"""

from __future__ import annotations

import heapq
import json
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import by_bytes, hand_back, staged
from tessera.llm.transducer import Transducer, compile_words

LEXICON_WORDS = 1 << 17
# Fixed value: the pre-tokenizer's pattern, as the vocabulary's file names it (byte level, use_regex).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_COUNT_BYTES = 24 << 20
_MEMO_BYTES = 48 << 20
_ENTRY_BYTES = 200  # of a dictionary's entry, beside its key's and value's own bytes
_SLICE_BYTES = 2 << 20
_SHIFT = 20
_MASK = (1 << _SHIFT) - 1
_NO_MERGE = 1 << 2 * _SHIFT + 1
_LONG_TOKEN = 64
_MERGE_ROWS = 4096
_GROUP_CHARS = 1_500_000


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


@dataclass
class Vocabulary:
    """Ids of the bytes, merges, the bytes of each id, special tokens.

    ``merges`` maps ``left << _SHIFT | right`` to ``rank << _SHIFT | id``: plain integers compare by rank.
    """

    byte_ids: list[int]
    merges: dict[int, int]
    pieces: list[bytes]
    special: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab = spec["model"]["vocab"]
        alphabet = byte_alphabet()
        back = {c: b for b, c in enumerate(alphabet)}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        pieces = [b""] * (1 + max([*vocab.values(), *special.values()]))
        for token, i in vocab.items():
            pieces[i] = bytes(back[c] for c in token)
        for token, i in special.items():
            pieces[i] = token.encode()
        merges = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            merges[vocab[left] << _SHIFT | vocab[right]] = rank << _SHIFT | vocab[left + right]
        return cls([vocab[c] for c in alphabet], merges, pieces, special)


class MergeTable:
    """Batch merging: the ranks of many pairs at once, from an open-addressing table of the merges."""

    def __init__(self, merges: dict[int, int]):
        bits = max(10, (8 * max(1, len(merges))).bit_length())
        self._shift, self._mask = np.uint64(64 - bits), (1 << bits) - 1
        self._keys = np.full(1 << bits, -1, dtype=np.int64)
        self._values = np.full(1 << bits, _NO_MERGE, dtype=np.int64)
        keys = np.fromiter(merges.keys(), dtype=np.int64, count=len(merges))
        values = np.fromiter(merges.values(), dtype=np.int64, count=len(merges))
        slot = self._slot(keys)
        while len(keys):
            free = self._keys[slot] == -1
            _, first = np.unique(np.where(free, slot, -1 - np.arange(len(slot))), return_index=True)
            first = first[free[first]]
            self._keys[slot[first]], self._values[slot[first]] = keys[first], values[first]
            rest = np.ones(len(keys), dtype=bool)
            rest[first] = False
            keys, values, slot = keys[rest], values[rest], (slot[rest] + 1) & self._mask

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """``rank << _SHIFT | id`` of each pair, or ``_NO_MERGE``."""
        keys = (left << _SHIFT | right).ravel()
        slot = self._slot(keys)
        held = self._keys[slot]
        out = np.where(held == keys, self._values[slot], _NO_MERGE)
        open_ = np.flatnonzero((held != keys) & (held != -1))
        while len(open_):
            slot[open_] = (slot[open_] + 1) & self._mask
            held = self._keys[slot[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self._values[slot[open_[hit]]]
            open_ = open_[~hit & (held != -1)]
        return out.reshape(left.shape)

    def merge(self, ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Merge rows of byte ids to the end: (row numbers, ids) of the rows that end with one length.

        Every row still open merges its lowest-ranked pair, leftmost first, once a round, so
        open rows stay of one length.
        """
        rows, done = np.arange(len(ids)), []
        ranks = self.find(ids[:, :-1], ids[:, 1:])
        while ids.shape[1] > 1 and len(rows):
            at = ranks.argmin(axis=1)
            best = ranks[np.arange(len(rows)), at]
            closed = best == _NO_MERGE
            if closed.any():
                done.append((rows[closed], ids[closed]))
                rows, ids, ranks, at, best = (x[~closed] for x in (rows, ids, ranks, at, best))
            n, width = ids.shape
            line, cols = np.arange(n), np.arange(width - 1)
            ids[line, at] = best & _MASK
            ids = ids[line[:, None], cols + (cols > at[:, None])]
            cols = np.arange(width - 2)
            ranks = ranks[line[:, None], cols + (cols >= at[:, None])]
            left, right = np.flatnonzero(at > 0), np.flatnonzero(at < width - 2)
            ranks[left, at[left] - 1] = self.find(ids[left, at[left] - 1], ids[left, at[left]])
            ranks[right, at[right]] = self.find(ids[right, at[right]], ids[right, at[right] + 1])
        return [*done, (rows, ids)]


class Encoder:
    """Encodes texts with a vocabulary; a transducer answers for the words it holds."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Transducer | None = None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.pattern = regex.compile(PATTERN)
        self.specials = regex.compile("|".join(map(regex.escape, vocabulary.special)) or r"(?!)")
        self._table = MergeTable(vocabulary.merges)
        self._byte_ids = np.array(vocabulary.byte_ids, dtype=np.int64)
        self._tokens: dict[str, bytes] = {}
        self._memo_bytes = 0

    def forget(self) -> None:
        """Empty the memo of pre-tokens."""
        self._tokens, self._memo_bytes = {}, 0

    def merge(self, tokens: list[str]) -> list[bytes]:
        """Ids (little-endian unsigned 32 bit) of pre-tokens, merged exactly."""
        out: list[bytes] = [b""] * len(tokens)
        raw = [t.encode() for t in tokens]
        by_length: dict[int, list[int]] = {}
        for i, r in enumerate(raw):
            by_length.setdefault(len(r), []).append(i)
        for length, members in by_length.items():
            if length > _LONG_TOKEN:
                for i in members:
                    out[i] = self._merge_long([self.vocabulary.byte_ids[b] for b in raw[i]])
                continue
            for at in range(0, len(members), _MERGE_ROWS):
                part = members[at:at + _MERGE_ROWS]
                flat = np.frombuffer(b"".join([raw[i] for i in part]), dtype=np.uint8)
                for rows, ids in self._table.merge(self._byte_ids[flat].reshape(len(part), length)):
                    packed, width = ids.astype("<u4").tobytes(), 4 * ids.shape[1]
                    for k, row in enumerate(rows.tolist()):
                        out[part[row]] = packed[k * width:(k + 1) * width]
        return out

    def _merge_long(self, ids: list[int]) -> bytes:
        """The same merges over a linked list with a heap, for very long pre-tokens."""
        find = self.vocabulary.merges.get
        after = list(range(1, len(ids))) + [-1]
        before = [-1, *range(len(ids) - 1)]
        heap = [(m >> _SHIFT, i, ids[i], ids[i + 1], m & _MASK) for i in range(len(ids) - 1)
                if (m := find(ids[i] << _SHIFT | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, left, right, new = heapq.heappop(heap)
            j = after[i] if ids[i] == left else -1
            if j < 0 or ids[j] != right:
                continue
            ids[i], ids[j] = new, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (m := find(ids[a] << _SHIFT | ids[b])) is not None:
                    heapq.heappush(heap, (m >> _SHIFT, a, ids[a], ids[b], m & _MASK))
        return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()

    def _learn(self, tokens: list[str]) -> None:
        """Put the ids of new pre-tokens into the memo: from the lexicon, or merged."""
        memo, unseen = self._tokens, tokens
        self._memo_bytes += _ENTRY_BYTES * len(tokens) + 4 * sum(map(len, tokens))
        if self.lexicon is not None:
            words = [t for t in tokens if t[0] == " "]
            found = dict(zip(words, self.lexicon.get_all([w[1:].encode() for w in words])))
            memo.update((w, ids) for w, ids in found.items() if ids is not None)
            unseen = [t for t in tokens if found.get(t) is None]
        memo.update(zip(unseen, self.merge(unseen)))

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        special = {t: np.uint32(i).tobytes() for t, i in self.vocabulary.special.items()}
        out: list[bytes] = []
        held: list[list] = []  # texts as lists of pre-tokens and names of special tokens
        size = 0

        def close() -> None:
            nonlocal held, size
            new = set().union(*(part for line in held for part in line if isinstance(part, list)))
            if self._memo_bytes > _MEMO_BYTES:
                self.forget()
            memo = self._tokens
            self._learn([t for t in new if t not in memo])
            for line in held:
                out.append(b"".join([b"".join(map(memo.__getitem__, part)) if isinstance(part, list) else special[part]
                                     for part in line]))
            held, size = [], 0

        for text in texts:
            line, at = [], 0
            for m in self.specials.finditer(text):
                line += [self.pattern.findall(text[at:m.start()]), m.group()]
                at = m.end()
            line.append(self.pattern.findall(text[at:]))
            held.append(line)
            size += len(text)
            if size >= _GROUP_CHARS:
                close()
        close()
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def decode(self, ids: bytes) -> str:
        pieces = self.vocabulary.pieces
        return b"".join([pieces[i] for i in np.frombuffer(ids, dtype="<u4").tolist()]).decode("utf-8", "replace")


def count_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``word, n``: how often each space-led word occurs in all texts."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                             names=["word", "n"])
            counts.clear()
            return out

        counts: Counter[str] = Counter()
        held = 0
        for whole in batches:
            for batch in by_bytes(whole, 0, _SLICE_BYTES):
                before = len(counts)
                for text in batch.column(0):
                    if text.is_valid:
                        counts.update(text.as_py().split(" ")[1:])
                # New words take no more than the batch's bytes, beside their entries.
                held += _ENTRY_BYTES * (len(counts) - before) + (batch.column(0).nbytes if len(counts) > before else 0)
                if held > _COUNT_BYTES:
                    yield flush()
                    held = 0
        yield flush()
        hand_back()

    return (docs.select(F.col(text_col)).mapInArrow(count, "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def frequent_words(spark: SparkSession, docs: DataFrame, size: int = LEXICON_WORDS, text_col: str = "text") -> list[str]:
    """The words that make up at least ``1 / size`` of all occurrences of repeated words.

    There are at most ``size`` of them, whatever the input; beyond 64 bytes a word is left
    out, which bounds the list's bytes too.
    """
    counts = staged(spark, count_words(docs, text_col).filter((F.col("n") > 1) & (F.octet_length("word") <= 64)), "bpe-words")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return [r.word for r in counts.filter(F.col("n") * size >= total).orderBy("word").collect()]


def build_lexicon(vocabulary: Vocabulary, words: list[str]) -> bytes:
    """The transducer of the words with their ids (of a space and the word) as outputs."""
    plain = Encoder(vocabulary)
    words = [w for w in words if len(plain.pattern.findall(" " + w)) == 1]
    return compile_words(dict(zip([w.encode() for w in words], plain.encode_all([" " + w for w in words]))))


def encoder_factory(spark: SparkSession, vocabulary: Vocabulary, blob: bytes) -> Callable[[], Encoder]:
    """A function that tasks call for their encoder; each Python worker builds it once."""
    shared = spark.sparkContext.broadcast((vocabulary, blob))
    return lambda: _worker_encoder(shared)


_WORKER: dict[int, Encoder] = {}


def _worker_encoder(shared) -> Encoder:
    key = shared._jbroadcast.id() if getattr(shared, "_jbroadcast", None) else id(shared.value)
    if key not in _WORKER:
        _WORKER.clear()
        vocabulary, blob = shared.value
        _WORKER[key] = Encoder(vocabulary, Transducer(blob))
    return _WORKER[key]


def encode(spark: SparkSession, docs: DataFrame, tokenizer_path: str, lexicon_words: int = LEXICON_WORDS,
           text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), decode: bool = True) -> DataFrame:
    """``keep`` columns, ``ids`` (little-endian unsigned 32 bit) and, with ``decode``, the text ``decoded`` from them."""
    vocabulary = Vocabulary.load(tokenizer_path)
    blob = build_lexicon(vocabulary, frequent_words(spark, docs, lexicon_words, text_col))
    make = encoder_factory(spark, vocabulary, blob)
    source = docs.select(*keep, F.col(text_col).alias("__text"))
    n_keep = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hand_back()  # what earlier stages left in this worker
        encoder = make()
        for whole in batches:
            for batch in by_bytes(whole, n_keep, _SLICE_BYTES):
                ids = encoder.encode_all([t or "" for t in batch.column(n_keep).to_pylist()])
                columns = [batch.column(i) for i in range(n_keep)] + [pa.array(ids, pa.binary())]
                if decode:
                    columns.append(pa.array([encoder.decode(i) for i in ids], pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "ids", "decoded"][:len(columns)])
        encoder.forget()
        hand_back()

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[:n_keep]]
    return source.mapInArrow(run, ", ".join(fields + ["ids binary"] + ["decoded string"] * decode))


def digests(encoded: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of an encoded table, and the columns of ``keep``."""
    return encoded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), *keep)


__all__ = ["LEXICON_WORDS", "PATTERN", "byte_alphabet", "Vocabulary", "Encoder", "count_words", "frequent_words",
           "build_lexicon", "encoder_factory", "encode", "digests"]
