"""Toxicity scores of text restored by a noisy-channel decoder.

1. A character trigram model is counted over all documents.
2. Obfuscated words (look-alike digits and signs, letters set apart, stretched letters)
   become lattices: each place holds the letters it may stand for, or none; a separator of
   letters set apart is nothing or a word boundary.  The Viterbi path under the trigram
   model and the channel's costs is the restored word.
3. Terms (whole words and word stems) that mark toxic documents are learned from a bounded
   sample of labelled training rows: held by toxic documents and rare in clean ones.  The
   near copies of a document count as one document, in either class.
4. A document's score is a logistic function of the weights of the terms in its restored text.

Only ``labels`` rows of the training folds are read; the score's only input is the text.

Defined cases: NULL and empty texts get the score of a text without terms; NULL labels are
ignored; an id labelled both ways is ignored; without toxic training rows every score is
the smoothed base rate; repeated rows are scored one by one; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fold, staged
from tessera.llm.simhash import near_duplicates

FOLDS = 5
MAX_TOXIC_ROWS = 40_000   # bound of the labelled sample, by class
MAX_CLEAN_ROWS = 80_000
MIN_DOCS = 3              # toxic training documents that hold a term, near copies counted once
MIN_LOG_ODDS = 2.5
STEMS = (4, 5, 6, 7)  # lengths of word beginnings that count as terms
SYMBOLS = 28              # a-z, other letters, boundary
_EDGE, _OTHER = 0, 27

# Letters that digits and signs commonly stand for.
LOOKALIKES = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
              "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l"}
_SWAP_COST = 1.0      # a sign stands for a letter
_DROP_COST = 12.0     # a sign stands for nothing
_EDGE_DROP_COST = 8.0
_JOIN_COST = 4.0      # a wide separator of letters set apart stands for nothing
_SHRINK_COST = 0.5    # a stretched run stands for one or two letters
_JOINTS = "+|(!"      # signs that may also join words
_LONG = 40            # longer mixed tokens may be addresses: their own words count beside the reading
_READINGS, _MARGIN = 12, 8.0  # of letters set apart: how many, and how much dearer than the cheapest
_TAIL_READINGS = 4
_COST = itemgetter(0)
_MEMO_LONGEST = 200
_SIGNS = re.escape("".join(LOOKALIKES))
_MEMBER = rf"(?:[^\W\d_]|[{_SIGNS}])"
_SEPARATOR = rf"(?:[^\w{_SIGNS}]|_)"
_SETS = re.compile(rf"(?<![^\W_]){_MEMBER}(?:{_SEPARATOR}{{1,3}}{_MEMBER}){{2,}}(?![^\W_])")
_MEMBERS = re.compile(_MEMBER)
# Each run of letters and signs is tried once, from its beginning: a long run without a sign costs its length.
_TOKEN = re.compile(rf"(?<![a-z{_SIGNS}])[a-z]*+[{_SIGNS}][a-z{_SIGNS}]*+")
_MIXED = re.compile(rf"[{_SIGNS}][a-z]|[a-z](?:[013-9]+|[@$€£]{{1,2}})$")
# Signs after the last letter are punctuation or decoration, unless they are digits ("foo0") or one or two that look like letters ("a$$").
_TAIL = re.compile(rf"(?<![{_SIGNS}])[{_SIGNS}]+$")
_TAIL_READ = re.compile(r"[013-9]+|[@$€£]{1,2}(?![@$€£])")
_WORD = re.compile(r"[^\W\d_]++")
_TRIPLE = re.compile(r"([a-z])\1\1")
_SLICE_ROWS = 1000


def _symbol_table() -> np.ndarray:
    table = np.zeros(256, dtype=np.int32)
    for i, c in enumerate(b"abcdefghijklmnopqrstuvwxyz"):
        table[c] = table[c - 32] = i + 1
    table[128:] = _OTHER
    return table


_TABLE = _symbol_table()


def _kind_table() -> np.ndarray:
    """Bits by code point (the last stands for all beyond): 1 for letters, 2 for signs that stand for letters, 4 for digits."""
    table = np.array([1 if (c := chr(i)).isalpha() else 4 if c.isalnum() else 0 for i in range(1 << 16)] + [1], dtype=np.uint8)
    for c in LOOKALIKES:
        table[ord(c)] |= 2
    return table


_KINDS = _kind_table()
_LETTERS_ONLY = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def suspicious(text: str) -> tuple[bool, bool, bool]:
    """Whether the text may hold letters set apart, signs beside letters, stretched letters."""
    if len(text) < 3:
        return False, False, False
    if text.isascii():
        c = np.frombuffer(text.encode(), dtype=np.uint8)
        kind = _KINDS[c]
    else:
        c = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        kind = _KINDS[np.minimum(c, 1 << 16)]
    letter, sign = (kind & 1).view(bool), (kind & 2) != 0
    same = (c[1:] == c[:-1]) & letter[1:]
    mixed = (sign[:-1] & letter[1:]).any() or (letter[:-1] & sign[1:]).any()
    # Members of a run have no letter or digit beside them, and one to three other characters between them.
    solid = (kind & 5) != 0
    member = letter | sign
    member[1:] &= ~solid[:-1]
    member[:-1] &= ~solid[1:]
    alone = np.flatnonzero(member)
    apart = False
    if len(alone) > 2:
        gap = np.diff(alone)
        near, with_letter = (gap > 1) & (gap <= 4), letter[alone]
        apart = (near[1:] & near[:-1] & (with_letter[:-2] | with_letter[1:-1] | with_letter[2:])).any()
    return bool(apart), bool(mixed), bool((same[1:] & same[:-1]).any())


def trigram_counts(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Counts of character trigrams over all texts: each task adds up its own table, Spark adds the tables."""
    cells = SYMBOLS ** 3

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(cells, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                raw = np.frombuffer((text.as_py() or "").encode(), dtype=np.uint8)
                for at in range(0, len(raw), 1 << 20):
                    c = _TABLE[raw[max(0, at - 2):at + (1 << 20)]]
                    if len(c) > 2:
                        total += np.bincount(c[:-2] * (SYMBOLS * SYMBOLS) + c[1:-1] * SYMBOLS + c[2:], minlength=cells)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], names=["cell", "n"])

    out = np.zeros(cells)
    for r in docs.select(text_col).mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n  # at most SYMBOLS ** 3 rows
    return out.reshape((SYMBOLS,) * 3)


def trigram_costs(counts: np.ndarray) -> np.ndarray:
    """Negative log probabilities of the third symbol, smoothed towards the bigram and the unigram model."""
    pair, one = counts.sum(axis=0), counts.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SYMBOLS)
    p2 = (pair + 5 * p1) / (pair.sum(axis=1, keepdims=True) + 5)
    p3 = (counts + 5 * p2[None]) / (counts.sum(axis=2, keepdims=True) + 5)
    return -np.log(p3)


@dataclass
class Decoder:
    """Viterbi decoding of character lattices under the trigram costs."""

    costs: np.ndarray
    memo: dict[str, str] = field(default_factory=dict)

    def lattice(self, token: str) -> list[list[tuple[str, float]]]:
        """For each place of the token: what it may stand for and at which cost."""
        places = []
        i = 0
        while i < len(token):
            run = i + 1
            while run < len(token) and token[run] == token[i]:
                run += 1
            c = token[i]
            if c in LOOKALIKES:
                drop = _EDGE_DROP_COST if i == 0 or run == len(token) else _DROP_COST
                options = [(letter, _SWAP_COST) for letter in LOOKALIKES[c]] + [("", drop)]
                places += [options] * (run - i if run - i < 3 else 1)
            elif run - i >= 3:
                places.append([(c, _SHRINK_COST), (c + c, _SHRINK_COST)])
            else:
                places += [[(c, 0.0)]] * (run - i)
            i = run
        return places

    def spaced(self, run: str) -> list[list[tuple[str, float]]]:
        """The lattice of letters set apart: a separator is nothing or a boundary, one wider than the narrowest rather a boundary."""
        members = [m.start() for m in _MEMBERS.finditer(run)]
        narrow = min(b - a for a, b in zip(members, members[1:]))
        places = []
        for at, after in zip(members, [*members[1:], None]):
            places += self.lattice(run[at])
            if after is not None:
                places.append([("", _JOIN_COST if after - at > narrow else 0.0), (" ", 0.0)])
        return places

    def readings(self, places: list[list[tuple[str, float]]], n: int = 1) -> list[str]:
        """The lattice's cheapest readings: ``n`` at most, none dearer than the first by more than ``_MARGIN``."""
        # A path is a chain of (path before, letters).
        states: dict[tuple[int, int], list[tuple[float, tuple | None]]] = {(_EDGE, _EDGE): [(0.0, None)]}
        for options in [*places, [(" ", 0.0)]]:
            after: dict[tuple[int, int], list[tuple[float, tuple | None]]] = {}
            for (a, b), ways in states.items():
                for letters, extra in options:
                    x, y, more = a, b, extra
                    for c in letters:
                        z = _EDGE if c == " " else ord(c) - 96 if "a" <= c <= "z" else _OTHER
                        more += self.costs[x, y, z]
                        x, y = y, z
                    after.setdefault((x, y), []).extend((cost + more, (path, letters)) for cost, path in ways)
            states = {k: v if len(v) <= n else heapq.nsmallest(n, v, key=_COST) for k, v in after.items()}
        ends = heapq.nsmallest(n, (way for ways in states.values() for way in ways), key=_COST)
        out = []
        for cost, path in ends:
            if cost <= ends[0][0] + _MARGIN:
                letters = []
                while path is not None:
                    letters.append(path[1])
                    path = path[0]
                out.append("".join(reversed(letters)).strip())
        return out

    def decode(self, token: str) -> str:
        """The token's cheapest reading."""
        return self._remembered(token, lambda: self.readings(self.lattice(token))[0])

    def _remembered(self, token: str, read: Callable[[], str]) -> str:
        best = self.memo.get(token)
        if best is None:
            best = read()
            if len(self.memo) > 100_000:
                self.memo.clear()
            if len(token) <= _MEMO_LONGEST:
                self.memo[token] = best
        return best

    def _apart(self, match: re.Match) -> str:
        """The words of the run's likely readings: boundaries are doubtful under trigrams, so not only of the first."""
        run = match.group()
        members = "".join(_MEMBERS.findall(run))
        if sum(c not in LOOKALIKES for c in members) < 2:
            return run
        found = self._remembered(run, lambda: " ".join(self.readings(self.spaced(run), _READINGS)))
        return f" {' '.join(dict.fromkeys([self.decode(members), *found.split()]))} "

    def _mixed(self, match: re.Match) -> str:
        token = match.group()
        tail = _TAIL.search(token)
        read = _TAIL_READ.match(tail.group()) if tail else None
        body = token if tail is None else token[:tail.start() + (read.end() if read else 0)]
        if len(body) < 3 or not _MIXED.search(body):
            return token
        # A tail may be a number or decoration after all, and a long token an address.
        found = [self.decode(body)]
        if read is not None:
            found += self._remembered(body + " ", lambda: " ".join(self.readings(self.lattice(body), _TAIL_READINGS))).split()
        for sign in _JOINTS:
            if sign in body[1:-1]:
                found += [self.decode(part) if len(part) > 2 and _MIXED.search(part) else part for part in body.split(sign)]
        if len(found) > 1 or len(body) > _LONG:
            return f" {' '.join(dict.fromkeys(found))} {token}"
        return found[0] + token[len(body):]

    def _stretched(self, match: re.Match) -> str:
        word = match.group()
        return self.decode(word) if _TRIPLE.search(word) and word.isascii() else word

    def restore(self, text: str) -> str:
        """The lower-cased text with its obfuscated words replaced by their readings."""
        text = text.lower()
        apart, mixed, stretched = suspicious(text)
        if apart:
            text = _SETS.sub(self._apart, text)
        if mixed:
            text = _TOKEN.sub(self._mixed, text)
        if stretched:
            text = _WORD.sub(self._stretched, text)
        return text


def words_of(decoder: Decoder, text: str | None) -> list[str]:
    """The words (runs of letters) of the restored text."""
    return decoder.restore(text or "").encode().translate(_LETTERS_ONLY).decode().split()


def terms_of(word: str) -> list[str]:
    """The word, and its stems (marked by a star)."""
    return [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]


@dataclass
class Model:
    """Decoder, term weights, and the logistic layer over (largest weight, log of the sum)."""

    decoder: Decoder
    weights: dict[str, float]
    layer: tuple[float, float, float]

    def features(self, text: str | None) -> tuple[float, float]:
        """The largest weight, and the log of the sum, of the terms in the restored text."""
        weights = self.weights
        if not weights:
            return 0.0, 0.0
        words = set(words_of(self.decoder, text))
        found = words & weights.keys()
        for n in STEMS:
            found |= {w[:n] + "*" for w in words if len(w) > n} & weights.keys()
        return max((weights[t] for t in found), default=0.0), math.log1p(sum(weights[t] for t in found))

    def score(self, text: str | None) -> float:
        best, total = self.features(text)
        b0, b1, b2 = self.layer
        z = b0 + b1 * best + b2 * total
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, training: Callable, toxic: bool, rows: int,
                    text_col: str = "text") -> DataFrame:
    """``text`` of at most ``rows`` training documents of one class (smallest id hashes first)."""
    ids = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & training("doc_id"))
           .groupBy("doc_id").agg(F.min(label).alias("lo"), F.max(label).alias("hi"))
           .filter((F.col("lo") == F.col("hi")) & (F.col("hi") == int(toxic)))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows).select(F.col("doc_id").cast("long").alias("id")))
    # At most `rows` ids: the sample's bound is the broadcast's bound.
    return (docs.select(F.col("doc_id").cast("long").alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(ids), "id").select("text"))


def with_shares(spark: SparkSession, rows: DataFrame, bound: int) -> DataFrame:
    """``text, toxic, share``: a row's share is 1 / (its class's rows among its near copies)."""
    x = F.xxhash64(F.coalesce("text", F.lit("")))
    found = near_duplicates(spark, rows.select(x.alias("doc_id"), "text"))
    roots = staged(spark, found.select("x", "root").distinct(), "labelled-roots", bound)
    # At most `bound` texts: the sample's bound is the broadcasts' bound.
    rooted = rows.withColumn("x", x).join(F.broadcast(roots), "x")
    sizes = rooted.groupBy("root", "toxic").agg((1.0 / F.count("*")).alias("share"))
    return rooted.join(F.broadcast(sizes), ["root", "toxic"]).select("text", "toxic", "share")


def _document_counts(sample: DataFrame, make: Callable[[], Decoder]) -> DataFrame:
    """``term, t, c``: shares of the toxic and the clean documents that hold each term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = make()
        counts: tuple[Counter[str], Counter[str]] = (Counter(), Counter())

        def flush() -> pa.RecordBatch:
            terms = [*counts[1].keys() | counts[0].keys()]
            out = pa.RecordBatch.from_arrays([pa.array(terms, pa.string())] +
                                             [pa.array([float(counts[k][t]) for t in terms], pa.float64()) for k in (1, 0)],
                                             names=["term", "t", "c"])
            for c in counts:
                c.clear()
            return out

        for batch in batches:
            for text, toxic, share in zip(*(batch.column(n).to_pylist() for n in ("text", "toxic", "share"))):
                # The empty term counts the documents.
                terms = {"", *(t for w in set(words_of(decoder, text)) for t in terms_of(w))}
                if share == 1:
                    counts[toxic].update(terms)
                else:
                    for t in terms:
                        counts[toxic][t] += share
            if len(counts[0]) + len(counts[1]) > 200_000:
                yield flush()
        yield flush()

    return sample.mapInArrow(run, "term string, t double, c double").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))


def fit_layer(x: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Weighted logistic regression by Newton steps (intercept first, not penalised)."""
    x = np.column_stack([np.ones(len(x)), x])
    b = np.zeros(x.shape[1])
    ridge = np.diag([1e-6] + [penalty] * (x.shape[1] - 1)) * weight.sum()
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge,
                               x.T @ (weight * (y - p)) - ridge @ b)
        b += np.clip(step, -5, 5)
    return b


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, training: Callable, label: str = "toxic",
          max_toxic: int = MAX_TOXIC_ROWS, max_clean: int = MAX_CLEAN_ROWS) -> Model:
    """The model from all texts (character model) and the labelled training rows (terms)."""
    costs = trigram_costs(trigram_counts(docs))
    decoder = Decoder(costs)
    shared = spark.sparkContext.broadcast(costs)
    make = lambda: Decoder(shared.value)
    rows = staged(spark, labelled_sample(docs, labels, label, training, True, max_toxic).distinct().coalesce(16)
                  .withColumn("toxic", F.lit(1))
                  .unionByName(labelled_sample(docs, labels, label, training, False, max_clean).withColumn("toxic", F.lit(0))),
                  "labelled-rows")
    toxic, clean = rows.filter("toxic = 1").select("text"), rows.filter("toxic = 0").select("text")

    counts = _document_counts(with_shares(spark, rows, max_toxic + max_clean), make)
    # Shares are added up in any order: a little less than a whole number is that number.
    found = staged(spark, counts.filter((F.col("t") > MIN_DOCS - 1e-6) | (F.col("term") == "")), "labelled-terms")
    whole = found.filter("term = ''").first()
    n_toxic, n_clean = (whole.t, whole.c) if whole else (0.0, 0.0)
    tried = found.filter("term != ''")
    t, c, share = F.col("t"), F.col("c"), n_toxic / max(n_toxic + n_clean, 1.0)
    log_odds = F.log((t + 0.5) / (n_toxic + 1)) - F.log((c + 0.5) / (n_clean + 1))
    # Log-likelihood ratio of the split (t, c) against the sample's own shares.
    evidence = t * F.log(t / ((t + c) * share)) + F.when(c > 0, c * F.log(c / ((t + c) * (1 - share)))).otherwise(0.0)
    # Many terms are tried: the evidence must outweigh their number.
    needed = 1 + math.log(max(1, tried.count()))
    learned = tried.select("term", log_odds.alias("w"), evidence.alias("e")).filter((F.col("e") >= needed) & (F.col("w") >= MIN_LOG_ODDS))
    weights = {r.term: round(r.w, 9) for r in learned.collect()}  # they have evidence in the sample, which bounds them
    model = Model(decoder, weights, (0.0, 0.0, 0.0))
    base = math.log((n_toxic + 0.5) / (n_clean + 0.5)) if n_toxic + n_clean else -3.0
    if not weights:
        return Model(decoder, weights, (base, 0.0, 0.0))
    rows = [(f.best, f.total, f.n, y) for y, frame in ((1, toxic), (0, clean))
            for f in _feature_histogram(spark, frame, model).collect()]
    x = np.array([r[:2] for r in rows], dtype=float)
    layer = fit_layer(x, np.array([r[3] for r in rows], dtype=float), np.array([r[2] for r in rows], dtype=float))
    return Model(decoder, weights, tuple(layer))


def _worker_model(shared) -> Model:
    costs, weights, layer = shared.value
    return Model(Decoder(costs), weights, layer)


def _feature_histogram(spark: SparkSession, sample: DataFrame, model: Model) -> DataFrame:
    """Documents of the sample by rounded features (a bounded grid)."""
    shared = spark.sparkContext.broadcast((model.decoder.costs, model.weights, model.layer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = _worker_model(shared), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                best, total = own.features(text)
                counts[round(best, 1), round(total, 1)] += 1
        yield pa.RecordBatch.from_arrays([pa.array([c[0] for c in counts], pa.float64()), pa.array([c[1] for c in counts], pa.float64()),
                                          pa.array(list(counts.values()), pa.int64())], names=["best", "total", "n"])

    return (sample.mapInArrow(run, "best double, total double, n long")
            .groupBy("best", "total").agg(F.sum("n").alias("n")))


def with_scores(spark: SparkSession, docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``toxicity`` (any column of that name is replaced)."""
    shared = spark.sparkContext.broadcast((model.decoder.costs, model.weights, model.layer))
    source = docs.drop("toxicity")
    at = source.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _worker_model(shared)
        for whole in batches:
            for start in range(0, whole.num_rows, _SLICE_ROWS):
                batch = whole.slice(start, _SLICE_ROWS)
                scores = [own.score(t) for t in batch.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())],
                                                 names=[*batch.schema.names, "toxicity"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields]
    return source.mapInArrow(run, ", ".join([*fields, "toxicity double"]))


def training_fold(id_col: str):
    return fold(id_col, FOLDS) != 0


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = train(spark, texts, labels, training_fold)
    return with_scores(spark, texts, model).select(
        "doc_id", (fold("doc_id", FOLDS) == 0).alias("held_out"), F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"))


__all__ = ["LOOKALIKES", "trigram_counts", "trigram_costs", "Decoder", "Model", "words_of", "terms_of", "train",
           "with_scores", "training_fold", "score_documents"]
