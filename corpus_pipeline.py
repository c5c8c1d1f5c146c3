"""The corpus pipeline: raw documents to token ids, in five stages of the training-data operators.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before kept; ``run``
writes every stage's result as Parquet to the shared folder and reads it back for the next.

* toxicity: rejects documents whose restored text scores 0.5 or more;
* SimHash near-dedup: of each component, the document of the smallest id stays;
* suffix-array dedup: 100-byte strings that start earlier are cut out of the text, whole
  characters only (``n_chars`` follows the text);
* benchmark decontamination: rejects documents with a twentieth of their words in benchmark windows;
* BPE: encodes and decodes what is left: ids, their number, and digests of ids and decoded text.

Defined cases: NULL and empty texts pass the first, third and fourth stage as they are (an
empty text has no repeated bytes, and NULL stays NULL) and count as near duplicates of each other; repeated rows
are one document to the dedup stages and only one of them stays; an empty table stays empty;
other columns pass through every stage but the last, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, simhash, suffix_dedup, toxicity
from tessera.llm.common import NULL_ID, small_batches, staged
from tessera.llm.queries import tokenizer_path
from tessera.sources.tables import read_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _boxed(docs: DataFrame) -> DataFrame:
    """``row`` (a struct of all columns), ``doc_id`` and ``text``: names of other columns cannot clash."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), "doc_id", "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    model = toxicity.train(spark, docs.select("doc_id", "text"), read_table(spark, sf_dir, "labels"), toxicity.training_fold)
    scored = toxicity.with_scores(spark, _boxed(docs).select("row", "text"), model)
    return scored.filter("toxicity < 0.5").select("row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = simhash.near_duplicates(spark, docs)
    # A document without an id stays only where no other is in its component.
    stays = (found.groupBy("root").agg(F.min(F.struct(F.col("k") == NULL_ID, "k", "x")).alias("first"))
             .select(F.col("first.k").alias("k"), F.col("first.x").alias("x")))
    rows = _boxed(docs).select("row", F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("k"),
                               F.xxhash64(F.coalesce("text", F.lit(""))).alias("x"))
    return rows.join(stays, ["k", "x"], "left_semi").dropDuplicates(["k", "x"]).select("row.*")


def cut_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    kept = suffix_dedup.dedup_bytes(spark, docs.withColumn("__null", F.col("text").isNull()), whole_characters=True, with_rest=True)
    # A NULL text has no bytes to cut: it stays NULL, and so does its length.
    text = F.when(~F.col("rest.__null"), F.col("kept").cast("string"))
    own = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": text}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("rest.__null"), F.col("rest.n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType)
    return kept.select(*(own.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    found = decontaminate.find_passages(spark, _boxed(docs).select("row", "text"), read_table(spark, sf_dir, "benchmark"),
                                        keep=("row",))
    return decontaminate.judged(found).filter(~F.col("contaminated")).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return bpe.digests(bpe.encode(spark, docs, tokenizer_path()), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeated_strings),
    ("benchmark_decontamination", drop_contaminated),
    ("bpe_encoding", encode),
]

# Learned scores, fingerprints and greedy merges cannot be written in SQL: tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
