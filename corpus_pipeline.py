"""From raw documents to packed training sequences: toxic texts, near copies, repeated spans and benchmark leaks go.

Each stage takes the documents its predecessor kept, from Parquet, and returns the documents it keeps with all their
columns; the last returns the packed pieces. A stage's decisions are made on its own input.
"""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm import decontamination, near_copies, packing, repeats, toxicity
from tillweave.operators.materialize import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxic_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text the classifier doesn't reject; it learns from the labelled rows that aren't held out."""
    usable = F.crc32(F.col("doc_id").cast("string")) % 5 != 0
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, toxicity.fit(docs, labels, usable=usable))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, that with the smallest id."""
    return near_copies.one_of_each(docs)


def repeated_spans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without what repeats elsewhere, untouched ones as they were; documents with nothing left go."""
    others = [name for name in docs.columns if name != "text"]
    kept = repeats.remove_repeats(docs.select(F.struct(*others).alias("doc"), "text"), key="doc", original=True)
    kept = kept.where("n_removed < n_words or n_words = 0").select("doc.*", F.col("kept").alias("text"))
    if "n_chars" in others:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(docs.columns)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item."""
    others = [name for name in docs.columns if name != "text"]
    found = decontamination.decontaminate(
        docs.select(F.struct(*others).alias("doc"), "text"),
        spark.read.parquet(f"{sf_dir}/benchmark.parquet"),
        key="doc",
        with_text=True,
    )
    return found.where(F.size("spans") == 0).select("doc.*", "text").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxic_texts),
    ("ngram_jaccard_join", near_duplicates),
    ("substring_dedup", repeated_spans),
    ("decontamination", benchmark_leaks),
    ("best_fit_packing", packed),
]

#: Tokenizer ids and a learned classifier can't be had in SQL; the stages are tested against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the documents table on, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        folder = scratch_path(spark, name)
        step(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs
