"""From raw documents to packed training sequences: five stages, each on all that the one before it kept."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stopmetrics.llm import line_dedup, packing, simhash, suffix_dedup, toxicity
from stopmetrics.scratch import new_folder

WORD_TOKENIZER = "word_bpe_49k.json"
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with n_chars counted anew."""
    return docs.withColumn("n_chars", F.coalesce(F.char_length("text"), F.lit(0)).cast("long")).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labelled ones among them, does not predict to be toxic."""
    docs = docs.select(*COLUMNS)
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without multi-line chunks that occurred before; one that loses all its text goes."""
    cleaned = line_dedup.remove_repeated_chunks(docs.select(*COLUMNS))
    return _documents(cleaned.where("n_removed = 0 OR length(trim(text)) > 0"))


def keep_one_near_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near duplicates: three-word shingles, at most three differing bits."""
    return simhash.keep_one_per_component(docs.select(*COLUMNS), words_per_shingle=3, radius=3)


def drop_repeated_strings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the 50-byte strings that an earlier one has, whole characters only; emptied ones go."""
    cleaned = suffix_dedup.remove_repeats(docs.select(*COLUMNS), width=50, whole_characters=True)
    kept = cleaned.where("n_removed = 0 OR length(kept) > 0")
    text = F.when(F.col("n_bytes") > 0, F.col("kept").cast("string")).otherwise(F.lit(""))
    return _documents(kept.withColumn("text", text))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the documents, its ids and its place in a sequence of at most 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path(WORD_TOKENIZER), end_id=1, capacity=4096)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_near_copy),
    ("suffix_array_dedup", drop_repeated_strings),
    ("best_fit_packing", pack_sequences),
]

#: A learned model, rolling hashes, SimHash and a tokenizer are not expressible in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over documents; each stage's result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
    return docs
