"""The corpus pipeline: five stages over ``documents``, each a Parquet table that the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketry.llm import bin_completion, compression_toxicity, cross_parsing, minhash, queries, temperature_mix
from basketry.llm.common import shared_path

#: Shingles of five words and a similarity of 0.8.
SHINGLE_WORDS = 5
#: No source is taken more often than this; every document is taken at least once.
MAX_REPEAT = 1.25


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that operator 8 does not call toxic."""
    return compression_toxicity.keep_clean(docs, queries.toxicity_model(spark, docs, sf_dir))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that operator 6 has learned: neither without letters nor like none of them."""
    return cross_parsing.keep_known(docs, cross_parsing.build(cross_parsing.sample(docs, "doc_id", "text", "lang")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each of operator 7's groups."""
    return minhash.keep_one(docs, SHINGLE_WORDS, 80, 100)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as operator 10 takes them."""
    return temperature_mix.mix_documents(docs, max_repeat=MAX_REPEAT)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in operator 5's sequences."""
    return bin_completion.pack_documents(docs, queries.tokenizer_path("byte_bpe_50k.json"), queries.BYTE_END_ID, queries.CAPACITY)[0]


STAGES = [
    ("toxicity", toxicity),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("mixture", mixture),
    ("packing", packing),
]

#: SQL can express neither the compression, the automata, the tokenizer nor the packing search.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = shared_path(spark, f"stage-{name}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
