"""A training-data pipeline over documents: drop toxic texts, keep identified languages, keep one of each group of near
copies, mix to target weights, encode.

Each stage takes (spark, docs, sf_dir) and gives a DataFrame that is written as Parquet before the next one reads it. All
stages but the last return the columns of documents. Defined results for nulls, empty and very long texts, ties and
repeated rows are those of the operators: a null text is an empty one (not toxic, but without a language, so it goes), rows
without an id can't be copies of others and stay, and tables without rows stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from kerbside.llm import bpe, jaccard, language_id, mixing, toxicity
from kerbside.llm.common import prepare, read
from kerbside.llm.queries import MIX_BUDGET, MIX_TARGETS, language_network, toxicity_model
from kerbside.llm.registry import QUERIES
from kerbside.session import scratch_path

# Documents in two or three languages are clean and share their probability; only near even odds say nothing.
LEAST_LANGUAGE_SCORE = 0.3
SHINGLE, LEAST = 5, (80, 100)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't predicted toxic."""
    prepare(spark)
    return toxicity.reject_toxic(docs, toxicity_model(docs, read(spark, sf_dir, "labels")))


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is told better than by near even odds."""
    prepare(spark)
    return language_id.keep_identified(docs, language_network(docs), LEAST_LANGUAGE_SCORE)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near copies."""
    prepare(spark)
    return jaccard.one_of_each(docs, shingle=SHINGLE, least=LEAST)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A sample whose tokens have the target weights."""
    prepare(spark)
    return mixing.sample(docs, MIX_TARGETS, MIX_BUDGET)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every text, and whether decoding them gives the text again."""
    prepare(spark)
    encoded = bpe.decode(bpe.encode(docs.select("doc_id", "text", "source", "lang")))
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return encoded.select("doc_id", "source", "lang", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("language_id", keep_languages),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix_sources),
    ("bpe", encode),
]

# Networks and language models aren't SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES["pipeline"] = run
