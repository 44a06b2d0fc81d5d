"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes all rows its predecessor kept and, but for the last, returns the columns of
`documents`:

1. `quality` drops documents that the quality classifier scores below 0.3;
2. `exact_dedup` keeps the row with the largest id of equal texts;
3. `near_dedup` keeps the document with the smallest id of each component of similar texts;
4. `mixing` draws the sources to their target weights: a row per document and pass, holding
   what the pass takes of its text;
5. `packing` cuts and packs the token ids into sequences of 2048.

A classifier, random draws and a tokenizer have no SQL; `tests/llm/test_corpus_pipeline.py`
checks every stage by brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm import exact_dedup, mixing, ngram_join, packing, quality
from seriesloom.llm.common import table
from seriesloom.llm.queries import vocabulary
from seriesloom.session import durable, ship_package


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.accepted(docs, machine)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.without_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return ngram_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    kind = docs.schema["n_chars"].dataType
    return mixing.mixed_documents(docs).withColumn("n_chars", F.length("text").cast(kind))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return packing.pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("quality", quality_stage), ("exact_dedup", exact_stage), ("near_dedup", near_stage),
          ("mixing", mixing_stage), ("packing", packing_stage)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; what a stage keeps is written once and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
