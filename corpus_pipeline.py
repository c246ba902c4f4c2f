"""A training corpus from `documents`: one stage after another, each written as Parquet and reread.

1. `quality` (operator 7): documents that a quality rule rejects go.
2. `line_dedup` (operator 10): runs of 50 words or more that stand earlier are cut out of the texts;
   documents that lose all their words this way go.
3. `near_dedup` (operator 1): of documents linked by five-word shingles with a similarity of 0.8 or
   more, directly or over others, the one with the smallest doc_id stays.
4. `decontaminate` (operator 5): documents in which a benchmark item is found go.
5. `encode` (operator 9): two distinct sampled segmentations of every text.

All stages but the last return the columns of `documents`; n_chars follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recolens.llm.decontaminate import drop_leaks
from recolens.llm.linededup import line_dedup
from recolens.llm.minhash import drop_near_duplicates
from recolens.llm.quality import keep_good
from recolens.llm.queries import piece_model
from recolens.llm.segment import encode_samples
from recolens.llm.store import written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def cut_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = line_dedup(docs)
    left = (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]")
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        changed = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.char_length("text").cast(kind))
        cut = cut.withColumn("n_chars", changed)
    return cut.where(left).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode_samples(docs, piece_model())


STAGES = [
    ("quality", quality),
    ("line_dedup", cut_lines),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("encode", encode),
]

#: Segmentation is not expressible in SQL; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
