"""From raw documents to training shards: toxicity, near-duplicates, benchmark decontamination, mixing and sharding.

Each stage takes the rows that its predecessor kept, in the columns of
``documents``; the last one returns where every row goes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.llm import decontamination, mixing, near_duplicates, sharding, toxicity
from tidewire.llm.keys import stored


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below 0.5; labels of held-out documents are not learnt."""
    scores = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), name="_toxicity")
    return scores.filter(F.col("_toxicity") < 0.5).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near-duplicates."""
    return near_duplicates.without_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return decontamination.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, size, text_crc32, shard, slot`` of every row."""
    return sharding.shuffled_shards(docs, 24)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("sharding", shards),
]

#: The first stage is a trained model, which SQL cannot express; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written once, because the next stage reads it more than once."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
