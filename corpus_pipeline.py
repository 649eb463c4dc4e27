"""From raw documents to mixed, shuffled shards: five stages, each a stored table.

Every stage takes the columns of ``documents`` (doc_id, text, lang, source,
n_chars) and all but the last return just those.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.llm import decontaminate, mixing, sharding, simhash, toxicity
from opsframe.llm.batches import bounded_batches
from opsframe.sources.scratch import written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier scores as toxic go; labels come from the labels table."""
    labels = bounded_batches(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.without_toxic(docs, labels)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-copies stays: four-word shingles, four bits."""
    bounded_batches(spark)
    return simhash.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out of the texts; ``n_chars`` follows the text.

    Documents without any passage keep every column as it was.
    """
    benchmark = bounded_batches(spark).read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.decontaminated(docs, benchmark, n_chars_col="n_chars")


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target weight takes it, 0 to 3 times."""
    bounded_batches(spark)
    draws = mixing.drawn(mixing.mixed(docs))
    return mixing.shuffled_shards(draws).select(*docs.columns)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row with its shard and slot in a uniform shuffle."""
    return sharding.sharded(docs)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_near_copies),
    ("decontamination", without_benchmark),
    ("mixing", mixed),
    ("sharding", sharded),
]

# Trained scores, fingerprint links and seeded draws are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows, from the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
