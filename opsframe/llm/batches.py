"""How much goes to a Python worker at a time, and how many rows leave the tasks for a sample."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

#: Bytes of one Arrow batch. Batches that count rows alone can hold any amount of text.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches bounded by bytes; a lower bound that is set stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if not 0 < now <= BATCH_BYTES:
        spark.conf.set(key, f"{BATCH_BYTES}b")
    return spark


def hash_share(hashed: Column, wanted: int, total: int) -> Column:
    """Whether a row's hash is so low that such rows of ``total`` are at least ``wanted`` ones.

    Hashes of distinct rows are uniform, so eight standard deviations above
    ``wanted`` never leave too few; fewer rows than that all pass.
    """
    part = min(1.0, (wanted + 8 * wanted**0.5 + 64) / max(total, 1))
    return hashed <= F.lit(-(2**63) + min(int(part * 2**64), 2**64 - 1))
