"""A durable cache of model answers in buckets: a call reads the buckets of its prompts only.

Layout: ``<cache>/level=<name>/bucket=<n>/``. Each append is a level of its own. A
bucket found in many levels is merged into one by ``compact``. First answers win
wherever a key occurs more than once, so an append or a merge that breaks off, or
two writers at a time, change no answer.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.shapes import INT, TEXT, TIMESTAMP, shape
from opsframe.operators.inference import Model, prompt_key, respond
from opsframe.sources.scratch import read_parquet_or_empty, removed, written

BUCKETS = 256
MOST_LEVELS = 8
STORED = shape(key=TEXT, response=TEXT, written_at=TIMESTAMP, level=TEXT, bucket=INT)


def bucket_of(key: Column, buckets: int = BUCKETS) -> Column:
    """By the first digits of the key, a SHA-256 in hexadecimal digits."""
    return F.pmod(F.conv(F.substring(key, 1, 8), 16, 10).cast("bigint"), F.lit(buckets)).cast("int")


def stored_answers(spark: SparkSession, cache: str, touched: list[int] | None = None) -> DataFrame:
    """Everything in the cache, or in the named buckets, whose folders alone are then read."""
    found = read_parquet_or_empty(spark, cache, STORED)
    return found if touched is None else found.filter(F.col("bucket").isin(touched))


def first_answers(stored: DataFrame) -> DataFrame:
    """(key, bucket, response, written_at): the first answer of each key."""
    first = F.min(F.struct("written_at", "response")).alias("first")
    return stored.groupBy("bucket", "key").agg(first).select("key", "bucket", "first.response", "first.written_at")


def _append(rows: DataFrame, cache: str) -> None:
    """Rows of (key, bucket, response, written_at) as a new level, one file a bucket and task."""
    level = f"{cache.rstrip('/')}/level={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    rows.select("key", "response", "written_at", "bucket").write.partitionBy("bucket").parquet(level)


def _folders(spark: SparkSession, cache: str) -> DataFrame:
    """(level, bucket) of every folder with files; no file is opened."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(cache)
    place = F.regexp_extract("path", r"level=([^/]+)/bucket=(\d+)/", 0)
    parts = listed.select(place.alias("place")).distinct()
    return parts.select(
        F.regexp_extract("place", r"level=([^/]+)/", 1).alias("level"),
        F.regexp_extract("place", r"bucket=(\d+)/", 1).cast("int").alias("bucket"),
    )


def compact(spark: SparkSession, cache: str, most: int = MOST_LEVELS) -> list[int]:
    """Merge every bucket that over ``most`` levels have into a new level; the buckets merged.

    The merged level is whole before the old folders go, so a merge that breaks off
    leaves repeats, and no reader without answers but one that is reading just then.
    """
    folders = _folders(spark, cache)
    many = [r["bucket"] for r in folders.groupBy("bucket").count().filter(F.col("count") > most).collect()]
    if not many:
        return []
    old = folders.filter(F.col("bucket").isin(many)).collect()
    stored = stored_answers(spark, cache, many)
    levels = sorted({r["level"] for r in old})
    _append(first_answers(stored.filter(F.col("level").isin(levels))).repartition("bucket"), cache)
    for place in old:
        removed(spark, f"{cache.rstrip('/')}/level={place['level']}/bucket={place['bucket']}")
    return sorted(many)


def infer_bucketed(
    df: DataFrame,
    prompt_col: str,
    make_model: Callable[[], Model],
    schema: T.StructType,
    cache: str,
    *,
    model_id: str = "model",
    buckets: int = BUCKETS,
    most_levels: int = MOST_LEVELS,
) -> DataFrame:
    """``infer`` with a bucketed cache: known prompts are looked up, the others asked and appended.

    The names of the touched buckets come to the driver, ``buckets`` at most; what
    is looked up, appended and joined back lies in these. A null prompt has no
    answer. Use a cache with the number of buckets it was begun with.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_key", prompt_key(F.col(prompt_col), model_id))
    wanted = keyed.filter(F.col("_key").isNotNull()).select(
        F.col("_key").alias("key"), bucket_of(F.col("_key"), buckets).alias("bucket"), F.col(prompt_col).alias("prompt")
    )
    wanted = written(wanted.distinct(), "wanted")
    touched = sorted(r["bucket"] for r in wanted.select("bucket").distinct().collect())
    known = stored_answers(spark, cache, touched).select("key")
    pending = written(wanted.join(known, "key", "left_anti"), "unanswered")
    if not pending.isEmpty():
        asked = pending.select(
            "key", "bucket", respond(F.col("prompt"), make_model).alias("response"),
            F.current_timestamp().alias("written_at"),
        )
        _append(asked, cache)
        compact(spark, cache, most_levels)
    answers = stored_answers(spark, cache, touched)
    repeated = answers.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    # A plain scan, so that AQE can split a prompt of very many rows; repeats are rare.
    once = answers if repeated.isEmpty() else written(first_answers(answers), "answers")
    once = once.select(F.col("key").alias("_key"), "response")
    return keyed.join(once, "_key", "left").drop("_key").withColumn("record", F.from_json("response", schema))
