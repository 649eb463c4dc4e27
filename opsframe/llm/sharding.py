"""A uniform shuffle into shards by a two-pass external shuffle, in DataFrame functions.

First pass: every record goes to a bucket by a seeded hash of its ordinal, one
bucket a partition, and each memory-sized bucket is shuffled as an array
(Spark's ``shuffle`` is Fisher-Yates) and written. Second pass: the buckets
follow each other, which gives each record its place in the whole order, and
the places are dealt out to the shards in turn.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.sources.scratch import written

SHARDS = 16
#: Text bytes of one bucket, about; a bucket is held in memory by one task.
BUCKET_BYTES = 16 << 20
SEED = 6


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text and one more; null has none."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def _ordinal(docs: DataFrame) -> Column:
    """File and row of a Parquet file's record; else the number of the row in its partition."""
    try:
        place = docs.metadataColumn("_metadata")
        place = F.struct(place["file_path"].alias("file"), place["row_index"].alias("row"))
        docs.select(place)
    except AnalysisException:
        return F.monotonically_increasing_id()
    return place


def sharded(
    docs: DataFrame,
    text_col: str = "text",
    shards: int = SHARDS,
    bucket_bytes: int = BUCKET_BYTES,
    seed: int = SEED,
) -> DataFrame:
    """``docs`` with ``shard`` and ``slot``: numbers of rows per shard differ by one at most.

    Slots count from 0 in each shard without gaps. Nothing but a record's
    ordinal decides its place, so nulls, ties, copies and repeated rows are
    spread like any others. The ordinal of rows of Parquet files is the file and
    the row in it: the same files give the same result, however tasks read them.
    Of a frame that is not a plain read of such files, with columns chosen or
    rows left out, it is the row's number in the frame's partitions. An empty
    table stays empty. Columns ``shard`` and ``slot`` that were there are replaced.
    """
    docs = docs.drop("shard", "slot")
    total = docs.agg(F.sum(text_bytes(F.col(text_col)))).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    scattered = (
        docs.select(F.struct(_ordinal(docs).alias("__n"), *docs.columns).alias("__row"))
        .withColumn(
            "__bucket", F.pmod(F.xxhash64(F.lit(seed), "__row.__n"), F.lit(buckets)).cast("int")
        )
        .repartitionById(buckets, "__bucket")
    )
    shuffled = written(
        scattered.groupBy("__bucket")
        .agg(F.array_sort(F.collect_list("__row")).alias("__rows"))
        .select("__bucket", F.posexplode(F.shuffle("__rows", seed)).alias("__at", "__row")),
        "shuffled",
    )
    sizes = shuffled.groupBy("__bucket").agg(F.count("*").alias("__size"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each bucket, stored, so that the join knows how small it is and moves no text.
    starts = written(
        sizes.select("__bucket", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__start")),
        "starts",
    )
    place = F.col("__start") + F.col("__at")
    return shuffled.join(starts, "__bucket").select(
        *(F.col("__row")[name].alias(name) for name in docs.columns),
        (place % shards).cast("int").alias("shard"),
        F.floor(place / shards).cast("long").alias("slot"),
    )


def write_shards(shards: DataFrame, path: str) -> None:
    """One folder of Parquet files per shard, each in slot order within its files."""
    shards.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
