"""Manifests routed to lanes as their files arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from opsframe.operators.routing import route_lane
from opsframe.sources.manifests import MANIFEST, known_lane


def read_manifest_stream(
    spark: SparkSession, path: str, *, one_per_file: bool = True
) -> DataFrame:
    """New manifest files of a folder under the fixed schema."""
    return spark.readStream.schema(MANIFEST).option("multiLine", one_per_file).json(path)


def write_lanes(manifests: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Route everything that is available, append it per lane, and stop."""
    routed = route_lane(manifests).withColumn("lane", known_lane(F.col("lane")))
    return (
        routed.writeStream.format("parquet")
        .partitionBy("lane")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
