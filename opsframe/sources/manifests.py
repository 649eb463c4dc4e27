"""Nested cargo manifests, and rows fanned out to lanes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.records import LANES
from opsframe.functions.shapes import DOUBLE, TEXT, TEXTS, list_of, shape

MANIFEST = shape(
    manifest_id=TEXT,
    origin_station=TEXT,
    destination_station=TEXT,
    declared_items=list_of(shape(item=TEXT, tonnes=DOUBLE, hazard_class=TEXT)),
    pilot_certification=TEXT,
    customs_flags=TEXTS,
)


def load_manifests(
    spark: SparkSession, path: str, *, one_per_file: bool = True
) -> DataFrame:
    """Manifests under the fixed schema; a broken one has its text in ``_corrupt_record``.

    ``one_per_file`` reads one JSON object per file, over any number of lines;
    False reads one object per line, which large inputs should use.
    """
    schema = T.StructType([*MANIFEST.fields, T.StructField("_corrupt_record", T.StringType())])
    return spark.read.schema(schema).option("multiLine", one_per_file).json(path)


def pick_one(df: DataFrame, key: str, seed: str | int) -> DataFrame:
    """One row, pseudo-random by seed: a top-1 by hash, without a full sort."""
    text = F.col(key).cast("string")
    return df.orderBy(F.md5(F.concat(text, F.lit(str(seed)))), text).limit(1)


def known_lane(lane: Column, lanes: tuple[str, ...] = LANES) -> Column:
    """The lane itself; the job fails on a row outside the known lanes."""
    return F.when(lane.isin(*lanes), lane).otherwise(
        F.raise_error(F.concat(F.lit("unknown lane: "), F.coalesce(lane, F.lit("null"))))
    )


def write_by_lane(
    df: DataFrame, out: str, lane: str = "lane", lanes: tuple[str, ...] = LANES
) -> None:
    """Write each row to the folder of its one lane.

    Tasks write their own file per lane, so a lane that holds most rows is
    spread over all tasks and nothing is shuffled.
    """
    checked = df.withColumn(lane, known_lane(F.col(lane), lanes))
    checked.write.mode("overwrite").partitionBy(lane).parquet(out)


def read_lane(spark: SparkSession, out: str, value: str, lane: str = "lane") -> DataFrame:
    """One lane read back; the filter prunes the other folders."""
    return spark.read.parquet(out).filter(F.col(lane) == value)
