import pytest
from pyspark.sql import functions as F

from opsframe.functions import records
from opsframe.operators import inference
from opsframe.plans import warehouse
from opsframe.streaming import lanes

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def manifest_files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stream") / "in")
    warehouse.order_manifests(spark, FOLDER).repartition(4).write.json(path)
    return path


def test_lanes_of_a_stream_equal_those_of_a_batch(spark, manifest_files, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for _ in range(2):  # The second run finds nothing new.
        stream = lanes.read_manifest_stream(spark, manifest_files, one_per_file=False)
        lanes.write_lanes(stream, out, checkpoint).awaitTermination(120)
    got = spark.read.parquet(out).select("manifest_id", "lane")
    expected = warehouse.r13_route_lane(spark, FOLDER)
    assert sorted(got.collect()) == sorted(expected.collect())


def test_stateless_operators_run_on_a_stream(spark, manifest_files, tmp_path):
    source = lanes.read_manifest_stream(spark, manifest_files, one_per_file=False)
    payload = F.to_json(F.struct(F.struct(F.col("manifest_id").alias("latitude"), F.lit("0").alias("longitude")).alias("iss_position")))
    placed = inference.parse_position(source.withColumn("p", payload), "p")
    answer = F.struct(
        F.when(F.col("pilot_certification") == "current", "fast_lane").alias("lane"),
        F.lit("r").alias("reason"),
        F.lit(0.5).alias("risk_score"),
    )
    valid, rejected = inference.validate(placed.withColumn("record", answer), "record", records.CARGO_DECISION_RULES)
    counts = {}
    for name, frame in (("valid", valid), ("rejected", rejected)):
        query = (
            frame.select("manifest_id", "position_line")
            .writeStream.format("parquet")
            .option("path", str(tmp_path / name))
            .option("checkpointLocation", str(tmp_path / f"{name}-checkpoint"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination(120)
        stored = spark.read.parquet(str(tmp_path / name))
        assert stored.filter("position_line = concat('latitude ', manifest_id, ', longitude 0')").count() == stored.count()
        counts[name] = stored.count()
    whole = warehouse.order_manifests(spark, FOLDER)
    assert counts["valid"] == whole.filter("pilot_certification = 'current'").count()
    assert counts["valid"] + counts["rejected"] == whole.count()
