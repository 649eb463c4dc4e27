"""What Spark plans for the operators: shuffles, pruning, limits, skew."""

import re

import pytest
from pyspark.sql import functions as F

from opsframe.functions import records
from opsframe.operators import drift, inference, relational, review, routing
from opsframe.plans import warehouse

FOLDER = "/root/testdata/sf0.001"


def planned(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def executed(frame):
    frame.collect()
    return planned(frame).split("== Initial Plan ==")[0]


@pytest.fixture
def settings(spark):
    before = {}

    def change(**values):
        for name, value in values.items():
            key = "spark.sql." + name.replace("__", ".")
            before.setdefault(key, spark.conf.get(key, None))
            spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_top_k_is_a_bounded_sort(spark):
    for name in ("r6_topk", "r7_topk_join", "s8_pick_one", "r12_max_hazard"):
        assert "TakeOrderedAndProject" in planned(warehouse.QUERIES[name](spark, FOLDER)), name


def test_small_dimension_is_broadcast_and_large_one_is_not(spark, settings):
    query = warehouse.QUERIES["r7_topk_join"]
    assert "BroadcastHashJoin" in planned(query(spark, FOLDER))
    settings(autoBroadcastJoinThreshold="-1")
    assert "SortMergeJoin" in planned(query(spark, FOLDER))


def test_filters_and_columns_reach_the_scan(spark):
    plan = planned(warehouse.QUERIES["r8_count_where"](spark, FOLDER))
    assert "EqualTo(o_orderstatus,P)" in plan and "ReadSchema: struct<o_orderstatus:string>" in plan


def test_row_wise_operators_do_not_shuffle(spark):
    folder_manifests = warehouse.order_manifests(spark, FOLDER)
    path = warehouse.shared_dir(spark, "plan-test")
    folder_manifests.write.parquet(path)
    stored = spark.read.parquet(path)
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    part = spark.read.parquet(f"{FOLDER}/part.parquet")
    frames = [
        routing.route_lane(stored),
        routing.with_hazard(stored),
        relational.numbered(stored.select("manifest_id", "customs_flags"), "customs_flags"),
        inference.extract_findings(docs, "text", warehouse.FINDING_RULES),
        inference.infer(docs, "text", warehouse.SEVERITY_MODEL, records.SEVERITY_REPORT),
        drift.project_drift(part, warehouse.PART_DRIFT),
    ]
    for frame in frames:
        assert "Exchange" not in planned(frame)


def test_one_shuffle_of_partial_results(spark):
    part = spark.read.parquet(f"{FOLDER}/part.parquet")
    for frame in (
        relational.count_by(part, "p_brand"),
        drift.diff_tables(part, part, ["p_partkey"]),
        drift.diff_rows(part, part),
    ):
        plan = planned(frame)
        assert plan.count("Exchange") == 1 and "partial_" in plan


def test_top_groups_counts_once(spark):
    plan = executed(warehouse.QUERIES["r4_top_groups"](spark, FOLDER))
    assert "ReusedExchange" in plan


def test_ranks_are_cut_before_the_shuffle(spark, settings):
    settings(autoBroadcastJoinThreshold="-1")
    for name in ("r11_reroute", "g2_review_state"):
        plan = planned(warehouse.QUERIES[name](spark, FOLDER))
        assert re.search(r"WindowGroupLimit.*Partial", plan), name


def test_model_runs_once_per_row(spark):
    scored = warehouse._severities(spark, FOLDER)
    plan = planned(inference.escalate(scored).select("record.severity", "record.summary", "response"))
    assert plan.count("ArrowEvalPython") == 1


def test_no_operator_forms_all_pairs(spark):
    for name, query in warehouse.QUERIES.items():
        plan = planned(query(spark, FOLDER))
        assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan, name


def test_a_hot_prompt_is_split_in_the_join_back(spark, settings, tmp_path):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="20KB",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="40KB",
        adaptive__skewJoin__skewedPartitionFactor="2",
    )
    rows = spark.range(60_000, numPartitions=12)
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("p"), (F.col("id") % 4000).cast("string")))
    pad = F.sha2(F.col("id").cast("string"), 512).alias("pad")
    path = str(tmp_path / "prompts")
    rows.select("id", hot.alias("text"), pad).write.parquet(path)
    frame = spark.read.parquet(path)
    got = inference.infer_cached(
        frame, "text", warehouse.SEVERITY_MODEL, records.SEVERITY_REPORT, str(tmp_path / "cache")
    ).select("id", "pad", "response")
    plan = executed(got)
    assert "SortMergeJoin(skew=true)" in plan
    assert got.count() == 60_000 and got.filter("response is null").count() == 0


def test_hot_keys_shrink_before_the_shuffle(spark):
    """A key with a third of the rows sends one row per task, not its rows."""
    hot = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    a = spark.range(90_000, numPartitions=6).select(hot.alias("k"), F.lit(2.0).alias("x"))
    b = a.select("k", (F.col("x") * 1000).alias("y"))
    row = drift.unit_drift(a, b, ("k", "k"), [("x", "y")]).first()
    assert row.n_keys == 60_001 and row.constant and row.max_ratio == 1000
    same = drift.diff_tables(a, a, ["k"])
    assert same.count() == 0
    events = a.select(
        F.col("k").alias("item"),
        F.timestamp_seconds(F.lit(0)).alias("ts"),
        F.monotonically_increasing_id().alias("seq"),
        F.lit("changes").alias("decision"),
    )
    import datetime as dt

    states = review.review_state(
        events, max_iterations=3, timeout=dt.timedelta(hours=1), as_of=dt.datetime(2000, 1, 1)
    )
    assert [(r.item, r.state) for r in states.filter("state = 'exhausted'").collect()] == [(0, "exhausted")]


def test_a_hot_item_is_spread_over_tasks(spark, settings):
    settings(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__advisoryPartitionSizeInBytes="16k",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="16k",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
    )
    left = spark.range(0, 90_000, numPartitions=24).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 ELSE id % 500 END AS k", "id"
    )
    right = left.groupBy("k").agg(F.max("id").alias("w"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        side = right.filter("k <> 7") if how == "left_anti" else right
        joined = relational.join_stored(left, side, "k", how)
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count()
        sizes.collect()
        assert "skew=true" in sizes._jdf.queryExecution().executedPlan().toString(), how


def test_profile_sorts_no_fixed_width_column(spark):
    lines = warehouse.table(spark, "/root/testdata/sf0.001", "lineitem")
    for exact in (True, False):
        plan = drift.profile(lines, exact=exact)._jdf.queryExecution().executedPlan().toString()
        sorting = [line for line in plan.splitlines() if "SortAggregate" in line]
        fixed_width = ("l_orderkey", "l_quantity", "l_shipdate", "l_tax", "n_rows", "hll")
        assert not any(name in line for line in sorting for name in fixed_width)


def test_sketched_findings_shuffle_no_value(spark):
    part, drifted = warehouse._part_versions(spark, "/root/testdata/sf0.001")
    plan = drift.match_columns_sketched(part, drifted)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(value" not in plan and "hashpartitioning(_branch" in plan


def test_reroute_scans_its_tables_once_per_use(spark):
    found = warehouse.r11_reroute(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") <= 12
