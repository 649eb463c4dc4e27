import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from opsframe.functions import records
from opsframe.functions.text import lookup
from opsframe.operators import inference

SEVERE = inference.severity_json("high", "s", ["hull"], "dock")
MODEL = inference.keyword_model(
    (
        ("leak", SEVERE),
        ("garbled", "{broken"),
        ("odd", inference.severity_json("terrible", "s", [], "a")),
        ("partial", '{"severity": "low"}'),
    ),
    inference.severity_json("low", "{size}", [], "none"),
)


@pytest.fixture(scope="module")
def reports(spark):
    texts = ["a leak", "all fine", "garbled", "odd", "partial", None, "all fine"]
    return spark.createDataFrame(list(enumerate(texts)), "id int, text string")


def test_prompts(reports):
    got = inference.build_prompts(reports, "No. {}:\n{}", ["id", "text"])
    assert got.filter("id = 1").first().prompt == "No. 1:\nall fine"
    assert got.filter("id = 5").first().prompt == "No. 5:\n"
    brief = reports.select(inference.record_json("id", "text").alias("brief"))
    assert json.loads(brief.first().brief) == {"id": 0, "text": "a leak"}
    percent = inference.build_prompts(reports, "100% of {}", ["text"])
    assert percent.first().prompt == "100% of a leak"
    with pytest.raises(ValueError, match="places"):
        inference.build_prompts(reports, "{} {}", ["text"])


def test_infer_and_validate_split_the_input(reports):
    scored = inference.infer(reports, "text", MODEL, records.SEVERITY_REPORT, request_size=2, concurrency=3)
    valid, rejected = inference.validate(scored, "record", records.SEVERITY_RULES)
    assert sorted(r.id for r in valid.collect()) == [0, 1, 6]
    reasons = {r.id: (r.reasons, r.response) for r in rejected.collect()}
    assert reasons[3][0] == ["severity: not allowed"]
    assert reasons[4][0] == ["summary: missing", "affected_systems: missing", "recommended_action: missing"]
    assert len(reasons[2][0]) == 4 and reasons[2][1] == "{broken"
    assert len(reasons[5][0]) == 4 and reasons[5][1] is None
    assert [r.id for r in inference.escalate(scored).collect()] == [0]


def test_model_is_built_once_per_task_and_asked_once_per_row(spark, reports):
    built, asked = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0)

    def make():
        built.add(1)

        def model(prompts):
            asked.add(len(prompts))
            assert len(prompts) <= 2
            return [SEVERE for _ in prompts]

        return model

    scored = inference.infer(reports.coalesce(1), "text", make, records.SEVERITY_REPORT, request_size=2)
    kept = scored.filter("record.severity = 'high'").select("id", "record.summary", "response")
    assert kept.count() == 6 and len(kept.collect()) == 6
    assert (built.value, asked.value) == (2, 12)


def test_labels(reports):
    model = inference.keyword_model((("leak", "quarantine"), ("odd", "attic")), "fast_lane")
    got = {r.id: (r.label, r.accepted) for r in inference.infer_label(reports, "text", model, records.LANES).collect()}
    assert got[0] == ("quarantine", True) and got[3] == (None, False) and got[5] == (None, False)


RECORD_CASES = [
    (records.CARGO_DECISION, records.CARGO_DECISION_RULES, {"lane": "fast_lane", "reason": "r", "risk_score": 1.0}, {"risk_score": 1.01}),
    (records.CARGO_DECISION, records.CARGO_DECISION_RULES, {"lane": "fast_lane", "reason": "r", "risk_score": 0}, {"lane": "attic"}),
    (
        records.MISSION_PLAN,
        records.MISSION_PLAN_RULES,
        {"mission_name": "m", "origin": "o", "destination": "d", "steps": ["a"], "estimated_days": 3.5},
        {"steps": ["a", None]},
    ),
    (records.FINDING, records.FINDING_RULES, {"anomaly_type": "t", "confidence": 0.5, "notes": ""}, {"confidence": -0.1}),
    (
        records.FILE_REPORT,
        records.FILE_REPORT_RULES,
        {"title": "t", "findings": [{"anomaly_type": "t", "confidence": 0.5, "notes": "n"}]},
        {"findings": [{"anomaly_type": "t", "confidence": 7, "notes": "n"}]},
    ),
    (records.FILE_REPORT, records.FILE_REPORT_RULES, {"title": "t", "findings": []}, {"findings": [{"confidence": 0.5}]}),
    (records.ROUTE_ANSWER, records.ROUTE_ANSWER_RULES, {"question": "q", "top_routes": ["a"], "rationale": "r"}, {"top_routes": None}),
    (
        records.TELEMETRY_REPORT,
        records.TELEMETRY_RULES,
        {"signal_grade": "a", "headline": "h", "watch_items": [], "position_line": "p"},
        {"signal_grade": "e"},
    ),
    (
        records.SEVERITY_REPORT,
        records.SEVERITY_RULES,
        {"severity": "critical", "summary": "s", "affected_systems": ["x"], "recommended_action": "a"},
        {"severity": "CRITICAL"},
    ),
]


@pytest.mark.parametrize("case", RECORD_CASES, ids=lambda c: next(iter(c[3])))
def test_record_rules(spark, case):
    schema, rules, good, change = case
    rows = [(1, json.dumps(good)), (2, json.dumps({**good, **change}))]
    frame = spark.createDataFrame(rows, "id int, response string").withColumn("record", F.from_json("response", schema))
    valid, rejected = inference.validate(frame, "record", rules)
    assert [r.id for r in valid.collect()] == [1]
    assert [r.id for r in rejected.collect()] == [2]


def test_findings_are_distinct_per_document(spark):
    docs = spark.createDataFrame(
        [(1, "leak in tank 9, leak in tank 10"), (2, "quiet"), (3, None)], "id int, text string"
    )
    rules = [
        inference.FindingRule("leak", "leak in tank [0-9]+", 0.9, needle="leak"),
        inference.FindingRule("leak", "leak in tank [0-9]+", 0.9),
        inference.FindingRule("number", "[0-9]{2}", 0.5),
    ]
    got = inference.extract_findings(docs, "text", rules)
    assert sorted(got.collect()) == [
        (1, "leak", 0.9, "leak in tank 10"),
        (1, "leak", 0.9, "leak in tank 9"),
        (1, "number", 0.5, "10"),
    ]
    nested = docs.select("id", inference.findings_of_text(F.col("text"), rules).alias("findings"))
    assert {r.id: len(r.findings) for r in nested.collect()} == {1: 3, 2: 0, 3: 0}
    assert sorted(r[0] for r in got.select(inference.finding_line()).collect()) == [
        "leak (confidence=0.90): leak in tank 10",
        "leak (confidence=0.90): leak in tank 9",
        "number (confidence=0.50): 10",
    ]


@pytest.mark.parametrize("waves", [1, 3])
def test_cache_asks_every_prompt_once(spark, tmp_path, reports, waves):
    cache = str(tmp_path / "cache")

    def run(model_id="m", frame=reports):
        return inference.infer_cached(
            frame, "text", MODEL, records.SEVERITY_REPORT, cache, model_id=model_id, waves=waves
        )

    first = sorted((r.id, r.response) for r in run().collect())
    assert inference.cached_calls(reports, cache) == 5
    assert first == sorted((r.id, r.response) for r in run().collect())
    assert inference.cached_calls(reports, cache) == 5
    more = reports.unionAll(spark.createDataFrame([(9, "new")], "id int, text string"))
    assert run(frame=more).count() == 8
    assert inference.cached_calls(reports, cache) == 6
    run("another model")
    assert inference.cached_calls(reports, cache) == 11


def test_reading_the_result_never_calls_the_model(spark, tmp_path, reports):
    calls = spark.sparkContext.accumulator(0)

    def make():
        def model(prompts):
            calls.add(len(prompts))
            return [SEVERE for _ in prompts]

        return model

    frame = inference.infer_cached(reports, "text", make, records.SEVERITY_REPORT, str(tmp_path / "c"))
    assert calls.value == 5
    assert frame.count() == 7 and frame.filter("record.severity = 'high'").count() == 6
    assert calls.value == 5


def test_finished_waves_survive_a_failure(spark, tmp_path):
    cache = str(tmp_path / "cache")
    prompts = spark.createDataFrame([(f"p{i}",) for i in range(40)], "text string")
    fuse = str(tmp_path / "fuse")

    def make():
        import os

        def model(batch):
            if "p7" in batch and not os.path.exists(fuse):
                open(fuse, "w").close()
                raise RuntimeError("the service went away")
            return [SEVERE for _ in batch]

        return model

    def run():
        return inference.infer_cached(prompts, "text", make, records.SEVERITY_REPORT, cache, waves=8)

    with pytest.raises(Exception, match="went away"):
        run()
    kept = inference.cached_calls(prompts, cache)
    assert 0 <= kept < 40
    assert run().filter("response is not null").count() == 40
    assert inference.cached_calls(prompts, cache) == 40


def test_first_writer_wins(spark, tmp_path, reports):
    cache = str(tmp_path / "cache")
    for second, answer in ((2, "late"), (1, "early")):
        spark.createDataFrame([("k", answer)], "key string, response string").withColumn(
            "written_at", F.lit(f"2100-01-01 00:00:0{second}").cast("timestamp")
        ).write.mode("append").parquet(cache)
    assert inference.read_cache(reports, cache).collect() == [("k", "early")]


def test_position(spark):
    payloads = [
        '{"message": "success", "iss_position": {"latitude": "-12.3400", "longitude": "045.1"}, "timestamp": 1}',
        '{"iss_position": {"latitude": -1.50, "longitude": 2}}',
        '{"iss_position": {}}',
        "no json",
        None,
    ]
    frame = spark.createDataFrame([(p,) for p in payloads], "p string")
    lines = [r.position_line for r in inference.parse_position(frame, "p").collect()]
    assert lines == [
        "latitude -12.3400, longitude 045.1",
        "latitude -1.5, longitude 2",
        None,
        None,
        None,
    ]


def test_lookup_of_any_size(spark):
    frame = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    assert [r[0] for r in frame.select(lookup(F.col("k"), {"a": 1})).collect()] == [1, None, None]
    many = {str(i): i for i in range(1500)} | {"b": -1}
    assert [r[0] for r in frame.select(lookup(F.col("k"), many)).collect()] == [None, -1, None]


def test_executors_do_not_need_the_package(tmp_path):
    """Run from a folder where Python workers cannot import it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from opsframe.plans import warehouse
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", warehouse.i2_infer(spark, "/root/testdata/sf0.001").count(), warehouse.i4_label(spark, "/root/testdata/sf0.001").filter("accepted").count() > 0)
spark.stop()
"""
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300
    )
    assert "rows 200 True" in run.stdout, run.stderr[-2000:]


def test_answers_written_twice_do_not_repeat_rows(spark, tmp_path, reports):
    cache = str(tmp_path / "cache")

    def run():
        return inference.infer_cached(reports, "text", MODEL, records.SEVERITY_REPORT, cache)

    first = sorted((r.id, r.response) for r in run().collect())
    spark.read.parquet(cache).withColumn("written_at", F.current_timestamp()).withColumn(
        "response", F.lit("another answer")
    ).write.mode("append").parquet(str(tmp_path / "late"))
    spark.read.parquet(str(tmp_path / "late")).write.mode("append").parquet(cache)
    assert inference.cached_calls(reports, cache) == 10
    assert sorted((r.id, r.response) for r in run().collect()) == first
