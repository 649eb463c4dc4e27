import json

import pytest

from opsframe.operators import inference, relational
from opsframe.plans import reports

GRADES = inference.keyword_model(
    (("fire", inference.severity_json("critical", "s", ["engine", "hull"], "land")),),
    inference.severity_json("low", "s", [], "none"),
)


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame([(1, "a fire"), (2, "calm"), (3, "a fire")], "id int, text string")


@pytest.mark.parametrize("cached", [True, False])
def test_severity_reports(texts, tmp_path, cached):
    cache = str(tmp_path / "answers") if cached else None
    valid, rejected = reports.severity_reports(texts, GRADES, cache)
    assert rejected.count() == 0
    assert sorted(r.id for r in inference.escalate(valid).collect()) == [1, 3]
    systems = valid.filter("id = 1").select(relational.joined_list("record.affected_systems"))
    assert systems.first()[0] == "engine, hull"
    if cached:
        assert inference.cached_calls(texts, cache) == 2


def test_mission_plans(spark):
    briefs = spark.createDataFrame([("run", "Anchor", "Dock", 18.0)], "mission_name string, origin string, destination string, cargo_tonnes double")

    def make():
        def model(prompts):
            out = []
            for prompt in prompts:
                brief = json.loads(prompt.split(": ", 1)[1])
                plan = {k: brief[k] for k in ("mission_name", "origin", "destination")}
                out.append(json.dumps({**plan, "steps": ["load", "go"], "estimated_days": brief["cargo_tonnes"] / 2}))
            return out

        return model

    valid, _ = reports.mission_plans(briefs, make)
    assert valid.select("record.destination", "record.estimated_days").collect() == [("Dock", 9.0)]
    assert reports.steps_of(valid, "mission_name").collect() == [("run", 1, "load"), ("run", 2, "go")]


def test_file_reports(texts):
    model = inference.keyword_model(
        (("fire", '{"title": "f", "findings": [{"anomaly_type": "fire", "confidence": 0.9, "notes": "n"}]}'),),
        '{"title": "c", "findings": [{"anomaly_type": "x", "confidence": 2, "notes": "n"}]}',
    )
    valid, rejected = reports.file_reports(texts, model)
    assert sorted(reports.findings_of(valid, "id").collect()) == [(1, "f", "fire", 0.9, "n"), (3, "f", "fire", 0.9, "n")]
    assert [r.id for r in rejected.collect()] == [2]


def test_telemetry_reports(spark):
    payloads = spark.createDataFrame(
        [(1, '{"iss_position": {"latitude": "1.5", "longitude": "-2"}}'), (2, "nothing")], "id int, payload string"
    )

    def make():
        def answer(prompt):
            line = prompt.removeprefix("Report on a craft at ").removesuffix(".")
            grade = "a" if line else "z"
            return json.dumps({"signal_grade": grade, "headline": "h", "watch_items": ["w"], "position_line": line})

        return lambda prompts: [answer(p) for p in prompts]

    valid, rejected = reports.telemetry_reports(payloads, make)
    assert valid.select("id", "record.position_line").collect() == [(1, "latitude 1.5, longitude -2")]
    assert [(r.id, r.reasons) for r in rejected.collect()] == [(2, ["signal_grade: not allowed"])]


def test_route_answer(spark):
    routes = spark.createDataFrame([("short", 1.0), ("long", 9.0), ("middle", 5.0)], "route_name string, km double")
    answer = reports.route_answer("Which?", routes, "km", 2).first()
    assert (answer.question, answer.top_routes) == ("Which?", ["long", "middle"])
