"""Texts, briefs and payloads turned into checked records by a model.

Each function returns (valid, rejected). Give a ``cache_path`` to ask the model
once per distinct prompt and keep the answers; without it, every action on
either frame asks again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions import records
from opsframe.operators import inference, relational
from opsframe.operators.inference import Model

Checked = tuple[DataFrame, DataFrame]


def checked_records(
    prompts: DataFrame,
    make_model: Callable[[], Model],
    schema: T.StructType,
    rules: Sequence,
    cache_path: str | None = None,
) -> Checked:
    """Ask the model for a record per ``prompt`` and check it."""
    if cache_path is None:
        scored = inference.infer(prompts, "prompt", make_model, schema)
    else:
        scored = inference.infer_cached(prompts, "prompt", make_model, schema, cache_path)
    return inference.validate(scored, "record", rules)


def severity_reports(
    reports: DataFrame, make_model: Callable[[], Model], cache_path: str | None = None
) -> Checked:
    """One severity record per report ``text``; ``inference.escalate`` picks the alerts."""
    asked = inference.build_prompts(reports, "Give this report one severity record.\n\n{}", ["text"])
    return checked_records(
        asked, make_model, records.SEVERITY_REPORT, records.SEVERITY_RULES, cache_path
    )


def file_reports(
    reports: DataFrame, make_model: Callable[[], Model], cache_path: str | None = None
) -> Checked:
    """One title and list of findings per file ``text``."""
    asked = inference.build_prompts(reports, "List each distinct anomaly of this file.\n\n{}", ["text"])
    return checked_records(asked, make_model, records.FILE_REPORT, records.FILE_REPORT_RULES, cache_path)


def findings_of(valid: DataFrame, key: str) -> DataFrame:
    """(key, title, anomaly_type, confidence, notes): one row per finding."""
    return valid.select(key, "record.title", F.inline("record.findings"))


def mission_plans(
    briefs: DataFrame, make_model: Callable[[], Model], cache_path: str | None = None
) -> Checked:
    """One plan per mission brief; the whole brief goes into the prompt as JSON."""
    brief = briefs.withColumn("_brief", inference.record_json(*briefs.columns))
    asked = inference.build_prompts(brief, "Plan this mission in steps: {}", ["_brief"]).drop("_brief")
    return checked_records(asked, make_model, records.MISSION_PLAN, records.MISSION_PLAN_RULES, cache_path)


def steps_of(valid: DataFrame, key: str) -> DataFrame:
    """(key, n, step): the steps of every plan, numbered from 1."""
    return relational.numbered(valid.select(key, "record.steps"), "steps", "step")


def model_lanes(manifests: DataFrame, make_model: Callable[[], Model]) -> DataFrame:
    """The lane a model chooses per manifest; ``routing.route_lane`` needs no model."""
    record = manifests.withColumn("_json", inference.record_json(*manifests.columns))
    asked = inference.build_prompts(record, "Choose one lane for this manifest: {}", ["_json"]).drop("_json")
    return inference.infer_label(asked, "prompt", make_model, records.LANES)


def telemetry_reports(
    payloads: DataFrame, make_model: Callable[[], Model], cache_path: str | None = None
) -> Checked:
    """One telemetry record per stored position ``payload``."""
    placed = inference.parse_position(payloads, "payload")
    asked = inference.build_prompts(placed, "Report on a craft at {}.", ["position_line"])
    return checked_records(asked, make_model, records.TELEMETRY_REPORT, records.TELEMETRY_RULES, cache_path)


def route_answer(question: str, routes: DataFrame, order_col: str, k: int, name: str = "route_name") -> DataFrame:
    """(question, top_routes, rationale): the k largest rows as one answer record."""
    top = relational.top_k(routes, order_col, k, [name])
    entry = F.struct((-F.col(order_col)).alias("key"), F.col(name).alias("name"))
    return top.agg(F.array_sort(F.collect_list(entry)).alias("ranked")).select(
        F.lit(question).alias("question"),
        F.col("ranked.name").alias("top_routes"),
        F.lit(f"largest {order_col} first").alias("rationale"),
    )
