"""Schemas and checking rules of the typed output records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from opsframe.functions.shapes import BOOLEAN, DOUBLE, TEXT, TEXTS, list_of, shape

# Record fields, allowed words and bounds.
SEVERITIES = ("low", "medium", "high", "critical")
LANES = ("fast_lane", "customs_review", "quarantine")
SIGNAL_GRADES = ("a", "b", "c", "d")

SEVERITY_REPORT = shape(
    severity=TEXT,
    summary=TEXT,
    affected_systems=TEXTS,
    recommended_action=TEXT,
)
CARGO_DECISION = shape(
    lane=TEXT,
    reason=TEXT,
    risk_score=DOUBLE,
)
MISSION_PLAN = shape(
    mission_name=TEXT,
    origin=TEXT,
    destination=TEXT,
    steps=TEXTS,
    estimated_days=DOUBLE,
)
FINDING = shape(
    anomaly_type=TEXT,
    confidence=DOUBLE,
    notes=TEXT,
)
FILE_REPORT = shape(
    title=TEXT,
    findings=list_of(FINDING),
)
ROUTE_ANSWER = shape(
    question=TEXT,
    top_routes=TEXTS,
    rationale=TEXT,
)
TELEMETRY_REPORT = shape(
    signal_grade=TEXT,
    headline=TEXT,
    watch_items=TEXTS,
    position_line=TEXT,
)
COMPATIBILITY_REPORT = shape(compatible=BOOLEAN, mismatches=TEXTS, suggested_actions=TEXTS)


@dataclass(frozen=True)
class Required:
    """The field is present and not null."""

    field: str

    def problem(self, record: Column) -> Column:
        return F.when(record[self.field].isNull(), F.lit(f"{self.field}: missing"))


@dataclass(frozen=True)
class OneOf:
    """The field, when present, is one of the given words."""

    field: str
    values: tuple[str, ...]

    def problem(self, record: Column) -> Column:
        return F.when(
            ~record[self.field].isin(*self.values), F.lit(f"{self.field}: not allowed")
        )


@dataclass(frozen=True)
class Between:
    """The field, when present, lies in a closed range."""

    field: str
    low: float
    high: float

    def problem(self, record: Column) -> Column:
        return F.when(
            ~record[self.field].between(self.low, self.high),
            F.lit(f"{self.field}: out of range"),
        )


@dataclass(frozen=True)
class NoNulls:
    """The list field, when present, holds no null element."""

    field: str

    def problem(self, record: Column) -> Column:
        return F.when(
            F.exists(record[self.field], lambda x: x.isNull()),
            F.lit(f"{self.field}: null element"),
        )


@dataclass(frozen=True)
class Each:
    """Every record of a list field keeps the inner rule."""

    field: str
    rule: object

    def problem(self, record: Column) -> Column:
        broken = F.exists(
            record[self.field], lambda item: self.rule.problem(item).isNotNull()
        )
        return F.when(broken, F.lit(f"{self.field}[].{self.rule.field}: invalid"))


def required(*fields: str) -> list:
    return [Required(f) for f in fields]


SEVERITY_RULES = [
    *required("severity", "summary", "affected_systems", "recommended_action"),
    OneOf("severity", SEVERITIES),
    NoNulls("affected_systems"),
]
CARGO_DECISION_RULES = [
    *required("lane", "reason", "risk_score"),
    OneOf("lane", LANES),
    Between("risk_score", 0.0, 1.0),
]
MISSION_PLAN_RULES = [
    *required("mission_name", "origin", "destination", "steps", "estimated_days"),
    NoNulls("steps"),
]
FINDING_RULES = [
    *required("anomaly_type", "confidence", "notes"),
    Between("confidence", 0.0, 1.0),
]
FILE_REPORT_RULES = [
    *required("title", "findings"),
    NoNulls("findings"),
    *[Each("findings", rule) for rule in FINDING_RULES],
]
ROUTE_ANSWER_RULES = [
    *required("question", "top_routes", "rationale"),
    NoNulls("top_routes"),
]
TELEMETRY_RULES = [
    *required("signal_grade", "headline", "watch_items", "position_line"),
    OneOf("signal_grade", SIGNAL_GRADES),
    NoNulls("watch_items"),
]
