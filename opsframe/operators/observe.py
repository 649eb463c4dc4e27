"""Counting and timing steps without changing their result."""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

log = logging.getLogger(__name__)


def observed(
    df: DataFrame, name: str, metrics: Mapping[str, Column] | None = None
) -> tuple[DataFrame, Observation]:
    """The same frame, plus metrics filled in by the first action that runs it."""
    observation = Observation(name)
    asked = dict(metrics or {"n_rows": F.count(F.lit(1))})
    return df.observe(observation, *[m.alias(n) for n, m in asked.items()]), observation


@dataclass(frozen=True)
class StepLog:
    """What one step did."""

    name: str
    seconds: float
    metrics: Mapping[str, Any]


def run_observed(
    df: DataFrame,
    name: str,
    action: Callable[[DataFrame], Any],
    metrics: Mapping[str, Column] | None = None,
) -> tuple[Any, StepLog]:
    """Run an action on the frame, log and return its metrics and duration."""
    watched, observation = observed(df, name, metrics)
    start = time.perf_counter()
    result = action(watched)
    step = StepLog(name, time.perf_counter() - start, observation.get)
    log.info("%s: %.3f s, %s", step.name, step.seconds, step.metrics)
    return result, step
