"""Review decisions folded into one state per item."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from opsframe.operators.relational import join_stored

APPROVE, REJECT, CHANGES = "approve", "reject", "changes"
# Default limits of a review.
MAX_ITERATIONS = 3
TIMEOUT = timedelta(hours=1)
STATES = ("approved", "rejected", "exhausted", "timed_out", "pending")


def review_state(
    decisions: DataFrame,
    *,
    as_of: datetime,
    max_iterations: int = MAX_ITERATIONS,
    timeout: timedelta = TIMEOUT,
) -> DataFrame:
    """(item, state, decided_at, opened_at): where each item stands at ``as_of``.

    ``decisions`` holds item, ts, seq (settles equal times) and decision:
    approve, reject or changes; any other word only opens the item. An item
    opens at its first row. Up to the deadline, the first of these ends it: an
    approval, a rejection, or one change request more than ``max_iterations``.
    Otherwise it is timed_out when the deadline has passed, else pending.

    No task holds all rows of an item: the first decision is an aggregate (of
    a struct, so Spark sorts each task's rows for it, before the shuffle and
    the few partial results after it), and the rank of change requests is cut to
    ``max_iterations + 1`` in every task before the shuffle (by Spark, for
    limits up to 1000).
    """
    limit = max_iterations + 1
    now = F.lit(as_of.isoformat(sep=" ")).cast(decisions.schema["ts"].dataType)
    seen = decisions.filter(F.col("ts") <= now)
    terminal = F.col("decision").isin(APPROVE, REJECT)
    per_item = seen.groupBy("item").agg(
        F.min("ts").alias("opened_at"),
        F.min(F.when(terminal, F.struct("ts", "seq", "decision"))).alias("decided"),
    )
    order = Window.partitionBy("item").orderBy("ts", "seq")
    exhausting = (
        seen.filter(F.col("decision") == CHANGES)
        .select("item", "ts", "seq")
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= limit)
        .filter(F.col("rank") == limit)
        .select("item", F.struct("ts", "seq").alias("spent"))
    )
    deadline = F.col("opened_at") + F.lit(timeout)
    decided_in_time = F.col("decided.ts") <= F.col("deadline")
    spent_in_time = F.col("spent.ts") <= F.col("deadline")
    spent_first = F.col("decided").isNull() | (
        F.col("spent") < F.struct(F.col("decided.ts").alias("ts"), F.col("decided.seq").alias("seq"))
    )
    state = (
        F.when(spent_in_time & spent_first, F.lit("exhausted"))
        .when(decided_in_time & (F.col("decided.decision") == APPROVE), F.lit("approved"))
        .when(decided_in_time, F.lit("rejected"))
        .when(now > F.col("deadline"), F.lit("timed_out"))
        .otherwise(F.lit("pending"))
    )
    return (
        per_item.join(exhausting, "item", "left")
        .withColumn("deadline", deadline)
        .withColumn("state", state)
        .select(
            "item",
            "state",
            F.when(F.col("state") == "exhausted", F.col("spent.ts"))
            .when(F.col("state").isin("approved", "rejected"), F.col("decided.ts"))
            .when(F.col("state") == "timed_out", F.col("deadline"))
            .alias("decided_at"),
            "opened_at",
        )
    )


def approved_only(proposals: DataFrame, states: DataFrame, on: tuple[str, str]) -> DataFrame:
    """Proposals whose item was approved; one item may have most of the proposals."""
    approved = states.filter(F.col("state") == "approved").select(F.col(on[1]).alias("_item"))
    return join_stored(
        proposals.withColumn("_item", F.col(on[0])), approved, "_item", "left_semi"
    ).drop("_item")
