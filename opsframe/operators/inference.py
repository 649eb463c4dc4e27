"""Scoring a column of prompts with a model, as a distributed job.

The model is the only user code: a factory that returns ``model(list[str]) ->
list[str]``, called once per task. Only the prompt column crosses to Python, in
Arrow batches; all other columns stay in the JVM.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.shapes import INT, TEXT, TIMESTAMP, shape
from opsframe.functions.text import fixed
from opsframe.sources.scratch import read_parquet_or_empty, removed, shared_dir, written

Model = Callable[[list[str]], list[str]]

# Severities that raise an alert, and the position line.
ALERT_SEVERITIES = ("high", "critical")
POSITION_LINE = "latitude %s, longitude %s"

CACHE = shape(
    key=TEXT,
    response=TEXT,
    written_at=TIMESTAMP,
)


def keyword_model(answers: Sequence[tuple[str, str]], default: str) -> Callable[[], Model]:
    """Factory of a deterministic stand-in for a model: the first keyword found decides.

    ``answers`` are (keyword, response) in order of precedence. ``{size}`` in a
    response becomes the prompt length. Spark sends the functions themselves to
    the executors, which need not have this package.
    """

    def make() -> Model:
        def model(prompts: list[str]) -> list[str]:
            found = (next((r for word, r in answers if word in p), default) for p in prompts)
            return [response.replace("{size}", str(len(p))) for response, p in zip(found, prompts)]

        return model

    return make


def severity_json(severity: str, summary: str, systems: Sequence[str], action: str) -> str:
    return json.dumps(
        {
            "severity": severity,
            "summary": summary,
            "affected_systems": list(systems),
            "recommended_action": action,
        }
    )


def build_prompts(df: DataFrame, template: str, cols: Sequence[str], name: str = "prompt") -> DataFrame:
    """Adds the template with each ``{}`` filled from a column; null counts as empty.

    For a whole record as input, pass a column made by ``record_json``.
    """
    fixed_parts = template.split("{}")
    if len(fixed_parts) != len(cols) + 1:
        raise ValueError(f"{len(cols)} columns for {len(fixed_parts) - 1} places in the template")
    pieces = [F.lit(fixed_parts[0])]
    for column, text in zip(cols, fixed_parts[1:]):
        pieces += [F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(text)]
    return df.withColumn(name, F.concat(*pieces))


def record_json(*cols: str) -> Column:
    """A row's fields as one JSON object."""
    return F.to_json(F.struct(*cols))


def respond(prompt: Column, make_model: Callable[[], Model], request_size: int = 256) -> Column:
    """The model's raw response to every prompt.

    The model is built once per task and sees at most ``request_size`` prompts
    per call. The call counts as nondeterministic so that Catalyst neither
    repeats it nor moves it past a filter. Null prompts give null responses.
    """

    @F.pandas_udf(T.StringType())
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make_model()
        for batch in batches:
            asked = batch[batch.notna()]
            answers: list[str] = []
            for start in range(0, len(asked), request_size):
                answers.extend(model(asked.iloc[start : start + request_size].tolist()))
            yield pd.Series(answers, index=asked.index, dtype=object).reindex(batch.index)

    return call.asNondeterministic()(prompt)


def infer(
    df: DataFrame,
    prompt_col: str,
    make_model: Callable[[], Model],
    schema: T.StructType,
    *,
    request_size: int = 256,
    concurrency: int | None = None,
) -> DataFrame:
    """Adds ``response`` (raw text) and ``record`` (parsed to the schema, or null fields).

    ``concurrency`` sets the number of tasks that call the model at a time by a
    round-robin repartition, which also evens out long and short texts.
    """
    spread = df if concurrency is None else df.repartition(concurrency)
    return spread.withColumn("response", respond(F.col(prompt_col), make_model, request_size)).withColumn(
        "record", F.from_json("response", schema)
    )


def validate(df: DataFrame, record_col: str, rules: Sequence) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected): every row is in exactly one; rejects carry ``reasons``.

    Unreadable JSON parses to a record of nulls and is rejected by the required
    fields; keep the raw response column to see what came back. Both frames
    start from ``df``: store a scored frame first (``infer_cached`` does), or
    each of them asks the model.
    """
    checked = df.withColumn(
        "reasons", F.array_compact(F.array(*[rule.problem(F.col(record_col)) for rule in rules]))
    )
    valid = checked.filter(F.size("reasons") == 0).drop("reasons")
    return valid, checked.filter(F.size("reasons") > 0)


def infer_label(
    df: DataFrame, prompt_col: str, make_model: Callable[[], Model], labels: Sequence[str]
) -> DataFrame:
    """Adds ``response``, ``label`` (null when off the list) and ``accepted``."""
    asked = df.withColumn("response", respond(F.col(prompt_col), make_model))
    accepted = F.coalesce(F.col("response").isin(*labels), F.lit(False))
    return asked.withColumn("label", F.when(accepted, F.col("response"))).withColumn("accepted", accepted)


@dataclass(frozen=True)
class FindingRule:
    """A pattern that reports one anomaly type; the text of a match becomes its notes.

    ``needle`` is text that every match contains: looking for it first is much
    cheaper than running the pattern over texts that cannot match.
    """

    anomaly_type: str
    pattern: str
    confidence: float
    needle: str = ""


def findings_of_text(text: Column, rules: Sequence[FindingRule]) -> Column:
    """The distinct findings of one whole text, every match of every rule, as a list of records."""

    def found(rule: FindingRule) -> Column:
        matches = F.array_distinct(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)))
        here = text.contains(rule.needle) if rule.needle else text.isNotNull()
        records = F.transform(
            F.when(here, matches).otherwise(F.array().cast("array<string>")),
            lambda match: F.struct(
                F.lit(rule.anomaly_type).alias("anomaly_type"),
                F.lit(rule.confidence).alias("confidence"),
                match.alias("notes"),
            ),
        )
        return records

    return F.array_distinct(F.flatten(F.array(*[found(rule) for rule in rules])))


def extract_findings(docs: DataFrame, text_col: str, rules: Sequence[FindingRule]) -> DataFrame:
    """One row per document and distinct finding: anomaly_type, confidence, notes.

    The rules become one array expression over the text, so documents are
    neither joined with the rules nor shuffled for the distinct step.
    """
    others = [c for c in docs.columns if c != text_col]
    return docs.select(*others, F.inline(findings_of_text(F.col(text_col), rules)))


def finding_line() -> Column:
    """A finding as one line: type, confidence with two decimals, notes (a fixed format)."""
    return F.concat(
        F.col("anomaly_type"), F.lit(" (confidence="), fixed(F.col("confidence")), F.lit("): "), F.col("notes")
    )


def escalate(df: DataFrame, severity: str = "record.severity") -> DataFrame:
    """Rows whose severity calls for an alert."""
    return df.filter(F.col(severity).isin(*ALERT_SEVERITIES))


def prompt_key(prompt: Column, model_id: str) -> Column:
    return F.sha2(F.concat(F.lit(model_id + "\n"), prompt), 256)


def read_cache(df: DataFrame, cache_path: str) -> DataFrame:
    """(key, response): the first answer written per key."""
    stored = read_parquet_or_empty(df.sparkSession, cache_path, CACHE)
    first = F.min(F.struct("written_at", "response")).alias("first")
    return stored.groupBy("key").agg(first).select("key", F.col("first.response").alias("response"))


def unique_answers(df: DataFrame, cache_path: str) -> DataFrame:
    """``read_cache`` as a plain table scan, so that AQE can split a skewed join with it.

    Keys repeat only after writers ran at the same time; then the first answers
    are stored once more without the repeats.
    """
    stored = read_parquet_or_empty(df.sparkSession, cache_path, CACHE)
    repeated = stored.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
    if repeated.isEmpty():
        return stored.select("key", "response")
    return written(read_cache(df, cache_path), "answers")


def infer_cached(
    df: DataFrame,
    prompt_col: str,
    make_model: Callable[[], Model],
    schema: T.StructType,
    cache_path: str,
    *,
    model_id: str = "model",
    waves: int = 4,
) -> DataFrame:
    """``infer`` with a durable cache: a prompt answered before is not asked again.

    Distinct unanswered prompts go to the model and are appended to the Parquet
    table at ``cache_path``; the result joins back to that table, so losing an
    executor while reading the result never calls the model again. ``waves``
    splits the calls into that many appends, so that a failed run keeps the
    finished ones. Copies of a prompt collapse before the shuffle; the hot key
    they leave in the join back is on the probe side, where AQE splits it.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_key", prompt_key(F.col(prompt_col), model_id))
    wanted = keyed.filter(F.col("_key").isNotNull()).select(
        F.col("_key").alias("key"), F.col(prompt_col).alias("prompt")
    )
    known = read_parquet_or_empty(spark, cache_path, CACHE).select("key")
    pending = wanted.distinct().join(known, "key", "left_anti")
    parts, store = [pending], None
    if waves > 1:
        store = shared_dir(spark, "pending")
        wave = F.pmod(F.xxhash64("key"), F.lit(waves)).cast("int")
        pending.withColumn("wave", wave).write.partitionBy("wave").parquet(store)
        stored = spark.read.schema(shape(key=TEXT, prompt=TEXT, wave=INT)).parquet(store)
        parts = [] if stored.isEmpty() else [stored.filter(F.col("wave") == w) for w in range(waves)]
    for part in parts:
        part.select(
            "key",
            respond(F.col("prompt"), make_model).alias("response"),
            F.current_timestamp().alias("written_at"),
        ).write.mode("append").parquet(cache_path)
    if store is not None:
        removed(spark, store)
    answers = unique_answers(df, cache_path).withColumnRenamed("key", "_key")
    return (
        keyed.join(answers, "_key", "left")
        .drop("_key")
        .withColumn("record", F.from_json("response", schema))
    )


def cached_calls(df: DataFrame, cache_path: str) -> int:
    """How many model calls the cache holds."""
    return read_parquet_or_empty(df.sparkSession, cache_path, CACHE).count()


def parse_position(df: DataFrame, json_col: str, root: str = "iss_position") -> DataFrame:
    """Adds latitude, longitude and position_line from a stored payload, as sent.

    A payload without a position gives nulls.
    """
    payload = shape(**{root: shape(latitude=TEXT, longitude=TEXT)})
    place = F.col(f"_payload.`{root}`")
    line = F.when(
        F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
        F.format_string(POSITION_LINE, "latitude", "longitude"),
    )
    return (
        df.withColumn("_payload", F.from_json(json_col, payload))
        .withColumn("latitude", place["latitude"])
        .withColumn("longitude", place["longitude"])
        .withColumn("position_line", line)
        .drop("_payload")
    )
