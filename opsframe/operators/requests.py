"""Model calls that may fail: balanced requests, errors kept per prompt, and a limited number of waves."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.shapes import TEXT, shape
from opsframe.operators.inference import Model
from opsframe.sources.scratch import written

# Sent to the executors by value, so that they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

REQUEST_BYTES = 64 << 10
REQUEST_SIZE = 256
OUTCOME = shape(response=TEXT, error=TEXT)


def packed(sizes: list[int], most_bytes: int, most: int) -> list[list[int]]:
    """Places of items in as few requests as their bytes and number ask for, of about equal bytes.

    The largest items are dealt first, each to the request with the fewest bytes
    that has room for one more. An item over the bound is a request of its own.
    """
    from heapq import heapify, heappop, heappush

    single = [[i] for i, size in enumerate(sizes) if size >= most_bytes]
    rest = sorted((i for i, size in enumerate(sizes) if size < most_bytes), key=lambda i: -sizes[i])
    if not rest:
        return single
    n = max(-(-sum(sizes[i] for i in rest) // most_bytes), -(-len(rest) // most))
    bins: list[list[int]] = [[] for _ in range(n)]
    heap = [(0, k) for k in range(n)]
    heapify(heap)
    for i in rest:
        load, k = heappop(heap)
        bins[k].append(i)
        if len(bins[k]) < most:
            heappush(heap, (load + sizes[i], k))
    return single + [b for b in bins if b]


def respond_or_fail(
    prompt: Column,
    make_model: Callable[[], Model],
    request_bytes: int = REQUEST_BYTES,
    request_size: int = REQUEST_SIZE,
) -> Column:
    """A struct of the model's response and the error that kept it from giving one.

    A request that fails is halved until the prompts are found that fail alone, so
    one bad prompt costs a request a few more calls and no other prompt its answer.
    A model that returns too few or too many answers has failed. Null prompts have
    neither response nor error.
    """

    @F.pandas_udf(OUTCOME)
    def call(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make_model()

        def ask(prompts: list[str]) -> list[tuple[str | None, str | None]]:
            try:
                answers = list(model(prompts))
                if len(answers) != len(prompts):
                    raise ValueError(f"{len(answers)} answers to {len(prompts)} prompts")
                return [(answer, None) for answer in answers]
            except Exception as error:  # whatever the model's own code raises
                if len(prompts) == 1:
                    return [(None, f"{type(error).__name__}: {error}")]
                half = len(prompts) // 2
                return ask(prompts[:half]) + ask(prompts[half:])

        for batch in batches:
            prompts = batch.tolist()
            asked = [i for i, p in enumerate(prompts) if p is not None]
            out: list[tuple[str | None, str | None]] = [(None, None)] * len(prompts)
            sizes = [len(prompts[i].encode()) for i in asked]
            for places in packed(sizes, request_bytes, request_size):
                mine = [asked[k] for k in places]
                for i, outcome in zip(mine, ask([prompts[i] for i in mine]), strict=True):
                    out[i] = outcome
            yield pd.DataFrame(out, columns=["response", "error"], dtype=object)

    return call.asNondeterministic()(prompt)


def infer_retried(
    df: DataFrame,
    prompt_col: str,
    make_model: Callable[[], Model],
    schema: T.StructType,
    *,
    attempts: int = 3,
    request_bytes: int = REQUEST_BYTES,
    request_size: int = REQUEST_SIZE,
) -> tuple[DataFrame, DataFrame]:
    """(answered, given_up): every row is in exactly one, both are stored tables.

    ``answered`` has ``response``, ``record`` and ``attempt``, the wave that
    answered it; ``given_up`` has ``error``, the last one, and ``attempt``. Rows
    whose prompt failed are asked again in the next wave, ``attempts`` waves in
    all. Each wave is stored before the next begins: a lost executor repeats what
    its wave lacks, and no answered prompt is asked again. A null prompt is
    answered by null.
    """
    if attempts < 1:
        raise ValueError("attempts: at least one")
    done, left = [], df
    for attempt in range(1, attempts + 1):
        outcome = respond_or_fail(F.col(prompt_col), make_model, request_bytes, request_size)
        wave = written(left.withColumn("_outcome", outcome), "wave")
        answered = wave.filter("_outcome.error is null")
        done.append(
            answered.withColumn("response", F.col("_outcome.response"))
            .withColumn("record", F.from_json("response", schema))
            .withColumn("attempt", F.lit(attempt))
            .drop("_outcome")
        )
        failed = wave.filter("_outcome.error is not null")
        left = failed.drop("_outcome")
        if attempt == attempts or left.isEmpty():
            break
    answered = done[0]
    for more in done[1:]:
        answered = answered.unionByName(more)
    given_up = failed.withColumn("error", F.col("_outcome.error")).withColumn("attempt", F.lit(attempt)).drop("_outcome")
    return answered, given_up
