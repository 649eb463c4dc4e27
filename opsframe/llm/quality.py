"""Quality rules on text statistics, and isolation forests for what the rules miss.

Statistics are counted once per document and stored. A forest for each statistic
and one for all of them together are grown on a bounded sample; every document
is scored by each, and the scores from which documents go are read off the
scores of all labelled rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.llm.batches import hash_share
from opsframe.sources.scratch import written

TREES = 40
SUBSAMPLE = 256
#: Rows of statistics that the forest is grown on, at most.
SAMPLE_ROWS = 20_000
#: Share of labelled good documents that one forest may drop, at most.
LOSS = 0.001
#: Share of bad ones among the labelled documents that it drops, at least.
PRECISION = 0.9
BINS = 1_000
SEED = 20_11
MIN_WORDS = 50
# Fixed value: the characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_STOPS = b".,;:!?"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_digits", "n_stops", "n_distinct",
)


def _without(text: bytes, some: bytes) -> int:
    return len(text) - len(text.translate(None, some))


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words inside a window of ``window`` words that the text has twice or more."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    code = np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)
    grams = code[:n]
    for k in range(1, window):
        joined = grams * len(ids) + code[k : k + n]
        _, grams = np.unique(joined, return_inverse=True)
    twice = np.bincount(grams)[grams] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    for k in range(window):
        cover[k : k + n] |= twice
    return int(cover.sum())


def statistics_of(text: bytes | None) -> dict[str, int]:
    text = text or b""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip(SPACE)]
    return {
        "n_words": len(words),
        "word_chars": len(text.translate(None, SPACE).decode()),
        "n_symbols": _without(text, SYMBOLS),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeated_words(words),
        "n_lines": len(lines),
        "n_upper": _without(text, _UPPER),
        "n_digits": _without(text, _DIGITS),
        "n_stops": _without(text, _STOPS),
        "n_distinct": len(set(words)),
    }


def statistics(text: Column) -> Column:
    """Struct of whole-text counts; null and empty texts count zero everywhere."""
    kind = pa.struct([(name, pa.int64()) for name in COUNTS])

    @F.arrow_udf("struct<" + ",".join(f"{name}:bigint" for name in COUNTS) + ">")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            raw = batch.cast(pa.binary())
            yield pa.array([statistics_of(x.as_py()) for x in raw], kind)

    return of(text)


def features(counts: dict[str, np.ndarray]) -> np.ndarray:
    """Rates that say how a text is written, one row per document."""
    c = {k: np.asarray(v, float) for k, v in counts.items()}
    words, lines = np.maximum(c["n_words"], 1), np.maximum(c["n_lines"], 1)
    chars = np.maximum(c["word_chars"], 1)
    return np.column_stack(
        [
            c["word_chars"] / words,
            c["n_symbols"] / words,
            c["n_dup_lines"] / lines,
            c["n_repeat_words"] / words,
            c["n_upper"] / chars,
            c["n_digits"] / chars,
            c["n_stops"] / words,
            np.log1p(c["n_words"] / lines),
            c["n_distinct"] / np.sqrt(words),
        ]
    )


def _average_path(n: np.ndarray) -> np.ndarray:
    n = np.asarray(n, float)
    h = np.log(np.maximum(n - 1, 1)) + np.euler_gamma
    return np.where(n > 2, 2 * h - 2 * (n - 1) / np.maximum(n, 1), np.where(n == 2, 1.0, 0.0))


class IsolationForest:
    """Random splits of small samples; rows that few splits isolate are anomalous."""

    def __init__(self, rows: np.ndarray, trees: int = TREES, size: int = SUBSAMPLE, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.size = min(size, len(rows))
        self.height = int(np.ceil(np.log2(max(self.size, 2))))
        nodes = 2 ** (self.height + 1) - 1
        self.column = np.zeros((trees, nodes), np.int64)
        self.cut = np.zeros((trees, nodes))
        self.path = np.full((trees, nodes), -1.0)
        for tree in range(trees):
            self._grow(tree, 0, 0, rows[rng.choice(len(rows), self.size, replace=False)], rng)

    def _grow(self, tree: int, node: int, depth: int, rows: np.ndarray, rng) -> None:
        low, high = (rows.min(axis=0), rows.max(axis=0)) if len(rows) else (None, None)
        able = np.nonzero(low < high)[0] if len(rows) > 1 else []
        if depth == self.height or not len(able):
            self.path[tree, node] = depth + float(_average_path(np.array(len(rows))))
            return
        column = int(rng.choice(able))
        cut = rng.uniform(low[column], high[column])
        self.column[tree, node], self.cut[tree, node] = column, cut
        left = rows[:, column] < cut
        self._grow(tree, 2 * node + 1, depth + 1, rows[left], rng)
        self._grow(tree, 2 * node + 2, depth + 1, rows[~left], rng)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Between 0 and 1; about a half for ordinary rows, higher for isolated ones."""
        total = np.zeros(len(rows))
        every = np.arange(len(rows))
        for column, cut, path in zip(self.column, self.cut, self.path, strict=True):
            node = np.zeros(len(rows), np.int64)
            for _ in range(self.height):
                inner = path[node] < 0
                right = rows[every, column[node]] >= cut[node]
                node = np.where(inner, 2 * node + 1 + right, node)
            total += path[node]
        usual = max(float(_average_path(np.array(self.size))), 1e-9)
        return 2.0 ** (-total / len(self.path) / usual)


def base_failed(counts: Column) -> Column:
    """Too few words, or over half of them in repeated three-word windows."""
    return (counts["n_words"] < MIN_WORDS) | (
        100 * counts["n_repeat_words"] > 50 * counts["n_words"]
    )


Forests = list[tuple[list[int], IsolationForest]]


def forests_of(rows: np.ndarray, seed: int = SEED) -> Forests:
    """One forest for each column and one for all of them."""
    columns = [[i] for i in range(rows.shape[1])] + [list(range(rows.shape[1]))]
    return [(some, IsolationForest(rows[:, some], seed=seed + i)) for i, some in enumerate(columns)]


def _grown(stats: DataFrame, id_col: str, seed: int) -> Forests:
    # The id tells documents of equal statistics apart, so that each is drawn by itself.
    passing = stats.where(~base_failed(F.col("__counts"))).select(
        F.xxhash64(F.lit(seed), id_col, "__counts").alias("__order"), "__counts.*"
    )
    # Only this share leaves the tasks.
    sample = (
        passing.where(hash_share(F.col("__order"), SAMPLE_ROWS, passing.count()))
        .orderBy("__order", *COUNTS)
        .limit(SAMPLE_ROWS)
        .toPandas()
    )
    if sample.empty:
        return []
    return forests_of(features({name: sample[name].to_numpy() for name in COUNTS}), seed)


def _scored(counts: Column, forests: Forests) -> Column:
    if not forests:
        return F.array().cast("array<double>")

    @F.arrow_udf("array<double>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            columns = {name: batch.field(i).to_numpy(zero_copy_only=False) for i, name in enumerate(COUNTS)}
            rows = features(columns)
            scores = np.column_stack([forest.scores(rows[:, some]) for some, forest in forests])
            yield pa.array(scores.tolist(), pa.list_(pa.float64()))

    return of(counts)


def thresholds(
    scored: DataFrame, labels: DataFrame, id_col: str, n_forests: int, loss: float = LOSS
) -> list[float]:
    """Per forest the score from which documents go, from all labelled rows that pass the rules.

    Of the bin bounds from which at most ``loss`` of the good rows lie, and at
    least ``PRECISION`` of the rows are bad, the one with most bad rows;
    infinity if there is none. A document with several labels counts by the
    best of them.
    """
    known = (
        labels.where(F.col("quality").isin(0, 1))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max("quality").alias("__good"))
    )
    bins = (
        scored.where(~base_failed(F.col("__counts")))
        .join(known, F.col(id_col) == F.col("__id"))
        .select("__good", F.posexplode("__scores").alias("forest", "score"))
        .groupBy("forest", F.floor(F.col("score") * BINS).cast("int").alias("bin"))
        .agg(F.sum("__good").alias("good"), F.sum(1 - F.col("__good")).alias("bad"))
        .collect()
    )
    good, bad = np.zeros((2, n_forests, BINS + 2))
    for row in bins:
        good[row["forest"], row["bin"]] = row["good"]
        bad[row["forest"], row["bin"]] = row["bad"]
    limits = []
    for mine in zip(good, bad, strict=True):
        above_good, above_bad = (np.cumsum(x[::-1])[::-1] for x in mine)
        able = (above_good <= loss * above_good[0]) & (
            above_bad >= PRECISION * (above_good + above_bad)
        )
        gain = np.where(able, above_bad, 0)
        # The highest bound that drops as many: nothing is known of scores below it.
        best = len(gain) - 1 - int(gain[::-1].argmax())
        limits.append(best / BINS if gain[best] > 0 else float("inf"))
    return limits


def judged(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    loss: float = LOSS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: id, the counts, ``anomalies`` (0 to 1), ``base_failed`` and ``kept``.

    ``anomalies`` has a score for each statistic of ``features`` and, last, one
    for all of them. ``kept`` is false if the rules fail or a score reaches its
    threshold.
    Null and empty texts have no words and fail. Without documents that pass the
    rules, or without labels, the rules alone decide. Repeated rows are judged
    alike; a null id is never labelled.
    """
    stats = written(
        docs.select(F.col(id_col), statistics(F.col(text_col)).alias("__counts")), "statistics"
    )
    forests = _grown(stats, id_col, seed)
    scored = written(stats.withColumn("__scores", _scored(F.col("__counts"), forests)), "scores")
    limits = thresholds(scored, labels, id_col, len(forests), loss)
    failed = base_failed(F.col("__counts"))
    odd = [F.col("__scores")[i] >= limit for i, limit in enumerate(limits) if limit <= 1]
    anomalous = reduce(lambda a, b: a | b, odd, F.lit(False))
    return scored.select(
        id_col,
        "__counts.*",
        F.col("__scores").alias("anomalies"),
        failed.alias("base_failed"),
        (~failed & ~anomalous).alias("kept"),
    )
