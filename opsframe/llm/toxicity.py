"""Toxic documents by non-negative positive-unlabelled learning.

Only texts confirmed as toxic teach what toxic is; all other texts are
unlabelled, toxic ones among them. A linear classifier in numpy minimises the
logistic risk estimated from both with the share of toxic documents (the class
prior), whose negative part is kept from falling below zero.

A document's features are its distinct words, their beginnings, and the beginnings
that several of its words share. Which of them the classifier sees is decided by
counts over every document, copies of a text counted once; it is fitted on bounded
samples of rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from math import exp, lgamma, log, sqrt
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.sources.scratch import written

FOLDS = 4
HELD_OUT = 2
CUT = 0.3
#: Rows the classifier is fitted on, at most: confirmed and unlabelled ones.
POSITIVES = 8_000
UNLABELLED = 16_000
PREFIXES = (4, 5, 6)
#: A feature is used if its count among toxic texts is less likely by chance (a logarithm).
CHANCE = -15.0
ROUNDS = 400
#: Features that a task counts before it passes the counts on.
COUNTED_AT_ONCE = 200_000
#: Remainders of feature hashes, by which counts over all texts are filtered before they are shuffled.
BITS = 1 << 20
#: Bits of the filter of texts that have copies (8 MB); a table with more of them shuffles more texts.
COPY_BITS = 1 << 26
SEED = 8
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def features_of(text: bytes | None) -> set[str]:
    """Distinct words, A-Z lower-cased, their first characters (marked with ``*``), and those of
    two or more of the words (marked with ``**``)."""
    words = {w.decode() for w in (text or b"").translate(_FOLD).split()}
    found = set(words)
    for n in PREFIXES:
        for start, times in Counter([w[:n] for w in words if len(w) >= n]).items():
            found.add(start + "*")
            if times > 1:
                found.add(start + "**")
    return found


class Known:
    """Some features, and which of them a text has: ``features_of`` without forming all others."""

    def __init__(self, features: Iterable[str]):
        self.features = frozenset(features)
        marked = {f.rstrip("*") for f in self.features if f.endswith("*")}
        self.starts = {n: frozenset(x for x in marked if len(x) == n) for n in PREFIXES}

    def of(self, text: bytes | None) -> set[str]:
        words = {w.decode() for w in (text or b"").translate(_FOLD).split()}
        found = words & self.features
        for n, starts in self.starts.items():
            begun = [w[:n] for w in words if len(w) >= n]
            for start in starts.intersection(begun):
                found.add(start + "*")
                if begun.count(start) > 1:
                    found.add(start + "**")
        return found & self.features


def in_fold(id_col: str) -> Column:
    """Whether labels of the id may be learned from; a null id has none."""
    return F.crc32(F.col(id_col).cast("string")) % FOLDS != HELD_OUT


def _in_filter(filter_: bytes, hashes: pa.Array) -> np.ndarray:
    bit = hashes.to_numpy(zero_copy_only=False).astype(np.int64) & (8 * len(filter_) - 1)
    return np.frombuffer(filter_, np.uint8)[bit >> 3] >> (bit & 7) & 1 > 0


def _may_repeat(filter_: bytes, hashed: Column) -> Column:
    @F.arrow_udf("boolean")
    def of(hashes: pa.Array) -> pa.Array:
        return pa.array(_in_filter(filter_, hashes))

    return of(hashed)


def _copied(copies: DataFrame) -> bytes:
    """The filter of the hashes ``__h`` of stored texts (``__h``, ``__g``, ``times``) that repeat."""
    bit = F.pmod(F.col("__h"), F.lit(COPY_BITS)) + 1
    parts = (
        copies.where("times > 1")
        .groupBy(F.bitmap_bucket_number(bit).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits"))
    )
    filter_ = np.zeros(COPY_BITS // 8, np.uint8)
    for row in parts.collect():
        bits = np.frombuffer(bytes(row["bits"]), np.uint8)
        start = (row["part"] - 1) * len(bits)
        filter_[start : start + len(bits)] = bits
    return filter_.tobytes()


def _counts(wanted: bytes | None, copied: bytes | None = None):
    """Per task, how many of its texts have each feature, in parts.

    Counts of features whose bit of ``wanted`` is not set are not passed on.
    Texts whose hash, the second column, is in the filter ``copied`` are passed over.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            some = [f for f in counts if wanted is None or wanted[crc32(f.encode()) % BITS]]
            return pa.RecordBatch.from_arrays(
                [pa.array(some, pa.string()), pa.array([counts[f] for f in some], pa.int64())],
                ["feature", "n"],
            )

        for batch in batches:
            texts = batch.column(0).cast(pa.binary())
            if copied is not None:
                texts = texts.filter(pa.array(~_in_filter(copied, batch.column(1))))
            for raw in texts:
                for feature in features_of(raw.as_py()):
                    counts[feature] = counts.get(feature, 0) + 1
                if len(counts) > COUNTED_AT_ONCE:
                    yield out()
                    counts = {}
        yield out()

    return of


def _counted(texts: DataFrame, wanted: bytes | None = None, copied: bytes | None = None) -> DataFrame:
    """How many of the texts have each feature.

    With the filter ``copied`` the texts are those of a frame by ``_keyed``, and each
    counts once: only those in the filter shuffle, to find one of their copies.
    """
    kind = "feature string, n long"
    if copied is None:
        parts = texts.mapInArrow(_counts(wanted), kind)
    else:
        again = _distinct(texts.where(_may_repeat(copied, F.col("__h")))).select("text")
        parts = texts.select("__text", "__h").mapInArrow(_counts(wanted, copied), kind)
        parts = parts.union(again.mapInArrow(_counts(wanted), kind))
    return parts.groupBy("feature").agg(F.sum("n").alias("n"))


def _bits(features: DataFrame) -> bytes:
    """One byte for each remainder of a feature's hash: whether any feature has it."""
    bits = np.zeros(BITS, np.uint8)
    bits[features.select((F.crc32("feature") % BITS).alias("bit")).distinct().toPandas()["bit"].to_numpy(int)] = 1
    return bits.tobytes()


def _chance(n: Column, expected: Column) -> Column:
    """Of that count by Poisson's law, as a logarithm."""

    @F.arrow_udf("double")
    def of(n: pa.Array, expected: pa.Array) -> pa.Array:
        pairs = zip(n.to_pylist(), expected.to_pylist(), strict=True)
        return pa.array([k * log(x) - x - lgamma(k + 1) for k, x in pairs], pa.float64())

    return of(n, expected)


def _rows(known: dict[str, int]):
    """Numbers of the known features that a text has."""
    some = Known(known)

    @F.arrow_udf("array<int>")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            raw = batch.cast(pa.binary())
            yield pa.array(
                [sorted(known[f] for f in some.of(x.as_py())) for x in raw],
                pa.list_(pa.int32()),
            )

    return of


class Risk:
    """The non-negative risk of a linear score and its gradient."""

    def __init__(self, positive: list[list[int]], unlabelled: list[list[int]], prior: float, n: int):
        self.prior, self.n = prior, n
        self.parts = []
        for rows in (positive, unlabelled):
            at = np.repeat(np.arange(len(rows)), [len(x) for x in rows])
            columns = np.fromiter((c for x in rows for c in x), np.int64)
            sizes = np.array([max(len(x), 1) for x in rows])
            self.parts.append((at, columns, 1 / np.sqrt(sizes[at]), len(rows)))

    def _score(self, part, weights: np.ndarray, bias: float) -> np.ndarray:
        at, columns, share, rows = part
        return np.bincount(at, weights[columns] * share, rows) + bias

    def _back(self, part, slopes: np.ndarray) -> tuple[np.ndarray, float]:
        at, columns, share, _ = part
        return np.bincount(columns, slopes[at] * share, self.n), float(slopes.sum())

    def gradient(self, weights: np.ndarray, bias: float) -> tuple[np.ndarray, float]:
        """Of prior * positive loss + max(0, unlabelled negative loss - prior * positive's).

        Below zero the second part is climbed back instead of followed.
        """
        p, u = (self._score(part, weights, bias) for part in self.parts)
        negative = np.logaddexp(0, u).mean() - self.prior * np.logaddexp(0, p).mean()
        up_p, up_u = 1 / (1 + np.exp(-p)), 1 / (1 + np.exp(-u))
        positive_slope = self.prior * (up_p - 1) / len(p)
        p_slope, u_slope = -self.prior * up_p / len(p), up_u / len(u)
        if negative >= 0:
            p_slope = p_slope + positive_slope
        else:
            p_slope, u_slope = -p_slope, -u_slope
        a, x = self._back(self.parts[0], p_slope)
        b, y = self._back(self.parts[1], u_slope)
        return a + b, x + y


def fitted(risk: Risk, rounds: int = ROUNDS, rate: float = 0.1, decay: float = 1e-4):
    """Weights and bias after ``rounds`` Adam steps."""
    theta = np.zeros(risk.n + 1)
    theta[-1] = np.log(risk.prior / (1 - risk.prior))
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, rounds + 1):
        slope, bias = risk.gradient(theta[:-1], theta[-1])
        slope = np.r_[slope + decay * theta[:-1], bias]
        first = 0.9 * first + 0.1 * slope
        second = 0.999 * second + 0.001 * slope**2
        theta -= rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return theta[:-1], float(theta[-1])


class Classifier:
    """Feature weights; a text's score is the logistic function of their scaled sum.

    The sum is divided by the root of the number of features found.
    """

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias
        self.known = Known(weights)

    def score(self, text: bytes | None) -> float:
        found = sorted(self.weights[f] for f in self.known.of(text))
        return 1 / (1 + exp(-self.bias - sum(found) / sqrt(max(len(found), 1))))


def class_prior(confirmed: list[list[int]], share: float, known: float) -> float:
    """The share of toxic texts: that among labelled ones, or less if their features say so.

    ``share`` is that of all texts with a feature. It is at least the class
    prior times its share among toxic texts, which bounds the prior, however
    labels were chosen.
    """
    toxic = sum(map(bool, confirmed)) / max(len(confirmed), 1)
    bound = share / toxic if toxic else known
    return max(min(known, bound), 1e-4)


def _keyed(docs: DataFrame, text_col: str, seed: int) -> DataFrame:
    """``docs`` with the text and its two hashes, which copies of it share."""
    text = F.col(text_col)
    return docs.withColumns(
        {"__h": F.xxhash64(F.lit(seed), text), "__g": F.xxhash64(F.lit(seed + 1), text), "__text": text}
    )


def _distinct(keyed: DataFrame) -> DataFrame:
    """Each text once, however many copies it has."""
    return keyed.groupBy("__h", "__g").agg(F.min("__text").alias("text"))


def _chosen(
    positive: DataFrame, texts: DataFrame, n_positive: int, total: int, copied: bytes | None = None
) -> list[str]:
    """Features that point to toxic texts, by counts over the ``total`` distinct texts.

    Three or more of the confirmed texts have each, so those bound their number.
    """
    n, expected = F.col("n"), F.col("expected")
    mine = written(_counted(positive).where(n >= 3), "features")
    # The bits spare the shuffle of most other features; the join drops the rest of them.
    every = _counted(texts, _bits(mine), copied).withColumnRenamed("n", "every")
    both = mine.join(every, "feature")
    more = both.withColumn("expected", F.col("every") * n_positive / total).where(n >= 3 * expected)
    # The longest of a word's beginnings that have the same counts stands for them all.
    longest = F.min_by("feature", F.struct(-F.length("feature"), "feature")).alias("feature")
    ones = more.groupBy(F.substring("feature", 1, min(PREFIXES)), n, "every", expected).agg(longest)
    found = ones.withColumn("chance", _chance(n, expected)).where(F.col("chance") <= CHANCE)
    return [r["feature"] for r in found.orderBy("chance", "feature").collect()]


def trained(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, seed: int = SEED) -> Classifier:
    """Fit on labels of the training folds; a document with several labels is toxic if one says so."""
    known = (
        labels.where(F.col("toxic").isin(0, 1) & in_fold(id_col))
        .groupBy(F.col(id_col).alias("__id"))
        .agg(F.max("toxic").alias("toxic"))
    )
    n_known, n_toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    if not n_toxic:
        return Classifier({}, -5.0)
    keyed = _keyed(docs, text_col, seed)
    # At most POSITIVES ids, so they are small enough to send to every task.
    ids = (
        known.where("toxic = 1")
        .withColumn("__h", F.xxhash64(F.lit(seed), "__id"))
        .orderBy("__h", "__id")
        .limit(POSITIVES)
        .select("__id")
    )
    # Copies of one text confirm it once, and count once among all texts and labelled ones.
    positive = written(
        _distinct(keyed.join(F.broadcast(ids), F.col(id_col) == F.col("__id"), "left_semi")), "confirmed"
    )
    n_positive = positive.count()
    if n_positive:
        per_text = (
            keyed.select(F.col(id_col).alias("__id"), "__h", "__g")
            .join(known, "__id")
            .groupBy("__h", "__g")
            .agg(F.max("toxic").alias("toxic"))
        )
        n_known, n_toxic = per_text.agg(F.count("*"), F.sum("toxic")).first()
    prior = min(max(n_toxic / n_known, 1e-4), 0.9)
    chosen = []
    if n_positive:
        copies = written(keyed.groupBy("__h", "__g").agg(F.count("*").alias("times")), "copies")
        total = copies.count()
        chosen = _chosen(positive.select("text"), keyed, n_positive, total, _copied(copies))
    if not chosen:
        return Classifier({}, float(np.log(prior / (1 - prior))))
    numbers = {feature: i for i, feature in enumerate(chosen)}

    def found(rows: DataFrame) -> list[list[int]]:
        some = rows.orderBy("__h", "__g").select(_rows(numbers)("text").alias("x"))
        return [r["x"] for r in some.collect()]

    # Hashes are uniform, so these are somewhat more than UNLABELLED texts, of which the first are
    # taken. Of all copies of a text one is drawn, or none.
    part = min(1.0, 1.1 * UNLABELLED / total)
    near = keyed.where(F.col("__h") <= F.lit(-(2**63) + min(int(part * 2**64), 2**64 - 1)))
    confirmed = found(positive)
    unlabelled = found(_distinct(near).orderBy("__h", "__g").limit(UNLABELLED))
    has = F.size(_rows(numbers)("__text")) > 0
    share = keyed.select("__h", "__g", has.alias("has")).where("has").select("__h", "__g").distinct().count() / total
    risk = Risk(confirmed, unlabelled, class_prior(confirmed, share, prior), len(chosen))
    weights, bias = fitted(risk)
    return Classifier(dict(zip(chosen, weights.tolist(), strict=True)), bias)


def scored(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = SEED
) -> DataFrame:
    """``docs`` with ``toxicity``: a score from 0 to 1 for every whole text.

    Labels of ids whose crc32 leaves remainder ``HELD_OUT`` are not learned
    from. A score reads the text alone; null and empty texts get the score of a
    text without features. Without toxic labels every score is low. Rows stay as
    they are; a column ``toxicity`` that was there is replaced.
    """
    model = trained(docs, labels, id_col, text_col, seed)

    @F.arrow_udf("double")
    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            raw = batch.cast(pa.binary())
            yield pa.array([model.score(x.as_py()) for x in raw], pa.float64())

    return docs.withColumn("toxicity", of(F.col(text_col)))


def without_toxic(docs: DataFrame, labels: DataFrame, cut: float = CUT, **names) -> DataFrame:
    """The documents that score under ``cut``."""
    return scored(docs, labels, **names).where(F.col("toxicity") < cut).drop("toxicity")
