"""Units changed by a factor and an offset: straight lines between numeric columns of two tables.

Both tables are brought together by key once. Which column could be a line of
which other one is settled on what is as small as the schema: mergeable quantile
sketches of all columns, scaled to their range, and the rows of a few common keys,
where a line of three points or more either holds or is refuted. The pairs that are
left are fitted over all keys in one pass.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.functions.text import canonical

#: Common keys whose rows may refute a line.
PROBES = 512
QUANTILES = 10
#: What of the variance a line may leave unexplained, among probes and over all keys.
PROBE_TOLERANCE = 1e-6
TOLERANCE = 1e-10

Names = Sequence[Sequence[str]]


def keyed_values(a: DataFrame, b: DataFrame, key_pair: tuple[str, str], names: Names) -> DataFrame:
    """One row per key: ``has_0``, ``has_1``, and the extremes ``lo_s_i``, ``hi_s_i`` of the
    i-th named numeric column of side s, which are equal unless copies of the key disagree."""

    def side(df: DataFrame, mine: int) -> DataFrame:
        key = key_pair[mine]
        cells = [
            (F.nanvl(F.col(f"`{n}`").cast("double"), none) if s == mine else none).alias(f"{s}_{i}")
            for s in (0, 1)
            for i, n in enumerate(names[s])
        ]
        flags = [(F.lit(True) if s == mine else F.lit(None).cast("boolean")).alias(f"has_{s}") for s in (0, 1)]
        return df.select(canonical(F.col(f"`{key}`"), df.schema[key].dataType).alias("key"), *flags, *cells)

    none = F.lit(None).cast("double")
    rows = side(a, 0).unionAll(side(b, 1)).filter(F.col("key").isNotNull())
    extremes = [f(c).alias(f"{g}_{c}") for c in rows.columns[3:] for f, g in ((F.min, "lo"), (F.max, "hi"))]
    return rows.groupBy("key").agg(*[F.max(f"has_{s}").alias(f"has_{s}") for s in (0, 1)], *extremes)


def _usable(side: int, i: int) -> Column:
    """The column's value where a key has one value; conflicts are null."""
    return F.when(F.col(f"lo_{side}_{i}") == F.col(f"hi_{side}_{i}"), F.col(f"lo_{side}_{i}"))


def fitted(per_key: DataFrame, names: Names, pairs: Iterable[tuple[str, str]]) -> DataFrame:
    """(col_a, col_b, n_keys, n_conflicts, n_ratios, min_ratio, max_ratio, factor, offset, r2, size).

    One pass over the keys. ``n_keys`` have one value on both sides, ``n_ratios``
    of them no zero; factor and offset are those of the least squares line.
    """

    def compared(pair: tuple[str, str]) -> Column:
        i, j = (names[s].index(pair[s]) for s in (0, 1))
        x, y = _usable(0, i), _usable(1, j)
        both = F.col(f"lo_0_{i}").isNotNull() & F.col(f"lo_1_{j}").isNotNull()
        return F.struct(
            F.lit(pair[0]).alias("col_a"),
            F.lit(pair[1]).alias("col_b"),
            F.when(x.isNotNull() & y.isNotNull(), x).alias("x"),
            F.when(x.isNotNull() & y.isNotNull(), y).alias("y"),
            F.when((x != 0) & (y != 0), F.try_divide(y, x)).alias("ratio"),
            F.when(both & (x.isNull() | y.isNull()), F.lit(1)).alias("conflict"),
        )

    return (
        per_key.select(F.inline(F.array(*[compared(pair) for pair in pairs])))
        .groupBy("col_a", "col_b")
        .agg(
            F.count("x").alias("n_keys"),
            F.count("conflict").alias("n_conflicts"),
            F.count("ratio").alias("n_ratios"),
            F.min("ratio").alias("min_ratio"),
            F.max("ratio").alias("max_ratio"),
            F.regr_slope("y", "x").alias("factor"),
            F.regr_intercept("y", "x").alias("offset"),
            F.regr_r2("y", "x").alias("r2"),
            F.max(F.abs("y")).alias("size"),
        )
    )


def is_line(tolerance: float = TOLERANCE) -> Column:
    """Whether a row of ``fitted`` is a line through three keys or more, none of them in conflict."""
    line = (F.col("n_keys") > 2) & (F.col("n_conflicts") == 0) & (F.col("r2") >= 1 - tolerance) & (F.col("factor") != 0)
    return F.coalesce(line, F.lit(False))


def is_identity(tolerance: float = 1e-9) -> Column:
    near = (F.abs(F.col("factor") - 1) <= tolerance) & (F.abs("offset") <= tolerance * F.greatest("size", F.lit(1.0)))
    return F.coalesce(near, F.lit(False))


def affine_drift(
    a: DataFrame,
    b: DataFrame,
    key_pair: tuple[str, str],
    col_pairs: Sequence[tuple[str, str]],
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """(col_a, col_b, n_keys, n_conflicts, factor, offset, constant, changed).

    Least squares ``b = factor * a + offset`` per key over the keys with a value
    on both sides. ``constant`` holds when the line leaves at most ``tolerance`` of
    b's variance, ``changed`` when it is not b = a as well. Nulls and NaN are left
    out; equal copies of a key count once; a key whose copies disagree is a
    conflict and makes ``constant`` false. Under three keys, or without variance,
    nothing is constant.
    """
    names = [sorted({pair[s] for pair in col_pairs}) for s in (0, 1)]
    lines = fitted(keyed_values(a, b, key_pair, names), names, col_pairs)
    return lines.withColumn("constant", is_line(tolerance)).select(
        "col_a", "col_b", "n_keys", "n_conflicts", "factor", "offset", "constant",
        (F.col("constant") & ~is_identity()).alias("changed"),
    )


def _quantiles(common: DataFrame, names: Names) -> list[np.ndarray]:
    """Per side a row for each column: its range's deciles from a sketch, NaN without values."""
    steps = F.array(*[F.lit(k / QUANTILES) for k in range(QUANTILES + 1)])
    columns = [(s, i) for s in (0, 1) for i in range(len(names[s]))]
    # Sketches of many tasks meet in some tasks before the last one.
    branch = F.pmod(F.spark_partition_id(), F.lit(64)).alias("branch")
    values = common.select(branch, *[_usable(s, i).alias(f"v{s}_{i}") for s, i in columns])
    parts = values.groupBy("branch").agg(
        *[F.kll_sketch_agg_double(f"v{s}_{i}").alias(f"q{s}_{i}") for s, i in columns],
        *[F.count(f"v{s}_{i}").alias(f"n{s}_{i}") for s, i in columns],
    )
    merged = parts.agg(
        *[F.kll_merge_agg_double(F.when(F.col(f"n{s}_{i}") > 0, F.col(f"q{s}_{i}"))).alias(f"q{s}_{i}") for s, i in columns],
        *[F.sum(f"n{s}_{i}").alias(f"n{s}_{i}") for s, i in columns],
    )
    row = merged.select(
        *[F.when(F.col(f"n{s}_{i}") > 0, F.kll_sketch_get_quantile_double(f"q{s}_{i}", steps)) for s, i in columns]
    ).first()
    none = [np.nan] * (QUANTILES + 1)
    found = np.array([none if x is None else x for x in row], float).reshape(len(columns), QUANTILES + 1)
    return [found[: len(names[0])], found[len(names[0]) :]]


def _scaled(quantiles: np.ndarray) -> np.ndarray:
    """From 0 to 1 over each column's range; all zero without any."""
    low, wide = quantiles[:, :1], quantiles[:, -1:] - quantiles[:, :1]
    with np.errstate(invalid="ignore", divide="ignore", over="ignore"):
        return np.where(wide > 0, (quantiles - low) / wide, np.where(np.isnan(wide), np.nan, 0.0))


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs whose deciles fit when each may be off by one, upright or upside down."""

    def fits(x: np.ndarray) -> np.ndarray:
        low = np.c_[np.zeros(len(x)), x[:, :-1]] - 1e-9
        high = np.c_[x[:, 1:], np.ones(len(x))] + 1e-9
        return ((b[None] >= low[:, None]) & (b[None] <= high[:, None])).all(axis=2)

    return fits(a) | fits(1 - a[:, ::-1])


def _not_refuted(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs of columns of the probes (NaN is no value) between which there can be a line."""
    out = np.zeros((a.shape[1], b.shape[1]), bool)
    filled = np.isfinite(b)
    for i, x in enumerate(a.T):
        on = filled & np.isfinite(x)[:, None]
        n = np.maximum(on.sum(axis=0), 1)
        with np.errstate(all="ignore"):
            dx = np.where(on, x[:, None] - np.where(on, x[:, None], 0).sum(axis=0) / n, 0)
            dy = np.where(on, b - np.where(on, b, 0).sum(axis=0) / n, 0)
            xx, yy, xy = (dx * dx).sum(axis=0), (dy * dy).sum(axis=0), (dx * dy).sum(axis=0)
            r2 = xy * xy / (xx * yy)
        both_flat = (xx == 0) & (yy == 0)
        out[i] = (on.sum(axis=0) < 3) | both_flat | ((xx > 0) & (yy > 0) & ~(r2 < 1 - PROBE_TOLERANCE))
    return out


def proposed(per_key: DataFrame, names: Names, allowed: np.ndarray) -> list[tuple[str, str]]:
    """Pairs of columns that a line may join, of those marked in ``allowed``.

    ``per_key`` is a stored table of ``keyed_values``. A pair is left out only
    when its quantiles over the common keys differ by far more than a sketch errs,
    or when ``PROBES`` common keys refute it; every line over all keys passes.
    """
    if not allowed.any():
        return []
    common = per_key.filter("has_0 and has_1")
    columns = [(s, i) for s in (0, 1) for i in range(len(names[s]))]
    some = common.orderBy(F.xxhash64("key"), "key").limit(PROBES)
    probes = some.select(*[_usable(s, i).alias(f"p{s}_{i}") for s, i in columns]).toArrow()
    values = np.array([c.to_numpy(zero_copy_only=False) for c in probes.columns], float).reshape(len(columns), -1).T
    a, b = values[:, : len(names[0])], values[:, len(names[0]) :]
    left = allowed & _not_refuted(a, b)
    if left.any():
        quantiles = [_scaled(q) for q in _quantiles(common, names)]
        left &= _alike(*quantiles)
    return [(names[0][i], names[1][j]) for i, j in zip(*np.nonzero(left), strict=True)]
