"""Differences of two tables through digests: rows that are equal on both sides do not move.

Rows fall into buckets by the hash of their key. A bucket's digest does not depend
on the order of its rows, and is built in each task before anything is
shuffled. Only buckets whose digests differ are cut into finer ones, and only
rows of fine buckets that differ are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.functions.shapes import TEXT, shape
from opsframe.functions.text import is_atomic
from opsframe.operators.drift import _comparable, diff_tables
from opsframe.sources.scratch import written

#: Buckets of the first level, and parts of each on the second.
COARSE = 1_024
FINE = 4_096
_SEEDS = (17, 23)


def _hashed(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Comparable rows with the coarse and the fine bucket of their key, and two hashes of all cells."""
    rows = df.select(*[_comparable(f) for f in df.schema.fields])
    # A hash skips nulls inside of lists and records, their text does not.
    nested = {f.name for f in df.schema.fields if not is_atomic(f.dataType)}
    cells = [F.to_json(F.struct(f"`{c}`")) if c in nested else F.col(f"`{c}`") for c in sorted(rows.columns)]
    spread = F.xxhash64(F.lit(_SEEDS[0]), *[F.col(f"`{c}`") for c in key])
    return rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"),
        F.struct(*[F.col(f"`{c}`") for c in key]).alias("key"),
        F.pmod(spread, F.lit(COARSE)).cast("int").alias("coarse"),
        F.pmod(F.shiftright(spread, 20), F.lit(FINE)).cast("int").alias("fine"),
        *[F.xxhash64(F.lit(seed), *_filled(cells)).alias(f"h{i}") for i, seed in enumerate(_SEEDS)],
    )


def _filled(cells: Sequence[Column]) -> list[Column]:
    """Cells and which of them are null: Spark's hash of a null is that of nothing at all."""
    return [*cells, F.concat(*[F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in cells])]


def _digests(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per bucket the number of rows, sums of 31 bits of each hash, and an exclusive or.

    Sums tell copies apart, which an exclusive or does not; they fit for over four
    billion rows of a bucket.
    """
    parts = [F.sum(F.shiftrightunsigned(F.col(h), 33)).alias(f"sum_{h}") for h in ("h0", "h1")]
    low = F.sum(F.col("h0").bitwiseAND(F.lit((1 << 31) - 1))).alias("low")
    return rows.groupBy(*by).agg(F.count("*").alias("n"), *parts, low, F.bit_xor("h1").alias("both"))


def _differing(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Buckets whose digests are not the same on both sides."""
    digest = ["n", "sum_h0", "sum_h1", "low", "both"]
    sides = _digests(a, by).unionAll(_digests(b, by))
    return sides.groupBy(*by, *digest).agg(F.count("*").alias("sides")).filter("sides < 2").select(*by).distinct()


def diff_digests(a: DataFrame, b: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """``diff_tables`` for tables that are mostly equal: (key, status, changed_columns).

    Two passes of digests, of which the second reads rows of differing buckets
    only, then one over the keys of differing fine buckets. Only keys that do not
    have the same rows on both sides are reported; one whose copies differ among
    themselves, but alike in both tables, is not. The names of at most ``COARSE`` buckets come to the driver. Equal tables shuffle nothing but
    digests. Two different buckets pass for equal when 93 bits of sums, their row
    counts and 64 bits of an exclusive or all agree.
    """
    if b is None or set(a.columns) != set(b.columns):
        return diff_tables(a, b, key)
    sides = [_hashed(x, key) for x in (a, b)]
    coarse = sorted(r["coarse"] for r in _differing(*sides, ["coarse"]).collect())
    if not coarse:
        keys = {k: a.schema[k].dataType for k in key}
        return a.sparkSession.createDataFrame([], shape(**keys, status=TEXT, changed_columns=TEXT))
    some = [x.filter(F.col("coarse").isin(coarse)) for x in sides]
    fine = written(_differing(*some, ["coarse", "fine"]), "buckets")
    # Semi joins whose small side is a stored table: broadcast by its size, or the other side split.
    near = [written(x.join(fine, ["coarse", "fine"], "left_semi"), "rows") for x in some]
    keys = written(_differing(*near, ["key"]).withColumnRenamed("key", "_key"), "keys")
    same = F.col("key").eqNullSafe(F.col("_key"))
    left, right = (x.join(keys, same, "left_semi").select("row.*") for x in near)
    return diff_tables(left, right, key)
