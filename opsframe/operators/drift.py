"""Two versions of a table: renames, unit changes, differences, profile.

Both sides are unioned and aggregated by key or value instead of joined. Copies
collapse in each task before the shuffle, so one key or value that holds a
large share of the rows costs one row per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.shapes import BIGINT, DOUBLE, TEXT, shape
from opsframe.functions.text import canonical, is_atomic, is_numeric, lookup, strip
from opsframe.operators import lines
from opsframe.sources.scratch import written

MASK_BITS = 62
BRANCHES = 64
SLOTS = 256  # Of a column's min-wise signature.
LG_K = 13  # Size of a profile's sketches, as a power of two.
MATCH = shape(col_a=TEXT, col_b=TEXT, n_a=BIGINT, n_b=BIGINT, n_common=BIGINT, score=DOUBLE)


@dataclass(frozen=True)
class Change:
    """One output column of a drifted copy."""

    old: str
    new: str
    dtype: str
    scale: float | None = None


def project_drift(df: DataFrame, changes: Sequence[Change]) -> DataFrame:
    """Rename, cast and rescale columns in one projection."""
    return df.select(
        *[
            (F.col(c.old) if c.scale is None else F.col(c.old).cast("double") * F.lit(c.scale))
            .cast(c.dtype)
            .alias(c.new)
            for c in changes
        ]
    )


def _atomic_fields(df: DataFrame) -> list[T.StructField]:
    return [f for f in df.schema.fields if is_atomic(f.dataType)]


def _branched(df: DataFrame) -> DataFrame:
    """Adds ``_branch``: results of many tasks meet in so many tasks before the last one."""
    return df.withColumn("_branch", F.pmod(F.spark_partition_id(), F.lit(BRANCHES)))


def _values(df: DataFrame, slots: Sequence[tuple[T.StructField, int]]) -> DataFrame:
    """(value, word, bit): every non-null cell with the position of its column."""
    cells = [
        F.struct(
            canonical(F.col(f"`{f.name}`"), f.dataType).alias("value"),
            F.lit(slot // MASK_BITS).alias("word"),
            F.lit(1 << (slot % MASK_BITS)).cast("bigint").alias("bit"),
        )
        for f, slot in slots
    ]
    return df.select(F.inline(F.array(*cells))).filter(F.col("value").isNotNull())


def match_columns(a: DataFrame, b: DataFrame, min_score: float = 0.0) -> DataFrame:
    """(col_a, col_b, n_a, n_b, n_common, score): column pairs by shared values.

    The score is the exact Jaccard overlap of the distinct values. One shuffle
    moves each distinct value with a bit mask of the columns it occurs in; the
    masks are then counted, and pairs of columns are formed from the counts.
    """
    fields_a, fields_b = _atomic_fields(a), _atomic_fields(b)
    if not fields_a or not fields_b:
        return a.sparkSession.createDataFrame([], MATCH)
    n_a = len(fields_a)
    slots_a = list(zip(fields_a, range(n_a)))
    slots_b = list(zip(fields_b, range(n_a, n_a + len(fields_b))))
    words = range((n_a + len(fields_b) - 1) // MASK_BITS + 1)
    masks = [
        F.bit_or(F.when(F.col("word") == w, F.col("bit")).otherwise(F.lit(0))).alias(f"mask{w}")
        for w in words
    ]
    names = [f"mask{w}" for w in words]
    per_value = _values(a, slots_a).unionAll(_values(b, slots_b)).groupBy("value").agg(*masks)
    per_mask = per_value.groupBy(*names).agg(F.count(F.lit(1)).alias("n"))

    def present(slots: Sequence[tuple[T.StructField, int]]) -> Column:
        return F.array_compact(
            F.array(
                *[
                    F.when(
                        F.col(f"mask{s // MASK_BITS}").bitwiseAND(F.lit(1 << (s % MASK_BITS))) != 0,
                        F.lit(f.name),
                    )
                    for f, s in slots
                ]
            )
        )

    none = F.lit(None).cast("string")
    only_a = F.transform("in_a", lambda x: F.struct(x.alias("col_a"), none.alias("col_b")))
    only_b = F.transform("in_b", lambda x: F.struct(none.alias("col_a"), x.alias("col_b")))
    both = F.flatten(
        F.transform(
            "in_a",
            lambda x: F.transform(
                "in_b", lambda y: F.struct(x.alias("col_a"), y.alias("col_b"))
            ),
        )
    )
    counts = (
        per_mask.select(present(slots_a).alias("in_a"), present(slots_b).alias("in_b"), "n")
        .select("n", F.inline(F.concat(only_a, only_b, both)))
        .groupBy("col_a", "col_b")
        .agg(F.sum("n").alias("n_common"))
    )
    total_a = F.max(F.when(F.col("col_b").isNull(), F.col("n_common")))
    total_b = F.max(F.when(F.col("col_a").isNull(), F.col("n_common")))
    return (
        counts.withColumn("n_a", total_a.over(Window.partitionBy("col_a")))
        .withColumn("n_b", total_b.over(Window.partitionBy("col_b")))
        .filter(F.col("col_a").isNotNull() & F.col("col_b").isNotNull())
        .withColumn("score", F.col("n_common") / (F.col("n_a") + F.col("n_b") - F.col("n_common")))
        .filter(F.col("score") >= min_score)
        .select("col_a", "col_b", "n_a", "n_b", "n_common", "score")
    )


def match_columns_sketched(
    a: DataFrame, b: DataFrame, min_score: float = 0.0, lg_k: int = 14
) -> DataFrame:
    """``match_columns`` with estimated counts; no values are shuffled.

    Every column has a min-wise signature: of the values that fall into each of
    ``SLOTS`` slots the smallest hash. Columns that share one are compared (of pairs
    with a score of 0.05 all but one in 500,000), so pairs of columns are rows of a
    join and never expressions of the plan. One HyperLogLog sketch per column is
    merged across tasks, in two steps; the overlap of a pair is the two estimates
    minus that of the merged sketch.
    """
    fields_a, fields_b = _atomic_fields(a), _atomic_fields(b)
    if not fields_a or not fields_b:
        return a.sparkSession.createDataFrame([], MATCH)

    def sketches(df: DataFrame, own: list, side: str) -> DataFrame:
        """(col, n, sketch): as many rows as columns."""
        cells = [canonical(F.col(f"`{f.name}`"), f.dataType).alias(f"c{i}") for i, f in enumerate(own)]
        values = df.select(*cells)
        per_branch = _branched(values).groupBy("_branch").agg(
            *[F.hll_sketch_agg(c, F.lit(lg_k)).alias(c) for c in values.columns]
        )
        merged = per_branch.agg(*[F.hll_union_agg(c).alias(c) for c in values.columns])
        rows = [F.struct(F.lit(f.name).alias(f"col_{side}"), F.col(f"c{i}").alias(f"of_{side}")) for i, f in enumerate(own)]
        return merged.select(F.inline(F.array(*rows)))

    def signatures(df: DataFrame, own: list, side: str) -> DataFrame:
        """(col, slot, least): at most ``SLOTS`` rows for each column."""
        hashes = [
            F.struct(
                F.lit(i).alias("i"), F.xxhash64(canonical(F.col(f"`{f.name}`"), f.dataType)).alias("h"),
                F.col(f"`{f.name}`").isNotNull().alias("filled"),
            )
            for i, f in enumerate(own)
        ]
        cells = df.select(F.inline(F.array(*hashes))).filter("filled")
        least = cells.groupBy("i", F.pmod("h", F.lit(SLOTS)).alias("slot")).agg(F.min("h").alias("least"))
        names = lookup(F.col("i"), {i: f.name for i, f in enumerate(own)})
        return written(least.select(names.alias(f"col_{side}"), "slot", "least"), "signatures")

    shared = signatures(a, fields_a, "a").join(signatures(b, fields_b, "b"), ["slot", "least"])
    pairs = shared.select("col_a", "col_b").distinct()
    sized = pairs.join(sketches(a, fields_a, "a"), "col_a").join(sketches(b, fields_b, "b"), "col_b")
    return (
        sized.select(
            "col_a",
            "col_b",
            F.hll_sketch_estimate("of_a").alias("n_a"),
            F.hll_sketch_estimate("of_b").alias("n_b"),
            F.hll_sketch_estimate(F.hll_union("of_a", "of_b")).alias("n_union"),
        )
        .withColumn("n_common", F.greatest(F.col("n_a") + F.col("n_b") - F.col("n_union"), F.lit(0)))
        .withColumn("score", F.try_divide("n_common", "n_union"))
        .filter((F.col("n_common") > 0) & (F.col("score") >= min_score))
        .select("col_a", "col_b", "n_a", "n_b", "n_common", "score")
    )


def unit_drift(
    a: DataFrame,
    b: DataFrame,
    key_pair: tuple[str, str],
    col_pairs: Sequence[tuple[str, str]],
    tolerance: float = 1e-9,
) -> DataFrame:
    """(col_a, col_b, n_keys, n_conflicts, min_ratio, max_ratio, constant, changed).

    Compares b/a per key, leaving out nulls and zeros. ``constant`` holds when
    the ratios agree within the relative tolerance, ``changed`` when the
    constant is not 1. Equal copies of a key count once; a key whose copies
    disagree is a conflict, has no ratio, and makes ``constant`` false.
    """
    names = [sorted({pair[s] for pair in col_pairs}) for s in (0, 1)]
    totals = lines.fitted(lines.keyed_values(a, b, key_pair, names), names, col_pairs)
    return _ratios(totals, tolerance).select(
        "col_a", "col_b", "n_keys", "n_conflicts", "min_ratio", "max_ratio", "constant", "changed"
    )


def _ratios(totals: DataFrame, tolerance: float) -> DataFrame:
    """Fitted pairs with ``constant`` and ``changed`` by their ratios; ``n_keys`` are those with one."""
    spread = F.col("max_ratio") - F.col("min_ratio")
    constant = (
        (F.col("n_ratios") > 0)
        & (F.col("n_conflicts") == 0)
        & (spread <= F.abs("max_ratio") * F.lit(tolerance))
    )
    off_one = F.abs(F.col("max_ratio") - F.lit(1.0)) > F.lit(tolerance)
    return (
        totals.withColumn("constant", F.coalesce(constant, F.lit(False)))
        .withColumn("changed", F.col("constant") & F.coalesce(off_one, F.lit(False)))
        .withColumn("n_fitted", F.col("n_keys"))
        .withColumn("n_keys", F.col("n_ratios"))
    )


def schema_findings(a: DataFrame, b: DataFrame) -> tuple[list[str], list[str], list[tuple]]:
    """Columns only in a, only in b, and (name, type in a, type in b) where types differ."""
    types_a = {f.name: f.dataType for f in a.schema.fields}
    types_b = {f.name: f.dataType for f in b.schema.fields}
    changed = [
        (n, types_a[n].simpleString(), types_b[n].simpleString())
        for n in types_a
        if n in types_b and types_a[n] != types_b[n]
    ]
    return (
        [n for n in types_a if n not in types_b],
        [n for n in types_b if n not in types_a],
        changed,
    )


def _units(per_key: DataFrame, names: lines.Names, pairs: list, tolerance: float) -> DataFrame:
    """Findings of pairs with a constant ratio other than 1, or else on a line other than b = a."""
    totals = _ratios(lines.fitted(per_key, names, pairs), tolerance)
    ratio = F.col("changed") & (F.col("n_keys") > 1)
    line = ~F.col("constant") & lines.is_line() & ~lines.is_identity()
    totals = totals.withColumn("n_keys", F.when(ratio, F.col("n_keys")).otherwise(F.col("n_fitted")))
    factor = F.format_string(
        "%.6f", F.when(ratio, (F.col("min_ratio") + F.col("max_ratio")) / 2).otherwise(F.col("factor"))
    )
    offset = F.format_string("%.6f", "offset")
    return totals.filter(ratio | line).select(
        F.lit("unit_changed").alias("kind"),
        "col_a",
        "col_b",
        F.when(ratio, F.concat(F.lit("factor "), factor))
        .otherwise(F.concat(F.lit("factor "), factor, F.lit(" offset "), offset))
        .alias("detail"),
        F.when(ratio, F.concat(F.lit("multiply "), "col_a", F.lit(" by "), factor, F.lit(" into "), "col_b"))
        .otherwise(
            F.concat(F.lit("multiply "), "col_a", F.lit(" by "), factor, F.lit(" and add "), offset, F.lit(" into "), "col_b")
        )
        .alias("action"),
    )


def compatibility_findings(
    a: DataFrame,
    b: DataFrame,
    key_pair: tuple[str, str],
    *,
    min_score: float = 0.5,
    tolerance: float = 1e-9,
    sketched: bool = False,
) -> DataFrame:
    """(kind, col_a, col_b, detail, action): what breaks a job copying rows a to b.

    Kinds: renamed (each other's best match by shared values), unit_changed
    (constant ratio other than 1, or a straight line, between columns of the same
    name or numeric columns found on one side only), type_changed (of columns with the same
    name, and of pairs found by either), missing and extra. ``sketched``
    estimates the shared values, which shuffles no value.
    """
    spark = a.sparkSession
    finding = shape(kind=TEXT, col_a=TEXT, col_b=TEXT, detail=TEXT, action=TEXT)
    only_a, only_b, changed = schema_findings(a, b)
    static = spark.createDataFrame(
        [
            ("type_changed", n, n, f"{ta} to {tb}", f"cast {n} from {ta} to {tb}")
            for n, ta, tb in changed
        ],
        finding,
    )
    match = match_columns_sketched if sketched else match_columns
    scores = match(a.select(*only_a), b.select(*only_b), min_score)
    numeric_a = {f.name for f in a.schema.fields if is_numeric(f.dataType)}
    numeric_b = {f.name for f in b.schema.fields if is_numeric(f.dataType)}
    same = [n for n in a.columns if n in numeric_a & numeric_b and n != key_pair[0]]
    names = [
        same + [x for x in only_a if x in numeric_a and x != key_pair[0]],
        same + [y for y in only_b if y in numeric_b and y != key_pair[1]],
    ]
    best_a = Window.partitionBy("col_a").orderBy(F.desc("score"), "col_b")
    best_b = Window.partitionBy("col_b").orderBy(F.desc("score"), "col_a")
    renamed = (
        scores.withColumn("rank_a", F.row_number().over(best_a))
        .withColumn("rank_b", F.row_number().over(best_b))
        .filter((F.col("rank_a") == 1) & (F.col("rank_b") == 1))
        .select(
            F.lit("renamed").alias("kind"),
            "col_a",
            "col_b",
            F.concat(F.lit("overlap "), F.format_string("%.4f", "score")).alias("detail"),
            F.concat(F.lit("map "), "col_a", F.lit(" to "), "col_b").alias("action"),
        )
    )
    found = static.unionAll(renamed)
    if names[0] and names[1]:
        # A column found on both sides is compared with itself only.
        allowed = np.ones((len(names[0]), len(names[1])), bool)
        allowed[: len(same)] = allowed[:, : len(same)] = False
        np.fill_diagonal(allowed[: len(same), : len(same)], True)
        per_key = written(lines.keyed_values(a, b, key_pair, names), "keyed")
        pairs = lines.proposed(per_key, names, allowed)
        found = found.unionAll(_units(per_key, names, pairs, tolerance)) if pairs else found
    types_a, types_b = ({f.name: f.dataType.simpleString() for f in x.schema.fields} for x in (a, b))
    if only_a and only_b:
        # As many rows as findings; stored, for they are read several times.
        found = written(found, "findings")
        old = lookup(F.col("col_a"), {n: types_a[n] for n in only_a})
        new = lookup(F.col("col_b"), {n: types_b[n] for n in only_b})
        retyped = (
            found.filter(F.col("kind").isin("renamed", "unit_changed"))
            .select("col_a", "col_b", old.alias("old"), new.alias("new"))
            .filter(F.col("old") != F.col("new"))
            .distinct()
            .select(
                F.lit("type_changed").alias("kind"),
                "col_a",
                "col_b",
                F.concat("old", F.lit(" to "), "new").alias("detail"),
                F.format_string("cast %s from %s to %s into %s", "col_a", "old", "new", "col_b").alias("action"),
            )
        )
        found = found.unionAll(retyped)
    one_sided = [("missing", n, None) for n in only_a] + [("extra", None, n) for n in only_b]
    if not one_sided:
        return found
    # One row per finding and one per one-sided column: as many rows as there are columns.
    sides = spark.createDataFrame(one_sided, "kind string, col_a string, col_b string").select(
        "kind",
        "col_a",
        "col_b",
        F.lit("no counterpart found").alias("detail"),
        F.when(F.col("kind") == "missing", F.concat(F.lit("add "), "col_a", F.lit(" to the target")))
        .otherwise(F.concat(F.lit("give "), "col_b", F.lit(" a default")))
        .alias("action"),
    )
    pool = found.unionAll(sides)
    mapped = F.col("kind").isin("renamed", "unit_changed")
    used_a = F.max(F.when(mapped, F.lit(1))).over(Window.partitionBy("col_a"))
    used_b = F.max(F.when(mapped, F.lit(1))).over(Window.partitionBy("col_b"))
    settled = ((F.col("kind") == "missing") & F.col("used_a").isNotNull()) | (
        (F.col("kind") == "extra") & F.col("used_b").isNotNull()
    )
    return (
        pool.withColumn("used_a", used_a)
        .withColumn("used_b", used_b)
        .filter(~settled)
        .select("kind", "col_a", "col_b", "detail", "action")
    )


def compatibility_report(
    a: DataFrame, b: DataFrame, key_pair: tuple[str, str], **options
) -> DataFrame:
    """(compatible, mismatches, suggested_actions): one row over the findings.

    The lists hold one entry per finding, so their length is bounded by the
    number of column pairs, not by the data.
    """
    findings = compatibility_findings(a, b, key_pair, **options)
    text = F.concat_ws(
        " ", "kind", F.concat_ws(" -> ", "col_a", "col_b"), F.concat(F.lit("("), "detail", F.lit(")"))
    )
    return findings.select(text.alias("mismatch"), "action").agg(
        (F.count(F.lit(1)) == 0).alias("compatible"),
        F.array_sort(F.collect_list("mismatch")).alias("mismatches"),
        F.array_sort(F.collect_list("action")).alias("suggested_actions"),
    )


def _comparable(field: T.StructField) -> Column:
    column = F.col(f"`{field.name}`")
    return (strip(column) if isinstance(field.dataType, T.StringType) else column).alias(field.name)


def diff_tables(a: DataFrame, b: DataFrame | None, key: Sequence[str]) -> DataFrame:
    """(key, status, changed_columns): rows that two tables do not share, by key.

    Text is trimmed before comparing and nulls equal nulls. ``status`` is
    added, removed, changed, ambiguous when a key has copies that differ within
    a table, or copies when both have equal rows in different numbers. An absent
    ``b`` means the comparison is skipped: no rows.
    """
    if b is None:
        keys = {k: a.schema[k].dataType for k in key}
        return a.sparkSession.createDataFrame([], shape(**keys, status=TEXT, changed_columns=TEXT))
    if set(a.columns) != set(b.columns):
        raise ValueError("the tables have different columns: see compatibility_findings")
    rest = [c for c in a.columns if c not in key]
    fields = [_comparable(f) for f in a.schema.fields]

    def side(df: DataFrame, tag: str) -> DataFrame:
        row = F.struct(*[F.col(f"`{c}`") for c in rest]) if rest else F.struct(F.lit(1).alias("_"))
        return df.select(*fields).select(*key, F.lit(tag).alias("_side"), row.alias("_row"))

    extremes = [
        f(F.when(F.col("_side") == tag, F.col("_row"))).alias(f"{name}_{tag}")
        for tag in "ab"
        for name, f in (("lo", F.min), ("hi", F.max))
    ]
    copies = [F.count_if(F.col("_side") == tag).alias(f"n_{tag}") for tag in "ab"]
    per_key = side(a, "a").unionAll(side(b, "b")).groupBy(*key).agg(*extremes, *copies)
    changed = F.concat_ws(
        ",",
        *[
            F.when(~F.col(f"lo_a.`{c}`").eqNullSafe(F.col(f"lo_b.`{c}`")), F.lit(c))
            for c in rest
        ],
    )

    def differ(x: str, y: str) -> Column:
        return ~F.col(x).eqNullSafe(F.col(y))

    status = (
        F.when(differ("lo_a", "hi_a") | differ("lo_b", "hi_b"), F.lit("ambiguous"))
        .when(F.col("lo_b").isNull(), F.lit("removed"))
        .when(F.col("lo_a").isNull(), F.lit("added"))
        .when(differ("lo_a", "lo_b"), F.lit("changed"))
        .when(F.col("n_a") != F.col("n_b"), F.lit("copies"))
    )
    return (
        per_key.withColumn("status", status)
        .filter(F.col("status").isNotNull())
        .select(
            *key,
            "status",
            F.when(F.col("status") == "changed", changed).otherwise(F.lit("")).alias("changed_columns"),
        )
    )


def diff_rows(a: DataFrame, b: DataFrame | None) -> DataFrame:
    """(columns..., n_left, n_right): rows that occur a different number of times.

    ``exceptAll`` in both directions in a single shuffle; a surplus of copies
    is one row with two counts instead of that many rows. Text is trimmed.
    """
    fields = [_comparable(f) for f in a.schema.fields]
    counts = ["n_left", "n_right"]

    def side(df: DataFrame, left: int) -> DataFrame:
        return df.select(*fields, F.lit(left).alias(counts[0]), F.lit(1 - left).alias(counts[1]))

    if b is None:
        return side(a, 1).limit(0)
    if set(a.columns) != set(b.columns):
        raise ValueError("the tables have different columns: see compatibility_findings")
    return (
        side(a, 1)
        .unionByName(side(b, 0))
        .groupBy(*[F.col(f"`{c}`") for c in a.columns])
        .agg(*[F.sum(c).alias(c) for c in counts])
        .filter(F.col(counts[0]) != F.col(counts[1]))
    )


def profile(df: DataFrame, *, exact: bool = True) -> DataFrame:
    """(column, type, n_rows, n_nulls, n_distinct, min_value, max_value) per column.

    ``exact=False`` estimates the distinct counts with HyperLogLog (error
    about one per cent): its tasks each send one row, some ten kilobytes per
    column, which is the form for very large tables. Counts and fixed-width extremes, text extremes, and
    distinct counts are three passes, joined per column.
    A negative zero is shown as zero.
    """
    fields = _atomic_fields(df)

    def shown(extreme: Column, dtype: T.DataType) -> Column:
        fraction = isinstance(dtype, (T.DoubleType, T.FloatType))
        return (extreme + F.lit(0.0).cast(dtype) if fraction else extreme).cast("string")

    def per_column(totals: DataFrame, names: Sequence[str]) -> DataFrame:
        """The single row of totals as one row per column."""
        rows = [
            F.struct(F.lit(f.name).alias("column"), *[F.col(f"{n}{i}").alias(n) for n in names])
            for i, f in enumerate(fields)
        ]
        return totals.select("n_rows", F.inline(F.array(*rows)))

    def extremes(some: Sequence[tuple[int, T.StructField]]) -> list[Column]:
        return [
            shown(f(f"`{field.name}`"), field.dataType).alias(f"{name}{i}")
            for i, field in some
            for name, f in (("min_value", F.min), ("max_value", F.max))
        ]

    # Three aggregates, since one with text extremes would sort its rows, and
    # one of fixed-width extremes with estimates would not fit one generated method.
    numbered = list(enumerate(fields))
    wide = [(i, f) for i, f in numbered if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    narrow = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(f"`{f.name}`").alias(f"filled{i}") for i, f in numbered],
        *extremes([x for x in numbered if x not in wide]),
    )
    def distinct(field: T.StructField) -> Column:
        col = F.col(f"`{field.name}`")
        if exact:
            return F.count_distinct(col)
        sketch = F.hll_sketch_agg(F.when(col.isNotNull(), F.xxhash64(col)), F.lit(LG_K))
        return F.coalesce(F.hll_sketch_estimate(sketch), F.lit(0))

    counts = df.agg(*[distinct(f).alias(f"n_distinct{i}") for i, f in numbered])
    shown_wide = df.agg(F.lit(0).alias("_"), *extremes(wide))
    none = F.lit(None).cast("string")
    totals = [
        narrow.select(
            "*",
            *[F.lit(f.dataType.simpleString()).alias(f"type{i}") for i, f in numbered],
            *[none.alias(f"{n}{i}") for i, _ in wide for n in ("min_value", "max_value")],
        ),
        counts.withColumn("n_rows", F.lit(0)),
        shown_wide.select(
            F.lit(0).alias("n_rows"),
            *[
                (F.col(f"{n}{i}") if (i, f) in wide else none).alias(f"{n}{i}")
                for i, f in numbered
                for n in ("min_value", "max_value")
            ],
        ),
    ]
    joined = per_column(totals[0], ["type", "filled", "min_value", "max_value"]).join(
        per_column(totals[1], ["n_distinct"]).drop("n_rows"), "column"
    )
    if wide:
        texts = per_column(totals[2], ["min_value", "max_value"]).select(
            "column", F.col("min_value").alias("_min"), F.col("max_value").alias("_max")
        )
        joined = joined.join(texts, "column").withColumns(
            {"min_value": F.coalesce("min_value", "_min"), "max_value": F.coalesce("max_value", "_max")}
        )
    return joined.select(
        "column",
        "type",
        "n_rows",
        (F.col("n_rows") - F.col("filled")).alias("n_nulls"),
        "n_distinct",
        "min_value",
        "max_value",
    )
