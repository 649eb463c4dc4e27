"""Scans, filters, counts, top-k and joins over tables.

No join here carries a broadcast hint. Catalyst broadcasts a side when its
statistics, or the sizes AQE measures at run time, are under the session's
threshold, and otherwise uses a sort-merge join. Sides that could repeat a key
are aggregated to one row per key first, so no join emits pairs within a group.
AQE splits a hot partition only when both sides come straight from a shuffle;
``join_stored`` is for the joins with an aggregated side.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.functions.text import blank_to_null
from opsframe.sources.scratch import written


def scan(df: DataFrame) -> DataFrame:
    """Every row and column."""
    return df.select("*")


def filter_optional(df: DataFrame, column: str, value: str | None = None) -> DataFrame:
    """Rows equal to ``value``; None and the empty string mean no filter."""
    return df.filter(F.col(column) == F.lit(value)) if value else df


def count_by(df: DataFrame, key: str, unknown: str = "unknown") -> DataFrame:
    """(key, n): rows per key as text, null and blank keys under ``unknown``."""
    text = blank_to_null(F.col(key).cast("string"))
    return df.groupBy(F.coalesce(text, F.lit(unknown)).alias(key)).agg(
        F.count(F.lit(1)).alias("n")
    )


def top_groups(df: DataFrame, key: str, where: Column | None = None) -> DataFrame:
    """(key, n) of the largest groups, all of them on a tie; null and blank keys left out."""
    rows = df if where is None else df.filter(where)
    counts = rows.filter(blank_to_null(F.col(key).cast("string")).isNotNull()).groupBy(key)
    counts = counts.agg(F.count(F.lit(1)).alias("n"))
    largest = counts.agg(F.max("n").alias("n"))
    return counts.join(largest, "n").select(key, "n")


def counts_as_json(
    df: DataFrame, key: str, *, unknown: str = "unknown", buckets: int = 1
) -> DataFrame:
    """(bucket, counts_json): the counts of ``count_by`` as JSON maps, keys sorted.

    A key is in the map of its bucket, the first 32 bits of its MD5 modulo
    ``buckets``; the union of the maps is the answer. One map is one row: ask
    for as many buckets as keep a map small.
    """
    counts = count_by(df, key, unknown)
    prefix = F.conv(F.substring(F.md5(F.col(key)), 1, 8), 16, 10).cast("bigint")
    entry = F.struct(F.col(key).alias("key"), F.col("n").alias("value"))
    return (
        counts.groupBy((prefix % F.lit(buckets)).alias("bucket"))
        .agg(F.array_sort(F.collect_list(entry)).alias("entries"))
        .select("bucket", F.to_json(F.map_from_entries("entries")).alias("counts_json"))
    )


def top_k(
    df: DataFrame,
    order_col: str,
    k: int,
    tie_keys: Sequence[str],
    where: Column | None = None,
) -> DataFrame:
    """The k rows with the largest ``order_col``, ties settled by ``tie_keys``."""
    rows = df if where is None else df.filter(where)
    return rows.orderBy(F.col(order_col).desc_nulls_last(), *tie_keys).limit(k)


def top_k_joined(
    facts: DataFrame,
    dim: DataFrame,
    on: tuple[str, str],
    dim_where: Column,
    order_col: str,
    k: int,
    tie_keys: Sequence[str],
) -> DataFrame:
    """The k largest fact rows whose dimension row passes ``dim_where``.

    Nothing of the dimension is returned, so a semi join on its key suffices
    and a repeated dimension key cannot repeat a fact.
    """
    keys = dim.filter(dim_where).select(F.col(on[1]).alias("_dim_key"))
    kept = facts.join(keys, F.col(on[0]) == F.col("_dim_key"), "left_semi")
    return top_k(kept, order_col, k, tie_keys)


def count_where(df: DataFrame, cond: Column) -> DataFrame:
    """(n): how many rows meet the condition."""
    return df.filter(cond).agg(F.count(F.lit(1)).alias("n"))


def mean_converted(
    df: DataFrame,
    col: str,
    factor: float,
    digits: int,
    where: Column | None = None,
) -> DataFrame:
    """(mean_value): average times a unit factor, rounded."""
    rows = df if where is None else df.filter(where)
    return rows.agg(F.round(F.avg(col) * F.lit(float(factor)), digits).alias("mean_value"))


def qualified(
    people: DataFrame,
    licence_col: str,
    licence_map: Mapping[str, Sequence[str]],
    craft_type: str,
) -> DataFrame:
    """People whose licence covers the craft type.

    No column states who may fly what: ``licence_map`` (licence to craft
    types) is the caller's rule and becomes a plain filter.
    """
    licences = sorted(l for l, crafts in licence_map.items() if craft_type in crafts)
    return people.filter(F.col(licence_col).isin(licences))


def join_stored(left: DataFrame, right: DataFrame, on: str, how: str) -> DataFrame:
    """Join with aggregated rows that are unique by ``on``, whatever keys of the left are hot.

    A right side that Catalyst knows to be small is joined as it is, and broadcast.
    Any other is stored and scanned, so both sides come straight from a shuffle
    and AQE splits just the keys that turn out hot, into as many tasks as their
    size asks for, or broadcasts it by its measured size.
    """
    spark = right.sparkSession
    most = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    most = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(most) if most != "-1" else -1
    size = int(str(right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return left.join(right if size <= most else written(right, "join"), on, how)


def evidence_per_home(
    places: DataFrame, place_id: str, home: str, evidence: DataFrame, evidence_id: str
) -> DataFrame:
    """(home, n_places, n_evidenced): one row per home, whatever its number of places."""
    seen = evidence.select(F.col(evidence_id).alias("_seen")).distinct()
    flagged = places.select(F.col(home).alias("home"), F.col(place_id).alias("_place")).join(
        seen, F.col("_place") == F.col("_seen"), "left"
    )
    return flagged.groupBy("home").agg(
        F.count("_place").alias("n_places"), F.count("_seen").alias("n_evidenced")
    )


def qualified_with_evidence(
    people: DataFrame,
    licence_col: str,
    home_col: str,
    licence_map: Mapping[str, Sequence[str]],
    craft_type: str,
    per_home: DataFrame,
) -> DataFrame:
    """Qualified people, flagged by whether their home has a place with evidence.

    ``per_home`` comes from ``evidence_per_home``; people without a known home
    are kept with the flag false.
    """
    homes = per_home.select(
        F.col("home").alias("_home"), F.col("n_places").alias("_places"), F.col("n_evidenced").alias("_evidenced")
    )
    fit = qualified(people, licence_col, licence_map, craft_type).withColumn("_home", F.col(home_col))
    joined = join_stored(fit, homes, "_home", "left")
    return joined.select(
        *people.columns,
        F.coalesce("_places", F.lit(0)).alias("n_places"),
        F.coalesce("_evidenced", F.lit(0)).alias("n_evidenced"),
        (F.coalesce("_evidenced", F.lit(0)) > 0).alias("has_evidence"),
    )


def keep_evidenced(
    people: DataFrame,
    evidence: DataFrame,
    on: tuple[str, str],
    *,
    present: bool = True,
) -> DataFrame:
    """People with evidence (semi join), or with none (anti join).

    Repeated evidence collapses to one row per task before the shuffle; one key
    may hold any part of the people.
    """
    seen = evidence.select(F.col(on[1]).alias("_seen")).distinct()
    how = "left_semi" if present else "left_anti"
    return join_stored(people.withColumn("_seen", F.col(on[0])), seen, "_seen", how).drop("_seen")


def numbered(df: DataFrame, array_col: str, item: str = "item") -> DataFrame:
    """One row per list element, numbered from 1; the list column is replaced."""
    others = [c for c in df.columns if c != array_col]
    return df.select(*others, F.posexplode(array_col).alias("_pos", item)).select(
        *others, (F.col("_pos") + 1).alias("n"), item
    )


def joined_list(array_col: str, separator: str = ", ") -> Column:
    """List of text shown on one line."""
    return F.array_join(F.col(array_col), separator)
