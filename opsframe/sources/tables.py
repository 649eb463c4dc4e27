"""Typed CSV tables, full refresh, and configured sources as views."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.functions.text import blank_to_null, typed
from opsframe.sources import quoted


BROKEN = "_broken_row"  # The text of a row with too many or too few cells, else null.


def _raw_csv(
    spark: SparkSession, path: str, multi_line: bool, options: Mapping[str, str]
) -> DataFrame | None:
    """All cells as text under their header names, and ``BROKEN``; None when nothing is there.

    The header is read once and then enforced on every file of the path, so a
    file with another column order fails loudly instead of swapping columns.
    """
    reader = spark.read.option("header", True).option("escape", '"')
    reader = reader.option("multiLine", multi_line).options(**options)
    try:
        names = reader.csv(path).columns
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None
    cells = T.StructType([T.StructField(name, T.StringType()) for name in [*names, BROKEN]])
    # Without pruning, so that a row's cells are counted whatever columns are read.
    reader = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", BROKEN)
    raw = reader.schema(cells).option("enforceSchema", False).csv(path)
    if multi_line and quoted.splits_help(raw, options):
        return quoted.raw_cells(spark, path, names, BROKEN, options)
    return raw


def _checked_raw(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    multi_line: bool,
    options: Mapping[str, str],
) -> DataFrame | None:
    """The raw cells under the table's own names, whatever their case in the header."""
    raw = _raw_csv(spark, path, multi_line, options)
    if raw is None:
        return None
    own = {name.lower(): name for name in schema.names}
    names = [name for name in raw.columns if name != BROKEN]
    unknown = sorted(name for name in names if name.lower() not in own)
    if unknown:
        raise ValueError(f"{path}: header names not in the table: {unknown}")
    return raw.toDF(*[own[name.lower()] for name in names], BROKEN)


def load_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    multi_line: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """CSV with a header to a typed table, columns matched by name.

    Blank lines are skipped, blank cells are null, columns absent from the
    header are null, a missing or empty path is an empty table, and a header
    name the table lacks is an error. A row with too few cells has null in the
    rest, one with too many loses them; ``rejected_rows`` lists both. Line
    breaks inside quotes belong to their cell; files larger than a split are then
    read twice, by a task for each split. Pass ``multi_line=False`` for large files
    that have none. ``options`` go to the CSV reader (``sep``, say); with others than
    separator and null or empty values, such files are one task each.
    """
    raw = _checked_raw(spark, path, schema, multi_line, options or {})
    if raw is None:
        return spark.createDataFrame([], schema)
    return raw.select(
        *[
            (
                typed(F.col(f"`{f.name}`"), f.dataType)
                if f.name in raw.columns
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


def rejected_rows(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    multi_line: bool = True,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw rows with too many or too few cells, or a cell that is unreadable as its type.

    ``bad_columns`` lists the columns whose filled cell became null in the typed
    table; ``BROKEN`` has the text of a row whose number of cells is wrong.
    """
    raw = _checked_raw(spark, path, schema, multi_line, options or {})
    if raw is None:
        empty = [T.StructField(n, T.StringType()) for n in [*schema.names, BROKEN]]
        bad = T.StructField("bad_columns", T.ArrayType(T.StringType()))
        return spark.createDataFrame([], T.StructType([*empty, bad]))
    checks = [
        F.when(
            blank_to_null(F.col(f"`{f.name}`")).isNotNull()
            & typed(F.col(f"`{f.name}`"), f.dataType).isNull(),
            F.lit(f.name),
        )
        for f in schema.fields
        if f.name in raw.columns
    ]
    return raw.withColumn("bad_columns", F.array_compact(F.array(*checks))).filter(
        (F.size("bad_columns") > 0) | F.col(BROKEN).isNotNull()
    )


def refresh_tables(
    spark: SparkSession,
    specs: Mapping[str, tuple[str, T.StructType]],
    out_dir: str,
    *,
    at_a_time: int = 4,
) -> DataFrame:
    """Replace every table under ``out_dir`` by its CSV; one (table, rows) row each.

    A table is written beside the old one, which goes only when the new one is
    whole: a load that fails leaves the old rows. For readers that must not see
    the moment between the two, see ``refresh_versions``. Several tables load at a time, since one small table leaves a cluster idle.
    The counts come from the Parquet footers of what was written: the source is
    scanned once, and a task that ran twice is not counted twice.
    """

    def refresh(name: str) -> DataFrame:
        path, schema = specs[name]
        target = f"{out_dir.rstrip('/')}/{name}"
        beside = f"{out_dir.rstrip('/')}/_{name}-{uuid.uuid4().hex}"
        load_table(spark, path, schema).write.parquet(beside)
        _replaced(spark, beside, target)
        rows = spark.read.schema(schema).parquet(target).agg(F.count(F.lit(1)).alias("rows"))
        return rows.select(F.lit(name).alias("table"), "rows")

    if not specs:
        return spark.createDataFrame([], "table string, rows bigint")
    with ThreadPoolExecutor(at_a_time) as jobs:
        return reduce(DataFrame.unionAll, jobs.map(refresh, specs))


def _store(spark: SparkSession, path: str):
    """The file system of a path, and the path as it names it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return store, store.makeQualified(place)


def _replaced(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to the place of another one, which is deleted last."""
    store, new = _store(spark, source)
    _, place = _store(spark, target)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{source}-old")
    if store.exists(place) and not store.rename(place, old):
        raise OSError(f"{target}: cannot be moved aside")
    if not store.rename(new, place):
        store.rename(old, place)
        raise OSError(f"{target}: cannot be replaced")
    store.delete(old, True)


POINTER = "CURRENT"


def current_version(spark: SparkSession, out_dir: str, name: str) -> str | None:
    """The version that readers of a table get now; None before the first."""
    store, pointer = _store(spark, f"{out_dir.rstrip('/')}/{name}/{POINTER}")
    if not store.exists(pointer):
        return None
    stream = store.open(pointer)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
    finally:
        stream.close()


def _switched(spark: SparkSession, out_dir: str, name: str, version: str) -> None:
    """Point readers to a version: a file written beside, renamed over the old one in one step."""
    jvm, base = spark._jvm, f"{out_dir.rstrip('/')}/{name}"
    store, beside = _store(spark, f"{base}/_{POINTER}-{uuid.uuid4().hex}")
    _, pointer = _store(spark, f"{base}/{POINTER}")
    stream = store.create(beside)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(pointer.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(beside, pointer, options)


def versions(spark: SparkSession, out_dir: str, name: str) -> list[str]:
    """All versions of a table that are kept, in the order of their making."""
    store, base = _store(spark, f"{out_dir.rstrip('/')}/{name}")
    if not store.exists(base):
        return []
    names = [status.getPath().getName() for status in store.listStatus(base) if status.isDirectory()]
    return sorted(n for n in names if re.fullmatch(r"v\d{20}-[0-9a-f]{8}", n))


def refresh_versions(
    spark: SparkSession, specs: Mapping[str, tuple[str, T.StructType]], out_dir: str, *, keep: int = 2
) -> DataFrame:
    """Load every CSV as a new version of its table; (table, version, rows) each.

    A version is a folder of its own; when it is whole, readers are switched to it
    by one rename. A load that fails leaves the pointer and all older versions as
    they were, and what it wrote is no version that anyone reads. The newest
    ``keep`` versions stay, so a reader that holds the one before loses nothing.
    """
    found = []
    for name, (path, schema) in specs.items():
        base = f"{out_dir.rstrip('/')}/{name}"
        version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        load_table(spark, path, schema).write.parquet(f"{base}/{version}")
        _switched(spark, out_dir, name, version)
        for old in versions(spark, out_dir, name)[:-keep]:
            store, place = _store(spark, f"{base}/{old}")
            store.delete(place, True)
        rows = spark.read.schema(schema).parquet(f"{base}/{version}").agg(F.count(F.lit(1)).alias("rows"))
        found.append(rows.select(F.lit(name).alias("table"), F.lit(version).alias("version"), "rows"))
    if not found:
        return spark.createDataFrame([], "table string, version string, rows bigint")
    return reduce(DataFrame.unionAll, found)


def read_version(
    spark: SparkSession, out_dir: str, name: str, schema: T.StructType, version: str | None = None
) -> DataFrame:
    """The named version of a table, or the current one; no rows before the first."""
    version = version or current_version(spark, out_dir, name)
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{out_dir.rstrip('/')}/{name}/{version}")


@dataclass(frozen=True)
class Source:
    """One configured source: view name, location and format."""

    table_name: str
    uri: str
    format: str = "parquet"
    schema: T.StructType | None = None
    options: Mapping[str, str] = field(default_factory=dict)


FORMATS = ("csv", "json", "orc", "parquet", "text")


def read_source(spark: SparkSession, source: Source) -> DataFrame:
    """The frame behind a configured source.

    CSV with a schema binds by header name; without one the types are inferred,
    which costs a second pass over the file.
    """
    if source.format == "avro":
        raise ValueError("avro needs the external spark-avro module on the classpath")
    if source.format not in FORMATS:
        raise ValueError(f"unknown format {source.format!r}; known: {FORMATS}")
    if source.format == "csv" and source.schema is not None:
        return load_table(spark, source.uri, source.schema, options=source.options)
    reader = spark.read.format(source.format)
    if source.format == "csv":
        reader = reader.option("header", True)
        reader = reader.option("inferSchema", True)
    if source.schema is not None:
        reader = reader.schema(source.schema)
    return reader.options(**source.options).load(source.uri)


def register_sources(spark: SparkSession, sources: Iterable[Source]) -> list[str]:
    """Register every source as a temporary view; returns the view names."""
    names = []
    for source in sources:
        read_source(spark, source).createOrReplaceTempView(source.table_name)
        names.append(source.table_name)
    return names
