"""CSV files with line breaks in quotes, read by many tasks.

Whether a line break ends a record depends on all quotes before it. Each split of
a file finds out where it ends, inside a quoted cell or not, for either way in
which it may start; composing these along the file's splits tells how each one
starts. Then every split reads its own records, and the few that run over a
border are put together from their pieces.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.sources.scratch import written

# Sent to the executors by value, so that they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

QUOTE = '"'
#: Options of the CSV reader under which records are found as here.
KNOWN_OPTIONS = ("sep", "delimiter", "nullvalue", "emptyvalue", "header")
_ENDS = "split long, out_ends boolean, in_ends boolean"
_BATCH = 4_096


def ends_inside(line: str, inside: bool, sep: str) -> bool:
    """Whether a line that starts inside a quoted cell, or not, ends in one.

    A quote opens a cell only where the cell starts, a doubled one inside stands
    for itself, and what follows a closing quote runs on to the separator.
    """
    if QUOTE not in line:
        return inside
    at = 0
    while True:
        if not inside:
            if line.startswith(QUOTE, at):
                inside, at = True, at + 1
            else:
                at = line.find(sep, at)
                if at < 0:
                    return False
                at += len(sep)
                continue
        at = line.find(QUOTE, at)
        if at < 0:
            return True
        if line.startswith(QUOTE, at + 1):
            at += 2
            continue
        inside = False
        at = line.find(sep, at + 1)
        if at < 0:
            return False
        at += len(sep)


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(split, file, start, line): lines in order within each split, which is a run of rows of a task."""
    place = F.col("_metadata")
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.xxhash64(place["file_path"], place["file_block_start"]).alias("split"),
            place["file_path"].alias("file"),
            place["file_block_start"].alias("start"),
            F.col("value").alias("line"),
        )
    )


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[str]]]:
    """Lines of one split at a time, in parts."""
    for batch in batches:
        splits = batch.column(0).to_numpy()
        lines = batch.column(1).to_pylist()
        edges = [0, *(np.flatnonzero(splits[1:] != splits[:-1]) + 1).tolist(), len(splits)]
        for a, b in zip(edges, edges[1:], strict=False):
            if b > a:
                yield int(splits[a]), lines[a:b]


def _ends(sep: str):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list[bool]] = {}
        for split, lines in _by_split(batches):
            state = found.setdefault(split, [False, True])
            for line in lines:
                if QUOTE in line:
                    state[:] = [ends_inside(line, inside, sep) for inside in state]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found.keys(), pa.int64()),
                pa.array([out for out, _ in found.values()], pa.bool_()),
                pa.array([in_ for _, in_ in found.values()], pa.bool_()),
            ],
            ["split", "out_ends", "in_ends"],
        )

    return of


def _start_of(known: tuple[np.ndarray, np.ndarray, np.ndarray], split: int) -> tuple[bool, bool]:
    """Whether the split starts inside a quoted cell, and whether it is its file's first."""
    splits, inside, first = known
    at = int(np.searchsorted(splits, split))
    if at == len(splits) or splits[at] != split:
        raise ValueError("files or splits have changed since the table was opened: load it again")
    return bool(inside[at]), bool(first[at])


def _starts(lines: DataFrame, sep: str) -> DataFrame:
    """(split, file, start, inside, first), stored: a row for each split that has lines."""
    # Of a split a task has all lines, so that its ends need no second look.
    ends = lines.select("split", "line").mapInArrow(_ends(sep), _ENDS)
    places = lines.groupBy("split").agg(F.first("file").alias("file"), F.first("start").alias("start"))
    known = written(ends.join(places, "split"), "splits")
    along = Window.partitionBy("file").orderBy("start")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    # A split ends as it starts, or the other way round, or in one way however it starts.
    fixed = F.col("out_ends") == F.col("in_ends")
    swaps = F.col("out_ends") & ~F.col("in_ends")
    flips = F.sum(swaps.cast("long")).over(along.rowsBetween(Window.unboundedPreceding, 0))
    last = F.last(F.when(fixed, F.struct("out_ends", F.col("flips"))), ignorenulls=True).over(before)
    # The state after the last split that fixes it, turned by every swap since then.
    turned = F.coalesce(F.lag("flips").over(along), F.lit(0)) - F.coalesce(F.col("last.flips"), F.lit(0))
    return written(
        known.withColumn("flips", flips)
        .withColumn("last", last)
        .withColumn("turned", turned)
        .select(
            "split",
            "file",
            "start",
            ((F.coalesce(F.col("last.out_ends"), F.lit(False)).cast("long") + F.col("turned")) % 2 == 1).alias("inside"),
            (F.row_number().over(along) == 1).alias("first"),
        ),
        "starts",
    )


def _split_records(sep: str, starts, pieces: bool):
    """A split's own records, or what it has of records that run over its borders.

    Pieces are ``head`` (up to where the record ends), ``middle`` (the whole
    split is inside one) or ``tail``. ``first`` marks what starts a file.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, str, bool, str]] = []

        def sent() -> pa.RecordBatch:
            splits, kinds, firsts, texts = zip(*out, strict=True)
            out.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(splits, pa.int64()), pa.array(kinds, pa.string()), pa.array(firsts, pa.bool_()),
                 pa.array(texts, pa.string())], ["split", "kind", "first", "record"],
            )

        now, parts, inside, first, head = None, [], False, False, False

        def close() -> None:
            if parts and pieces:
                kind = "middle" if head else "tail"
                out.append((now, kind, first and kind == "tail", "\n".join(parts)))

        for split, lines in _by_split(batches):
            if split != now:
                close()
                now, parts = split, []
                inside, first = _start_of(starts.value, split)
                head = inside
            for line in lines:
                if not inside and QUOTE not in line and not pieces:
                    if line.rstrip("\r"):
                        out.append((split, "record", first, line))
                        first = False
                    continue
                if pieces and not inside and not parts and line.rstrip("\r") and not ends_inside(line, False, sep):
                    first = False
                    continue
                inside = ends_inside(line, inside, sep)
                parts.append(line)
                if not inside:
                    text = "\n".join(parts)
                    if head:
                        if pieces:
                            out.append((split, "head", False, text))
                    elif text.rstrip("\r"):
                        if not pieces:
                            out.append((split, "record", first, text))
                        first = False
                    parts, head = [], False
            if len(out) >= _BATCH:
                yield sent()
        close()
        if out:
            yield sent()

    return of


_RECORD = "split long, kind string, first boolean, record string"


def records(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> DataFrame:
    """(first, record): the records of CSV files, without the last line break; ``first`` marks headers.

    Empty lines are left out. How the splits start is settled at the call, a
    hash of 8 bytes and two flags for each; if the files or the size of splits
    are others when the frame is read, it fails.
    """
    lines = _lines(spark, path)
    starts = _starts(lines, sep)
    table = starts.select("split", "inside", "first").toArrow()
    arrays = [table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in table.column_names]
    order = np.argsort(arrays[0])
    known = spark.sparkContext.broadcast(
        tuple(np.asarray(x, t)[order] for x, t in zip(arrays, (np.int64, bool, bool), strict=True))
    )
    cells = lines.select("split", "line")
    own = cells.mapInArrow(_split_records(sep, known, False), _RECORD).select("first", "record")
    if not np.asarray(arrays[1], bool).any():
        return own
    pieces = written(cells.mapInArrow(_split_records(sep, known, True), _RECORD), "pieces")
    along = Window.partitionBy("file").orderBy("start", F.col("kind") == "tail").rowsBetween(Window.unboundedPreceding, 0)
    # A tail starts a record; middles and a head after it belong to it. Two pieces a split at most.
    numbered = pieces.join(starts.select("split", "file", "start"), "split").withColumn(
        "n", F.count(F.when(F.col("kind") == "tail", 1)).over(along)
    )
    stitched = numbered.groupBy("file", "n").agg(
        F.max("first").alias("first"),
        F.array_sort(F.collect_list(F.struct("start", (F.col("kind") == "tail").alias("last"), "record"))).alias("parts"),
    )
    whole = F.array_join(F.transform("parts", lambda x: x["record"]), "\n")
    return own.unionByName(stitched.select("first", whole.alias("record")))


def raw_cells(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Sequence[str],
    broken: str,
    options: Mapping[str, str],
) -> DataFrame:
    """Every cell as text under its header name, and ``broken``, as Spark's CSV reader gives them.

    Each file must begin with the header of these names. Files whose lines end with a
    carriage return have them, in quotes as well, as plain line breaks.
    """
    sep = {k.lower(): v for k, v in options.items()}.get("sep") or options.get("delimiter") or ","
    cells = T.StructType([T.StructField(name, T.StringType()) for name in [*names, broken]])
    given = {"mode": "PERMISSIVE", "escape": QUOTE, **options, "columnNameOfCorruptRecord": broken, "columnPruning": "false"}
    text = F.regexp_replace(F.regexp_replace("record", r"\r\z", ""), "\r\n", "\n")
    row = F.from_csv(text, _ddl(cells), given)
    header = F.array(*[F.col("row")[n] for n in names])
    same = F.coalesce(header == F.array(*[F.lit(n) for n in names]), F.lit(False))
    wrong = F.raise_error(F.concat(F.lit("a file has another header: "), F.col("record")))
    kept = F.when(F.col("first"), F.when(same, F.lit(False)).otherwise(wrong.cast("boolean"))).otherwise(F.lit(True))
    return (
        records(spark, path, sep)
        .withColumn("row", row)
        .where(kept)
        .select(*[F.col("row")[f.name].alias(f.name) for f in cells.fields])
    )


def _ddl(cells: T.StructType) -> str:
    return ", ".join(f"`{f.name.replace('`', '``')}` string" for f in cells.fields)


def splits_help(raw: DataFrame, options: Mapping[str, str]) -> bool:
    """Whether files behind a CSV frame are larger than a split, and have options known here."""
    if any(k.lower() not in KNOWN_OPTIONS for k in options):
        return False
    size = int(str(raw._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    key = "spark.sql.files.maxPartitionBytes"
    most = raw.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(
        raw.sparkSession.conf.get(key)
    )
    return size > most
