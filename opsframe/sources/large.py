"""Text files of any size, in numbered pieces that no task has to hold together.

A file is read by a task for each split. How many characters stand before a split
is a sum over the splits before it, so every task can number the pieces that its
lines belong to; fragments of a piece that runs over a border are joined.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from opsframe.sources.files import MAX_CHARS, _inside, _qualified, list_files, plain_lines
from opsframe.sources.scratch import written

# Sent to the executors by value, so that they need not have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_FRAGMENT = "split long, piece long, at long, fragment string"
_SENT = 1 << 20


def _fragments(starts, max_chars: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splits, offsets, ends_bare = starts.value
        out: list[tuple[int, int, int, str]] = []
        size = 0
        now, at, total, bare = None, 0, 0, False
        waiting: list[str] = []
        held = 0

        def cut(whole: bool) -> None:
            """Hand on the pieces that the waiting text fills; all of it if ``whole``."""
            nonlocal at, held, size
            text = "".join(waiting)
            done = 0
            while done < len(text):
                room = max_chars - at % max_chars
                if not whole and len(text) - done < room:
                    break
                part = text[done : done + room]
                out.append((now, at // max_chars + 1, at % max_chars, part))
                at += len(part)
                done += len(part)
                size += len(part)
            waiting[:] = [text[done:]] if done < len(text) else []
            held = len(text) - done

        def close() -> None:
            nonlocal held
            if now is not None:
                if bare and waiting:
                    waiting[-1] = waiting[-1][:-1]  # the file ends without a line break
                cut(True)

        def sent() -> pa.RecordBatch:
            nonlocal size
            columns = list(zip(*out, strict=True))
            out.clear()
            size = 0
            return pa.RecordBatch.from_arrays(
                [*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())],
                ["split", "piece", "at", "fragment"],
            )

        for batch in batches:
            keys = batch.column(0).to_numpy()
            for split, line in zip(keys.tolist(), batch.column(1).to_pylist(), strict=True):
                if split != now:
                    close()
                    now = split
                    k = int(np.searchsorted(splits, split))
                    if k == len(splits) or splits[k] != split:
                        raise ValueError("files or splits have changed since the files were opened: read them again")
                    at, bare = int(offsets[k]), bool(ends_bare[k])
                waiting.append(line + "\n")
                held += len(line) + 1
                if held > max_chars + 1:
                    last = waiting.pop()  # its line break may be none
                    keep, held = last, held - len(last)
                    cut(False)
                    waiting.append(keep)
                    held += len(keep)
            if size >= _SENT:
                yield sent()
        close()
        if out:
            yield sent()

    return of


def read_large_texts(
    spark: SparkSession, root: str, subdir: str = "", max_chars: int = MAX_CHARS
) -> DataFrame:
    """(path, piece, text): every file below, in pieces of ``max_chars`` characters numbered from 1.

    The same pieces as those of ``read_text_files``, for files of any size: no task
    holds more than a line and a piece. Line ends become ``\\n``, characters are never
    cut, an empty file is one empty piece. The files are read twice, and must not
    change between the call and the reading; the number of splits is what the
    driver gathers.
    """
    listed = list_files(spark, root, subdir).select("path", "length")
    place = F.col("_metadata")
    base = _qualified(spark, root)
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    try:
        read = reader.text(_inside(root, subdir))
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "path string, piece long, text string")
    lines = read.select(
        F.xxhash64(place["file_path"], place["file_block_start"]).alias("split"),
        F.url_decode(F.replace(F.substr(place["file_path"], F.lit(1)), F.lit("+"), F.lit("%2B"))).alias("file"),
        place["file_block_start"].alias("start"),
        place["file_size"].alias("file_size"),
        F.octet_length("value").alias("bytes"),
        # A carriage return before the line break is part of it.
        plain_lines(F.regexp_replace("value", r"\r\z", "")).alias("line"),
    )
    sums = lines.groupBy("split").agg(
        F.first("file").alias("file"), F.first("start").alias("start"), F.first("file_size").alias("file_size"),
        F.sum(F.length("line") + 1).alias("chars"), F.sum(F.col("bytes") + 1).alias("bytes"),
    )
    along = Window.partitionBy("file").orderBy("start")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("file")
    known = written(
        sums.select(
            "split",
            F.regexp_replace("file", "^file:/+", "file:/").alias("file"),
            F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("offset"),
            (
                (F.sum("bytes").over(whole) > F.col("file_size")) & (F.col("start") == F.max("start").over(whole))
            ).alias("ends_bare"),
        ),
        "splits",
    )
    table = known.select("split", "offset", "ends_bare").toArrow()
    arrays = [table.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in table.column_names]
    order = np.argsort(arrays[0])
    kinds = (np.int64, np.int64, bool)
    starts = spark.sparkContext.broadcast(tuple(np.asarray(x, t)[order] for x, t in zip(arrays, kinds, strict=True)))
    fragments = lines.select("split", "line").mapInArrow(_fragments(starts, max_chars), _FRAGMENT)
    prefix = base.removeprefix("file:").lstrip("/") if base.startswith("file:") else base
    path = F.regexp_replace("file", "^file:/+", "") if base.startswith("file:") else F.col("file")
    placed = fragments.join(known.select("split", "file"), "split").withColumn(
        "path", F.substr(path, F.lit(len(prefix) + 1))
    )
    # As many fragments as a piece has parts: its lines are joined in the task before.
    parts = F.array_sort(F.collect_list(F.struct("at", "fragment")))
    pieces = placed.groupBy("path", "piece").agg(parts.alias("parts")).select(
        "path", "piece", F.array_join(F.col("parts.fragment"), "").alias("text")
    )
    empty = listed.filter(F.col("length") == 0).select("path", F.lit(1).cast("long").alias("piece"), F.lit("").alias("text"))
    return pieces.unionByName(empty)
