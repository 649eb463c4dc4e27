"""File listing and whole-file text under one root folder."""

from __future__ import annotations

import posixpath
import re
from concurrent.futures import ThreadPoolExecutor

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MAX_CHARS = 65536  # Fixed value: characters of one piece of a file, where pieces are asked for.


def _split(root: str) -> tuple[str, str]:
    """(scheme and authority, normal path) of the root folder."""
    store, path = re.fullmatch(r"([A-Za-z][\w+.-]*:(?://[^/]*)?)?(.*)", root, re.S).groups()
    return store or "", posixpath.normpath(path)


def _inside(root: str, subdir: str) -> str:
    """``root/subdir``; ValueError when it leaves root, compared by components."""
    store, base = _split(root)
    target = posixpath.normpath(posixpath.join(base, subdir))
    if posixpath.commonpath([base, target]) != base:
        raise ValueError(f"{subdir!r} escapes the root folder")
    return store + re.sub(r"([\\*?{}\[\]])", r"\\\1", target)


def _qualified(spark: SparkSession, root: str) -> str:
    """The root as the file system writes it in front of its files' paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path("".join(_split(root)))
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.makeQualified(path).toString().rstrip("/") + "/"


def _files(spark: SparkSession, root: str, subdir: str) -> DataFrame:
    """Every file below ``root/subdir`` with its path relative to root."""
    target = _inside(root, subdir)
    base = _qualified(spark, root)
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    try:
        found = reader.load(target)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        found = spark.createDataFrame(
            [],
            "path string, modificationTime timestamp, length bigint, content binary",
        )
    return found.withColumn("path", F.substr(F.col("path"), F.lit(len(base) + 1)))


def _listed(spark: SparkSession, root: str, subdir: str, at_a_time: int) -> DataFrame:
    """Every file below, hidden ones too: folders are listed in rounds, some at a time."""
    target = re.sub(r"\\([\\*?{}\[\]])", r"\1", _inside(root, subdir))
    base = _qualified(spark, root)
    folder = spark._jvm.org.apache.hadoop.fs.Path(target)
    store = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    rows: list[tuple[str, int, int]] = []

    def listed(path) -> list:
        """Folders in a folder; its files go to the rows."""
        below = []
        for status in store.listStatus(path):
            if status.isDirectory():
                below.append(status.getPath())
            else:
                rows.append((status.getPath().toString()[len(base) :], status.getLen(), status.getModificationTime()))
        return below

    front = [store.makeQualified(folder)] if store.exists(folder) else []
    with ThreadPoolExecutor(at_a_time) as jobs:
        while front:
            front = [path for below in jobs.map(listed, front) for path in below]
    found = spark.createDataFrame(rows, "path string, length bigint, ms bigint")
    return found.select("path", "length", F.timestamp_millis("ms").alias("modified")).orderBy("path")


def list_files(
    spark: SparkSession, root: str, subdir: str = "", *, hidden: bool = False, at_a_time: int = 16
) -> DataFrame:
    """(path, length, modified) of every file below, sorted by path.

    Paths are relative to the root. A missing folder gives no rows. File
    content is not read. Spark skips names that start with ``_`` or ``.``; with
    ``hidden`` these are listed too, folder by folder, ``at_a_time`` of them at once.
    Either way the driver holds the list of files.
    """
    if hidden:
        return _listed(spark, root, subdir, at_a_time)
    return (
        _files(spark, root, subdir)
        .select("path", "length", F.col("modificationTime").alias("modified"))
        .orderBy("path")
    )


def plain_lines(text: Column) -> Column:
    """The text with line ends as ``\\n``."""
    return F.regexp_replace(text, "\r\n?", "\n")


def pieces(text: Column, max_chars: int = MAX_CHARS) -> Column:
    """A text as a list of pieces of at most ``max_chars`` characters that join up to it.

    An empty text is one empty piece, a null one none.
    """
    n = F.greatest(F.ceil(F.length(text) / F.lit(max_chars)), F.lit(1)).cast("int")
    split = F.transform(
        F.sequence(F.lit(0), n - 1), lambda i: F.substr(text, i * max_chars + 1, F.lit(max_chars))
    )
    return F.when(text.isNotNull(), split)


def in_pieces(texts: DataFrame, max_chars: int = MAX_CHARS, text_col: str = "text") -> DataFrame:
    """One row per piece of every text, numbered from 1 in ``piece``; no character is lost."""
    others = [c for c in texts.columns if c != text_col]
    split = F.posexplode(pieces(F.col(text_col), max_chars)).alias("_at", text_col)
    return texts.select(*others, split).select(
        *others, (F.col("_at") + 1).alias("piece"), text_col
    )


def read_text_files(
    spark: SparkSession,
    root: str,
    subdir: str = "",
    max_chars: int | None = None,
) -> DataFrame:
    """(path, text): each file as one whole UTF-8 text, line ends as ``\\n``.

    With ``max_chars``, (path, piece, text): long texts in numbered pieces.
    """
    text = plain_lines(F.decode("content", "utf-8"))
    whole = _files(spark, root, subdir).select("path", text.alias("text"))
    return whole if max_chars is None else in_pieces(whole, max_chars)
