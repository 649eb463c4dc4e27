"""WARC archives: written as whole-file gzip streams, normalised to one member a record, read by index.

``write_archives`` makes one gzip stream of each task's records, as a crawler
that compresses whole files does. ``normalised`` inflates each such stream once,
piece by piece, writes every record again as a gzip member of its own, and
beside each archive a sidecar with the offset and length of every member, so that
a record can be read without what stands before it. ``records`` reads the
members that the sidecars list.

All files are written by Spark's text writer, so they can be in any store that
Spark reaches, and a task that runs twice leaves one file. It ends every row with
a separator: for streams that is the record's own last line break; for members
it is the zero byte with which a gzip member of less than 16 MB ends anyway
(its length, little end first). A longer record's member is followed by an empty one.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.sources.scratch import removed, shared_dir, written

#: Payloads of fewer bytes are written again for each page that has them.
LEAST_REVISIT = 100
PIECE = 1 << 20
LEVEL = 4
EPOCH = "2000-01-01T00:00:00Z"
# Fixed value: WARC's name of the profile of records whose payload an earlier one has.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = "page_id string, url string, record_type string, payload_bytes long, payload_digest string, refers_to string"
_GZIP = 31  # zlib's window bits for gzip streams
_ID = re.compile(r"<urn:page:(.*):sha256:([0-9a-f]{64})>")


def with_digest(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` with ``payload`` (UTF-8, empty for null), ``payload_bytes`` and ``payload_digest``."""
    payload = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    return pages.withColumns(
        {
            "payload": payload,
            "payload_bytes": F.octet_length(payload).cast("long"),
            "payload_digest": F.sha2(payload.cast("binary"), 256),
        }
    )


def _record_id(page_id: Column) -> Column:
    return F.concat(
        F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(":sha256:"),
        F.col("payload_digest"), F.lit(">"),
    )


def _header(name: str, value: Column) -> Column:
    """A header line; none for a null value. Line breaks and other controls are percent-encoded."""
    coded = F.regexp_replace(value, "%", "%25")
    for code in [*range(0x21), 0x7F]:
        coded = F.replace(coded, F.lit(chr(code)), F.lit(f"%{code:02X}"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), coded, F.lit("\r\n")), F.lit(""))


def _record(id_col: str, url_col: str) -> Column:
    """A whole record but for its last line break."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.col("payload_bytes").cast("string"),
        F.lit("\r\n\r\n"),
    )
    body = F.when(revisit, F.lit("")).otherwise(F.col("payload"))
    kept = F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes"))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "),
        _record_id(F.col(id_col)),
        F.lit(f"\r\nWARC-Date: {EPOCH}\r\n"),
        _header("WARC-Target-URI", F.col(url_col)),
        F.lit("WARC-Payload-Digest: sha256:"),
        F.col("payload_digest"),
        F.when(
            revisit,
            F.concat(
                F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "), _record_id(F.col("refers_to"))
            ),
        ).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: application/http; msgtype=response\r\nContent-Length: "),
        (F.octet_length(http) + kept).cast("string"),
        F.lit("\r\n\r\n"),
        http,
        body,
        F.lit("\r\n\r"),
    )


def with_revisits(pages: DataFrame, id_col: str = "page_id", least: int = LEAST_REVISIT) -> DataFrame:
    """Pages ``with_digest`` and ``refers_to``: the smallest id whose equal payload stands for theirs.

    It is null for the pages that have that id themselves, for payloads of less
    than ``least`` bytes, and where no page of the group has an id.
    """
    first = (
        pages.where(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.min(id_col).alias("__first"), F.count("*").alias("__n"))
        .where("__n > 1")
    )
    # Stored, so that the join is of plain tables and a payload that very many pages have can be split.
    first = written(first.select("payload_digest", "__first"), "payloads")
    own = F.col(id_col).eqNullSafe(F.col("__first"))
    return pages.join(first, "payload_digest", "left").select(
        *(F.col(f"`{c}`") for c in pages.columns), F.when(~own, F.col("__first")).alias("refers_to")
    )


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> None:
    """One WARC file a task, each a single gzip stream over all its records."""
    named = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"))
    found = with_revisits(with_digest(named), "id")
    found.select(_record("id", "url").alias("value")).write.option("compression", "gzip").option(
        "lineSep", "\n"
    ).text(path)


def _inflated(data: memoryview) -> Iterator[bytes]:
    """What a file of one or many gzip members, or without compression, holds, piece by piece."""
    if bytes(data[:2]) != b"\x1f\x8b":
        for at in range(0, len(data), PIECE):
            yield bytes(data[at : at + PIECE])
        return
    stream, rest, at = zlib.decompressobj(_GZIP), b"", 0
    while True:
        if not rest:
            if at >= len(data):
                break
            rest, at = bytes(data[at : at + PIECE]), at + PIECE
        if stream.eof:
            stream = zlib.decompressobj(_GZIP)
        piece = stream.decompress(rest, PIECE)
        rest = stream.unused_data if stream.eof else stream.unconsumed_tail
        yield piece
    while not stream.eof:
        piece = stream.decompress(stream.unconsumed_tail, PIECE)
        if not piece and not stream.eof:
            raise ValueError("the gzip stream ends within a member")
        yield piece


def _split(pieces: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """Header and block of each record of a stream; an unfinished record is an error."""
    waiting = bytearray()
    header, size = None, 0
    for piece in pieces:
        waiting += piece
        start = 0
        while True:
            if header is None:
                end = waiting.find(b"\r\n\r\n", start)
                if end < 0:
                    break
                header = bytes(waiting[start:end])
                size = int(_fields(header)["content-length"])
                start = end + 4
            if len(waiting) - start < size + 4:
                break
            if waiting[start + size : start + size + 4] != b"\r\n\r\n":
                raise ValueError("a record does not end where its length says")
            yield header, bytes(waiting[start : start + size])
            start, header = start + size + 4, None
        del waiting[:start]
    if header is not None or waiting:
        raise ValueError("the archive ends within a record")


def _fields(header: bytes) -> dict[str, str]:
    first, *lines = header.decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {first[:40]!r}")
    return {name.lower(): value.strip() for name, _, value in (line.partition(":") for line in lines)}


def _member(record: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP)
    member = packer.compress(record) + packer.flush()
    if member[-1]:
        empty = zlib.compressobj(LEVEL, zlib.DEFLATED, _GZIP)
        member += empty.flush()
    return member


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives to members without their last byte, and to lines of the sidecar.

    Offsets run on over all archives of a task, which become one file.
    """
    offset = number = 0
    waiting: list[tuple[str, int, bytes]] = []
    size = 0

    def sent() -> pa.RecordBatch:
        kinds, numbers, values = zip(*waiting, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(kinds), pa.array(numbers, pa.int64()), pa.array(values, pa.binary())],
            ["kind", "number", "value"],
        )

    for batch in batches:
        for content in batch.column(0):
            for header, block in _split(_inflated(memoryview(content.as_buffer()))):
                member = _member(header + b"\r\n\r\n" + block + b"\r\n\r\n")
                fields = _fields(header)
                line = "\t".join([str(offset), str(len(member)), fields["warc-type"], fields["warc-record-id"]])
                waiting += [("archive", number, member[:-1]), ("index", number, line.encode())]
                offset, number, size = offset + len(member), number + 1, size + len(member)
                if size >= PIECE:
                    yield sent()
                    waiting, size = [], 0
    if waiting:
        yield sent()


def normalised(spark: SparkSession, source: str, path: str) -> None:
    """Archives under ``source`` to archives with a member for each record, and their sidecars.

    ``path`` gets the folders ``kind=archive`` and ``kind=index``; files with the
    same part number belong together. A line of a sidecar, ended by a zero byte,
    has a member's offset, its length, the record's type and its id, by tabs. The
    archives of ``source`` may be one gzip stream, many members, or plain; one
    that breaks off fails the job.
    """
    archives = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(source)
    members = archives.where("length > 0").select("content").mapInArrow(
        _members, "kind string, number long, value binary"
    )
    # The order that the writer needs, so that it does not sort on its own.
    members.sortWithinPartitions("kind", "number").select(
        F.col("value").cast("string").alias("value"), "kind"
    ).write.partitionBy("kind").option("lineSep", "\0").text(path)


def sidecars(spark: SparkSession, path: str) -> DataFrame:
    """(part, offset, length, record_type, record_id) of every member of normalised archives."""
    lines = spark.read.option("lineSep", "\0").text(f"{path}/kind=index")
    cells = F.split("value", "\t")
    return lines.select(
        _part(F.col("_metadata.file_name")),
        cells[0].cast("long").alias("offset"),
        cells[1].cast("long").alias("length"),
        cells[2].alias("record_type"),
        cells[3].alias("record_id"),
    )


def _part(file: Column) -> Column:
    return F.regexp_extract(file, r"part-(\d+)", 1).cast("long").alias("part")


def _parsed(member: bytes) -> dict:
    """A record's row; its payload must have the digest and the length that are stated."""
    ((header, block),) = _split(_inflated(memoryview(member)))
    fields = _fields(header)
    http, _, payload = block.partition(b"\r\n\r\n")
    (size,) = (int(x.partition(b":")[2]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    page, digest = _ID.fullmatch(fields["warc-record-id"]).groups()
    if fields["warc-type"] == "response" and (
        hashlib.sha256(payload).hexdigest() != digest or len(payload) != size
    ):
        raise ValueError(f"the payload of {fields['warc-record-id']} is not what was written")
    refers = fields.get("warc-refers-to")
    url = fields.get("warc-target-uri")
    return {
        "page_id": page or None,
        "url": None if url is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), url),
        "record_type": fields["warc-type"],
        "payload_bytes": size,
        "payload_digest": digest,
        "refers_to": None if refers is None else _ID.fullmatch(refers)[1],
        "payload": payload,
    }


def _read(payload: bool):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.schema(
            [("page_id", pa.string()), ("url", pa.string()), ("record_type", pa.string()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.string())]
            + ([("payload", pa.binary())] if payload else [])
        )
        names = set(kind.names)
        for batch in batches:
            for content, places in zip(batch.column(0), batch.column(1).to_pylist(), strict=True):
                data, rows, size = memoryview(content.as_buffer()), [], 0
                for place in places:
                    row = _parsed(bytes(data[place["offset"] : place["offset"] + place["length"]]))
                    rows.append({c: x for c, x in row.items() if c in names})
                    size += len(row["payload"])
                    if size >= PIECE:
                        yield pa.RecordBatch.from_pylist(rows, kind)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    return of


def records(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """The records of normalised archives, read member by member at the sidecars' offsets.

    Columns: page_id and refers_to as strings, url, record_type, payload_bytes,
    payload_digest and, if asked for, payload (empty for a revisit). A payload that
    does not have its digest fails the job. Of a folder without archives there are none.
    """
    schema = RECORD + (", payload binary" if payload else "")
    try:
        return _members_read(spark, path, payload, schema)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _members_read(spark: SparkSession, path: str, payload: bool, schema: str) -> DataFrame:
    archives = spark.read.format("binaryFile").load(f"{path}/kind=archive").where("length > 0")
    # As many places as an archive has records, which is what a task wrote.
    places = sidecars(spark, path).groupBy("part").agg(
        F.array_sort(F.collect_list(F.struct("offset", "length"))).alias("places")
    )
    both = archives.select(_part(F.col("path")), "content").join(places, "part").select("content", "places")
    return both.mapInArrow(_read(payload), schema)


def archived(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Pages written to archives, normalised, and read back: a row for each, with the id's own type.

    Columns: the id, url, record_type, payload_bytes, payload_digest, refers_to.
    A page whose payload has 100 bytes or more and equals that of a page with a
    smaller id is a revisit of the smallest; bytes and digest are those of the
    full payload. Rows that repeat that smallest id are responses, and so are
    payloads that only pages without id have. A null html is empty. An empty
    table gives no rows. Other columns are not archived.
    """
    spark, kind = pages.sparkSession, pages.schema[id_col].dataType
    streams, archives = shared_dir(spark, "warc-streams"), shared_dir(spark, "warc")
    write_archives(pages, streams, id_col, url_col, html_col)
    normalised(spark, streams, archives)
    removed(spark, streams)
    return records(spark, archives).select(
        F.col("page_id").cast(kind).alias(id_col),
        "url",
        "record_type",
        "payload_bytes",
        "payload_digest",
        F.col("refers_to").cast(kind).alias("refers_to"),
    )
