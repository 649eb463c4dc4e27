"""Lines repeated across documents, suspected by two Bloom filters and confirmed exactly.

Every task sets the hashes of its lines in a filter of lines seen once and, when
they are there already, in a filter of lines seen twice. Merging the filters of
all tasks sets as twice seen what two of them have seen once. Only lines in the
merged twice-seen filter shuffle, as (line, document) rows: they are counted
exactly, and the last document holding a line is chosen.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from opsframe.sources.scratch import written

MIN_CHARS = 20
MIN_DOCS = 3
SPACE = b" \t\n\x0b\x0c\r"
SEED = 7
BITS_PER_LINE = 8
HASHES = 2
#: Filters are split into segments of so many bits, which are merged apart.
SEGMENT_BITS = 1 << 20
#: Bytes of the filter that is broadcast, at most. With more lines than fit, more
#: of them are suspected and shuffled; none is missed.
FILTER_BYTES = 8 << 20


def key_of(line: bytes) -> bytes:
    return line.strip(SPACE).lower()


def _long_enough(key: bytes, least: int) -> bool:
    return len(key) >= least and len(key) - _continued(key) >= least


def _continued(key: bytes) -> int:
    """Bytes that only continue a code point."""
    return 0 if key.isascii() else len(key) - len(key.decode())


def keys_of(text: bytes | None, least: int) -> list[bytes | None]:
    """One key per line; None for lines too short to count."""
    keys = (key_of(line) for line in (text or b"").split(b"\n"))
    return [key if _long_enough(key, least) else None for key in keys]


def _places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Filter positions of each hash, by double hashing."""
    low, high = hashes & np.uint64(0xFFFFFFFF), hashes >> np.uint64(32) | np.uint64(1)
    return [((low + np.uint64(k) * high) % np.uint64(bits)).astype(np.int64) for k in range(HASHES)]


class TwoFilters:
    """Bits for lines seen once and for lines seen twice or more."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.once = np.zeros(bits, bool)
        self.twice = np.zeros(bits, bool)

    def add(self, hashes: np.ndarray) -> None:
        """Of hashes that repeat within the call, every one after the first counts as a repeat."""
        unique, counts = np.unique(hashes, return_counts=True)
        places = _places(unique, self.bits)
        again = (counts > 1) | np.logical_and.reduce([self.once[p] for p in places])
        for p in places:
            self.twice[p[again]] = True
            self.once[p] = True

    def segments(self) -> Iterator[dict]:
        for at in range(0, self.bits, SEGMENT_BITS):
            once = self.once[at : at + SEGMENT_BITS]
            if once.any():
                twice = self.twice[at : at + SEGMENT_BITS]
                yield {
                    "segment": at // SEGMENT_BITS,
                    "once": np.packbits(once).tobytes(),
                    "twice": np.packbits(twice).tobytes(),
                }


def merged(parts: Iterator[tuple[bytes, bytes]]) -> tuple[bytes, bytes] | None:
    """One segment's filters of several tasks: what two have seen once is seen twice."""
    once = twice = None
    for a, b in parts:
        a, b = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
        if once is None:
            once, twice = a.copy(), b.copy()
        else:
            twice |= b | (once & a)
            once |= a
    return None if once is None else (once.tobytes(), twice.tobytes())


_SEGMENT = pa.schema([("segment", pa.int64()), ("once", pa.binary()), ("twice", pa.binary())])


def _filters(bits: int, least: int):
    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = TwoFilters(bits)
        digest = xxhash.xxh64_intdigest
        for batch in batches:
            hashes: list[int] = []
            for raw in batch.column(0).cast(pa.binary()):
                keys = {k for k in keys_of(raw.as_py(), least) if k is not None}
                hashes += [digest(k, SEED) for k in keys]
            filters.add(np.array(hashes, np.uint64))
        for segment in filters.segments():
            yield pa.RecordBatch.from_pylist([segment], _SEGMENT)

    return of


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merges segments as they come; at most one pair of filters per segment is held."""
    held: dict[int, tuple[bytes, bytes]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            mine = (row["once"], row["twice"])
            old = held.get(row["segment"])
            held[row["segment"]] = mine if old is None else merged(iter((old, mine)))
    for segment, (once, twice) in held.items():
        yield pa.RecordBatch.from_pylist([{"segment": segment, "once": once, "twice": twice}], _SEGMENT)


def _filter_bits(lines: int) -> int:
    segments = -(-max(1, lines * BITS_PER_LINE) // SEGMENT_BITS)
    return min(segments * SEGMENT_BITS, FILTER_BYTES * 8)


def twice_seen(texts: DataFrame, least: int) -> tuple[Broadcast, int]:
    """The merged twice-seen filter, at most ``FILTER_BYTES``, and its number of bits."""
    spark = texts.sparkSession
    lines = texts.agg(
        F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    ).first()[0]
    bits = _filter_bits(lines or 0)
    segments = (
        texts.mapInArrow(_filters(bits, least), "segment long, once binary, twice binary")
        .repartition("segment")
        .mapInArrow(_merge, "segment long, once binary, twice binary")
        .select("segment", "twice")
    )
    whole = bytearray(bits // 8)
    for segment, twice in segments.toLocalIterator():
        at = segment * SEGMENT_BITS // 8
        whole[at : at + len(twice)] = twice
    return spark.sparkContext.broadcast(bytes(whole)), bits


def _suspects(twice: Broadcast, bits: int, least: int):
    """Distinct keys of a text that the filter has; null where there are none."""
    digest = xxhash.xxh64_intdigest

    def of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        filled = np.frombuffer(twice.value, np.uint8)
        for batch in batches:
            found = []
            for raw in batch.cast(pa.binary()):
                keys = [*dict.fromkeys(k for k in keys_of(raw.as_py(), least) if k is not None)]
                if keys:
                    hashes = np.fromiter((digest(k, SEED) for k in keys), np.uint64, len(keys))
                    hit = np.logical_and.reduce(
                        [filled[p >> 3] >> (7 - (p & 7)) & 1 for p in _places(hashes, bits)]
                    ).astype(bool)
                    keys = [k.decode() for k, on in zip(keys, hit.tolist(), strict=True) if on]
                found.append(keys or None)
            yield pa.array(found, pa.list_(pa.string()))

    return F.arrow_udf(of, "array<string>")


def _kept(least: int):
    """Line counts and the lines that stay, given the keys to drop."""
    kind = pa.struct([("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept", pa.string())])

    def of(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for texts, drops in batches:
            out = []
            for raw, drop in zip(texts.cast(pa.binary()), drops.to_pylist(), strict=True):
                text = raw.as_py() or b""
                n = text.count(b"\n") + 1
                gone = 0
                if drop:
                    out_of = {x.encode() for x in drop}
                    lines = text.split(b"\n")
                    stay = [x for x in lines if key_of(x) not in out_of]
                    gone = n - len(stay)
                    text = b"\n".join(stay)
                out.append({"n_lines": n, "n_dropped": gone, "kept": text.decode()})
            yield pa.array(out, kind)

    return F.arrow_udf(of, "struct<n_lines:bigint,n_dropped:bigint,kept:string>")


def deduplicated(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = MIN_CHARS,
    most: int = MIN_DOCS,
) -> DataFrame:
    """``docs`` with ``lines``: n_lines, n_dropped and the ``kept`` text.

    A line's key is the line without ASCII white space at its ends, A-Z
    lower-cased. Keys of ``least`` code points or more in ``most`` documents or
    more lose their lines, except in the document with the largest id. A row is
    a document: rows that repeat an id count apart and are treated alike, and a
    null id is smaller than any other. A null or empty text is one empty line.
    Rows stay; a column ``lines`` that was there is replaced.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    filled, bits = twice_seen(rows.select("text"), least)
    suspects = written(
        rows.withColumn("key", F.explode(_suspects(filled, bits, least)("text"))).select("id", "key"),
        "suspects",
    )
    repeated = written(
        suspects.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("last"))
        .where(F.col("n") >= most).select("key", "last"),
        "repeated",
    )
    drops = (
        suspects.join(repeated, "key")
        .where(~F.col("id").eqNullSafe(F.col("last")))
        .groupBy("id")
        .agg(F.collect_set("key").alias("__drop"))
    )
    return (
        docs.join(drops, F.col(id_col).eqNullSafe(drops.id), "left")
        .withColumn("lines", _kept(least)(F.col(text_col), F.col("__drop")))
        .drop(drops.id)
        .drop("__drop")
    )
