"""Near-duplicate documents by SimHash fingerprints, found through Golay codes.

A 64-bit fingerprint is cut into three segments of 22, 21 and 21 bits. Each is
read as a word of the perfect binary Golay code [23, 12, 7]: the codewords
within distance four of it (one, or six when the nearest is three away) name it
by 12-bit indices, so that two segments at distance two or less always share an
index, and a segment at distance one contains the other's nearest codeword.

At most four differing bits fall on the three segments in one of two ways:

* one segment is equal and another differs in two bits or less: keys of
  (equal segment, index of the other);
* every segment differs, two of them in one bit and the third in two or less:
  keys of three indices, one from each segment. The fingerprint on one side
  needs its nearest codewords only, in the two segments with one bit.

So every link shares a key. Keys shuffle as numbers, the members of a key are
compared bit by bit, and only a spanning forest of each key's links goes on.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.llm.components import Forest, connected
from opsframe.sources.scratch import written

BITS = 64
MAX_DISTANCE = 4
SHINGLE = 4
SEED = 42
# (first bit, number of bits) of the three segments.
SEGMENTS = ((0, 22), (22, 21), (43, 21))
# Fixed value: the generator polynomial of the binary Golay code,
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GENERATOR = 0b110001110101
SMALL_RUN = 48
LARGE_RUN = 32_768
SHINGLES_AT_ONCE = 65_536
FINGERPRINTS_AT_ONCE = 2_048
#: Linked fingerprints that a task remembers, so as not to connect them again.
FOREST_NODES = 1_000_000


def text_fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The SimHash of one UTF-8 text as a signed 64-bit number; zero without words.

    Words are separated by ASCII white space and A-Z are lower-cased. A bit is
    set when over half of the shingles' XXH64 values have it; repeats count.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    whole = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    stops = ends[len(words) - n :].tolist()
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    counts = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, n, SHINGLES_AT_ONCE):
        some = [
            digest(whole[a:b], SEED)
            for a, b in zip(
                starts[at : at + SHINGLES_AT_ONCE], stops[at : at + SHINGLES_AT_ONCE], strict=True
            )
        ]
        rows = np.array(some, "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(rows, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    value = np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0]
    return int(value.astype(np.int64))


def fingerprint(text: Column, shingle: int = SHINGLE) -> Column:
    """SimHash of a text column as a long; null and empty texts give zero."""

    @F.arrow_udf("long")
    def of(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for some in texts:
            raw = some.cast(pa.binary())
            yield pa.array([text_fingerprint(x.as_py(), shingle) for x in raw], pa.int64())

    return of(text)


class Golay:
    """Tables of the [23, 12, 7] code, built from its generator polynomial."""

    def __init__(self) -> None:
        rest = np.arange(1 << 12, dtype=np.int64) << 11
        for bit in range(22, 10, -1):
            rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
        #: What is left of each message, shifted by 11 bits, modulo the generator.
        self.rest = rest
        #: For each syndrome the errors of weight four or less, nearest first, else -1.
        self.errors = np.full((1 << 11, 6), -1, np.int64)
        filled = np.zeros(1 << 11, np.int64)
        for weight in range(5):
            for places in combinations(range(23), weight):
                error = sum(1 << p for p in places)
                s = int(self.syndrome(np.array([error]))[0])
                if weight < 4 or filled[s] and int(self.errors[s, 0]).bit_count() == 3:
                    self.errors[s, filled[s]] = error
                    filled[s] += 1

    def syndrome(self, words: np.ndarray) -> np.ndarray:
        return self.rest[words >> 11] ^ (words & 0x7FF)

    def indices(self, words: np.ndarray) -> np.ndarray:
        """Per word the indices of its codewords within distance four: six columns, -1 where none."""
        errors = self.errors[self.syndrome(words)]
        return np.where(errors < 0, -1, (words[:, None] ^ errors) >> 11)


_golay: list[Golay] = []


def golay() -> Golay:
    """The tables, built once in each process."""
    if not _golay:
        _golay.append(Golay())
    return _golay[0]


def keys_of(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and keys: any two fingerprints within four bits share a key."""
    prints = fingerprints.astype(np.uint64)
    raw = [
        ((prints >> np.uint64(at)) & np.uint64((1 << n) - 1)).astype(np.int64) for at, n in SEGMENTS
    ]
    near = [golay().indices(x) for x in raw]
    rows = np.arange(len(prints))
    found_rows, found_keys = [], []
    for tag, (i, j) in enumerate((i, j) for i in range(3) for j in range(3) if i != j):
        at, column = np.nonzero(near[j] >= 0)
        found_rows.append(rows[at])
        found_keys.append((((tag << 22) | raw[i][at]) << 12) | near[j][at, column])
    a, b, c = near
    every = (a[:, :, None, None] >= 0) & (b[:, None, :, None] >= 0) & (c[:, None, None, :] >= 0)
    at, i, j, k = np.nonzero(every)
    found_rows.append(rows[at])
    found_keys.append((1 << 40) | (a[at, i] << 24) | (b[at, j] << 12) | c[at, k])
    return np.concatenate(found_rows), np.concatenate(found_keys)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        prints = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
        for at in range(0, len(prints), FINGERPRINTS_AT_ONCE):
            some = prints[at : at + FINGERPRINTS_AT_ONCE]
            rows, keys = keys_of(some)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(some[rows])], ["key", "fp"])


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))


def forest(prints: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is reachable within one key: (member, its first reached) pairs.

    Walks from one member at a time over what is not reached yet, so members
    that lie close together are compared with few others.
    """
    left = np.unique(prints)
    members, roots = [], []
    while len(left):
        root, left = left[0], left[1:]
        front = np.array([root])
        while len(front) and len(left):
            reached = np.zeros(len(left), bool)
            for one in front:
                rest = np.nonzero(~reached)[0]
                if not len(rest):
                    break
                reached[rest[_apart(left[rest], one) <= distance]] = True
            front, left = left[reached], left[~reached]
            members.append(front)
            roots.append(np.full(len(front), root))
    if not members:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(members), np.concatenate(roots)


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    starts = np.nonzero(np.r_[True, keys[1:] != keys[:-1]])[0]
    return starts, np.diff(np.r_[starts, len(keys)])


def _linked(distance: int):
    """Sorted (key, fp) rows to links; members of overlong keys come out with a null partner."""

    def solve(keys: np.ndarray, prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        found = []
        starts, lengths = _runs(keys)
        small = np.repeat((lengths > 1) & (lengths <= SMALL_RUN), lengths)
        k, p = keys[small], prints[small]
        step, any_left = 1, len(k) > 1
        while any_left:
            same = np.nonzero(k[step:] == k[:-step])[0]
            any_left = len(same) > 0 and step + 1 < len(k)
            near = same[_apart(p[same], p[same + step]) <= distance]
            found.append((p[near + step], p[near]))
            step += 1
        for s, n in zip(starts[lengths > SMALL_RUN], lengths[lengths > SMALL_RUN], strict=True):
            found.append(forest(prints[s : s + n], distance))
        return found

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest_of_task = Forest()

        def out(found) -> Iterator[pa.RecordBatch]:
            pairs = [
                pair
                for x, y in found
                for pair in zip(x.tolist(), y.tolist(), strict=True)
                if forest_of_task.join(*pair)
            ]
            if len(forest_of_task) > FOREST_NODES:
                forest_of_task.clear()
            if pairs:
                a, b = zip(*pairs, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"]
                )

        def overlong(prints: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(prints), pa.nulls(len(prints), pa.int64())], ["a", "b"]
            )

        keys, prints = np.empty(0, np.int64), np.empty(0, np.int64)
        long_key = None
        for batch in batches:
            more = batch.column(0).to_numpy(zero_copy_only=False)
            keys = np.concatenate([keys, more])
            prints = np.concatenate([prints, batch.column(1).to_numpy(zero_copy_only=False)])
            if long_key is not None:
                same = int(np.searchsorted(keys, long_key, "right"))
                if same:
                    yield overlong(prints[:same])
                keys, prints = keys[same:], prints[same:]
                if not len(keys):
                    continue
                long_key = None
            last = int(np.searchsorted(keys, keys[-1], "left")) if len(keys) else 0
            if last:
                yield from out(solve(keys[:last], prints[:last]))
                keys, prints = keys[last:], prints[last:]
            if len(keys) > LARGE_RUN:
                long_key = keys[0]
                yield overlong(prints)
                keys, prints = keys[:0], prints[:0]
        if len(keys):
            yield from out(solve(keys, prints))

    return links


def _centres(radius: int):
    """Every value within ``radius`` bits: fingerprints within twice that share one of them."""
    flips = np.array(
        [
            sum(1 << p for p in places)
            for n in range(radius + 1)
            for places in combinations(range(BITS), n)
        ],
        np.uint64,
    )

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for fp in batch.column(0).to_numpy(zero_copy_only=False):
                keys = (np.array([fp], np.int64).view(np.uint64) ^ flips).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys), pa.array(np.full(len(keys), fp, np.int64))], ["key", "fp"]
                )

    return around


def links(distinct: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column ``fp``) that connect all within ``distance``.

    ``distance`` is an even number up to four. Every emitted link holds, and every true link
    joins two fingerprints that the emitted ones connect. A key shared by over
    ``LARGE_RUN`` fingerprints is not compared in one task: its members are
    linked through the values within two bits of them, which need no comparing.
    """
    if distance not in range(0, MAX_DISTANCE + 1, 2):
        raise ValueError(f"distance: an even number up to {MAX_DISTANCE}")
    keyed = distinct.select("fp").mapInArrow(_keyed, "key long, fp long")
    found = written(
        keyed.repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(_linked(distance), "a long, b long"),
        "links",
    )
    overlong = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    close = found.where("b is not null")
    balls = overlong.mapInArrow(_centres(distance // 2), "key long, fp long")
    first = balls.groupBy("key").agg(F.min("fp").alias("b"))
    return close.unionByName(
        balls.join(first, "key").where("fp <> b").select(F.col("fp").alias("a"), "b")
    )


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """One row per document: its id, ``fp`` (a long) and ``component_id``.

    ``component_id`` is the smallest id that links of at most ``distance`` bits
    reach. Equal texts share a fingerprint and are counted once when keys are
    made, so copies are never paired. Null, empty and wordless texts have
    fingerprint zero and are linked like any other. A null id stays a row; it is
    a component's id only if the component has no other. Repeated rows stay
    repeated. An empty table gives an empty result.
    """
    prints = written(
        docs.select(F.col(id_col).alias(id_col), fingerprint(F.col(text_col), shingle).alias("fp")),
        "prints",
    )
    distinct = prints.groupBy("fp").agg(F.min(id_col).alias("first_id"))
    roots = connected(links(distinct, distance))
    rooted = distinct.join(roots, distinct.fp == roots.node, "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    # Both stored, so that the join is of plain tables and the root of very many can be split.
    rooted = written(rooted, "rooted")
    named = written(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "named")
    of_print = written(rooted.join(named, "root").select("fp", "component_id"), "components")
    return prints.join(of_print, "fp").select(id_col, "fp", "component_id")


def first_of_each(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = MAX_DISTANCE,
) -> DataFrame:
    """The rows of ``docs`` whose id names their component: one document of each group.

    Ids name documents and must be unique: of rows that repeat such an id one
    stays, whatever their texts. A group without any id keeps one row.
    """
    kept = (
        near_duplicates(docs, id_col, text_col, shingle, distance)
        .where(F.col(id_col).eqNullSafe(F.col("component_id")))
        .select(F.col(id_col).alias("__kept"), F.col("fp").alias("__fp"))
        .groupBy("__kept", "__fp")
        .agg(F.lit(1).alias("__one"))
    )
    # A null id cannot name its row, so rows without id are matched by fingerprint.
    named = docs.join(
        kept.where("__kept is not null"), F.col(id_col) == F.col("__kept"), "left_semi"
    )
    once = named.dropDuplicates([id_col])
    unnamed = docs.where(F.col(id_col).isNull()).withColumn(
        "__print", fingerprint(F.col(text_col), shingle)
    )
    rest = unnamed.join(
        kept.where("__kept is null"), F.col("__print") == F.col("__fp"), "left_semi"
    ).dropDuplicates(["__print"])
    return once.unionByName(rest.drop("__print"))
