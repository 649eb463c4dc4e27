"""How two tokenizers cut the same texts: groups, links, and scores of linked token ids.

A text is encoded by both; tokens whose byte ranges overlap are linked, and byte
offsets where both end a token cut the text into groups. Links of a pair of ids
are counted over the whole corpus by inverted bitmaps: each task numbers its
documents and keeps, for every pair, which of them hold it, in planes, plane j
having the documents whose number of links has bit j set. The planes OR-ed and
counted are the pair's documents, the planes counted by their weights its links.
Counts are summed over tasks, and the stored postings hand each pair's score
back to its documents, so every text is encoded once and never moved.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from opsframe.sources.scratch import written

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
#: Documents, and pairs of a document and a linked id pair, that one set of bitmaps covers.
SHARD_DOCS = 16_384
SHARD_ENTRIES = 4_000_000
#: Text bytes that are aligned at a time.
TEXT_AT_ONCE = 2 << 20
#: A pair in one of so many documents of a shard, or more, has bitmaps; others have lists.
DENSE = 16
#: Pairs scored at a time, 26 MB. Pairs are bounded by the product of the two vocabularies.
SCORES_AT_ONCE = 2_000_000
_SPACE_PIECE = "▁"
# Fixed value: the pattern by which byte-level BPE cuts a text before it merges.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _letters_of_bytes() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for.

    Printable bytes of Latin-1 stand for themselves, the others for letters from U+0100 on.
    """
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers with the bytes of their ids.

    The byte-level file is run by tiktoken, which gives the same ids several
    times as fast: its entries are ranked as they were merged.
    """

    def __init__(self, folder: str) -> None:
        import sentencepiece
        import tiktoken

        with open(f"{folder}/{BYTE_BPE}", encoding="utf-8") as file:
            stored = json.load(file)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{PIECE_BPE}")
        letters, vocabulary = _letters_of_bytes(), stored["model"]["vocab"]
        special = {x["content"] for x in stored["added_tokens"] if x["special"]}
        ranks = {bytes(letters[x] for x in entry): n for entry, n in vocabulary.items() if entry not in special}
        pairs = (pair if isinstance(pair, list) else pair.split(" ") for pair in stored["model"]["merges"])
        merged = [vocabulary["".join(pair)] for pair in pairs]
        if merged != sorted(merged) or not stored["pre_tokenizer"]["use_regex"]:
            raise ValueError(f"{BYTE_BPE}: not ranked by its merges")
        self.byte_pairs = tiktoken.Encoding("byte_bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        n = max(vocabulary.values()) + 1
        self.bytes_a = [b""] * n
        for entry, number in ranks.items():
            self.bytes_a[number] = entry
        self.bytes_b = [self._piece(i) for i in range(self.pieces.get_piece_size())]
        self.sizes_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.sizes_b = np.array([len(x) for x in self.bytes_b], np.int64)
        self.n_b = len(self.bytes_b)
        # Ids with what stands behind them in a list of groups: , | , ;
        self.names = [f"{i},".encode() for i in range(n)] + [f"{i}|".encode() for i in range(n)]
        self.names += [f"{i},".encode() for i in range(self.n_b)] + [f"{i};".encode() for i in range(self.n_b)]

    def _piece(self, number: int) -> bytes:
        piece = self.pieces.id_to_piece(number)
        if self.pieces.is_byte(number):
            return bytes([int(piece[3:-1], 16)])
        return b"" if self.pieces.is_control(number) else piece.replace(_SPACE_PIECE, " ").encode()

    def encoded(self, texts: list[str]) -> list[tuple[list[int], list[int]]]:
        """Ids of both for each text; none where the tokens' bytes are not a space and the text."""
        own = [i for i, t in enumerate(texts) if t]
        b = self.pieces.encode([texts[i] for i in own], num_threads=1)
        out: list[tuple[list[int], list[int]]] = [([], [])] * len(texts)
        for i, y in zip(own, b, strict=True):
            x = self.byte_pairs.encode_ordinary(" " + texts[i])
            whole = b" " + texts[i].encode()
            if b"".join([self.bytes_a[k] for k in x]) == whole == b"".join([self.bytes_b[k] for k in y]):
                out[i] = (x, y)
        return out


@lru_cache(maxsize=1)
def tokenizers(folder: str) -> Tokenizers:
    """Read once in each process."""
    return Tokenizers(folder)


def _numbers(lists: list[list[int]]) -> np.ndarray:
    return np.fromiter(chain.from_iterable(lists), np.int64, sum(map(len, lists)))


class Aligned:
    """Links and groups of some texts, laid end to end."""

    def __init__(self, texts: list[str], both: Tokenizers) -> None:
        encoded = both.encoded(texts)
        a, b = _numbers([x for x, _ in encoded]), _numbers([y for _, y in encoded])
        self.n_a = np.array([len(x) for x, _ in encoded], np.int64)
        self.n_b = np.array([len(y) for _, y in encoded], np.int64)
        ends_a, ends_b = np.cumsum(both.sizes_a[a]), np.cumsum(both.sizes_b[b])
        size = int(ends_a[-1]) if len(a) else 0
        ended_a, ended_b = np.zeros(size + 1, np.int32), np.zeros(size + 1, np.int32)
        ended_a[ends_a], ended_b[ends_b] = 1, 1
        before_a, before_b = np.cumsum(ended_a) - ended_a, np.cumsum(ended_b) - ended_b
        # Between two neighbouring ends lies the overlap of exactly one token of each.
        cuts = np.flatnonzero(ended_a | ended_b)
        self.pairs = a[before_a[cuts]] * both.n_b + b[before_b[cuts]]
        bytes_of = np.add.reduceat(np.r_[both.sizes_a[a], 0], np.minimum(np.cumsum(self.n_a) - self.n_a, len(a)))
        ends = np.cumsum(np.where(self.n_a > 0, bytes_of, 0))
        self.link_docs = np.searchsorted(ends, cuts)
        shared = np.flatnonzero(ended_a & ended_b)
        n = len(texts)
        self.n_links = np.bincount(self.link_docs, minlength=n)
        self.n_groups = np.bincount(np.searchsorted(ends, shared), minlength=n)
        self.digests = self._digests(a, b, ends_a, ends_b, ended_a & ended_b, both)

    def _digests(self, a, b, ends_a, ends_b, shared, both: Tokenizers) -> list[str]:
        """SHA-256 of each text's groups, written out; nothing for a text without tokens."""
        before = np.cumsum(shared) - shared
        group_a, group_b = before[ends_a], before[ends_b]
        groups = int(shared.sum())
        in_a, in_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
        # A group's tokens of A, then those of B.
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group_a]] = a + len(both.bytes_a) * shared[ends_a]
        order[np.arange(len(b)) + np.cumsum(in_a)[group_b]] = (
            b + 2 * len(both.bytes_a) + len(both.bytes_b) * shared[ends_b]
        )
        names, out, at = both.names, [], 0
        for n in (self.n_a + self.n_b).tolist():
            text = b"".join([names[k] for k in order[at : at + n].tolist()])
            out.append(hashlib.sha256(text[:-1]).hexdigest() if n else "")
            at += n
        return out


class Planes:
    """Inverted bitmaps of one shard of documents: per pair, which documents hold it how often.

    Pairs in many documents have a bitmap for each bit of the multiplicity. The
    others have a sorted list of documents, and their planes are bits along it.
    """

    def __init__(self, keys: np.ndarray, times: np.ndarray, docs: int) -> None:
        """``keys`` are sorted: a pair, shifted by 16 bits, and a document."""
        self.docs = docs
        pair, doc = keys >> 16, (keys & 0xFFFF).astype(np.uint16)
        starts = np.flatnonzero(np.r_[True, pair[1:] != pair[:-1]]) if len(keys) else np.empty(0, np.int64)
        sizes = np.diff(np.r_[starts, len(keys)])
        self.levels = int(times.max(initial=0)).bit_length()
        dense = sizes * DENSE >= max(docs, 1)
        self.dense, self.sparse = pair[starts[dense]], pair[starts[~dense]]
        self.sizes = sizes[~dense]
        in_dense = np.repeat(dense, sizes)
        self.lists = doc[~in_dense]
        self.width = -(-docs // 8)
        row = np.repeat(np.cumsum(dense) - 1, sizes)[in_dense]
        self.bitmaps, self.marks = [], []
        for level in range(self.levels):
            has = (times >> level & 1).astype(bool)
            bits = np.zeros((len(self.dense), self.width), np.uint8)
            on = has[in_dense]
            at = doc[in_dense][on]
            np.bitwise_or.at(bits, (row[on], at >> 3), np.uint8(1) << (at & 7).astype(np.uint8))
            self.bitmaps.append(bits)
            self.marks.append(has[~in_dense])

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs, the documents that hold them, and their links."""
        held = np.zeros((len(self.dense), self.width), np.uint8)
        links_dense = np.zeros(len(self.dense), np.int64)
        links_sparse = np.zeros(len(self.sparse), np.int64)
        starts = np.cumsum(self.sizes) - self.sizes
        for level in range(self.levels):
            held |= self.bitmaps[level]
            links_dense += np.bitwise_count(self.bitmaps[level]).sum(axis=1, dtype=np.int64) << level
            if len(starts):
                links_sparse += np.add.reduceat(self.marks[level].astype(np.int64), starts) << level
        docs_dense = np.bitwise_count(held).sum(axis=1, dtype=np.int64)
        return (
            np.r_[self.dense, self.sparse],
            np.r_[docs_dense, self.sizes],
            np.r_[links_dense, links_sparse],
        )

    def nbytes(self) -> int:
        """Of the planes before they are compressed."""
        marks = self.levels * -(-len(self.lists) // 8)
        bits = self.levels * len(self.dense) * self.width
        return 40 + 8 * len(self.dense) + 10 * len(self.sparse) + 2 * len(self.lists) + bits + marks

    def packed(self) -> bytes:
        """The planes as bytes, compressed; ``unpacked`` reads them."""
        head = np.array(
            [self.docs, self.levels, len(self.dense), len(self.sparse), len(self.lists)], "<i8"
        )
        # Neighbouring documents of a list are near each other, so the steps compress better.
        steps = np.diff(self.lists, prepend=np.uint16(0))
        parts = [head, self.dense.astype("<i8"), np.diff(self.sparse, prepend=0).astype("<i8"),
                 self.sizes.astype("<u2"), steps.astype("<u2"), *self.bitmaps,
                 *(np.packbits(x) for x in self.marks)]
        return pa.compress(b"".join(x.tobytes() for x in parts), codec="zstd", asbytes=True)

    @classmethod
    def unpacked(cls, data: bytes, size: int) -> Planes:
        raw = pa.decompress(data, decompressed_size=size, codec="zstd", asbytes=True)
        at = 0

        def read(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, n, at)
            at += found.nbytes
            return found

        self = cls.__new__(cls)
        self.docs, self.levels, n_dense, n_sparse, n_lists = read("<i8", 5).tolist()
        self.width = -(-self.docs // 8)
        self.dense, self.sparse = read("<i8", n_dense), np.cumsum(read("<i8", n_sparse))
        self.sizes = read("<u2", n_sparse).astype(np.int64)
        self.lists = np.cumsum(read("<u2", n_lists), dtype=np.uint16)
        self.bitmaps = [read("u1", n_dense * self.width).reshape(n_dense, self.width) for _ in range(self.levels)]
        self.marks = [
            np.unpackbits(read("u1", -(-n_lists // 8)), count=n_lists).astype(bool) for _ in range(self.levels)
        ]
        return self

    def summed(self, scores: Scores) -> tuple[np.ndarray, np.ndarray]:
        """Per document the sum of the scored pairs' counts over its links, and its best links."""
        total, best = np.zeros(self.docs, np.int64), np.zeros(self.docs, np.int64)
        count, is_best = scores.of(self.sparse)
        count, is_best = np.repeat(count, self.sizes), np.repeat(is_best, self.sizes)
        dense_count, dense_best = scores.of(self.dense)
        for level in range(self.levels):
            on = self.marks[level]
            np.add.at(total, self.lists[on], count[on] << level)
            best += np.bincount(self.lists[on & is_best], minlength=self.docs) << level
            for a in range(0, len(self.dense), 1_024):
                rows, at = np.nonzero(
                    np.unpackbits(self.bitmaps[level][a : a + 1_024], axis=1, bitorder="little")
                )
                np.add.at(total, at, dense_count[a + rows] << level)
                best += np.bincount(at[dense_best[a + rows]], minlength=self.docs) << level
        return total, best


class Scores:
    """Counts of a block of pairs, and whether each is the highest of its id of B."""

    def __init__(self, pairs: np.ndarray, counts: np.ndarray, best: np.ndarray) -> None:
        self.pairs, self.counts, self.best = pairs, counts, best

    def of(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each pair; zero and no for pairs of other blocks."""
        at = np.minimum(np.searchsorted(self.pairs, pairs), max(len(self.pairs) - 1, 0))
        if not len(self.pairs):
            return np.zeros(len(pairs), np.int64), np.zeros(len(pairs), bool)
        here = self.pairs[at] == pairs
        return np.where(here, self.counts[at], 0), here & self.best[at]


_DOC = "n_a:long,n_b:long,n_groups:long,n_links:long,groups_sha256:string"
_SHARD = "shard string, planes binary, size long, pairs array<long>, pair_docs array<long>, pair_links array<long>"


def _shards(folder: str):
    """Rows (rest of a document's columns, text) to one row for each shard of them."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(folder)
        kept, keys, times, facts = [], [], [], []
        docs = entries = 0

        def shard() -> pa.RecordBatch:
            nonlocal kept, keys, times, facts, docs, entries
            every, every_times = np.concatenate(keys), np.concatenate(times)
            order = np.argsort(every)
            planes = Planes(every[order], every_times[order], docs)
            del every, every_times, order
            pairs, pair_docs, pair_links = planes.counts()
            packed = planes.packed()
            size = planes.nbytes()
            rows = pa.concat_arrays(kept)
            columns = [pa.array([x for some in facts for x in some[i]]) for i in range(5)]
            fact = pa.StructArray.from_arrays(
                [c.cast(k) for c, k in zip(columns, [*[pa.int64()] * 4, pa.string()], strict=True)],
                ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"],
            )
            doc = pa.StructArray.from_arrays([rows, fact], ["row", "fact"])
            name = hashlib.sha256(packed + repr(facts).encode()).hexdigest()
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([name]),
                    pa.array([packed], pa.binary()),
                    pa.array([size], pa.int64()),
                    *(pa.ListArray.from_arrays([0, len(x)], pa.array(x, pa.int64()))
                      for x in (pairs, pair_docs, pair_links)),
                    pa.ListArray.from_arrays([0, docs], doc),
                ],
                ["shard", "planes", "size", "pairs", "pair_docs", "pair_links", "docs"],
            )
            kept, keys, times, facts, docs, entries = [], [], [], [], 0, 0
            return out

        for batch in batches:
            rest = batch.column(0)
            texts = [
                None if x is None else x.decode(errors="replace")
                for x in batch.column(1).cast(pa.binary()).to_pylist()
            ]
            for a, b in _runs(texts):
                some = Aligned(texts[a:b], both)
                key, n = np.unique(some.pairs << 16 | (some.link_docs + docs), return_counts=True)
                kept.append(rest.slice(a, b - a))
                keys.append(key)
                times.append(n)
                facts.append([x.tolist() for x in (some.n_a, some.n_b, some.n_groups, some.n_links)] + [some.digests])
                docs += b - a
                entries += len(key)
                if docs + RUN_DOCS > SHARD_DOCS or entries >= SHARD_ENTRIES:
                    yield shard()
        if docs:
            yield shard()

    return of


RUN_DOCS = 4_096


def _runs(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of bounded number and size, at least one each."""
    start, size = 0, 0
    for i, text in enumerate(texts):
        if i > start and (size >= TEXT_AT_ONCE or i - start >= RUN_DOCS):
            yield start, i
            start, size = i, 0
        size += len(text or "")
    if start < len(texts):
        yield start, len(texts)


def _scored(blocks: list):
    """Shards to the sums of their documents over the blocks of pairs."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, packed, size in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                planes = Planes.unpacked(packed, size)
                total, best = np.zeros(planes.docs, np.int64), np.zeros(planes.docs, np.int64)
                for block in blocks:
                    more, more_best = planes.summed(block.value)
                    total, best = total + more, best + more_best
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name]),
                        *(pa.ListArray.from_arrays([0, planes.docs], pa.array(x)) for x in (total, best)),
                    ],
                    ["shard", "total", "best"],
                )

    return of


def pair_counts(shards: DataFrame) -> DataFrame:
    """(pair, n_docs, n_links) summed over the shards; a pair is the id of A times B's size and that of B."""
    per_shard = shards.select(F.explode(F.arrays_zip("pairs", "pair_docs", "pair_links")).alias("x"))
    return per_shard.groupBy(F.col("x.pairs").alias("pair")).agg(
        F.sum("x.pair_docs").alias("n_docs"), F.sum("x.pair_links").alias("n_links")
    )


def inverted(docs: DataFrame, text_col: str = "text", folder: str = TOKENIZERS) -> DataFrame:
    """A row for each shard of documents: their other columns, the planes, and the pairs' counts.

    Stored, in the shared folder. ``docs.row`` has the columns of ``docs`` but the text.
    """
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    row = F.struct(*rest) if rest else F.struct(F.lit(None).cast("int").alias("_"))
    rows = docs.select(row.alias("row"), F.col(text_col).alias("text"))
    kind = rows.schema["row"].dataType
    schema = T.StructType.fromDDL(_SHARD).add(
        "docs", T.ArrayType(T.StructType().add("row", kind).add("fact", T.StructType.fromDDL(_DOC)))
    )
    return written(rows.mapInArrow(_shards(folder), schema), "postings")


def aligned(
    docs: DataFrame, text_col: str = "text", folder: str = TOKENIZERS, n_b: int | None = None
) -> DataFrame:
    """The columns of ``docs`` without the text, and a struct ``alignment``: n_a, n_b, n_groups,
    n_links, n_best, count_sum, groups_sha256.

    A is the byte-level vocabulary, which encodes a space and the text, B the
    pieces, which add the space; special tokens in a text are plain text. Null
    and empty texts, and those that either tokenizer does not give back byte by
    byte, have no tokens: zeros and an empty digest. A pair's count is its links
    over all rows, repeated ones included. ``n_best`` are a row's links whose
    count is the highest of their id of B, ties included, ``count_sum`` is the
    sum of the counts of its links. An empty table gives no rows; a column
    ``alignment`` that was there is replaced.
    """
    docs = docs.drop("alignment")
    spark = docs.sparkSession
    shards = inverted(docs, text_col, folder)
    n_b = n_b or tokenizers(folder).n_b
    counts = written(pair_counts(shards), "pairs")
    of_b = (F.col("pair") % n_b).alias("b")
    highest = written(counts.groupBy(of_b).agg(F.max("n_links").alias("highest")), "highest")
    pairs = counts.withColumn("b", of_b).join(highest, "b")
    scores = written(
        pairs.select("pair", "n_links", (F.col("n_links") == F.col("highest")).alias("best")), "scores"
    )
    rounds = []
    for low, high in _ranges(scores):
        block = scores.where(F.col("pair").between(low, high)).toArrow()
        arrays = [block.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in scores.columns]
        order = np.argsort(arrays[0])
        sent = spark.sparkContext.broadcast(Scores(*(x[order] for x in arrays)))
        found = shards.select("shard", "planes", "size").mapInArrow(
            _scored([sent]), "shard string, total array<long>, best array<long>"
        )
        rounds.append(written(found, "sums"))
        sent.destroy()
    out = shards.select("shard", "docs")
    for i, some in enumerate(rounds):
        # Equal shards, which hold equal documents, have equal sums.
        some = some.dropDuplicates(["shard"]).withColumnsRenamed({"total": f"total{i}", "best": f"best{i}"})
        out = out.join(some, "shard")
    return _unfolded(out, [c for c in docs.columns if c != text_col], len(rounds))


def _ranges(scores: DataFrame) -> list[tuple[int, int]]:
    """Ranges of pairs with at most about ``SCORES_AT_ONCE`` each."""
    n, low, high = scores.agg(F.count("*"), F.min("pair"), F.max("pair")).first()
    if not n:
        return []
    parts = -(-n // SCORES_AT_ONCE)
    if parts == 1:
        return [(low, high)]
    wide = -(-(high - low + 1) // (4_096 * parts))
    sizes = scores.groupBy(F.floor((F.col("pair") - low) / wide).alias("k")).count().orderBy("k").collect()
    found, start, size = [], low, 0
    for k, more in sizes:
        if size and size + more > SCORES_AT_ONCE:
            found.append((start, low + k * wide - 1))
            start, size = low + k * wide, 0
        size += more
    return [*found, (start, high)]


def _unfolded(shards: DataFrame, columns: list[str], rounds: int) -> DataFrame:
    """Shards to rows of documents, with the sums of all rounds."""
    one = shards.select("*", F.posexplode("docs").alias("at", "doc"))

    def total(name: str):
        out = F.lit(0).cast("long")
        for i in range(rounds):
            out = out + F.get(f"{name}{i}", F.col("at"))
        return out

    fact = F.col("doc.fact")
    alignment = F.struct(
        *(fact[c].alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")),
        total("best").alias("n_best"),
        total("total").alias("count_sum"),
        fact["groups_sha256"].alias("groups_sha256"),
    )
    return one.select(*(F.col("doc.row")[c].alias(c) for c in columns), alignment.alias("alignment"))
