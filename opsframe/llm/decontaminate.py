"""Benchmark passages in documents, found through an FM-index of each shard.

A shard is a run of documents of one task, about ``SHARD_WORDS`` words. Its
words become numbers of the searched phrases' vocabulary; any other word can be
in no occurrence and becomes a break, as does the end of a document, and only
the runs between breaks that are long enough for a phrase are indexed. The index
holds the Burrows-Wheeler transform in a wavelet matrix and every sixteenth
suffix position. All phrases are searched backward at once, their rows are
located by walking to a sampled position, and the located word ranges of a
document are merged to spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from opsframe.sources.scratch import removed, shared_dir

WINDOW = 10
SHARD_WORDS = 1_000_000
PHRASES_AT_ONCE = 100_000
SAMPLE = 16
FOUND = (
    "struct<n_words:bigint,spans:array<struct<start:bigint,end:bigint>>,items:array<string>>"
)
CUT = FOUND.replace("items:array<string>", "items:array<string>,left:string")
# Words are runs of these bytes: digits, letters and everything past ASCII.
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """Words with A-Z lower-cased; null has none."""
    return text.translate(_FOLD).split() if text else []


class Phrases:
    """One block of distinct phrases: their words as numbers, and the items that have them."""

    def __init__(self, window: int) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], list[str]] = {}

    def add(self, words: list[bytes], item: str) -> None:
        phrase = tuple(self.ids.setdefault(w, len(self.ids) + 1) for w in words)
        holders = self.items.setdefault(phrase, [])
        if item not in holders[-1:]:
            holders.append(item)

    def packed(self) -> Phrases:
        """Ready for the executors: a matrix of numbers, aligned to the right."""
        self.lengths = np.array([len(p) for p in self.items], np.int64)
        self.matrix = np.zeros((len(self.items), self.window), np.int64)
        for row, phrase in enumerate(self.items):
            self.matrix[row, self.window - len(phrase) :] = phrase
        self.holders = list(self.items.values())
        self.items = {}
        return self


def phrase_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> Iterator[Phrases]:
    """The benchmark's windows in blocks of bounded size, read through row by row.

    An item shorter than the window is one phrase; one without words is none.
    """
    block = Phrases(window)
    rows = benchmark.select(F.col(id_col).cast("string"), F.col(text_col).cast("binary"))
    for item, text in rows.toLocalIterator():
        words = words_of(bytes(text) if text is not None else None)
        for at in range(max(1, len(words) - window + 1) if words else 0):
            block.add(words[at : at + window], "" if item is None else item)
            if len(block.items) >= PHRASES_AT_ONCE:
                yield block.packed()
                block = Phrases(window)
    yield block.packed()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes of a text whose breaks (zeros) differ, each smaller than any word."""
    breaks = symbols == 0
    rank = np.where(breaks, np.cumsum(breaks) - 1, symbols + breaks.sum() - 1)
    n, step = len(symbols), 1
    while True:
        key = rank * (n + symbols.max(initial=0) + 2)
        key[: max(0, n - step)] += rank[step:] + 1
        order = np.argsort(key, kind="stable")
        fresh = np.r_[0, np.cumsum(key[order][1:] != key[order][:-1])]
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        if not n or fresh[-1] == n - 1:
            return order
        step *= 2


class WaveletMatrix:
    """Ranks of symbols in a sequence, by one prefix count of ones for each bit.

    There is a level for each bit of ``largest``, so that symbols which the
    sequence lacks can be ranked as well.
    """

    def __init__(self, sequence: np.ndarray, largest: int) -> None:
        self.levels = range(max(1, int(largest).bit_length()) - 1, -1, -1)
        self.ones, self.zeros = [], []
        for bit in self.levels:
            bits = (sequence >> bit) & 1
            self.ones.append(np.r_[0, np.cumsum(bits)].astype(np.int32))
            self.zeros.append(len(sequence) - int(self.ones[-1][-1]))
            sequence = np.concatenate([sequence[bits == 0], sequence[bits == 1]])

    def rank(self, symbols: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each end."""
        start, end = np.zeros_like(ends), ends
        for bit, ones, zeros in zip(self.levels, self.ones, self.zeros, strict=True):
            a, b = ones[start], ones[end]
            up = (symbols >> bit & 1).astype(bool)
            start = np.where(up, zeros + a, start - a)
            end = np.where(up, zeros + b, end - b)
        return end - start

    def access(self, rows: np.ndarray) -> np.ndarray:
        symbols, at = np.zeros_like(rows), rows
        for bit, ones, zeros in zip(self.levels, self.ones, self.zeros, strict=True):
            before = ones[at]
            up = ones[at + 1] > before
            symbols |= up.astype(rows.dtype) << bit
            at = np.where(up, zeros + before, at - before)
        return symbols


class FMIndex:
    """Backward search and location over a text of numbers in which zero is a break."""

    def __init__(self, symbols: np.ndarray, vocabulary: int) -> None:
        order = suffix_array(symbols)
        last = symbols[order - 1]
        last[order == 0] = 0
        self.starts = np.r_[0, np.cumsum(np.bincount(symbols, minlength=vocabulary + 1))]
        self.matrix = WaveletMatrix(last, vocabulary)
        # The first word of a run is always sampled, so no walk crosses a break.
        sampled = (order % SAMPLE == 0) | (last == 0)
        self.sampled = sampled
        self.samples_before = np.r_[0, np.cumsum(sampled)].astype(np.int32)
        self.positions = order[sampled]

    def search(self, matrix: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and end row of each phrase; equal where it does not occur."""
        window = matrix.shape[1]
        word = matrix[:, -1]
        low, high = self.starts[word], self.starts[word + 1]
        for back in range(2, window + 1):
            on = np.nonzero((low < high) & (lengths >= back))[0]
            word = matrix[on, window - back]
            low[on] = self.starts[word] + self.matrix.rank(word, low[on])
            high[on] = self.starts[word] + self.matrix.rank(word, high[on])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of the suffixes in the given rows."""
        at, found = rows.copy(), np.empty_like(rows)
        left, steps = np.arange(len(rows)), 0
        while len(left):
            done = self.sampled[at[left]]
            found[left[done]] = self.positions[self.samples_before[at[left[done]]]] + steps
            left = left[~done]
            word = self.matrix.access(at[left])
            at[left] = self.starts[word] + self.matrix.rank(word, at[left])
            steps += 1
        return found


def _search_shard(
    numbers: list[np.ndarray], phrases: Phrases
) -> tuple[dict[int, list[tuple[int, int]]], dict[int, list[str]]]:
    """Merged word spans and items of each document of a shard that has any."""
    ends = np.cumsum([len(x) + 1 for x in numbers])
    whole = np.zeros(int(ends[-1]) if len(ends) else 0, np.int64)
    for end, x in zip(ends, numbers, strict=True):
        whole[end - 1 - len(x) : end - 1] = x
    inside = np.r_[False, whole > 0, False]
    edges = np.nonzero(inside[1:] != inside[:-1])[0]
    first, stop = edges[::2], edges[1::2]
    enough = stop - first >= phrases.lengths.min(initial=phrases.window)
    first, stop = first[enough], stop[enough]
    if not len(first):
        return {}, {}
    change = np.zeros(len(whole) + 2, np.int64)
    change[first] += 1
    change[stop + 1] -= 1  # with the break behind the run
    kept = np.nonzero(np.cumsum(change)[: len(whole)] > 0)[0]
    index = FMIndex(whole[kept], len(phrases.ids))
    low, high = index.search(phrases.matrix, phrases.lengths)
    sizes = high - low
    phrase = np.repeat(np.arange(len(low)), sizes)
    rows = np.repeat(low - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
    at = kept[index.locate(rows)]
    cover = np.zeros(len(whole) + 1, np.int64)
    np.add.at(cover, at, 1)
    np.add.at(cover, at + phrases.lengths[phrase], -1)
    covered = np.r_[False, np.cumsum(cover)[:-1] > 0, False]
    edges = np.nonzero(covered[1:] != covered[:-1])[0]
    spans: dict[int, list[tuple[int, int]]] = {}
    begins = np.r_[0, ends]
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
        doc = int(np.searchsorted(ends, a, "right"))
        spans.setdefault(doc, []).append((a - int(begins[doc]), b - int(begins[doc])))
    pairs = np.unique(np.searchsorted(ends, at, "right") * len(low) + phrase)
    items: dict[int, set[str]] = {}
    for doc, p in zip((pairs // len(low)).tolist(), (pairs % len(low)).tolist(), strict=True):
        items.setdefault(doc, set()).update(phrases.holders[p])
    return spans, {doc: sorted(x) for doc, x in items.items()}


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def _cut(whole: bytes | None, spans: list[tuple[int, int]]) -> str | None:
    """The text without the words of the spans and what stands between them."""
    if whole and spans:
        places = [m.span() for m in WORD.finditer(whole)]
        parts, at = [], 0
        for start, end in spans:
            parts.append(whole[at : places[start][0]])
            at = places[end - 1][1]
        whole = b"".join([*parts, whole[at:]])
    return None if whole is None else whole.decode(errors="replace")


def _scan(phrases: Phrases, cut: bool):
    """What the phrases hit; ``cut`` adds the text that is left without it."""
    get = phrases.ids.get

    def shard(texts: list[bytes | None], before: list[dict | None]) -> list[dict]:
        found, numbers, waiting = [], [], []

        def flush() -> None:
            spans, items = _search_shard(numbers, phrases)
            for k, row in enumerate(waiting):
                row["spans"] = _merged(row["spans"] + spans.get(k, []))
                row["items"] = sorted({*row["items"], *items.get(k, [])})
            numbers.clear()
            waiting.clear()

        size = 0
        for text, old in zip(texts, before, strict=True):
            words = words_of(text)
            numbers.append(np.fromiter(map(get, words, repeat(0)), np.int64, len(words)))
            spans = [(s["start"], s["end"]) for s in old["spans"]] if old else []
            waiting.append({"n_words": len(words), "spans": spans, "items": old["items"] if old else []})
            found.append(waiting[-1])
            size += len(words)
            if size >= SHARD_WORDS:
                flush()
                size = 0
        if waiting:
            flush()
        return found

    def of(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(pa.string())),
        ]
        kind = pa.struct([*kind, ("left", pa.string())] if cut else kind)
        for some, before in columns:
            texts = some.cast(pa.binary()).to_pylist()
            found = shard(texts, before.to_pylist())
            for row, text in zip(found, texts, strict=True):
                if cut:
                    row["left"] = _cut(text, row["spans"])
                row["spans"] = [{"start": a, "end": b} for a, b in row["spans"]]
            yield pa.array(found, kind)

    # Nondeterministic, so that a filter on the result does not run the search a second time.
    return F.arrow_udf(of, CUT if cut else FOUND).asNondeterministic()


def scanned(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    benchmark_id: str = "item_id",
    benchmark_text: str = "text",
    window: int = WINDOW,
    cut: bool = False,
) -> DataFrame:
    """``docs`` with a struct column ``contamination``: n_words, word spans hit, items found.

    A span is a merged range of word numbers, end exclusive, that occurrences of
    a window cover; ``items`` are the ids, as strings, with an occurring window
    (a null id is the empty string). With ``cut`` there is ``left`` as well, the
    text without the spans' words and what stands between them; null stays null.
    Rows stay as they are, repeated or not; a column ``contamination`` that was
    there is replaced. Null and empty texts have no words. An empty benchmark
    finds nothing. The benchmark goes to the executors in blocks of at most
    ``PHRASES_AT_ONCE`` windows, one pass each; after each but the last the
    rows are stored, so that one block is held at a time.
    """
    spark = docs.sparkSession
    out = docs.withColumn("contamination", F.lit(None).cast(FOUND))
    blocks = phrase_blocks(benchmark, benchmark_id, benchmark_text, window)
    block, stored = next(blocks), None
    for later in blocks:
        path = shared_dir(spark, "scanned")
        out = out.withColumn("contamination", _scan(block, False)(F.col(text_col), F.col("contamination")))
        out.write.parquet(path)
        if stored is not None:
            removed(spark, stored)
        out, stored, block = spark.read.schema(out.schema).parquet(path), path, later
    return out.withColumn("contamination", _scan(block, cut)(F.col(text_col), F.col("contamination")))


def n_hit(spans: Column) -> Column:
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def decontaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    n_chars_col: str | None = None,
    **names,
) -> DataFrame:
    """``docs`` with every hit span cut from its text; other documents stay as they are.

    A document of which no word is left goes; one that had none before stays.
    ``n_chars_col``, if given, becomes the new length of a text that was cut.
    """
    hit = scanned(docs, benchmark, text_col, cut=True, **names)
    spans = F.col("contamination.spans")
    found = F.size(spans) > 0
    left = hit.where(~found | (n_hit(spans) < F.col("contamination.n_words")))
    left = left.withColumn(text_col, F.when(found, F.col("contamination.left")).otherwise(F.col(text_col)))
    if n_chars_col is not None:
        length = F.length(text_col).cast(docs.schema[n_chars_col].dataType)
        left = left.withColumn(n_chars_col, F.when(found, length).otherwise(F.col(n_chars_col)))
    return left.drop("contamination")
