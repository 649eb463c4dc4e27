"""Collocations: word sequences of each language that stand together more than their parts do.

Only phrases that can be frequent are counted, by double-array tries:

* Level by level (words, pairs, ...) each task hashes the phrases whose shorter
  parts all passed and sends sorted hashes with counts; a segment of the hash
  space adds them up and keeps those with enough occurrences in its slice of a
  Bloom filter. Hashes that meet and bits that are set by others only let more
  phrases pass, so no frequent phrase is lost.
* Every word that passed starts a run: the longest phrase from there on of which
  each beginning passed. One more reading of the texts sends each task's
  different runs with how often they stand there, and its words likewise, dealt
  to groups by a run's first two words.
* The beginnings of a group's runs become double-array tries over bytes, of
  bounded size. numpy advances all runs together, byte by byte, and counts the
  accepting states at word ends as often as the run stands in the texts.

So the texts are read once for each level and once to count, whatever number of
phrases passes. Spark joins, scores and ranks the counted phrases.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from opsframe.sources.scratch import written

LONGEST = 3
LEAST = 10
COVERED = 50
FIRST = 2_000
NO_LANG = "und"
#: Words of more bytes stand in the tries as a digest, which bounds the depth.
LONG_WORD = 64
#: Phrase hashes that a task gathers before it sends their counts.
HASHES_AT_ONCE = 2_000_000
#: Different runs that a task gathers before it passes them on.
PHRASES_AT_ONCE = 1_000_000
#: Text bytes to each 256 segments of the hash space: some 15 MB of hashes a segment.
SEGMENT_TEXT = 4 << 30
#: Bits of a level's Bloom filter (16 MB), and how many a hash sets.
FILTER_BITS = 27
PROBES = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
#: Run bytes of one trie, and tries of a group, which builds one at a time. A byte takes 12 bytes at most.
BLOCK_BYTES = 4 << 20
BLOCKS_AT_ONCE = 4
#: Groups of runs to one group of single words, of which far fewer differ: as a power of two.
WORD_GROUPS = 4
BYTES_AT_ONCE = 1 << 20
#: Parts of a language's phrases that are ranked on their own first.
SHARES = 64

_SPACE, _BREAK, _ESCAPE = 32, 10, 0xFF
_FOLD = bytes(
    _BREAK if b in b".,;:!?\n\x0b\x0c\r" else _SPACE if b == 9 else b + 32 if 65 <= b <= 90 else b
    for b in range(256)
)
_LONG = re.compile(rb"[^ \n]{%d,}" % (LONG_WORD + 1))
_POWERS = np.cumprod(np.full(LONG_WORD + 2, 0x9E3779B97F4A7C15, np.uint64))


def _digest(word: bytes) -> bytes:
    """What stands for a long word: a byte that UTF-8 lacks and 128 bits in hexadecimal digits."""
    return bytes([_ESCAPE]) + hashlib.blake2b(word, digest_size=16).hexdigest().encode()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of some texts in a row: one byte array with a space or a break behind each word."""

    def __init__(self, texts: list[bytes], lang: str) -> None:
        raw = (b"\n".join(texts) + b"\n").translate(_FOLD)
        self.long: dict[bytes, bytes] = {}
        self._read(raw)
        if (self.ends - self.starts > LONG_WORD).any():
            self._read(_LONG.sub(self._shortened, raw))
        self.seed = np.frombuffer(hashlib.blake2b(lang.encode(), digest_size=8).digest(), np.uint64)[0]
        self._hashes: list[np.ndarray] = []

    def _shortened(self, found: re.Match) -> bytes:
        short = _digest(found[0])
        self.long[short] = found[0]
        return short

    def _read(self, raw: bytes) -> None:
        letters = np.frombuffer(raw, np.uint8)
        breaks = letters == _BREAK
        inside = ~(breaks | (letters == _SPACE))
        edges = np.flatnonzero(np.diff(inside, prepend=False))
        starts, ends = edges[::2], edges[1::2]
        so_far = np.cumsum(breaks, dtype=np.int32)
        #: Whether a word and the next one are in the same piece.
        self.joined = np.zeros(len(starts), bool)
        self.joined[:-1] = so_far[starts[1:]] == so_far[ends[:-1] - 1]
        inside[ends] = True
        letters = letters.copy()
        letters[ends] = np.where(self.joined, _SPACE, _BREAK)
        self.letters = letters[inside]
        self.ends = np.cumsum(ends - starts + 1) - 1
        self.starts = self.ends - (ends - starts)

    def __len__(self) -> int:
        return len(self.starts)

    def at(self, length: int) -> np.ndarray:
        """The words at which phrases of the length start."""
        fits = np.ones(max(len(self) - length + 1, 0), bool)
        for k in range(length - 1):
            fits &= self.joined[k : k + len(fits)]
        return np.flatnonzero(fits)

    def word_hashes(self) -> np.ndarray:
        if not self._hashes:
            out = np.zeros(len(self), np.uint64)
            step = max(1, BYTES_AT_ONCE // 8)
            for a in range(0, len(self), step):
                starts, ends = self.starts[a : a + step], self.ends[a : a + step]
                sizes = ends - starts + 1
                place = np.arange(starts[0], ends[-1] + 1) - np.repeat(starts, sizes)
                letters = self.letters[starts[0] : ends[-1] + 1].astype(np.uint64)
                letters[ends - starts[0]] = 0
                out[a : a + step] = np.add.reduceat(letters * _POWERS[place], starts - starts[0])
            self._hashes.append(_mixed(out + self.seed))
        return self._hashes[0]

    def hashes(self, at: np.ndarray, length: int) -> np.ndarray:
        """Of the phrases that start there, 64 bits each."""
        words = self.word_hashes()
        out = words[at]
        for k in range(1, length):
            out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + words[at + k])
        return out

    def phrases(self, at: np.ndarray, length: int) -> pa.Array:
        """The different phrases that start there."""
        found = []
        for a in range(0, len(at), PHRASES_AT_ONCE):
            some = at[a : a + PHRASES_AT_ONCE]
            starts, sizes = self.starts[some], self.ends[some + length - 1] - self.starts[some]
            offsets = np.r_[0, np.cumsum(sizes)]
            places = np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])
            data = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(self.letters[places])]
            found.append(pa.Array.from_buffers(pa.binary(), len(some), data).unique())
        return pa.concat_arrays(found).unique() if found else pa.array([], pa.binary())

    def lines(self, at: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """The phrases of so many words that start there, each with a break behind it."""
        starts, sizes = self.starts[at], self.ends[at + lengths - 1] - self.starts[at] + 1
        offsets = np.r_[0, np.cumsum(sizes)]
        data = np.empty(offsets[-1], np.uint8)
        step = max(1, BYTES_AT_ONCE // 8)
        for a in range(0, len(at), step):
            low, high = offsets[a], offsets[min(a + step, len(at))]
            places = np.repeat((starts - offsets[:-1])[a : a + step], sizes[a : a + step])
            data[low:high] = self.letters[places + np.arange(low, high)]
        data[offsets[1:] - 1] = _BREAK
        return _lines(data, offsets)

    def pieces(self) -> tuple[np.ndarray, np.ndarray]:
        """The first word of each piece, and how many words it has."""
        first = np.flatnonzero(np.r_[True, ~self.joined[:-1]][: len(self)])
        return first, np.diff(first, append=len(self))


def _lines(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    buffers = [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.large_binary(), len(offsets) - 1, buffers)


def _letters(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of some lines in a row, and where each begins and the last one ends."""
    offsets = np.frombuffer(lines.buffers()[1], np.int64)[lines.offset : lines.offset + len(lines) + 1]
    data = np.frombuffer(lines.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def _summed(lines: list[pa.Array], counts: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """The different lines, with the sums of their counts."""
    numbered = pa.concat_arrays(lines).dictionary_encode()
    sums = np.zeros(len(numbered.dictionary), np.int64)
    np.add.at(sums, numbered.indices.to_numpy(), np.concatenate(counts))
    return numbered.dictionary, sums


def _by_lang(batch: pa.RecordBatch) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of each language; a null text is empty, a null language ``NO_LANG``."""
    texts: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
        if text.is_valid:
            texts.setdefault(lang, []).append(text.as_py())
    yield from texts.items()


class Filter:
    """Which phrase hashes may be frequent: a Bloom filter in segments of the hash space."""

    def __init__(self, bits: bytes, segments: int) -> None:
        self.bits, self.segments = np.frombuffer(bits, np.uint8), segments

    @staticmethod
    def places(rest: np.ndarray, segments: int) -> Iterator[np.ndarray]:
        """Bits within a segment's slice that 32-bit remainders set."""
        for probe in PROBES:
            yield (rest * np.uint32(probe)) >> np.uint32(32 - (FILTER_BITS - segments))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        first = (hashes >> np.uint64(64 - self.segments)) << np.uint64(FILTER_BITS - self.segments)
        rest = ((hashes << np.uint64(self.segments)) >> np.uint64(32)).astype(np.uint32)
        found = np.ones(len(hashes), bool)
        for place in self.places(rest, self.segments):
            bit = first + place
            found &= (self.bits[bit >> np.uint64(3)] >> (bit & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def _passing(words: Words, length: int, filters: list) -> np.ndarray:
    """Where phrases start of which the parts, a word shorter, all pass."""
    at = words.at(length)
    if length > 1:
        passes = np.zeros(len(words) + 1, bool)
        parts = words.at(length - 1)
        passes[parts] = filters[length - 2].value.has(words.hashes(parts, length - 1))
        at = at[passes[at] & passes[at + 1]]
    return at


def _hash_counts(length: int, segments: int, least: int, filters: list):
    """Per task, segment of the hash space and some millions of phrases: hashes and capped counts."""

    def sent(hashes: np.ndarray) -> pa.RecordBatch:
        hashes, counts = np.unique(hashes, return_counts=True)
        segment = (hashes >> np.uint64(64 - segments)).astype(np.int64)
        rest = ((hashes << np.uint64(segments)) >> np.uint64(32)).astype("<u4")
        counts = np.minimum(counts, min(least, 255)).astype(np.uint8)
        edges = np.flatnonzero(np.diff(segment, prepend=-1, append=-1))
        cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(segment[edges[:-1]]),
                pa.array([rest[a:b].tobytes() for a, b in cuts], pa.binary()),
                pa.array([counts[a:b].tobytes() for a, b in cuts], pa.binary()),
            ],
            ["segment", "hashes", "counts"],
        )

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, n = [], 0
        for batch in batches:
            for lang, texts in _by_lang(batch):
                words = Words(texts, lang)
                waiting.append(words.hashes(_passing(words, length, filters), length))
                n += len(waiting[-1])
                if n >= HASHES_AT_ONCE:
                    yield sent(np.concatenate(waiting))
                    waiting, n = [], 0
        if n:
            yield sent(np.concatenate(waiting))

    return of


def _slices(segments: int, least: int):
    """The slice of the Bloom filter of each segment, by all tasks' counts."""

    def of(table: pa.Table) -> pa.Table:
        segment = table.column("segment")[0]
        rest = np.concatenate([np.frombuffer(x.as_py(), "<u4") for x in table.column("hashes")])
        counts = np.concatenate([np.frombuffer(x.as_py(), np.uint8) for x in table.column("counts")])
        order = np.argsort(rest)
        rest, counts = rest[order], counts[order]
        firsts = np.flatnonzero(np.r_[True, rest[1:] != rest[:-1]])
        often = rest[firsts][np.add.reduceat(counts.astype(np.int64), firsts) >= min(least, 255)]
        bits = np.zeros(1 << (FILTER_BITS - segments), np.uint8)
        for place in Filter.places(often, segments):
            bits[place] = 1
        return pa.table([pa.array([segment.as_py()]), pa.array([np.packbits(bits, bitorder="little").tobytes()])],
                        names=["segment", "bits"])

    return of


def _filter(texts: DataFrame, length: int, segments: int, least: int, filters: list) -> Filter:
    """One level's filter; the driver gathers its slices, 16 MB in all."""
    sent = texts.mapInArrow(
        _hash_counts(length, segments, least, filters), "segment long, hashes binary, counts binary"
    )
    slices = sent.groupBy("segment").applyInArrow(_slices(segments, least), "segment long, bits binary")
    size = 1 << (FILTER_BITS - segments - 3)
    bits = bytearray(size << segments)
    for segment, some in slices.collect():
        bits[segment * size : (segment + 1) * size] = some
    return Filter(bytes(bits), segments)


def _runs(words: Words, longest: int, filters: list) -> np.ndarray:
    """For each word, how many words from there on make the longest phrase of which every beginning passes."""
    passes = filters[0].value.has(words.word_hashes())
    lengths = passes.astype(np.int64)
    for length in range(2, longest + 1):
        at = words.at(length)
        at = at[passes[at] & passes[at + 1]]
        at = at[filters[length - 1].value.has(words.hashes(at, length))]
        passes = np.zeros(len(words), bool)
        passes[at] = True
        lengths[at] = length
    return lengths


def _spelled(line: bytes, long: dict[bytes, bytes]) -> bytes:
    return b" ".join(long.get(w, w) for w in line.split(b" "))


def _written_out(lines: pa.Array, counts: np.ndarray, long: dict[bytes, bytes]) -> tuple[pa.Array, np.ndarray]:
    """The lines with their long words instead of digests, these lines last."""
    data, offsets = _letters(lines)
    held = np.zeros(len(lines), bool)
    held[np.searchsorted(offsets, np.flatnonzero(data == _ESCAPE), "right") - 1] = True
    if not held.any():
        return lines, counts
    odd = [_spelled(x[:-1], long) + x[-1:] for x in lines.filter(pa.array(held)).to_pylist()]
    plain = lines.filter(pa.array(~held))
    return pa.concat_arrays([plain, pa.array(odd, pa.large_binary())]), np.r_[counts[~held], counts[held]]


def _sent_runs(longest: int, groups: int, filters: list):
    """Per task and some hundred thousand different runs: a row for each language and group, compressed.

    A group has runs of two words or more with the hash of their first two, or single words.
    """

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, bool], tuple[list[pa.Array], list[np.ndarray]]] = {}
        long: dict[bytes, bytes] = {}
        n = 0

        def sent() -> Iterator[pa.RecordBatch]:
            for (lang, single), parts in found.items():
                lines, counts = _written_out(*_summed(*parts), long)
                if not len(lines):
                    continue
                order = pc.array_sort_indices(lines)
                lines, counts = lines.take(order), counts[order.to_numpy()]
                words = Words([_letters(lines)[0].tobytes()], lang)
                hashes = words.hashes(words.pieces()[0], 1 if single else 2)
                bits = groups - WORD_GROUPS if single else groups
                group = (hashes >> np.uint64(64 - bits)).astype(np.int64)
                order = np.argsort(group, kind="stable")
                group, counts = group[order], counts[order].astype("<i8")
                data, offsets = _letters(lines.take(pa.array(order)))
                edges = np.flatnonzero(np.diff(group, prepend=-1, append=-1)).tolist()
                cuts = list(zip(edges, edges[1:], strict=False))
                lists = [data[offsets[a] : offsets[b]].tobytes() for a, b in cuts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([lang] * len(cuts), pa.string()),
                        pa.array(group[edges[:-1]] + (single << groups)),
                        pa.array([len(x) for x in lists], pa.int64()),
                        pa.array([pa.compress(x, codec="zstd", asbytes=True) for x in lists], pa.binary()),
                        pa.array([b - a for a, b in cuts], pa.int64()),
                        pa.array([pa.compress(counts[a:b].tobytes(), codec="zstd", asbytes=True) for a, b in cuts],
                                 pa.binary()),
                    ],
                    ["lang", "group", "size", "runs", "n", "counts"],
                )
            found.clear()
            long.clear()

        for batch in batches:
            for lang, texts in _by_lang(batch):
                words = Words(texts, lang)
                lengths = _runs(words, longest, filters)
                for single, at in ((True, np.flatnonzero(lengths)), (False, np.flatnonzero(lengths > 1))):
                    lines, counts = found.setdefault((lang, single), ([], []))
                    for a in range(0, max(1, len(at)), PHRASES_AT_ONCE):
                        some = at[a : a + PHRASES_AT_ONCE]
                        some = words.lines(some, np.ones(len(some), np.int64) if single else lengths[some])
                        some = some.value_counts()
                        lines.append(some.field(0))
                        counts.append(some.field(1).to_numpy())
                        n += len(some)
                long.update(words.long)
            if n >= PHRASES_AT_ONCE:
                for key, parts in found.items():
                    lines, counts = _summed(*parts)
                    found[key] = [lines], [counts]
                n = sum(len(x) for (x,), _ in found.values())
                if n >= PHRASES_AT_ONCE // 2:
                    yield from sent()
                    n = 0
        yield from sent()

    return of


class Trie:
    """A double array over the bytes of sorted keys; ``accept`` has a key's number at its state.

    From a state, byte ``b`` leads to ``base[state] + code[b]`` if ``check`` there is the state.
    Nodes with several children get a span of places each; children without
    brothers fill the gaps in the spans, so hardly a place is empty.
    """

    ROOT = 256

    def __init__(self, keys: list[bytes]) -> None:
        letters = np.frombuffer(b"".join(keys), np.uint8)
        sizes = np.fromiter(map(len, keys), np.int64, len(keys))
        offsets = np.cumsum(sizes) - sizes
        node = np.zeros(len(keys), np.int64)
        parents, symbols, n = [np.array([-1])], [np.zeros(1, np.uint8)], 1
        on, depth = np.flatnonzero(sizes > 0), 0
        while len(on):
            up, letter = node[on], letters[offsets[on] + depth]
            fresh = np.r_[True, (up[1:] != up[:-1]) | (letter[1:] != letter[:-1])]
            node[on] = n + np.cumsum(fresh) - 1
            parents.append(up[fresh])
            symbols.append(letter[fresh])
            n += int(fresh.sum())
            depth += 1
            on = on[sizes[on] > depth]
        parent, symbol = np.concatenate(parents), np.concatenate(symbols)
        # Frequent bytes get neighbouring codes, which keeps spans short; 255 leads nowhere.
        often = np.bincount(symbol[1:], minlength=256)
        self.code = np.empty(256, np.int64)
        self.code[np.argsort(-often, kind="stable")] = np.arange(256)
        code = self.code[symbol]
        children = np.bincount(parent[1:], minlength=n)
        several = np.flatnonzero(children > 1)
        low, high = np.full(n, 256), np.full(n, -1)
        np.minimum.at(low, parent[1:], code[1:])
        np.maximum.at(high, parent[1:], code[1:])
        spans = high[several] - low[several] + 1
        first = np.zeros(n, np.int64)
        first[several] = self.ROOT + 1 + np.cumsum(spans) - spans
        end = self.ROOT + 1 + int(spans.sum())
        place = np.empty(n, np.int64)
        place[0] = self.ROOT
        nodes = np.arange(1, n)
        brothers = nodes[children[parent[1:]] > 1]
        place[brothers] = first[parent[brothers]] + code[brothers] - low[parent[brothers]]
        taken = np.zeros(end, bool)
        taken[: self.ROOT + 1] = True
        taken[place[brothers]] = True
        alone = nodes[children[parent[1:]] == 1]
        gaps = np.flatnonzero(~taken)[: len(alone)]
        place[alone] = np.r_[gaps, end + np.arange(len(alone) - len(gaps))]
        size = end + len(alone) - len(gaps) + 256
        self.base = np.zeros(size, np.int32)
        self.check = np.full(size, -1, np.int32)
        self.accept = np.full(size, -1, np.int32)
        self.base[place[parent[1:]]] = place[1:] - code[1:]
        self.check[place[1:]] = place[parent[1:]]
        self.accept[place[node]] = np.arange(len(keys))
        self.size = len(keys)

    def after(self, key: bytes) -> int:
        """The state that a key leads to from the root, or -1."""
        state = self.ROOT
        for letter in key:
            up = int(self.base[state]) + int(self.code[letter])
            if self.check[up] != state:
                return -1
            state = up
        return state

    def counted(self, words: Words, at: np.ndarray, times: np.ndarray) -> np.ndarray:
        """How often each key stands in the text, from the given words on, each of which counts so many times."""
        counts = np.zeros(self.size, np.int64)
        places = words.starts[at]
        states = np.full(len(places), self.ROOT, np.int64)
        while len(places):
            letter = words.letters[places]
            ends = np.flatnonzero((letter == _SPACE) | (letter == _BREAK))
            ended = self.accept[states[ends]]
            np.add.at(counts, ended[ended >= 0], times[ends[ended >= 0]])
            on = self.base[states] + self.code[letter]
            goes = self.check[on] == states
            states, places, times = on[goes], places[goes] + 1, times[goes]
        return counts


def _counted(longest: int, groups: int, least: int):
    """The beginnings of a group's runs that occur often enough, and how often; single words are whole runs."""

    def of(table: pa.Table) -> pa.Table:
        lang = table.column("lang")[0].as_py()
        fewest = 1 if table.column("group")[0].as_py() >> groups else 2
        sent = table.select(["size", "runs", "n", "counts"]).to_pylist()
        lists = [pa.decompress(x["runs"], decompressed_size=x["size"], codec="zstd", asbytes=True) for x in sent]
        counts = [np.frombuffer(pa.decompress(x["counts"], 8 * x["n"], "zstd", asbytes=True), "<i8") for x in sent]
        words = Words(lists, lang)
        long = words.long
        starts = np.r_[words.starts[words.pieces()[0]], len(words.letters)]
        runs, times = _summed([_lines(words.letters, starts)], counts)
        words = Words([_letters(runs)[0].tobytes()], lang)
        first, lengths = words.pieces()
        parts = -(-len(words.letters) // BLOCK_BYTES)
        part = _mixed(words.hashes(first, fewest)) % np.uint64(parts)
        phrases, found = [], []
        for number in range(parts):
            mine = np.flatnonzero(part == number)
            if not len(mine):
                continue
            at = first[mine]
            keys = [words.phrases(at[lengths[mine] >= length], length) for length in range(fewest, longest + 1)]
            keys = pa.concat_arrays(keys)
            keys = keys.take(pc.array_sort_indices(keys))
            f = Trie(keys.to_pylist()).counted(words, at, times[mine])
            often = np.flatnonzero(f >= least)
            names = keys.take(pa.array(often)).to_pylist()
            phrases += [_spelled(x, long) for x in names] if long else names
            found.append(f[often])
        return pa.table(
            [
                pa.array([lang] * len(phrases), pa.string()),
                pa.array(phrases, pa.binary()).cast(pa.string()),
                pa.array(np.concatenate(found), pa.int64()),
            ],
            names=["lang", "phrase", "f"],
        )

    return of


def counted_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, least: int = LEAST
) -> DataFrame:
    """(lang, phrase, f): all phrases of up to ``longest`` words that occur ``least`` times
    or more; ``f`` is exact. A stored table.

    A language is that of ``lang_col``, null being ``und``. Texts are
    lower-cased (A-Z) and split at ``. , ; : ! ?`` and line breaks into pieces,
    pieces at spaces and tabs into words. Every occurrence within a piece
    counts, overlapping or not. Null and empty texts have none.
    """
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))
    texts = docs.select(lang.alias("lang"), F.col(text_col).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    segments = 8
    while segments < 20 and size > SEGMENT_TEXT << (segments - 8):
        segments += 1
    groups = 6
    while groups < 20 and size * longest > BLOCKS_AT_ONCE * BLOCK_BYTES << groups:
        groups += 1
    context, filters = docs.sparkSession.sparkContext, []
    for length in range(1, longest + 1):
        filters.append(context.broadcast(_filter(texts, length, segments, least, filters)))
    sent = texts.mapInArrow(
        _sent_runs(longest, groups, filters),
        "lang string, group long, size long, runs binary, n long, counts binary",
    )
    counted = sent.groupBy("lang", "group").applyInArrow(
        _counted(longest, groups, least), "lang string, phrase string, f long"
    )
    counted = written(counted, "counted")
    for one in filters:
        one.destroy()
    return counted


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a a / (l r)), exact for counts of up to 16 digits; never above 1000000."""
    a, left, right = (x.cast("decimal(19,0)") for x in (a, left, right))
    return F.call_function("div", a * a * F.lit(1_000_000).cast("decimal(7,0)"), left * right)


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    least: int = LEAST,
    covered: int = COVERED,
    first: int = FIRST,
) -> DataFrame:
    """Each language's ``first`` phrases: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` the parts of the cut that scores
    lowest (of equal ones the first), ``n`` all words of the language; the score
    is floor(1000000 a a / (l r)). A phrase goes if a longer frequent phrase that
    holds it has at least ``covered`` per cent of its occurrences. Order: score
    and ``a`` descending, then the phrase by its bytes. Ties are thus settled;
    repeated rows count as often as they stand there; an empty table, or one
    without frequent phrases, gives no rows.
    """
    counted = counted_phrases(docs, text_col, lang_col, longest, least)
    words = F.split("phrase", " ")
    frequent = counted.where((F.col("f") >= least) & (F.size(words) > 1)).select(
        "lang", "phrase", F.col("f").alias("a"), words.alias("words")
    )
    size = F.size("words")

    def joined(start: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", start, length), " ")

    cuts = written(
        frequent.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
            "lang",
            "phrase",
            "a",
            "k",
            joined(F.lit(1), F.col("k")).alias("left"),
            joined(F.col("k") + 1, size - F.col("k")).alias("right"),
        ),
        "cuts",
    )
    lefts = counted.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l"))
    rights = counted.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r"))
    halves = written(cuts.join(lefts, ["lang", "left"]), "halves").join(rights, ["lang", "right"])
    scored = halves.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    best = scored.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("x"))
    best = best.select("lang", "phrase", *(F.col(f"x.{c}").alias(c) for c in ("a", "l", "r", "score")))
    # The parts of a phrase by one word are its longest ones; of shorter parts the chain holds too,
    # but not their share, so every part of a phrase is named.
    shorter = frequent.where(size > 2).select(
        "lang",
        "a",
        "words",
        F.explode(F.sequence(F.lit(2), size - 1)).alias("length"),
    )
    inner = shorter.select(
        "lang",
        "a",
        F.explode(
            F.transform(
                F.sequence(F.lit(1), size - F.col("length") + 1),
                lambda i: F.array_join(F.slice("words", i, F.col("length")), " "),
            )
        ).alias("phrase"),
    )
    most = written(inner.groupBy("lang", "phrase").agg(F.max("a").alias("longer")), "longer")
    kept = written(best, "scores").join(most, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * covered)
    )
    # Of each share of a language only the first ones can be among its first, so no task ranks a whole language.
    order = F.desc("score"), F.desc("a"), F.col("phrase")
    ranked = kept.withColumn("share", F.pmod(F.xxhash64("phrase"), F.lit(SHARES)))
    for keys in (("lang", "share"), ("lang",)):
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        ranked = ranked.withColumn("rank", rank.cast("long")).where(F.col("rank") <= first)
    return ranked.join(word_totals(docs, text_col, lang_col), "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def word_totals(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, n): all words of each language."""
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG))
    n = F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+"))
    return docs.groupBy(lang.alias("lang")).agg(F.sum(F.coalesce(n, F.lit(0))).cast("long").alias("n"))
