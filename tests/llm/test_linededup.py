import random
from collections import defaultdict

import numpy as np
import pytest

from opsframe.llm import linededup
from tests.llm.cases import DOCS, awkward, rows, sentence

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def plain(docs):
    holders = defaultdict(list)
    for i, text, *_ in docs:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 20:
                holders[k].append(i)
    out = []
    for i, text, *_ in docs:
        lines = (text or "").split("\n")
        stay = []
        for line in lines:
            at = holders.get(key(line), [])
            last = max((x for x in at if x is not None), default=None)
            if len(at) < 3 or i == last:
                stay.append(line)
        out.append((i, len(lines), len(lines) - len(stay), "\n".join(stay)))
    return out


def documents(rng):
    common = [sentence(rng, 6) for _ in range(8)] + ["Größe niño größe niño ü", "exactly 20 chars now", "only 19 chars here."]
    texts = []
    for _ in range(60):
        lines = [rng.choice(common) if rng.random() < 0.4 else sentence(rng, 5) for _ in range(rng.randint(0, 12))]
        lines = [rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < 0.2 else x) for x in lines]
        texts.append("\n".join(lines))
    return rows(texts, first=20) + awkward() + [(4, common[0], "en", "x", 1), (None, common[0], "en", "x", 1)]


@pytest.mark.parametrize("bits", [None, 64])
def test_lines_against_brute_force(spark, monkeypatch, bits):
    """Also with filters so small that nearly every line is suspected."""
    if bits:
        monkeypatch.setattr(linededup, "SEGMENT_BITS", bits)
        monkeypatch.setattr(linededup, "FILTER_BYTES", bits // 8)
    docs = documents(random.Random(1))
    frame = spark.createDataFrame(docs, DOCS).repartition(5)
    out = linededup.deduplicated(frame)
    assert out.columns == [*frame.columns, "lines"]
    got = [(r.doc_id, r.lines.n_lines, r.lines.n_dropped, r.lines.kept) for r in out.collect()]
    assert sorted(got, key=str) == sorted(plain(docs), key=str)


def test_filters_miss_no_repeat():
    """Hashes in two parts, or twice in one, are all in the merged twice-seen filter."""
    rng = np.random.default_rng(1)
    hashes = rng.integers(0, 2**63, 3_000).astype(np.uint64)
    parts = [np.concatenate([hashes[:1_000], hashes[:100]]), hashes[500:2_000], hashes[1_900:]]
    segments = []
    for part in parts:
        filters = linededup.TwoFilters(linededup.SEGMENT_BITS)
        for some in np.array_split(part, 4):
            filters.add(some)
        segments += [(s["once"], s["twice"]) for s in filters.segments()]
    _, twice = linededup.merged(iter(segments))
    filled = np.unpackbits(np.frombuffer(twice, np.uint8)).astype(bool)
    found = np.logical_and.reduce([filled[p] for p in linededup._places(hashes, linededup.SEGMENT_BITS)])
    repeated = np.r_[0:100, 500:1_000, 1_900:2_000]
    assert found[repeated].all()
    assert found.mean() < 0.3


def test_only_suspects_shuffle(spark):
    """A line that no two documents share is not among the rows that shuffle."""
    docs = rows([f"line number {i} stands alone\nthis line is in every document" for i in range(50)])
    texts = spark.createDataFrame(docs, DOCS).select("text")
    twice, bits = linededup.twice_seen(texts, 20)
    keys = [r[0] for r in texts.select(linededup._suspects(twice, bits, 20)("text")).collect()]
    assert all("this line is in every document" in k for k in keys)
    assert sum(len(k) for k in keys) < 55


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame(
        [(1, "a line of twenty characters", 5, "k", "l")],
        "doc_id long, text string, id long, key string, lines string",
    )
    row = linededup.deduplicated(frame).first()
    assert (row.id, row.key, row.lines.n_dropped) == (5, "k", 0)
    assert linededup.deduplicated(frame.limit(0)).count() == 0
