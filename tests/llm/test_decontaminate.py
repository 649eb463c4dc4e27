import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import example, given, settings
from hypothesis import strategies as st

from opsframe.llm import decontaminate, queries
from tests.llm.cases import DOCS, awkward, rows, sentence

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items):
    windows = {}
    for item, text in items:
        w = words_of(text)
        for a in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[a : a + 10]), set()).add("" if item is None else str(item))
    out = []
    for doc in docs:
        w, hit, found = words_of(doc[1]), set(), set()
        for phrase, holders in windows.items():
            for a in range(len(w) - len(phrase) + 1):
                if tuple(w[a : a + len(phrase)]) == phrase:
                    hit.update(range(a, a + len(phrase)))
                    found |= holders
        out.append((doc[0], len(w), len(hit), len(found), ",".join(sorted(found)), bool(hit)))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.lists(st.integers(1, 3), min_size=1, max_size=4))
@example([1], [1, 2, 1])
@example([1], [2, 1])
def test_index_finds_every_occurrence(symbols, phrase):
    text = np.array([*symbols, 0], np.int64)
    index = decontaminate.FMIndex(text, 3)
    matrix = np.zeros((1, 4), np.int64)
    matrix[0, 4 - len(phrase) :] = phrase
    low, high = index.search(matrix, np.array([len(phrase)]))
    found = sorted(index.locate(np.arange(low[0], high[0])).tolist())
    n = len(phrase)
    assert found == [i for i in range(len(text) - n + 1) if text[i : i + n].tolist() == phrase]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=80), st.integers(0, 9))
def test_wavelet_ranks_and_symbols(sequence, symbol):
    matrix = decontaminate.WaveletMatrix(np.array(sequence), 9)
    ends = np.arange(len(sequence) + 1)
    ranks = matrix.rank(np.full(len(ends), symbol), ends)
    assert ranks.tolist() == [sequence[:e].count(symbol) for e in ends]
    assert matrix.access(np.arange(len(sequence))).tolist() == sequence


def tables(rng):
    passages = [sentence(rng, n) for n in (30, 45, 12, 10, 9, 3, 60)]
    items = [(i, p) for i, p in enumerate(passages)]
    items += [(10, passages[0]), (11, None), (12, ""), (13, "!!!"), (None, passages[2]), (10, passages[1])]
    texts = []
    for _ in range(25):
        text = sentence(rng, rng.randint(0, 150))
        for _ in range(rng.randint(0, 3)):
            w = rng.choice(passages).split()
            a = rng.randrange(len(w))
            text += " " + ", ".join(w[a : a + rng.randint(5, 40)]).upper() + " " + sentence(rng, 4)
        texts.append(text)
    texts += [passages[0]] * 4 + [" ".join(passages), passages[1] + "\n" + passages[1]]
    return rows(texts, first=100) + awkward(), items


@pytest.mark.parametrize("shard, block", [(1_000_000, 100_000), (200, 25)])
def test_scan_against_brute_force(spark, monkeypatch, shard, block):
    """Also over many small shards and with the benchmark in many blocks."""
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontaminate, "PHRASES_AT_ONCE", block)
    docs, items = tables(random.Random(1))
    found = decontaminate.scanned(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, "item_id long, text string")
    )
    got = []
    for r in found.collect():
        c = r.contamination
        hit = sum(s.end - s.start for s in c.spans)
        assert all(a.end < b.start for a, b in zip(c.spans, c.spans[1:], strict=False))
        got.append((r.doc_id, c.n_words, hit, len(c["items"]), ",".join(c["items"]), bool(c.spans)))
    assert sorted(got, key=str) == sorted(plain(docs, items), key=str)


def test_cut_texts_have_no_window_left(spark):
    docs, items = tables(random.Random(2))
    frame = spark.createDataFrame(docs, DOCS)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminated(frame, benchmark, n_chars_col="n_chars")
    assert out.columns == frame.columns
    before = plain(docs, items)
    clean = sorted((d for d, b in zip(docs, before, strict=True) if not b[5]), key=str)
    kept = [tuple(r) for r in out.collect()]
    assert sorted((r for r in kept if r in clean), key=str) == clean
    gone = [b for b in before if b[2] and b[2] == b[1]]
    assert len(kept) == len(docs) - len(gone)
    cut = [r for r in kept if r not in clean]
    assert cut and all(r[4] == len(r[1]) for r in cut)


def test_spans_are_cut_by_words(spark):
    frame = spark.createDataFrame([(1, "Keep, THIS one: two! three and keep that.")], "doc_id long, text string")
    benchmark = spark.createDataFrame([("x", "one two THREE")], "item_id string, text string")
    out = decontaminate.decontaminated(frame, benchmark)
    assert out.first().text == "Keep, THIS  and keep that."


def test_empty_tables_and_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b", "old")], "doc_id long, text string, contamination string")
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.scanned(docs, none).first().contamination.spans == []
    assert decontaminate.scanned(docs, some).first().contamination["items"] == ["1"]
    assert decontaminate.scanned(docs.limit(0), some).count() == 0


def test_query_digest(spark):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, folder, "documents").collect()]
    items = [tuple(r) for r in queries.table(spark, folder, "benchmark").collect()]
    expected = {
        (i, n, hit, k, hashlib.sha256(names.encode()).hexdigest(), on)
        for i, n, hit, k, names, on in plain(docs, items)
    }
    assert {tuple(r) for r in queries.op2_decontaminate(spark, folder).collect()} == expected
