import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opsframe.llm import phrases
from tests.llm.cases import DOCS, awkward, rows, sentence


def pieces(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", folded)]


def plain(docs, longest=3, least=10, covered=50, first=2_000):
    counts, n, out = defaultdict(Counter), Counter(), []
    for text, lang in docs:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        gone = {
            p[i : i + k]
            for p, a in frequent.items()
            for k in range(2, len(p))
            for i in range(len(p) - k + 1)
            if 100 * a >= covered * f[p[i : i + k]]
        }
        scored = []
        for p, a in frequent.items():
            if p not in gone:
                s, _, left, right = min(
                    (1_000_000 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))
                )
                scored.append((-s, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, p, left, right) in enumerate(sorted(scored)[:first], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def corpus():
    rng = random.Random(3)
    words = "the of and on to river bank stone in a New York city".split()
    texts = []
    for i in range(160):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(0, 60)))
        text += rng.choice([" new york city", ".new  York,\tcity", "! San\tFrancisco bay", " a a a a"])
        texts.append(text.replace(" on ", rng.choice([". ", "\n", " ; ", " on "])))
    long = "w" * 300
    texts += [f"{long} {'é' * 40} tail", f"x {long}\t{'é' * 40} tail end"] * 28
    docs = [(i, t, ("en", "de", None, "und", "a\nb")[i % 5], "s", 0) for i, t in enumerate(texts)]
    return docs + awkward()


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, small):
    """Also with blocks, gathered phrases and hashes so small that each is cut many times."""
    if small:
        for name, value in (("BLOCK_BYTES", 4_000), ("PHRASES_AT_ONCE", 20), ("HASHES_AT_ONCE", 50),
                            ("SEGMENT_TEXT", 500), ("BLOCKS_AT_ONCE", 2), ("BYTES_AT_ONCE", 64)):
            monkeypatch.setattr(phrases, name, value)
    docs = corpus()
    found = phrases.collocations(spark.createDataFrame(docs, DOCS))
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    expected = plain([(d[1], d[2]) for d in docs])
    assert any("w" * 300 in p[2] for p in expected)
    assert sorted(map(tuple, found.collect())) == sorted(expected)


def test_other_lengths_and_cuts(spark):
    docs = corpus()
    found = phrases.collocations(spark.createDataFrame(docs, DOCS), longest=4, least=5, covered=80, first=7)
    assert sorted(map(tuple, found.collect())) == sorted(plain([(d[1], d[2]) for d in docs], 4, 5, 80, 7))


def test_empty_tables_and_other_columns(spark):
    frame = spark.createDataFrame([("a b", "en", 1, "x")] * 12, "body string, tongue string, f long, phrase string")
    names = {"text_col": "body", "lang_col": "tongue"}
    assert [tuple(r) for r in phrases.collocations(frame, **names).collect()] == [
        ("en", 1, "a b", 12, 12, 12, 24, 1_000_000)
    ]
    assert phrases.collocations(frame.limit(0), **names).count() == 0
    assert phrases.collocations(frame.limit(3), **names).count() == 0


def test_scores_beyond_64_bits(spark):
    n = 4_000_000_000_000_000
    frame = spark.createDataFrame([(n, n, n + 1), (7, 9, 11)], "a long, l long, r long")
    score = phrases._score(*(frame[c] for c in "alr"))
    assert [r[0] for r in frame.select(score).collect()] == [
        10**6 * n * n // (n * (n + 1)), 10**6 * 49 // 99]


KEYS = st.lists(st.text("ab é", min_size=1, max_size=6).map(str.encode), min_size=1, max_size=40, unique=True)


@settings(max_examples=80, deadline=None)
@given(KEYS)
def test_trie_holds_its_keys_and_nothing_else(keys):
    keys.sort()
    trie = phrases.Trie(keys)
    places = np.flatnonzero(trie.check >= 0)
    assert (trie.check[places] != -1).all()
    for number, key in enumerate(keys):
        assert trie.accept[trie.after(key)] == number
        for other in (key[:-1], key + b"a", key + b"z"):
            state = trie.after(other)
            if other not in keys and other:
                assert state == -1 or trie.accept[state] == -1


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aB .\t\n;é", max_size=30), max_size=6))
def test_words_are_those_of_the_pieces(texts):
    words = phrases.Words([t.encode() for t in texts], "en")
    expected = [w for t in texts for w in pieces(t)]
    assert [bytes(words.letters[a:b]).decode() for a, b in zip(words.starts, words.ends, strict=True)] == [
        x for w in expected for x in w
    ]
    for k in (1, 2, 3):
        assert len(words.at(k)) == sum(max(len(w) - k + 1, 0) for w in expected)
    assert sorted(x.as_py().decode() for x in words.phrases(words.at(2), 2)) == sorted(
        {f"{a} {b}" for w in expected for a, b in zip(w, w[1:], strict=False)}
    )
    same = defaultdict(set)
    for at, h in zip(words.at(2).tolist(), words.hashes(words.at(2), 2).tolist(), strict=True):
        same[bytes(words.letters[words.starts[at] : words.ends[at + 1]])].add(h)
    assert all(len(x) == 1 for x in same.values())


def test_rows_and_null_language(spark):
    docs = rows([sentence(random.Random(1), 30)] * 15)
    found = phrases.collocations(spark.createDataFrame(docs, DOCS)).collect()
    assert {r.lang for r in found} == {"en"} and all(r.a >= 15 for r in found)


def test_texts_are_read_as_often_for_many_tries(spark, monkeypatch):
    """Once a level and once to count, whatever number of tries the phrases fill."""
    docs = [(i, t, ("en", "de")[i % 2], "s", 0) for i, (_, t, *_) in enumerate(corpus()) if t and len(t) < 2_000]
    frame, readings = spark.createDataFrame(docs, DOCS), []
    whole = type(frame).mapInArrow
    monkeypatch.setattr(type(frame), "mapInArrow", lambda *a, **k: readings.append(1) or whole(*a, **k))
    expected = sorted(plain([(d[1], d[2]) for d in docs]))
    for block in (4 << 20, 200):
        monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
        monkeypatch.setattr(phrases, "BLOCKS_AT_ONCE", 1)
        readings.clear()
        assert sorted(map(tuple, phrases.collocations(frame).collect())) == expected
        assert len(readings) == phrases.LONGEST + 1


class Sent:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_groups_count_every_beginning_of_a_run(monkeypatch, block):
    """Also of runs with long words, in several tries of a group, sent by several tasks."""
    monkeypatch.setattr(phrases, "BLOCK_BYTES", block)
    monkeypatch.setattr(phrases, "PHRASES_AT_ONCE", 60)
    docs = [(d[1], d[2] or "und") for d in corpus() if d[1] is None or len(d[1]) < 2_000]
    every = [Sent(phrases.Filter(b"\xff" * (1 << (phrases.FILTER_BITS - 3)), 8))] * 3
    tasks = [pa.RecordBatch.from_pylist([{"lang": x, "text": t} for t, x in docs[k::2]]) for k in range(2)]
    sent = pa.Table.from_batches([b for task in tasks for b in phrases._sent_runs(3, 6, every)(iter([task, task]))])
    expected, found = Counter(), {}
    for text, lang in docs + docs:
        for w in pieces(text):
            expected.update((lang, " ".join(w[i : i + k])) for k in (1, 2, 3) for i in range(len(w) - k + 1))
    for lang, group in sorted(set(zip(*(sent.column(c).to_pylist() for c in ("lang", "group")), strict=True))):
        rows_of = [r for r in sent.to_pylist() if (r["lang"], r["group"]) == (lang, group)]
        counted = phrases._counted(3, 6, 3)(pa.Table.from_pylist(rows_of, sent.schema)).to_pylist()
        assert not found.keys() & {(r["lang"], r["phrase"]) for r in counted}
        found |= {(r["lang"], r["phrase"]): r["f"] for r in counted}
    assert found == {x: f for x, f in expected.items() if f >= 3}
