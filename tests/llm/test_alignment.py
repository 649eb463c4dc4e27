import bisect
import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from opsframe.llm import alignment, queries
from tests.llm.cases import DOCS, awkward, rows, sentence

pytestmark = pytest.mark.skipif(not os.path.isdir(alignment.TOKENIZERS), reason="no tokenizer files")


@pytest.fixture(scope="module")
def original():
    """The byte-level file as its own library runs it."""
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(f"{alignment.TOKENIZERS}/{alignment.BYTE_BPE}")
    found.encode_special_tokens = True
    return found


def plain(docs, original):
    both = alignment.tokenizers(alignment.TOKENIZERS)
    links, facts = Counter(), []
    for text in docs:
        a = original.encode(" " + text, add_special_tokens=False).ids if text else []
        b = both.pieces.encode(text) if text else []
        bytes_a, bytes_b = [both.bytes_a[i] for i in a], [both.bytes_b[i] for i in b]
        if text and not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            a, b, bytes_a, bytes_b = [], [], [], []
        ends_a, ends_b = ([sum(map(len, x[:i])) for i in range(len(x) + 1)] for x in (bytes_a, bytes_b))
        mine = []
        for i in range(len(a)):
            j = bisect.bisect_right(ends_b, ends_a[i]) - 1
            while j < len(b) and ends_b[j] < ends_a[i + 1]:
                mine.append((a[i], b[j]))
                j += 1
        links.update(mine)
        cuts = [0, *sorted((set(ends_a) & set(ends_b)) - {0})]
        groups = [
            ",".join(str(x) for x, e in zip(a, ends_a[1:], strict=True) if low < e <= high) + "|"
            + ",".join(str(x) for x, e in zip(b, ends_b[1:], strict=True) if low < e <= high)
            for low, high in zip(cuts, cuts[1:], strict=False)
        ]
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else ""
        facts.append((len(a), len(b), len(groups), mine, digest))
    most = Counter()
    for (_, y), n in links.items():
        most[y] = max(most[y], n)
    return [
        (a, b, g, len(m), sum(links[x] == most[x[1]] for x in m), sum(links[x] for x in m), digest)
        for a, b, g, m, digest in facts
    ]


ODD = [
    "<s> </s> <unk> <0x41> <|endoftext|>", "a  b   c ", " lead", "\n\n\ttabs", "ﬁ é é \xa0x", "x▁y",
    "\x00\x01 \U0001f600‍", "1234567 It's I'LL", "é" * 300, "!" * 200, " ",
]


@pytest.mark.parametrize("small", [False, True])
def test_equals_brute_force(spark, monkeypatch, original, small):
    """Also over many shards, some in one task, and with scores in many blocks."""
    if small:
        for name, value in (("SHARD_ENTRIES", 150), ("TEXT_AT_ONCE", 200), ("SCORES_AT_ONCE", 40), ("DENSE", 2)):
            monkeypatch.setattr(alignment, name, value)
    docs = [r for r in awkward() if r[0] not in (6, 7)] + rows([*ODD, *ODD[:3]], first=100)
    docs += rows([sentence(random.Random(i), 40) for i in range(30)], first=200)
    docs.append((6, "\n".join(sentence(random.Random(9), 12) for _ in range(60)), "en", "s", 0))
    found = alignment.aligned(spark.createDataFrame(docs, DOCS).coalesce(3))
    assert found.columns == ["doc_id", "lang", "source", "n_chars", "alignment"]
    expected = [(d[0], *x) for d, x in zip(docs, plain([d[1] for d in docs], original), strict=True)]
    got = [(r.doc_id, *r.alignment) for r in found.collect()]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_document_and_link_counts_of_pairs(spark):
    both = alignment.tokenizers(alignment.TOKENIZERS)
    texts = [sentence(random.Random(i), 25) for i in range(40)] + ["the the the the"] * 20
    docs, links = Counter(), Counter()
    for text in texts:
        pairs = Counter(alignment.Aligned([text], both).pairs.tolist())
        docs.update(pairs.keys())
        links.update(pairs)
    shards = alignment.inverted(spark.createDataFrame(rows(texts), DOCS).coalesce(2))
    found = {r.pair: (r.n_docs, r.n_links) for r in alignment.pair_counts(shards).collect()}
    assert found == {pair: (docs[pair], links[pair]) for pair in links}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 6), st.integers(0, 40), st.integers(1, 9)), max_size=60), st.integers(1, 50))
def test_planes_keep_what_they_are_given(entries, dense):
    times = {}
    for pair, doc, n in entries:
        times[pair << 16 | doc] = n
    keys = np.array(sorted(times), np.int64)
    counts = np.array([times[k] for k in keys.tolist()], np.int64)
    before, alignment.DENSE = alignment.DENSE, dense
    try:
        planes = alignment.Planes(keys, counts, 41)
    finally:
        alignment.DENSE = before
    back = alignment.Planes.unpacked(planes.packed(), planes.nbytes())
    scores = alignment.Scores(np.arange(5), np.arange(5) * 10 + 1, np.arange(5) % 2 == 0)
    for one in (planes, back):
        pairs, docs, links = one.counts()
        assert dict(zip(pairs.tolist(), docs.tolist(), strict=True)) == Counter(k >> 16 for k in times)
        expected = Counter()
        for k, n in times.items():
            expected[k >> 16] += n
        assert dict(zip(pairs.tolist(), links.tolist(), strict=True)) == expected
        total, best = one.summed(scores)
        for doc in range(41):
            mine = [(k >> 16, n) for k, n in times.items() if k & 0xFFFF == doc and k >> 16 < 5]
            assert total[doc] == sum(n * (pair * 10 + 1) for pair, n in mine)
            assert best[doc] == sum(n for pair, n in mine if pair % 2 == 0)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40))
def test_ids_are_those_of_the_file(original, text):
    both = alignment.tokenizers(alignment.TOKENIZERS)
    assert both.byte_pairs.encode_ordinary(" " + text) == original.encode(" " + text, add_special_tokens=False).ids


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame([("a b", 1, 2)], "text string, alignment int, shard int")
    found = alignment.aligned(frame)
    assert found.columns == ["shard", "alignment"] and found.first().alignment.n_links == 2
    assert alignment.aligned(frame.limit(0)).count() == 0
    assert alignment.aligned(frame.select("text")).columns == ["alignment"]


def test_query_digest(spark, original):
    folder = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in queries.table(spark, folder, "documents").limit(10**6).collect()]
    short = [(i, t) for i, t in docs if len(t or "") < 1_500]
    facts = {i: x[:4] + x[6:] for (i, _), x in zip(short, plain([t for _, t in short], original), strict=True)}
    found = {r.doc_id: tuple(r)[1:] for r in queries.op13_alignment(spark, folder).collect()}
    assert len(found) == len(docs)
    assert {i: found[i][:4] + found[i][6:] for i, _ in short} == facts
