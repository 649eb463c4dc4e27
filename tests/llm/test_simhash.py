import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from opsframe.llm import components, queries, simhash
from tests.llm.cases import DOCS, awkward, rows, sentence


def plain_fingerprint(text, shingle=4):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + shingle]).encode(), 42) for i in range(n)]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > n)


def groups(prints, distance=4):
    root = {p: p for p in prints}

    def top(p):
        return p if root[p] == p else top(root[p])

    for a, b in combinations(prints, 2):
        if (a ^ b).bit_count() <= distance:
            x, y = top(a), top(b)
            root[max(x, y)] = min(x, y)
    return {p: top(p) for p in prints}


def signed(p):
    return p - (1 << 64) if p >> 63 else p


def near(rng, p, n):
    for bit in rng.sample(range(64), n):
        p ^= 1 << bit
    return p


def test_golay_code_is_perfect():
    golay = simhash.Golay()
    weights = [int(e).bit_count() for e in golay.errors[:, 0]]
    assert [weights.count(w) for w in range(4)] == [1, 23, 253, 1771]
    six = (golay.errors >= 0).sum(axis=1)
    assert sorted(set(six.tolist())) == [1, 6]
    assert all((w == 3) == (n == 6) for w, n in zip(weights, six, strict=True))


def test_segments_within_two_bits_share_an_index():
    rng = random.Random(1)
    for _ in range(300):
        a = rng.getrandbits(23)
        b = a
        for bit in rng.sample(range(23), rng.randint(0, 2)):
            b ^= 1 << bit
        x, y = (set(simhash.golay().indices(np.array([v]))[0].tolist()) - {-1} for v in (a, b))
        assert x & y


def test_fingerprints_within_four_bits_share_a_key():
    rng = random.Random(2)
    for _ in range(400):
        a = rng.getrandbits(64)
        b = near(rng, a, rng.randint(0, 4))
        at, keys = simhash.keys_of(np.array([signed(a), signed(b)], np.int64))
        assert set(keys[at == 0].tolist()) & set(keys[at == 1].tolist())


@pytest.mark.parametrize("text", ["", " \n", "One", "a b c d e f g", "A b\tc\x0bd  e", "niño É é x y"])
def test_fingerprint_is_the_plain_one(text):
    assert simhash.text_fingerprint(text.encode()) == signed(plain_fingerprint(text))


def test_fingerprint_of_long_text_in_pieces(monkeypatch):
    text = sentence(random.Random(3), 500)
    monkeypatch.setattr(simhash, "SHINGLES_AT_ONCE", 7)
    assert simhash.text_fingerprint(text.encode()) == signed(plain_fingerprint(text))


@pytest.mark.parametrize("large_run", [simhash.LARGE_RUN, 3])
def test_links_connect_what_brute_force_connects(spark, monkeypatch, large_run):
    """Dense and chained groups; also when nearly every key counts as overlong."""
    monkeypatch.setattr(simhash, "LARGE_RUN", large_run)
    monkeypatch.setattr(simhash, "SMALL_RUN", 4)
    rng = random.Random(4)
    prints = set()
    for _ in range(12):
        p = rng.getrandbits(64)
        prints.add(p)
        for _ in range(6):
            prints.add(near(rng, p, rng.randint(1, 5)))
        for _ in range(3):
            p = near(rng, p, 4)
            prints.add(p)
    frame = spark.createDataFrame([(signed(p),) for p in prints], "fp long")
    found = {r.node: r.root for r in components.connected(simhash.links(frame)).collect()}
    expected = groups(prints)
    same = {}
    for p in prints:
        same.setdefault(expected[p], set()).add(found.get(signed(p), signed(p)))
    assert all(len(x) == 1 for x in same.values())
    assert len(set.union(*same.values())) == len(same)


def test_connected_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    loops = [(5000, 5000), (None, 3)]
    frame = spark.createDataFrame(chain + star + loops, "a long, b long").repartition(7)
    found = {r.node: r.root for r in components.connected(frame).collect()}
    assert found == {i: 0 for i in range(201)} | {i: 1000 for i in range(1000, 1300)}


def test_no_links_no_components(spark):
    assert components.connected(spark.createDataFrame([], "a long, b long")).count() == 0


def documents(rng):
    texts = []
    for _ in range(15):
        base = sentence(rng, 120).split()
        texts += [" ".join(base)] * 2
        changed = base.copy()
        changed[rng.randrange(len(base))] = "changed"
        texts.append(" ".join(changed))
    return texts


def test_near_duplicates_against_brute_force(spark):
    docs = rows(documents(random.Random(6)), first=10) + awkward()
    frame = spark.createDataFrame(docs, DOCS)
    found = sorted(map(tuple, simhash.near_duplicates(frame).collect()), key=str)
    prints = [plain_fingerprint(t) for _, t, *_ in docs]
    group = groups(sorted(set(prints)))
    first = {}
    for (i, *_), p in zip(docs, prints, strict=True):
        if i is not None:
            first[group[p]] = min(first.get(group[p], i), i)
    expected = [(i, signed(p), first.get(group[p])) for (i, *_), p in zip(docs, prints, strict=True)]
    assert found == sorted(expected, key=str)


def test_one_document_of_each_group_stays(spark):
    docs = rows(documents(random.Random(7)), first=10) + awkward()
    frame = spark.createDataFrame(docs, DOCS)
    kept = simhash.first_of_each(frame)
    assert kept.columns == frame.columns
    ids = [r.doc_id for r in kept.collect()]
    prints = {}
    for i, t, *_ in docs:
        prints.setdefault(plain_fingerprint(t), []).append(i)
    assert len(ids) == len(set(ids))
    assert len(ids) == len(set(groups(sorted(prints)).values()))


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.first_of_each(empty).count() == 0
    clash = spark.createDataFrame(
        [(1, "a b c d e", 9, 9, 9, 9)],
        "doc_id long, text string, fp long, component_id long, root long, key long",
    )
    assert simhash.near_duplicates(clash).first().component_id == 1
    assert simhash.first_of_each(clash).first().fp == 9


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_query_prints_sixteen_digits(spark):
    out = queries.op1_simhash(spark, "/root/testdata/sf0.001")
    docs = {r.doc_id: r.text for r in queries.table(spark, "/root/testdata/sf0.001", "documents").collect()}
    found = out.collect()
    assert len(found) == len(docs)
    assert all(r.fingerprint == f"{plain_fingerprint(docs[r.doc_id]):016x}" for r in found)
