import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsframe.llm import mixing, queries
from tests.llm.cases import DOCS, awkward, sentence


def plain_targets(sizes):
    """By the words of the rule: full sources stop, the rest share again."""
    weights = [1 + i % 3 for i in range(len(sizes))]
    targets, full = {}, set()
    while len(full) < len(sizes):
        left = sum(sizes) - sum(targets[i] for i in full)
        free = [i for i in range(len(sizes)) if i not in full]
        share = {i: left * weights[i] / sum(weights[j] for j in free) for i in free}
        over = [i for i in free if share[i] > 3 * sizes[i]]
        if not over:
            return [targets.get(i, share.get(i)) for i in range(len(sizes))]
        for i in over:
            targets[i] = 3.0 * sizes[i]
            full.add(i)
    return [targets[i] for i in range(len(sizes))]


def documents(rng):
    docs = []
    for i in range(300):
        # One source holds a third of the rows, some very few words.
        source = rng.choice(["hot", "hot", "a", "b", "é", "z", "tiny"])
        n = rng.randint(0, 3) if source == "tiny" else rng.randint(1, 120)
        docs.append((i + 100, sentence(rng, n), "en", source, 0))
    return docs + awkward() + [(900, "", "en", "nothing", 0)]


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("block_words", [mixing.BLOCK_WORDS, 200])
def test_targets_and_taken_words(spark, block_words):
    docs = documents(random.Random(1))
    frame = spark.createDataFrame(docs, DOCS)
    found = mixing.mixed(frame, block_words=block_words).collect()
    assert Counter(tuple(r)[:5] for r in found) == Counter(docs)
    sizes, largest = Counter(), Counter()
    for _, text, _, source, _ in docs:
        sizes[source] += words(text)
        largest[source] = max(largest[source], words(text))
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = dict(zip(order, plain_targets([sizes[s] for s in order]), strict=True))
    taken = Counter()
    for r in found:
        m = r.mix
        assert m["size"] == words(r.text) and m.source_size == sizes[r.source]
        assert m.target == pytest.approx(target[r.source])
        assert m.taken == m.times * m["size"] and 0 <= m.times <= 3
        taken[r.source] += m.taken
    for source in order:
        assert abs(taken[source] - target[source]) <= largest[source] / 2 + 1
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))


def test_reruns_agree_however_rows_are_stored(spark):
    docs = documents(random.Random(2))
    frame = spark.createDataFrame(docs, DOCS)
    runs = [
        Counter((r.doc_id, r.shard, r.mix_order) for r in mixing.drawn(mixing.mixed(f, block_words=300)).collect())
        for f in (frame, frame.orderBy("text").repartition(7))
    ]
    assert runs[0] == runs[1]


def test_draws_fill_disjoint_shards(spark):
    """Copies follow ``times``; one pass's block is in one shard; shards hold equal numbers of draws."""
    docs = documents(random.Random(3))
    frame = spark.createDataFrame(docs, DOCS)
    mix = mixing.mixed(frame, block_words=100, shards=4)
    times = Counter()
    blocks = {}
    for r in mix.collect():
        times[r.doc_id] += r.mix.times
        blocks[r.doc_id] = (r.source, r.mix.block)
    draws = mixing.drawn(mix)
    assert draws.columns == [*frame.columns, "shard", "mix_order"]
    rows = draws.collect()
    assert Counter(r.doc_id for r in rows) == +times
    assert {r.shard for r in rows} == {0, 1, 2, 3}
    per = defaultdict(Counter)
    for r in rows:
        per[blocks[r.doc_id]][r.shard] += 1
    assert all(len(shards) <= 3 for shards in per.values())


def test_another_seed_draws_others_and_misses_no_target(spark):
    docs = [d for d in documents(random.Random(4)) if (d[0] or 0) >= 100]
    frame = spark.createDataFrame(docs, DOCS)
    taken, shards = [], []
    for seed in (1, 2):
        mix = mixing.mixed(frame, block_words=60, shards=4, seed=seed)
        rows = mix.collect()
        sums, largest = Counter(), Counter()
        for r in rows:
            sums[r.source] += r.mix.taken
            largest[r.source] = max(largest[r.source], r.mix["size"])
        assert all(abs(sums[r.source] - r.mix.target) <= largest[r.source] / 2 + 1 for r in rows)
        taken.append({r.doc_id: r.mix.times for r in rows})
        shards.append(Counter((r.doc_id, r.shard) for r in mixing.drawn(mix, seed=seed).collect()))
    assert sum(taken[0][i] != taken[1][i] for i in taken[0]) > 20
    assert sum((shards[0] - shards[1]).values()) > 100


def test_passes_are_permutations_of_their_own(spark):
    """Every pass has each block once, in another order, without a step that leads from one to the next."""
    plan = F.struct(F.col("source"), F.lit(512).cast("long").alias("blocks"), F.lit(16).cast("long").alias("side"))
    blocks = spark.range(512).crossJoin(spark.createDataFrame([("a",), ("b",), (None,)], "source string"))
    orders = []
    for number in range(3):
        rows = blocks.select("source", "id", mixing._place(F.col("id"), plan, number, 10).alias("place")).collect()
        for source in ("a", "b", None):
            found = [r.place for r in sorted(rows, key=lambda r: r.id) if r.source == source]
            assert sorted(found) == list(range(512 * number, 512 * number + 512))
            orders.append(found)
    for found in orders:
        steps = Counter((b - a) % 512 for a, b in zip(found, found[1:], strict=False))
        assert max(steps.values()) < 16
    assert len({tuple(x % 512 for x in found) for found in orders}) == 9


def test_tree_splits_every_quota_exactly():
    rng = np.random.default_rng(1)
    quotas = [0, 7, 500, 3, 1, 90]
    tree = mixing.SplittingTree(sum(quotas), 7, rng)
    parts = np.array([tree.split(q) for q in quotas])
    assert parts.sum(axis=1).tolist() == quotas
    totals = parts.sum(axis=0)
    assert totals.max() - totals.min() <= 1


def test_tree_draws_are_hypergeometric():
    """A source with half of all blocks has about half of every shard's, with the right spread."""
    first = []
    for seed in range(400):
        tree = mixing.SplittingTree(40, 4, np.random.default_rng(seed))
        first.append(tree.split(20))
        tree.split(20)
    first = np.array(first)
    assert np.allclose(first.mean(axis=0), 5, atol=0.25)
    # n K (N - K) (N - n) / N^2 (N - 1) for N = 40, K = 20, n = 10
    assert np.allclose(first.var(axis=0), 10 * 0.25 * 30 / 39, rtol=0.3)


def test_empty_table_and_clashing_columns(spark):
    frame = spark.createDataFrame(
        [(1, "a b c", "s", 7, 8, "m")], "doc_id long, text string, source string, size long, target int, mix string"
    )
    row = mixing.mixed(frame).first()
    assert (row["size"], row.target, row.mix.taken) == (7, 8, 3)
    assert mixing.mixed(frame.limit(0)).count() == 0
    assert mixing.drawn(mixing.mixed(frame.limit(0))).count() == 0


def test_query_sums_to_its_targets(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: r for r in queries.table(spark, folder, "documents").collect()}
    out = queries.op10_mixing(spark, folder).collect()
    assert len(out) == len(docs)
    by = defaultdict(list)
    for r in out:
        assert r["size"] == words(docs[r.doc_id].text)
        by[docs[r.doc_id].source].append(r)
    for some in by.values():
        largest = max(r["size"] for r in some)
        assert abs(sum(r.taken for r in some) - some[0].target) <= largest / 2 + 1
        assert sum(r["size"] for r in some) == some[0].source_size
