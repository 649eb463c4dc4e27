import random
from collections import Counter

import corpus_pipeline
from opsframe.llm import simhash
from tests.llm.cases import DOCS, awkward, rows, sentence
from tests.llm.test_decontaminate import plain as contaminated
from tests.llm.test_simhash import groups, plain_fingerprint


def corpus(rng):
    """Clean documents, toxic ones, copies, near-copies and benchmark passages."""
    items = [(i, sentence(rng, 30)) for i in range(3)]
    texts = [sentence(rng, rng.randint(60, 150)) for _ in range(240)]
    for i in range(0, 240, 8):
        words = texts[i].split()
        for _ in range(4):
            words.insert(rng.randrange(len(words)), rng.choice(["wretched", "rotten", "vermin"]))
        texts[i] = " ".join(words)
    texts += [texts[1]] * 5 + [texts[2] + " end"] * 3
    for i in (3, 5):
        texts[i] = f"{texts[i]} {items[i % 3][1]} {sentence(rng, 5)}"
    labels = [(i, 1, int(i < 240 and i % 8 == 0)) for i in range(len(texts)) if i % 3]
    return rows(texts), items, labels


def test_stages_on_a_small_corpus(spark, tmp_path):
    docs, items, labels = corpus(random.Random(1))
    docs = docs + [(i and i + 1_000, *rest) for i, *rest in awkward()]
    for name, data, schema in (
        ("documents", docs, DOCS),
        ("benchmark", items, "item_id long, text string"),
        ("labels", labels, "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert [*stages] == ["toxicity", "near_duplicates", "decontamination", "mixing", "sharding"]

    def run(name, frame):
        stages[name](spark, frame, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        return spark.read.parquet(f"{tmp_path}/{name}")

    columns = DOCS.replace(" long", "").replace(" string", "").split(", ")
    clean = run("toxicity", spark.read.parquet(f"{tmp_path}/documents.parquet"))
    kept = [tuple(r) for r in clean.collect()]
    toxic = {i for i in range(240) if i % 8 == 0}
    assert clean.columns == columns
    assert Counter(kept) == Counter(d for d in docs if d[0] is None or d[0] not in toxic)

    distinct = run("near_duplicates", clean)
    left = [tuple(r) for r in distinct.collect()]
    prints = {plain_fingerprint(t) for _, t, *_ in kept}
    group = groups(sorted(prints))
    assert not Counter(left) - Counter(kept)
    assert Counter(group[plain_fingerprint(t)] for _, t, *_ in left) == Counter(set(group.values()))
    first = {}
    for i, t, *_ in kept:
        g = group[plain_fingerprint(t)]
        first[g] = min(first.get(g, 1e9), 1e9 if i is None else i)
    assert all(i is None or i == first[group[plain_fingerprint(t)]] for i, t, *_ in left)

    cut = run("decontamination", distinct)
    hits = {c[0] for c in contaminated(left, items) if c[5]}
    assert {3, 5} <= hits
    after = [tuple(r) for r in cut.collect()]
    assert sorted((r for r in after if r[0] not in hits), key=str) == sorted(
        (r for r in left if r[0] not in hits), key=str
    )
    assert not any(c[5] for c in contaminated(after, items))
    assert all(r[4] == len(r[1]) for r in after if r[0] in hits)

    mixed = run("mixing", cut)
    assert mixed.columns == columns
    times = Counter(tuple(r) for r in mixed.collect())
    assert times.keys() <= set(after) and max(times.values()) <= 3

    last = run("sharding", mixed)
    assert last.columns == [*columns, "shard", "slot"]
    assert Counter(tuple(r)[:5] for r in last.collect()) == times

    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(tuple(r)[:5] for r in whole) == times


def test_first_of_each_is_the_operator(spark):
    docs = spark.createDataFrame(rows(["a b c d e f"] * 3), DOCS)
    stage = corpus_pipeline.without_near_copies(spark, docs, "")
    assert stage.collect() == simhash.first_of_each(docs).collect()
    assert [r.doc_id for r in stage.collect()] == [0]


def test_empty_documents(spark, tmp_path):
    for name, schema in (
        ("documents", DOCS),
        ("benchmark", "item_id long, text string"),
        ("labels", "doc_id long, quality int, toxic int"),
    ):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
