import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from opsframe.llm import queries, toxicity
from opsframe.llm.toxicity import Risk
from tests.llm.cases import DOCS, awkward, rows, sentence

LABELS = "doc_id long, toxic int"
BAD = "wretched rotten vermin".split()


def documents(rng, n=400):
    docs, labels = [], []
    for i in range(n):
        words = sentence(rng, rng.randint(20, 80)).split()
        toxic = i % 8 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(BAD))
        docs.append(" ".join(words))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return rows(docs), labels


def remainder(i):
    return zlib.crc32(str(i).encode()) % 4


def test_held_out_documents_are_told_apart(spark):
    docs, labels = documents(random.Random(1))
    frame, known = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    out = {r.doc_id: r.toxicity for r in toxicity.scored(frame, known).collect()}
    held = [i for i, *_ in docs if remainder(i) == 2]
    assert {i for i in held if out[i] >= toxicity.CUT} == {i for i in held if i % 8 == 0}
    kept = toxicity.without_toxic(frame, known)
    assert kept.columns == frame.columns
    assert all(r.doc_id % 8 for r in kept.collect())


def with_hot_text(rng, hot):
    """The documents with one text more that makes up a third of the rows."""
    docs, labels = documents(rng)
    return docs + rows([hot] * (len(docs) // 2), first=len(docs)), labels


def test_copies_of_a_toxic_text_hide_none_of_its_words(spark):
    docs, labels = with_hot_text(random.Random(4), " ".join([sentence(random.Random(5), 30), *BAD]))
    model = toxicity.trained(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), "doc_id", "text"
    )
    # Of a word and its beginnings that have the same counts the longest is used.
    assert all({w, w[:6] + "*"} & model.weights.keys() for w in BAD)


@pytest.mark.parametrize("bad", [BAD, []])
def test_a_hot_text_changes_no_verdict_on_others(spark, bad):
    """Toxic or clean, of any hash: fits and the class prior see it once."""
    for seed in (5, 6):
        docs, labels = with_hot_text(random.Random(4), " ".join([sentence(random.Random(seed), 30), *bad]))
        frame, known = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
        out = {r.doc_id: r.toxicity for r in toxicity.scored(frame, known).collect()}
        hot = range(400, 600) if bad else ()
        assert {i for i in out if out[i] >= toxicity.CUT} == {*range(0, 400, 8), *hot}


def test_the_class_prior_counts_every_text(spark, monkeypatch):
    """A clean text of a third of the rows that fills the sample leaves the share of texts as it is."""
    monkeypatch.setattr(toxicity, "UNLABELLED", 60)
    seen = []
    monkeypatch.setattr(toxicity, "Risk", lambda p, u, prior, n: seen.append((len(u), u, prior)) or Risk(p, u, prior, n))
    docs, labels = documents(random.Random(4))
    keyed = toxicity._keyed(spark.createDataFrame(docs, DOCS), "text", toxicity.SEED)
    first = keyed.where("doc_id % 8 > 0").orderBy("__h").first().text
    docs += rows([first] * 200, first=400)
    toxicity.trained(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS), "doc_id", "text")
    n, unlabelled, prior = seen[0]
    assert n == 60 and any(unlabelled)
    assert 0.05 < prior < 0.3


def test_rare_toxic_words_are_tested_however_many_words_are_more_frequent(spark):
    """Ten toxic texts have a word of their own; each of 21,000 ordinary words is in twelve."""
    ordinary = " ".join(chr(0x4E00 + i // 200) + chr(0x4E00 + i % 200) for i in range(21_000))
    toxic = [f"{ordinary} {i}x" for i in range(12)] + [f"vilest {i}y" for i in range(10)]
    clean = [f"{ordinary} {i}z" for i in range(60)] + [f"{i}w" for i in range(300)]
    mine, every = (spark.createDataFrame([(t,) for t in x], "text string") for x in (toxic, toxic + clean))
    assert toxicity._chosen(mine, every, 22, 382) == ["vilest*"]


def test_features_against_plain_code():
    """Words, their beginnings, and beginnings of two different words."""
    found = toxicity.features_of("Abcd abcde ABCD x abcdefg".encode())
    assert found == {"abcd", "abcde", "x", "abcdefg", "abcd*", "abcd**", "abcde*", "abcde**", "abcdef*"}
    assert toxicity.features_of(None) == toxicity.features_of(b" ,") == set()


def test_known_features_are_those_of_all(spark):
    rng = random.Random(8)
    texts = [sentence(rng, rng.randint(0, 60)).encode() for _ in range(200)] + [None, b"", b"abcd abcde abcdefg"]
    every = sorted(set().union(*map(toxicity.features_of, texts)))
    for share in (0.01, 0.3, 1.0):
        some = {f for f in every if rng.random() < share}
        known = toxicity.Known(some)
        assert all(known.of(t) == toxicity.features_of(t) & some for t in texts)


@pytest.mark.parametrize("bits", [1 << 15, 1 << 26])
def test_every_text_counts_once_whatever_its_copies(spark, monkeypatch, bits):
    """Also null and empty texts, and with a filter so small that it suspects texts without copies."""
    monkeypatch.setattr(toxicity, "COPY_BITS", bits)
    rng = random.Random(6)
    some = [sentence(rng, rng.randint(0, 9)) for _ in range(200)] + ["", None, "one of a kind"]
    docs = spark.createDataFrame(rows(some + some[:90] + ["hot words"] * 150 + [None, ""]), DOCS)
    keyed = toxicity._keyed(docs, "text", 3)
    copied = toxicity._copied(keyed.groupBy("__h", "__g").agg(F.count("*").alias("times")))
    got = {r.feature: r.n for r in toxicity._counted(keyed, copied=copied).collect()}
    expected = Counter(f for t in {*some, "hot words"} for f in toxicity.features_of((t or "").encode()))
    assert got == expected


def test_only_texts_with_copies_shuffle(spark):
    """Of 2,000 texts without copies none is moved to be counted."""
    rng = random.Random(7)
    docs = spark.createDataFrame(rows([f"{i} " + sentence(rng, 5) for i in range(2_000)] + ["same"] * 9), DOCS)
    keyed = toxicity._keyed(docs, "text", 3)
    copied = toxicity._copied(keyed.groupBy("__h", "__g").agg(F.count("*").alias("times")))
    moved = keyed.where(toxicity._may_repeat(copied, F.col("__h")))
    assert {r.text for r in moved.collect()} == {"same"}


def test_clashing_columns(spark):
    docs, labels = documents(random.Random(3), 120)
    frame = spark.createDataFrame(docs, DOCS).withColumns(
        {"toxicity": F.lit("x"), "toxic": F.lit(0), "feature": F.lit("y"), "n": F.lit(1)}
    )
    out = toxicity.scored(frame, spark.createDataFrame(labels, LABELS).withColumn("text", F.lit("z")))
    assert sorted(out.columns) == sorted(frame.columns)
    assert all(0 <= r.toxicity <= 1 and r.feature == "y" for r in out.collect())


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs, labels = documents(random.Random(2), 200)
    frame = spark.createDataFrame(docs, DOCS)
    flipped = [(i, 1 - t if remainder(i) == 2 else t) for i, t in labels]
    a, b = (
        {r.doc_id: r.toxicity for r in toxicity.scored(frame, spark.createDataFrame(x, LABELS)).collect()}
        for x in (labels, flipped)
    )
    assert a == b


def test_awkward_rows_get_scores(spark):
    docs, labels = documents(random.Random(3), 200)
    frame = spark.createDataFrame([(i, *r) for (i, *r) in docs] + awkward(), DOCS)
    out = toxicity.scored(frame, spark.createDataFrame([*labels, (None, 1), (2, None)], LABELS)).collect()
    assert len(out) == len(docs) + len(awkward())
    assert all(0 <= r.toxicity <= 1 for r in out)
    assert len({r.toxicity for r in out if not (r.text or "").split()}) == 1


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame(rows(["one two", "three"]), DOCS)
    for labels in ([], [(0, 0), (1, 0)]):
        out = toxicity.scored(docs, spark.createDataFrame(labels, LABELS)).collect()
        assert all(r.toxicity < toxicity.CUT for r in out)
    assert toxicity.scored(docs.limit(0), spark.createDataFrame([(0, 1)], LABELS)).count() == 0


def test_gradient_is_that_of_the_risk():
    rng = np.random.default_rng(1)
    some = lambda n: [sorted(rng.choice(6, rng.integers(0, 4), replace=False).tolist()) for _ in range(n)]
    positive, unlabelled = some(15), some(60)
    risk = toxicity.Risk(positive, unlabelled, 0.2, 6)

    def value(theta):
        p, u = (risk._score(part, theta[:-1], theta[-1]) for part in risk.parts)
        rest = np.logaddexp(0, u).mean() - 0.2 * np.logaddexp(0, p).mean()
        # Where the estimate is negative, its opposite is what descends.
        return 0.2 * np.logaddexp(0, -p).mean() + rest if rest >= 0 else -rest

    for theta in (np.zeros(7), rng.normal(size=7), np.r_[np.zeros(6), -30.0], rng.normal(size=7) * 9):
        slope, bias = risk.gradient(theta[:-1], theta[-1])
        for k in range(7):
            step = np.zeros(7)
            step[k] = 1e-6
            near = (value(theta + step) - value(theta - step)) / 2e-6
            assert np.isclose(near, np.r_[slope, bias][k], atol=1e-4)


def test_query_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in queries.op8_toxicity(spark, folder).collect()}
    assert len(out) == queries.table(spark, folder, "documents").count()
    labels = {r.doc_id: r.toxic for r in queries.table(spark, folder, "labels").collect()}
    held = {i: r for i, r in out.items() if r.held_out and i in labels}
    assert all(r.held_out == (remainder(i) == 2) for i, r in out.items())
    toxic = [r.predicted for i, r in held.items() if labels[i] == 1]
    clean = [r.predicted for i, r in held.items() if labels[i] == 0]
    assert sum(toxic) >= 0.8 * len(toxic)
    assert sum(clean) <= 0.02 * len(clean)
