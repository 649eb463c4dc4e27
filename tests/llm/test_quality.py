import random
import re
from collections import Counter

import numpy as np

from opsframe.llm import quality, queries
from tests.llm.cases import DOCS, awkward, rows, sentence


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = list(zip(words, words[1:], words[2:], strict=False))
    counts, covered = Counter(grams), set()
    for i, g in enumerate(grams):
        if counts[g] > 1:
            covered.update((i, i + 1, i + 2))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    n = len(words)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return (n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed)


def texts(rng):
    out = [sentence(rng, rng.randint(1, 200)) for _ in range(30)]
    out += ["\n".join([sentence(rng, 9)] * 5 + [sentence(rng, 30)]) for _ in range(5)]
    out += ["#a $b %c &d |e <f> *g h \x85 " * 20, "a b " * 40, "a b c", "a b c a b c", "\n\n x \n x \n"]
    return out


def test_statistics_against_brute_force(spark):
    docs = rows(texts(random.Random(1)), first=50) + awkward()
    out = quality.judged(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], "doc_id long, quality int"))
    got = [
        (r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed), r.kept)
        for r in out.collect()
    ]
    expected = [(i, s := plain(t), not s[-1]) for i, t, *_ in docs]
    assert sorted(got, key=str) == sorted(expected, key=str)


def test_forest_isolates_outliers():
    rng = np.random.default_rng(1)
    usual = rng.normal(size=(2_000, 4))
    odd = rng.normal(size=(20, 4)) + 9
    forest = quality.IsolationForest(np.vstack([usual, odd]))
    assert forest.scores(odd).min() > np.quantile(forest.scores(usual), 0.99)


def test_forest_takes_equal_and_few_rows():
    same = quality.IsolationForest(np.ones((5, 3)))
    assert np.isfinite(same.scores(np.ones((2, 3)))).all()
    assert np.isfinite(quality.IsolationForest(np.ones((1, 3))).scores(np.zeros((1, 3)))).all()


def test_path_lengths_are_those_of_the_trees():
    """Scores against a walk through each tree, one row after the other."""
    rng = np.random.default_rng(2)
    rows_ = rng.normal(size=(300, 3))
    forest = quality.IsolationForest(rows_, trees=7, size=64)
    for row in rows_[:20]:
        total = 0.0
        for column, cut, path in zip(forest.column, forest.cut, forest.path, strict=True):
            node = 0
            while path[node] < 0:
                node = 2 * node + (1 if row[column[node]] < cut[node] else 2)
            total += path[node]
        usual = float(quality._average_path(np.array(64)))
        assert np.isclose(forest.scores(row[None])[0], 2 ** (-total / 7 / usual))


def test_threshold_drops_odd_documents_and_keeps_good_ones(spark):
    rng = random.Random(3)
    good = [sentence(rng, rng.randint(80, 200)) for _ in range(300)]
    odd = [" ".join(f"{w}%%%9|" for w in sentence(rng, 90).upper().split()) for _ in range(20)]
    docs = rows(good + odd)
    labels = [(i, 1 if i < 300 else 0) for i in range(0, 320, 2)] + [(0, 0), (None, 1), (3, None)]
    out = quality.judged(
        spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int")
    ).collect()
    kept = {r.doc_id for r in out if r.kept}
    assert len(kept & set(range(300))) >= 297
    assert kept <= set(range(300))


def test_documents_of_equal_statistics_are_drawn_each_by_itself(spark, monkeypatch):
    """A text of a third of the rows is about a third of the rows that forests grow on."""
    rng = random.Random(3)
    monkeypatch.setattr(quality, "SAMPLE_ROWS", 60)
    seen = []
    monkeypatch.setattr(quality, "forests_of", lambda some, seed: seen.append(some) or [])
    docs = rows([sentence(rng, rng.randint(80, 200)) for _ in range(200)] + [sentence(rng, 300)] * 100)
    quality.judged(spark.createDataFrame(docs, DOCS), spark.createDataFrame([], "doc_id long, quality int"))
    hot = max((seen[0] == row).all(axis=1).sum() for row in seen[0])
    assert len(seen[0]) == 60 and 8 <= hot <= 32


def test_empty_table(spark):
    none = quality.judged(spark.createDataFrame([], DOCS), spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    assert none.count() == 0


def test_query_keeps_labelled_good_documents(spark):
    folder = "/root/testdata/sf0.01"
    out = {r.doc_id: r for r in queries.op5_quality(spark, folder).collect()}
    docs = queries.table(spark, folder, "documents").collect()
    assert len(out) == len(docs)
    assert all(tuple(out[d.doc_id])[1:7] == plain(d.text) for d in docs)
    labels = queries.table(spark, folder, "labels").collect()
    passing = [out[r.doc_id].kept for r in labels if r.quality == 1 and not out[r.doc_id].base_failed]
    assert sum(passing) >= 0.99 * len(passing)
    bad = [out[r.doc_id].kept for r in labels if r.quality == 0 and not out[r.doc_id].base_failed]
    assert sum(bad) <= 0.1 * len(bad)
