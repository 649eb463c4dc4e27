import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from opsframe.operators import relational


@pytest.fixture(scope="module")
def keyed(spark):
    rows = [("a", 1), ("b", 2), ("a", 3), (None, 4), ("", 5), ("b", 6), ("c", 7)]
    return spark.createDataFrame(rows, "k string, v int")


def test_filter_optional(keyed):
    assert relational.filter_optional(keyed, "k", "a").count() == 2
    for absent in (None, ""):
        assert relational.filter_optional(keyed, "k", absent).count() == 7


def test_count_by_buckets_null_and_blank_together(keyed):
    assert dict(relational.count_by(keyed, "k").collect()) == {"a": 2, "b": 2, "c": 1, "unknown": 2}


def test_count_by_sums_to_the_rows_with_a_hot_key(spark):
    chooser = random.Random(5)
    keys = [chooser.choice(["hot", "hot", str(i % 97), None]) for i in range(3000)]
    frame = spark.createDataFrame([(k,) for k in keys], "k string")
    counts = dict(relational.count_by(frame, "k").collect())
    assert counts == Counter(k or "unknown" for k in keys) and sum(counts.values()) == 3000


def test_top_groups_keeps_ties_and_leaves_out_unknown(keyed):
    assert sorted(relational.top_groups(keyed, "k").collect()) == [("a", 2), ("b", 2)]
    assert relational.top_groups(keyed, "k", F.col("v") > 5).count() == 2
    assert relational.top_groups(keyed, "k", F.col("v") > 99).count() == 0


def test_counts_as_json_is_sorted_and_split_by_bucket(spark, keyed):
    assert relational.counts_as_json(keyed, "k").first().counts_json == '{"a":2,"b":2,"c":1,"unknown":2}'
    assert relational.counts_as_json(keyed.limit(0), "k").count() == 0
    many = spark.range(12_000).selectExpr("cast(id % 11000 AS string) AS k")
    maps = [json.loads(r.counts_json) for r in relational.counts_as_json(many, "k", buckets=8).collect()]
    assert len(maps) == 8 and sum(map(len, maps)) == 11_000
    assert sum(sum(m.values()) for m in maps) == 12_000


def test_top_k_settles_ties(keyed):
    same = keyed.withColumn("w", F.lit(1))
    assert [r.v for r in relational.top_k(same, "w", 3, ["v"]).collect()] == [1, 2, 3]


def test_top_k_joined_does_not_repeat_facts(spark):
    facts = spark.createDataFrame([(1, 10, 5.0), (2, 10, 4.0), (3, 20, 9.0)], "id int, d int, x double")
    dim = spark.createDataFrame([(10, True), (10, True), (20, False)], "d int, ok boolean")
    got = relational.top_k_joined(facts, dim, ("d", "d"), F.col("ok"), "x", 3, ["id"])
    assert [r.id for r in got.collect()] == [1, 2]


def test_mean_converted(keyed):
    assert relational.mean_converted(keyed, "v", 24, 2, F.col("k") == "a").first()[0] == 48.0
    assert relational.mean_converted(keyed, "v", 24, 2, F.col("k") == "zz").first()[0] is None


def test_evidence_flags(spark):
    people = spark.createDataFrame(
        [(1, "pro", 1), (2, "pro", 2), (3, "amateur", 1), (4, "pro", None)], "id int, licence string, home int"
    )
    places = spark.createDataFrame([(100, 1), (101, 1), (200, 2)], "place int, home int")
    evidence = spark.createDataFrame([(101,), (101,), (999,)], "place int")
    per_home = relational.evidence_per_home(places, "place", "home", evidence, "place")
    got = relational.qualified_with_evidence(
        people, "licence", "home", {"pro": ["heavy"], "amateur": ["light"]}, "heavy", per_home
    )
    assert sorted((r.id, r.n_places, r.n_evidenced, r.has_evidence) for r in got.collect()) == [
        (1, 2, 1, True),
        (2, 1, 0, False),
        (4, 0, 0, False),
    ]
    seen = relational.keep_evidenced(places, evidence, ("place", "place"))
    unseen = relational.keep_evidenced(places, evidence, ("place", "place"), present=False)
    assert [r.place for r in seen.collect()] == [101]
    assert sorted(r.place for r in unseen.collect()) == [100, 200]
    assert seen.columns == unseen.columns == places.columns


def test_numbered_and_joined(spark):
    frame = spark.createDataFrame([(1, ["x", "y"]), (2, []), (3, None)], "id int, steps array<string>")
    assert relational.numbered(frame, "steps").collect() == [(1, 1, "x"), (1, 2, "y")]
    shown = frame.select(relational.joined_list("steps")).collect()
    assert [r[0] for r in shown] == ["x, y", "", None]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_stored_join_equals_the_plain_one(spark, how):
    chooser = random.Random(8)
    rows = [(chooser.choice(["hot", "hot", "a", "b", None]), 1) for _ in range(500)]
    left = spark.createDataFrame(rows, "k string, v int").repartition(7)
    right = spark.createDataFrame([("hot", 1.0), ("a", 2.0), ("z", 3.0), (None, 4.0)], "k string, w double")
    stored = relational.join_stored(left, right, "k", how)
    plain = left.join(right, "k", how)
    assert stored.columns == plain.columns
    assert Counter(stored.collect()) == Counter(plain.collect())
