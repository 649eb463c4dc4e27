import itertools
import random

import pytest
from pyspark.sql import functions as F

from opsframe.operators import routing
from opsframe.sources.manifests import MANIFEST


def manifest(spark, *rows):
    return spark.createDataFrame(
        [(k, "Anchor", "Beacon", items, certificate, flags) for k, items, certificate, flags in rows], MANIFEST
    )


def item(hazard):
    return ("thing", 1.0, hazard)


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_reroute_against_brute_force(spark, seed):
    chooser = random.Random(seed)
    nodes = range(12)
    cost = {
        (o, d): chooser.randint(1, 9)
        for o, d in itertools.product(nodes, nodes)
        # Node 0 is the hub that most corridors touch.
        if 0 in (o, d) or chooser.random() < 0.3
    }
    closed = {e for e in cost if chooser.random() < 0.15}
    expected = []
    for o, d in closed:
        ways = sorted(
            (cost[o, v] + cost[v, d], v)
            for v in nodes
            if v not in (o, d)
            and (o, v) in cost
            and (v, d) in cost
            and (o, v) not in closed
            and (v, d) not in closed
        )
        expected += [(o, d, v, c, i) for i, (c, v) in enumerate(ways[:3], 1)]
    edges = spark.createDataFrame([(*e, c) for e, c in cost.items()], "origin int, destination int, cost int")
    shut = spark.createDataFrame(sorted(closed), "origin int, destination int")
    got = routing.reroute(edges, edges, shut, 3).collect()
    assert sorted((r.origin, r.destination, r.via, r.cost, r.rank) for r in got) == sorted(expected)


def test_reroute_around_a_large_hub(spark):
    """Half of 4,000 corridors of one hub are closed; each end knows one other way."""
    n = 4000
    ids = spark.range(1, n + 1)
    hub = ids.select(F.lit(0).cast("long").alias("origin"), F.col("id").alias("destination"), F.lit(1).alias("cost"))
    side = ids.select(F.col("id").alias("origin"), (F.col("id") % n + 1).alias("destination"), F.lit(2).alias("cost"))
    edges = hub.unionAll(side)
    closed = hub.filter("destination % 2 = 0")
    got = routing.reroute(closed, edges, closed, 3)
    assert got.count() == n // 2 and got.filter("via = destination - 1 and cost = 3 and rank = 1").count() == n // 2


def test_reroute_without_affected_trips_is_empty(spark):
    edges = spark.createDataFrame([(1, 2, 5), (1, 3, 1), (3, 2, 1)], "origin int, destination int, cost int")
    none = edges.filter("false")
    assert routing.reroute(none, edges, edges.filter("cost = 5"), 3).count() == 0
    assert routing.reroute(edges, edges, none, 3).count() == 0


def test_corridor_costs_take_the_cheapest(spark):
    legs = spark.createDataFrame([(1, 2, 9.0), (1, 2, 4.0), (2, 1, 7.0)], "a int, b int, c double")
    assert sorted(routing.corridor_costs(legs, "a", "b", "c").collect()) == [(1, 2, 4.0), (2, 1, 7.0)]


def test_hazard_order(spark):
    words = ["none", "unknown", "radiological", "biohazard-0", "biohazard-1", "biohazard-12"]
    frame = spark.createDataFrame([(w,) for w in [*words, "biohazard-x", "odd", None]], "w string")
    ranks = [r[0] for r in frame.select(routing.hazard_rank(F.col("w"))).collect()]
    assert ranks[:6] == sorted(set(ranks[:6])) and ranks[6:] == [1, 1, 1]


def test_hazard_order_of_the_caller(spark):
    frame = manifest(spark, ("a", [item("radiological")], "current", []), ("b", [item("acid")], "current", []))
    ranks = {"unknown": 0, "radiological": 1, "acid": 2}
    assert routing.max_hazard(frame, ranks).first().manifest_id == "b"


def test_worst_manifest_and_empty_items(spark):
    frame = manifest(
        spark,
        ("a", [item("radiological"), item("biohazard-1")], "current", []),
        ("b", [], "current", []),
        ("c", None, "current", []),
        ("d", [item("biohazard-1"), item("none")], "current", []),
    )
    ranks = {r.manifest_id: (r.hazard_rank, r.worst_class) for r in routing.with_hazard(frame).collect()}
    assert ranks == {"a": (4, "biohazard-1"), "b": (-1, None), "c": (-1, None), "d": (4, "biohazard-1")}
    assert routing.max_hazard(frame).first().manifest_id == "a"


def test_lanes_and_their_precedence(spark):
    calm, vague, bad = item("none"), item("unknown"), item("radiological")
    cases = [
        ("fast_lane", [calm], "current", []),
        ("fast_lane", [calm], "current", None),
        ("customs_review", [], "current", []),
        ("customs_review", None, "current", []),
        ("customs_review", [calm, vague], "current", []),
        ("customs_review", [item(None)], "current", []),
        ("customs_review", [calm], None, []),
        ("customs_review", [calm], "current", ["incomplete_declaration"]),
        ("customs_review", [calm], "current", ["some other flag"]),
        ("quarantine", [calm, bad], "current", []),
        ("quarantine", [vague, bad], "current", ["incomplete_declaration"]),
        ("quarantine", [calm], "expired", []),
        ("quarantine", None, None, ["origin_not_registered"]),
        ("quarantine", [calm], "current", [None, "biohazard_present"]),
    ]
    frame = manifest(spark, *[(str(i), *c[1:]) for i, c in enumerate(cases)])
    lanes = {int(r.manifest_id): r.lane for r in routing.route_lane(frame).collect()}
    assert [lanes[i] for i in range(len(cases))] == [c[0] for c in cases]


def test_every_manifest_gets_the_lane_of_the_rules(spark):
    chooser = random.Random(23)
    hazards = ["none", "none", "unknown", "radiological", "biohazard-2", None]
    flag_words = ["incomplete_declaration", "expired_certification", "origin_not_registered", "late", None]
    rows = []
    for i in range(500):
        items = chooser.choice([None, *[[item(h) for h in chooser.choices(hazards, k=n)] for n in (0, 1, 1, 2, 3)]])
        flags = chooser.choice([None, [], [], chooser.choices(flag_words, k=2)])
        rows.append((str(i), items, chooser.choice(["current", "current", "expired", None]), flags))

    def lane(items, certificate, flags):
        classes = [i[2] for i in items or []]
        bad = any(c not in ("none", "unknown", None) for c in classes)
        if bad or certificate == "expired" or set(flags or []) & {"expired_certification", "origin_not_registered"}:
            return "quarantine"
        if not classes or {"unknown", None} & set(classes) or certificate is None or flags:
            return "customs_review"
        return "fast_lane"

    got = {r.manifest_id: r.lane for r in routing.route_lane(manifest(spark, *rows)).collect()}
    assert got == {k: lane(*rest) for k, *rest in rows}
    assert set(got.values()) == {"quarantine", "customs_review", "fast_lane"}
