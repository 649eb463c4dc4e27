"""The named questions, end to end from CSV and JSON files."""

import json

import pytest
from pyspark.sql import functions as F

from opsframe.operators import drift
from opsframe.plans import logistics
from opsframe.plans.schemas import SPACECRAFT_DRIFT, TABLES
from opsframe.sources.manifests import load_manifests
from tests import data


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("logistics")
    for name, text in data.CSV.items():
        (root / f"{name}.csv").write_text(text)
    (root / "manifests").mkdir()
    for name, text in data.MANIFESTS.items():
        (root / "manifests" / name).write_text(text)
    out = str(root / "tables")
    counts = dict(logistics.refresh(spark, str(root), out).collect())
    return {"out": out, "counts": counts, "manifests": load_manifests(spark, str(root / "manifests"))}


@pytest.fixture(scope="module")
def read(spark, store):
    return lambda name: logistics.read_table(spark, store["out"], name)


def ids(frame, name):
    return [r[name] for r in frame.collect()]


def test_refresh(store):
    assert store["counts"] == {
        "planets": 4,
        "moons": 0,
        "asteroids": 0,
        "spacecraft": 7,
        "space_stations": 8,
        "pilots": 5,
        "shipping_routes": 9,
    }
    assert set(store["counts"]) == set(TABLES)


def test_lists(read):
    assert sorted(ids(logistics.list_planets(read("planets")), "planet_id")) == [1, 2, 3, 4]
    craft = read("spacecraft")
    assert sorted(ids(logistics.list_spacecraft(craft, "in_transit"), "spacecraft_id")) == [2, 4]
    assert logistics.list_spacecraft(craft).count() == logistics.list_spacecraft(craft, "").count() == 7


def test_stations_per_planet(read):
    stations = read("space_stations")
    assert dict(logistics.stations_per_planet(stations).collect()) == {"1": 1, "2": 2, "3": 3, "unknown": 2}
    assert sorted(logistics.busiest_planets(stations).collect()) == [(2, 2), (3, 2)]
    text = logistics.operational_stations_json(stations).first().counts_json
    assert text == '{"1":1,"2":2,"3":2,"unknown":2}' and json.loads(text)["unknown"] == 2


def test_top_lists(read):
    assert ids(logistics.available_by_capacity(read("spacecraft")), "spacecraft_id") == [1, 6, 3, 7]
    longest = logistics.longest_operational_routes(read("shipping_routes"), read("space_stations"))
    # Route 7 is the longest but ends at a station that is not operational.
    assert ids(longest, "route_id") == [8, 9, 5]


def test_counts_and_means(read):
    assert logistics.in_transit(read("spacecraft")).first().n == 2
    mean = (10 + 14 + 12 + 3 + 100 + 80 + 200) / 7 * 24
    assert logistics.mean_active_hours(read("shipping_routes")).first().mean_value == round(mean, 4)


def test_certified_pilots(read, store):
    got = logistics.certified_pilots(
        read("pilots"), read("space_stations"), store["manifests"], data.LICENCES
    )
    assert sorted((r.pilot_id, r.n_places, r.n_evidenced, r.has_evidence) for r in got.collect()) == [
        (1, 1, 1, True),
        (2, 2, 1, True),
        (4, 0, 0, False),
        (5, 3, 1, True),
    ]


def test_reroute(spark, read):
    closed = spark.createDataFrame([(1, 2)], "origin long, destination long")
    got = logistics.reroute_in_transit(read("spacecraft"), read("shipping_routes"), closed)
    # Delta is the one heavy transport in transit, at station 1; route 8 is not active.
    assert [(r.origin, r.destination, r.via, r.cost) for r in got.orderBy("rank").collect()] == [
        (1, 2, 3, 15.0),
        (1, 2, 4, 180.0),
    ]
    assert {r.spacecraft_id for r in got.collect()} == {4}
    twin = read("spacecraft").unionAll(
        read("spacecraft").filter("spacecraft_id = 4").withColumn("spacecraft_id", F.lit(44).cast("long"))
    )
    both = logistics.reroute_in_transit(twin, read("shipping_routes"), closed)
    assert sorted((r.spacecraft_id, r.via) for r in both.collect()) == [(4, 3), (4, 4), (44, 3), (44, 4)]
    couriers = logistics.reroute_in_transit(read("spacecraft"), read("shipping_routes"), closed, craft_type="courier")
    assert couriers.count() == 0


def test_worst_manifest(store):
    readable = store["manifests"].filter("_corrupt_record is null")
    assert ids(logistics.worst_manifest(readable), "manifest_id") == ["M-3"]


def test_drifted_copy_is_recognised(read):
    craft = read("spacecraft")
    copy = logistics.drifted_spacecraft(craft)
    assert copy.columns == [c[1] for c in SPACECRAFT_DRIFT]
    assert [f.dataType for f in copy.schema] == [f.dataType for f in TABLES["spacecraft"]]
    report = drift.compatibility_findings(craft, copy, ("spacecraft_id", "id"))
    found = {(r.col_a, r.col_b): r.kind for r in report.collect()}
    assert found == {
        (old, new): "unit_changed" if old == "capacity_tonnes" else "renamed" for old, new, _, _ in SPACECRAFT_DRIFT
    }
    summary = logistics.spacecraft_compatibility(craft, copy).first()
    assert not summary.compatible and len(summary.mismatches) == 11


def test_ask(spark, store):
    sql = "SELECT count(*) AS n FROM spacecraft WHERE current_status = 'in_transit'"
    assert logistics.ask(spark, store["out"], ["spacecraft"], sql).first().n == 2
    with pytest.raises(Exception, match="pilots"):
        logistics.ask(spark, store["out"], ["spacecraft"], "SELECT * FROM pilots").collect()


def test_two_answers_agree(read):
    stations = read("space_stations").filter(F.col("is_operational"))
    answer = logistics.operational_stations_json(stations)
    padded = F.concat(F.lit("\n"), "counts_json", F.lit(" \n")).alias("counts_json")
    other = answer.select("bucket", padded)
    assert drift.diff_rows(answer, other).count() == 0
    assert drift.diff_rows(answer, other.select("bucket", F.lit("{}").alias("counts_json"))).count() == 2
