"""The questions asked of the logistics tables, as Spark jobs.

Where a question leaves its meaning open, the docstring says which is used.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opsframe.operators import drift, relational, routing
from opsframe.operators.guarded import guarded_sql
from opsframe.plans.schemas import SPACECRAFT_DRIFT, TABLES
from opsframe.sources.scratch import written
from opsframe.sources.tables import Source, refresh_tables


def refresh(spark: SparkSession, csv_dir: str, out_dir: str) -> DataFrame:
    """Reload all seven tables from ``<csv_dir>/<table>.csv``; (table, rows)."""
    base = csv_dir.rstrip("/")
    specs = {name: (f"{base}/{name}.csv", schema) for name, schema in TABLES.items()}
    return refresh_tables(spark, specs, out_dir)


def read_table(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{out_dir.rstrip('/')}/{name}")


def drifted_spacecraft(spacecraft: DataFrame) -> DataFrame:
    """The copy with renamed columns and capacity in kilograms."""
    return drift.project_drift(spacecraft, [drift.Change(*c) for c in SPACECRAFT_DRIFT])


def list_planets(planets: DataFrame) -> DataFrame:
    return relational.scan(planets)


def list_spacecraft(spacecraft: DataFrame, status: str | None = None) -> DataFrame:
    return relational.filter_optional(spacecraft, "current_status", status)


def stations_per_planet(stations: DataFrame) -> DataFrame:
    """(planet_id, n); stations around no planet are under ``unknown``."""
    return relational.count_by(stations, "planet_id")


def busiest_planets(stations: DataFrame) -> DataFrame:
    """The planets with most operational stations, all of them on a tie."""
    return relational.top_groups(stations, "planet_id", F.col("is_operational"))


def operational_stations_json(stations: DataFrame) -> DataFrame:
    """Operational stations per planet as one JSON map."""
    return relational.counts_as_json(stations.filter("is_operational"), "planet_id")


def available_by_capacity(spacecraft: DataFrame, k: int = 5) -> DataFrame:
    return relational.top_k(
        spacecraft, "capacity_tonnes", k, ["spacecraft_id"], F.col("current_status") == "available"
    )


def longest_operational_routes(routes: DataFrame, stations: DataFrame, k: int = 3) -> DataFrame:
    """Longest means distance; the destination station must be operational."""
    return relational.top_k_joined(
        routes,
        stations,
        ("destination_station_id", "station_id"),
        F.col("is_operational"),
        "distance_million_km",
        k,
        ["route_id"],
    )


def in_transit(spacecraft: DataFrame) -> DataFrame:
    return relational.count_where(spacecraft, F.col("current_status") == "in_transit")


def mean_active_hours(routes: DataFrame) -> DataFrame:
    """Mean duration of active routes in hours, from the column in days."""
    return relational.mean_converted(routes, "avg_transit_days", 24, 4, F.col("is_active"))


def certified_pilots(
    pilots: DataFrame,
    stations: DataFrame,
    manifests: DataFrame,
    licence_map: Mapping[str, Sequence[str]],
    craft_type: str = "heavy_transport",
) -> DataFrame:
    """Pilots who may fly the craft type, and whether a home station has a manifest.

    A pilot's home stations are those around the home planet. A manifest names
    stations by name, as origin or destination; names without a station are
    passed over.
    """
    named = manifests.select(
        F.explode(F.array("origin_station", "destination_station")).alias("station_name")
    )
    per_home = relational.evidence_per_home(
        stations, "station_name", "planet_id", named, "station_name"
    )
    return relational.qualified_with_evidence(
        pilots, "license_class", "home_planet_id", licence_map, craft_type, per_home
    )


def reroute_in_transit(
    spacecraft: DataFrame,
    routes: DataFrame,
    closed: DataFrame,
    k: int = 3,
    craft_type: str = "heavy_transport",
) -> DataFrame:
    """Two-leg alternatives by transit days, per ``spacecraft_id`` of the type in transit.

    No table says which route a craft is on: its trips are taken to be the
    active routes from its home station.
    """
    travelling = spacecraft.filter(
        (F.col("current_status") == "in_transit") & (F.col("spacecraft_type") == craft_type)
    ).select("spacecraft_id", F.col("home_station_id").alias("origin_station_id"))
    active = routes.filter("is_active")
    trips = active.join(travelling, "origin_station_id").select(
        "spacecraft_id",
        F.col("origin_station_id").alias("origin"),
        F.col("destination_station_id").alias("destination"),
    )
    edges = written(
        routing.corridor_costs(
            active, "origin_station_id", "destination_station_id", "avg_transit_days"
        ),
        "corridors",
    )
    return routing.reroute(trips, edges, closed, k, "spacecraft_id")


def worst_manifest(manifests: DataFrame) -> DataFrame:
    return routing.max_hazard(manifests)


def spacecraft_compatibility(primary: DataFrame, alternate: DataFrame) -> DataFrame:
    """What breaks a job copying spacecraft rows into the drifted table."""
    return drift.compatibility_report(primary, alternate, ("spacecraft_id", "id"))


def ask(spark: SparkSession, out_dir: str, tables: Sequence[str], sql: str, max_rows: int | None = None) -> DataFrame:
    """Read-only SQL over some of the tables; ``max_rows`` cuts the result if given."""
    base = out_dir.rstrip("/")
    allowed = [Source(n, f"{base}/{n}", "parquet", TABLES[n]) for n in tables]
    return guarded_sql(spark, allowed, sql, max_rows)
