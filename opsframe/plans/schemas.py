"""Table schemas of the logistics data set.

Fixed values: table names, column names and types.
"""

from __future__ import annotations

from opsframe.functions.shapes import BIGINT, BOOLEAN, DATE, DOUBLE, TEXT, shape

PLANETS = shape(
    planet_id=BIGINT,
    planet_name=TEXT,
    planet_type=TEXT,
    distance_from_sun_au=DOUBLE,
    orbital_period_days=DOUBLE,
    is_habitable=BOOLEAN,
    has_orbital_station=BOOLEAN,
    has_surface_hub=BOOLEAN,
)
MOONS = shape(
    moon_id=BIGINT,
    moon_name=TEXT,
    planet_id=BIGINT,
    orbital_radius_km=DOUBLE,
    is_habitable=BOOLEAN,
    has_orbital_station=BOOLEAN,
    has_surface_hub=BOOLEAN,
)
ASTEROIDS = shape(
    asteroid_id=BIGINT,
    asteroid_name=TEXT,
    asteroid_belt=TEXT,
    designation=TEXT,
    diameter_km=DOUBLE,
    is_mining_colony=BOOLEAN,
    has_station=BOOLEAN,
)
SPACECRAFT = shape(
    spacecraft_id=BIGINT,
    spacecraft_name=TEXT,
    registration_number=TEXT,
    spacecraft_type=TEXT,
    manufacturer=TEXT,
    capacity_tonnes=DOUBLE,
    max_speed_kmps=DOUBLE,
    fuel_type=TEXT,
    home_station_id=BIGINT,
    current_status=TEXT,
    commissioned_date=DATE,
)
SPACE_STATIONS = shape(
    station_id=BIGINT,
    station_name=TEXT,
    station_type=TEXT,
    planet_id=BIGINT,
    moon_id=BIGINT,
    asteroid_id=BIGINT,
    orbital_altitude_km=DOUBLE,
    capacity_tonnes=DOUBLE,
    is_operational=BOOLEAN,
    commissioned_date=DATE,
)
PILOTS = shape(
    pilot_id=BIGINT,
    pilot_name=TEXT,
    license_number=TEXT,
    license_class=TEXT,
    species=TEXT,
    home_planet_id=BIGINT,
    hire_date=DATE,
    rating=DOUBLE,
    total_missions=BIGINT,
    is_active=BOOLEAN,
)
SHIPPING_ROUTES = shape(
    route_id=BIGINT,
    route_name=TEXT,
    origin_station_id=BIGINT,
    origin_hub_id=BIGINT,
    destination_station_id=BIGINT,
    destination_hub_id=BIGINT,
    distance_million_km=DOUBLE,
    avg_transit_days=DOUBLE,
    fuel_cost_credits=DOUBLE,
    risk_level=TEXT,
    is_active=BOOLEAN,
)

TABLES = {
    "planets": PLANETS,
    "moons": MOONS,
    "asteroids": ASTEROIDS,
    "spacecraft": SPACECRAFT,
    "space_stations": SPACE_STATIONS,
    "pilots": PILOTS,
    "shipping_routes": SHIPPING_ROUTES,
}

# Fixed values: (column, column of the drifted copy, type, factor).
SPACECRAFT_DRIFT = (
    ("spacecraft_id", "id", "bigint", None),
    ("spacecraft_name", "name", "string", None),
    ("registration_number", "reg_no", "string", None),
    ("spacecraft_type", "craft_type", "string", None),
    ("manufacturer", "maker", "string", None),
    ("capacity_tonnes", "capacity_kg", "double", 1000.0),
    ("max_speed_kmps", "top_speed_kps", "double", None),
    ("fuel_type", "propulsion", "string", None),
    ("home_station_id", "base_station", "bigint", None),
    ("current_status", "status", "string", None),
    ("commissioned_date", "in_service_since", "date", None),
)
