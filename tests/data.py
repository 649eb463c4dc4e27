"""Small made-up logistics tables, written as CSV by the tests.

Fixed values: table and column names, manifest fields, and the words that rules
read (flags, licence classes, statuses, hazard classes). All rows are invented.
"""

PLANETS = """planet_id,planet_name,planet_type,distance_from_sun_au,orbital_period_days,is_habitable,has_orbital_station,has_surface_hub
1,Aurel,rocky,0.50,120,false,true,false
2,Brone,rocky,1.10,400,true,true,true

3,Cinder,gas,5.00,4000,false,true,perhaps
4,Dorne,ice,20.5,,false,false,false
"""

# Columns in another order than the table's.
STATIONS = """station_name,station_id,station_type,planet_id,moon_id,asteroid_id,is_operational,orbital_altitude_km,capacity_tonnes,commissioned_date
Anchor,1,orbital,1,,,true,400,900,2101-02-03
Beacon,2,orbital,2,,,true,410,800,2102-02-03
Cradle,3,orbital,2,,,true,420,700,2103-02-03
Dock,4,surface,3,,,true,0,600,2104-02-03
Eyrie,5,surface,3,,,true,0,500,
Forge,6,orbital,3,,,false,300,400,not a date
Grove,7,orbital,,9,,true,200,300,2107-02-03
Haven,8,orbital,,,4,true,100,200,2108-02-03
"""

SPACECRAFT = """spacecraft_id,spacecraft_name,registration_number,spacecraft_type,manufacturer,capacity_tonnes,max_speed_kmps,fuel_type,home_station_id,current_status,commissioned_date
1,Able,R-1,heavy_transport,Oryx,700,30,fusion,1,available,2110-01-01
2,"Baker, the Second",R-2,freighter,Oryx,650.5,31,fusion,2,in_transit,2110-01-02
3,Charlie,R-3,courier,Pike,90,80,ion,3,available,2110-01-03
4,Delta,R-4,heavy_transport,Pike,800,29,fusion,1,in_transit,2110-01-04
5,Echo,R-5,cargo_shuttle,Quill,40,12,chemical,5,maintenance,2110-01-05
6,Foxtrot,R-6,freighter,Quill,700,33,fusion,2,available,2110-01-06
7,Golf,R-7,courier,Pike,,81,ion,3,available,2110-01-07
"""

PILOTS = """pilot_id,pilot_name,license_number,license_class,species,home_planet_id,hire_date,rating,total_missions,is_active
1,Ash,L-1,deep_space,human,1,2111-01-01,4.5,100,true
2,Birch,L-2,class_a,human,2,2111-01-02,4.1,90,true
3,Cedar,L-3,class_c,human,3,2111-01-03,3.9,10,false
4,Dale,L-4,deep_space,other,,2111-01-04,4.8,300,true
5,Elm,L-5,class_a,other,3,2111-01-05,4.0,50,true
"""

ROUTES = """route_id,route_name,origin_station_id,origin_hub_id,destination_station_id,destination_hub_id,distance_million_km,avg_transit_days,fuel_cost_credits,risk_level,is_active
1,A-B,1,,2,,50,10,500,low,true
2,A-B slow,1,,2,,50,14,300,low,true
3,A-C,1,,3,,60,12,600,low,true
4,C-B,3,,2,,5,3,60,low,true
5,A-D,1,,4,,300,100,9000,high,true
6,D-B,4,,2,,250,80,8000,high,true
7,A-F,1,,6,,900,200,20000,extreme,true
8,A-G,1,,7,,400,50,4000,medium,false
9,G-B,7,,2,,400,,4000,medium,true
"""

MOONS = "moon_id,moon_name,planet_id,orbital_radius_km,is_habitable,has_orbital_station,has_surface_hub\n"

CSV = {
    "planets": PLANETS,
    "space_stations": STATIONS,
    "spacecraft": SPACECRAFT,
    "pilots": PILOTS,
    "shipping_routes": ROUTES,
    "moons": MOONS,
}

LICENCES = {
    "deep_space": ["heavy_transport", "freighter"],
    "class_a": ["heavy_transport"],
    "class_c": ["courier"],
}

MANIFESTS = {
    "calm.json": """{
  "manifest_id": "M-1", "origin_station": "Anchor", "destination_station": "Beacon",
  "declared_items": [{"item": "blankets", "tonnes": 3, "hazard_class": "none"}],
  "pilot_certification": "current", "customs_flags": []
}
""",
    "vague.json": """{
  "manifest_id": "M-2", "origin_station": "Nowhere", "destination_station": "Beacon",
  "declared_items": [
    {"item": "rope", "tonnes": 1, "hazard_class": "none"},
    {"item": "boxes", "tonnes": 1.5, "hazard_class": "unknown"}
  ],
  "pilot_certification": "current", "customs_flags": []
}
""",
    "grave.json": """{
  "manifest_id": "M-3", "origin_station": "Drifting hulk", "destination_station": "Dock",
  "declared_items": [
    {"item": "spores", "tonnes": 0.25, "hazard_class": "biohazard-3"},
    {"item": "moss", "tonnes": 0.5, "hazard_class": "biohazard-1"},
    {"item": "rods", "tonnes": 9, "hazard_class": "radiological"}
  ],
  "pilot_certification": "expired", "customs_flags": ["expired_certification"]
}
""",
    "empty.json": """{
  "manifest_id": "M-4", "origin_station": "Anchor", "destination_station": "Dock",
  "declared_items": [], "pilot_certification": "current", "customs_flags": []
}
""",
    "broken.json": '{"manifest_id": "M-5", "declared_items": [',
}
