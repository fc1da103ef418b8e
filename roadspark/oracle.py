"""The queries of :mod:`roadspark.queries` as SQL for DuckDB, written apart from the operators."""

from __future__ import annotations

from . import fixtures as fx

_PLAIN = {t: t for t in "part orders customer nation region lineitem".split()}


# The vocabularies, written out once more so that a wrong one shows.
DRIVABLE = """'motorway', 'motorway_link', 'trunk', 'trunk_link', 'primary', 'primary_link', 'secondary', 'secondary_link',
 'tertiary', 'tertiary_link', 'residential', 'unclassified', 'living_street', 'service', 'track', 'road'"""
CALMING = """'bump', 'mini_bumps', 'hump', 'table', 'cushion', 'dynamic_bump', 'dip', 'double_dip', 'chicane', 'choker', 'island'"""
CALMING_CLASS = """CASE
 WHEN v IN ('bump', 'mini_bumps', 'hump', 'table', 'cushion', 'dynamic_bump') THEN 'speed_bump'
 WHEN v IN ('dip', 'double_dip') THEN 'dip'
 WHEN v IN ('choker') THEN 'narrowing'
 ELSE v END"""
SURFACE = """CASE
 WHEN surface IN ('asphalt') THEN 'asphalt'
 WHEN surface IN ('concrete', 'concrete:plates', 'concrete:lanes') THEN 'concrete'
 WHEN surface IN ('paved') THEN 'paved'
 WHEN surface IN ('cobblestone', 'cobblestone:flattened', 'paving_stones', 'sett') THEN 'cobblestone'
 WHEN surface IN ('gravel', 'fine_gravel', 'pebblestone') THEN 'gravel'
 WHEN surface IN ('compacted') THEN 'compacted'
 WHEN surface IN ('dirt', 'earth', 'mud', 'sand') THEN 'dirt'
 WHEN surface IN ('grass', 'grass_paver') THEN 'grass'
 WHEN surface IN ('unpaved', 'ground') THEN 'unpaved'
 ELSE 'unknown' END"""
CTE = f"""
WITH nodes AS ({fx.NODES.format(**_PLAIN)}),
ways AS ({fx.WAYS.format(**_PLAIN)}),
open_way_nodes AS ({fx.OPEN_WAY_NODES.format(**_PLAIN)}),
way_nodes AS ({fx.WAY_NODES.format(open_way_nodes="open_way_nodes", ways="ways")}),
region_catalogue AS ({fx.REGION_CATALOGUE.format(**_PLAIN)}),
artifacts AS ({fx.ARTIFACTS.format(**_PLAIN)}),
verts AS (SELECT w.way_id, w.node_id, w.seq, n.lat, n.lon FROM way_nodes w JOIN nodes n ON n.node_id = w.node_id),
shape AS (SELECT way_id, count(*) AS n_points, min(lat) AS min_lat, max(lat) AS max_lat, min(lon) AS min_lon, max(lon) AS max_lon,
  avg(lat) AS mean_lat, avg(lon) AS mean_lon, arg_min(node_id, seq) = arg_max(node_id, seq) AS ring,
  arg_min(lat, seq) AS lat0, arg_min(lon, seq) AS lon0, arg_max(lat, seq) AS lat1, arg_max(lon, seq) AS lon1
  FROM verts GROUP BY way_id HAVING count(*) >= 2),
features AS (SELECT w.*, s.* EXCLUDE (way_id), CASE WHEN w.area = 'yes' AND s.n_points >= 4 AND s.ring THEN 'Polygon' ELSE 'LineString' END AS geom
  FROM ways w JOIN shape s ON s.way_id = w.way_id),
roads AS (SELECT *, NOT (highway = 'service' AND coalesce(service, '') IN ('driveway', 'parking_aisle')) AS open_road
  FROM features WHERE geom = 'LineString' AND highway IN ({DRIVABLE}))
"""
ROUNDED = ", ".join(f"round({c} + 1e-9, 6) AS {c}" for c in ("min_lat", "max_lat", "min_lon", "max_lon"))
WAY_SURFACE = f"CASE WHEN surface <> '' AND {SURFACE} <> 'unknown' THEN {SURFACE} END AS surface"


def _tags(*pairs: tuple[str, str]) -> str:
    items = ", ".join(f"""CASE WHEN {c} <> '' THEN '"{k}":' || to_json({c}) END""" for k, c in pairs)
    return f"CASE WHEN len(list_filter([{items}], lambda v: v IS NOT NULL)) > 0 THEN '{{' || array_to_string(list_filter([{items}], lambda v: v IS NOT NULL), ',') || '}}' END AS tags"


NODE_TAGS = _tags(("name", "name"), ("maxspeed", "maxspeed"), ("highway", "highway"))
WAY_TAGS = _tags(("surface", "surface"), ("highway", "highway"), ("ref", "ref"))
AT = "round(lat + 1e-9, 6) AS lat, round(lon + 1e-9, 6) AS lon"
CALMING_ROWS = f"""SELECT region, {AT}, {CALMING_CLASS} AS type, {NODE_TAGS}
FROM (SELECT *, trim(unnest(string_split(traffic_calming, ';'))) AS v FROM nodes WHERE traffic_calming <> '') WHERE v IN ({CALMING})"""
CAMERA_ROWS = f"SELECT region, {AT}, 'speed_camera' AS type, {NODE_TAGS} FROM nodes WHERE highway = 'speed_camera' OR enforcement = 'maxspeed'"
BRIDGE_ROWS = f"""SELECT region, round(lat0 + 1e-9, 6) AS lat, round(lon0 + 1e-9, 6) AS lon, CASE WHEN bridge = 'yes' THEN 'bridge' ELSE 'tunnel' END AS type,
round(lat1 + 1e-9, 6) AS end_lat, round(lon1 + 1e-9, 6) AS end_lon, CASE WHEN way_id % 4 <> 0 THEN way_id END AS way_id, {WAY_TAGS}
FROM features WHERE geom = 'LineString' AND (bridge = 'yes' OR tunnel = 'yes')"""
MINI_ROWS = f"SELECT region, {AT}, CAST(3 AS DOUBLE) AS radius, 'mini_roundabout' AS type FROM nodes WHERE highway = 'mini_roundabout'"


def _metres(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = f"(pow(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2), 2))"
    return f"12742000.0 * atan2(sqrt({a}), sqrt(1 - {a}))"


ROUND_ROWS = f"""SELECT f.region, round(f.mean_lat + 1e-9, 6) AS lat, round(f.mean_lon + 1e-9, 6) AS lon,
round(round(max({_metres("f.mean_lat", "f.mean_lon", "v.lat", "v.lon")})) + 1e-9, 6) AS radius, 'roundabout' AS type
FROM features f JOIN verts v ON v.way_id = f.way_id WHERE f.junction = 'roundabout' GROUP BY f.way_id, f.region, f.mean_lat, f.mean_lon"""
CALMING_ALL = f"""SELECT region, lat, lon, type, CAST(NULL AS DOUBLE) AS end_lat, CAST(NULL AS DOUBLE) AS end_lon, CAST(NULL AS BIGINT) AS way_id, tags FROM ({CALMING_ROWS} UNION ALL {CAMERA_ROWS})
UNION ALL SELECT region, lat, lon, type, end_lat, end_lon, way_id, tags FROM ({BRIDGE_ROWS})"""
CORE_N = "traffic_calming IS NOT NULL OR highway IN ('speed_camera', 'mini_roundabout') OR enforcement = 'maxspeed'"
CORE_W = "bridge = 'yes' OR tunnel = 'yes' OR junction = 'roundabout'"
ROAD_WAYS = f"SELECT region, way_id, highway, {WAY_SURFACE}, {ROUNDED}, n_points FROM roads WHERE open_road"
SURFACES = f"SELECT region, way_id, {SURFACE} AS surface, {ROUNDED}, n_points FROM roads WHERE surface <> ''"
COUNTS = f"""SELECT r.region, t.table_name, count(c.region) AS n FROM (SELECT DISTINCT region FROM ways) r
CROSS JOIN (SELECT unnest(['traffic_calming', 'roundabouts', 'road_ways', 'road_surfaces']) AS table_name) t
LEFT JOIN (SELECT region, 'traffic_calming' AS table_name FROM ({CALMING_ALL}) UNION ALL SELECT region, 'roundabouts' FROM ({MINI_ROWS} UNION ALL {ROUND_ROWS})
 UNION ALL SELECT region, 'road_ways' FROM roads WHERE open_road UNION ALL SELECT region, 'road_surfaces' FROM roads WHERE surface <> '' AND open_road) c
ON c.region = r.region AND c.table_name = t.table_name GROUP BY r.region, t.table_name"""
ALL_REGIONS = "SELECT unnest(['AFRICA', 'AMERICA', 'ASIA', 'EUROPE', 'MIDDLE EAST', 'ATLANTIS']) AS region"
PUBLISHED = f"""SELECT 'road_ways' AS table_name, region FROM roads WHERE open_road UNION ALL SELECT 'road_surfaces', region FROM roads WHERE surface <> '' AND open_road
UNION ALL SELECT 'traffic_calming', region FROM ({CALMING_ROWS} UNION ALL {CAMERA_ROWS}) UNION ALL SELECT 'roundabouts', region FROM ({MINI_ROWS})
UNION ALL SELECT 'metadata', region FROM ({ALL_REGIONS}), range(5)"""
_HAS = "CASE WHEN max(CASE WHEN table_name = '{}' THEN n END) > 0 THEN 'true' ELSE 'false' END"
MANIFEST = """SELECT c.region, coalesce(nullif(r.name, ''), c.region) AS name, c.size, c.checksum,
s.size AS surface_size, s.checksum AS surface_checksum, w.size AS way_size, w.checksum AS way_checksum, d.size AS sqlite_size, d.checksum AS sqlite_checksum
FROM (SELECT split_part(file, '.json.gz', 1) AS region, size, left(sha256(content), 16) AS checksum FROM artifacts
 WHERE file LIKE '%.json.gz' AND file NOT LIKE '%-surfaces%' AND file NOT LIKE '%-ways%') c
LEFT JOIN (SELECT file, size, left(sha256(content), 16) AS checksum FROM artifacts) s ON s.file = c.region || '-surfaces.json.gz'
LEFT JOIN (SELECT file, size, left(sha256(content), 16) AS checksum FROM artifacts) w ON w.file = c.region || '-ways.json.gz'
LEFT JOIN (SELECT file, size, left(sha256(content), 16) AS checksum FROM artifacts) d ON d.file = c.region || '.sqlite.gz'
LEFT JOIN region_catalogue r ON r.id = c.region"""

_BODY = {
    "road_ways": ROAD_WAYS,
    "road_ways_vertices": "SELECT r.region, r.way_id, row_number() OVER (PARTITION BY r.way_id ORDER BY v.seq) AS seq, round(v.lon + 1e-9, 6) AS lon, round(v.lat + 1e-9, 6) AS lat FROM roads r JOIN verts v ON v.way_id = r.way_id WHERE r.open_road",
    "road_ways_plain": f"SELECT region, way_id, highway, {ROUNDED}, n_points FROM roads",
    "road_surfaces": f"{SURFACES} AND open_road",
    "road_surfaces_plain": SURFACES,
    "surface_normalization": f"SELECT surface AS raw, {SURFACE} AS surface, count(*) AS n FROM ways WHERE surface <> '' GROUP BY ALL",
    "calming_points": CALMING_ROWS,
    "speed_cameras": CAMERA_ROWS,
    "bridges_tunnels": BRIDGE_ROWS,
    "way_id_parse": "SELECT id, CASE WHEN id NOT LIKE 'way/%' THEN way_id END AS way_id FROM ways UNION ALL SELECT 'n' || node_id, NULL FROM nodes",
    "traffic_calming": CALMING_ALL,
    "mini_roundabouts": MINI_ROWS,
    "roundabouts": ROUND_ROWS,
    "roundabouts_all": f"{MINI_ROWS} UNION ALL {ROUND_ROWS}",
    "way_length": f"""SELECT region, way_id, round(sum(coalesce({_metres("lat", "lon", "next_lat", "next_lon")}, 0)), 3) AS length_m
FROM (SELECT r.region, v.*, lead(v.lat) OVER w AS next_lat, lead(v.lon) OVER w AS next_lon FROM roads r JOIN verts v ON v.way_id = r.way_id WINDOW w AS (PARTITION BY v.way_id ORDER BY v.seq)) GROUP BY region, way_id""",
    "core_tag_filter": f"SELECT 'n' AS kind, node_id AS element_id FROM nodes WHERE {CORE_N} UNION ALL SELECT 'w', way_id FROM ways WHERE {CORE_W}",
    "referenced_nodes": f"SELECT region, node_id FROM nodes WHERE node_id IN (SELECT node_id FROM way_nodes WHERE way_id IN (SELECT way_id FROM ways WHERE {CORE_W}))",
    "region_counts": f"SELECT region, table_name, n, CASE WHEN n > 0 THEN 'true' ELSE 'false' END AS has_data FROM ({COUNTS})",
    "metadata_long": f"""SELECT region, unnest(['version', 'region', 'createdAt', 'hasSurfaceData', 'hasWayData']) AS key,
unnest(['2026-01-01', region, '2026-01-01T00:00:00.000Z', {_HAS.format("road_surfaces")}, {_HAS.format("road_ways")}]) AS value FROM ({COUNTS}) GROUP BY region""",
    "bbox_query": f"SELECT * FROM ({ROAD_WAYS}) WHERE max_lat >= 50.02 AND min_lat <= 50.03 AND max_lon >= -0.9 AND min_lon <= -0.89",
    "dedup_segments": f"SELECT * EXCLUDE (tags) FROM ({BRIDGE_ROWS}) UNION ALL SELECT * EXCLUDE (tags) FROM ({BRIDGE_ROWS}) WHERE way_id IS NULL",
    "slim_regions": "SELECT id, name, b0, b1, b2, b3, estimated_size FROM region_catalogue",
    "checksum16": "SELECT doc_id, left(sha256(text), 16) AS checksum FROM documents",
    "manifest_regions": MANIFEST,
    "manifest_totals": f"SELECT count(*) AS n_regions, CAST(sum(size + coalesce(surface_size, 0) + coalesce(way_size, 0)) AS BIGINT) AS total_bytes FROM ({MANIFEST})",
    "geojsonseq_scan": "SELECT count(*) FILTER (way_id % 10 NOT IN (3, 7)) AS features, count(*) FILTER (way_id % 10 = 7) AS blank, count(*) FILTER (way_id % 10 = 3) AS rejected FROM roads",
    "geojsonseq_ways": f"SELECT 'all' AS region, highway, {WAY_SURFACE}, {ROUNDED}, n_points FROM roads WHERE open_road AND way_id % 10 NOT IN (3, 7)",
    "bundle_roundtrip": f"""SELECT '2026-01-01' AS version, region, max(CASE WHEN table_name = 'traffic_calming' THEN n END) AS n_calming, max(CASE WHEN table_name = 'roundabouts' THEN n END) AS n_roundabouts FROM ({COUNTS}) GROUP BY region""",
    "collection_roundabouts": f"""SELECT 'all' AS region, lat, lon, radius, type FROM ({ROUND_ROWS.replace("FROM features f", "FROM (SELECT w.*, s.* EXCLUDE (way_id) FROM ways w JOIN shape s ON s.way_id = w.way_id WHERE s.n_points >= 4 AND s.ring) f")})""",
    "catalogue_rows": "SELECT row_number() OVER (ORDER BY id) - 1 AS position, * FROM region_catalogue",
    "region_lookup": "SELECT r.id, r.continent, a.file, a.size FROM artifacts a, region_catalogue r WHERE r.id = 'nation_4' AND regexp_matches(a.file, '^nation_4[.-]')",
    "artifact_scan": "SELECT CAST(length(content) + 1 AS BIGINT) AS size, left(sha256(content || chr(10)), 16) AS checksum FROM artifacts",
    "manifest_rows": f"SELECT '2026-01-01' AS version, '2026-01-01T00:00:00.000Z' AS generated_at, region, name, size, checksum, surface_size, way_size, sqlite_size, sqlite_checksum FROM ({MANIFEST})",
    "slim_rows": "SELECT '2026-01-01' AS version, row_number() OVER (ORDER BY id) - 1 AS position, id, name, b3, estimated_size, CAST(NULL AS VARCHAR) AS continent FROM region_catalogue",
    "feature_ids": "SELECT 'w' || way_id AS id, way_id FROM ways UNION ALL SELECT 'n' || node_id, NULL FROM nodes",
    "run_stamps": """SELECT n_name, CASE WHEN n_nationkey % 3 = 0 THEN '2026-' || n_nationkey ELSE 'today' END AS version,
CASE WHEN n_nationkey % 3 = 0 THEN '2026-' || n_nationkey ELSE 'now' END AS instant, '2026-01-01' AS fixed FROM nation""",
    "lines_roundtrip": f"""SELECT 'road_ways' AS table_name, region, highway AS kind, surface, min_lat AS lat, max_lon AS lon, n_points FROM ({ROAD_WAYS})
UNION ALL SELECT 'road_surfaces', region, NULL, surface, min_lat, max_lon, n_points FROM ({SURFACES} AND open_road)
UNION ALL SELECT 'traffic_calming', region, type, NULL, lat, lon, NULL FROM ({CALMING_ALL})
UNION ALL SELECT 'roundabouts', region, type, NULL, lat, lon, NULL FROM ({MINI_ROWS} UNION ALL {ROUND_ROWS})""",
    "lines_metadata": f"""SELECT region, unnest(['version', 'region', 'createdAt', 'hasSurfaceData', 'hasWayData']) AS key,
unnest(['2026-01-01', region, '2026-01-01T00:00:00.000Z', 'false', CASE WHEN region <> 'ASIA' AND n > 0 THEN 'true' ELSE 'false' END]) AS value FROM ({COUNTS}) WHERE table_name = 'road_ways'""",
    "written_tables": f"""SELECT table_name, region, count(*) AS n, round(min(min_lat) + 1e-9, 6) AS min_lat, round(max(max_lat) + 1e-9, 6) AS max_lat FROM (
SELECT 'road_ways' AS table_name, region, min_lat, max_lat FROM roads WHERE open_road UNION ALL SELECT 'road_surfaces', region, min_lat, max_lat FROM roads WHERE surface <> '' AND open_road
UNION ALL SELECT 'traffic_calming', region, lat, lat FROM ({CALMING_ALL}) UNION ALL SELECT 'roundabouts', region, lat, lat FROM ({MINI_ROWS})
UNION ALL SELECT 'roundabouts', region, lat, lat FROM ({ROUND_ROWS}) WHERE region <> 'ASIA'
UNION ALL SELECT 'metadata', region, NULL, NULL FROM (SELECT DISTINCT region FROM ways), range(5)) GROUP BY table_name, region""",
    "bbox_stored": f"SELECT * EXCLUDE (way_id), way_id FROM ({ROAD_WAYS}) WHERE max_lat >= 50.02 AND min_lat <= 50.03 AND max_lon >= -0.9 AND min_lon <= -0.89",
    "size_report": f"""SELECT table_name AS folder, region, n, true AS some, true AS smaller, CAST(1.5 AS DOUBLE) AS seconds FROM ({COUNTS}) WHERE table_name LIKE 'road_%'""",
    "road_ways_by_node": ROAD_WAYS,
    "header_metadata": f"""SELECT region, unnest(['version', 'region', 'createdAt', 'hasSurfaceData', 'hasWayData']) AS key,
unnest(['2026-01-01', region, '2026-01-01T00:00:00.000Z', 'false', CASE WHEN n > 0 THEN 'true' ELSE 'false' END]) AS value
FROM (SELECT a.region, count(r.region) AS n FROM ({ALL_REGIONS}) a LEFT JOIN roads r ON r.region = a.region AND r.open_road AND r.region <> 'ASIA' GROUP BY a.region)""",
    "replaced_region": f"""SELECT a.region, count(m.region) AS n, CASE WHEN a.region IN ('ASIA', 'EUROPE') THEN count(m.region) END AS written
FROM ({ALL_REGIONS}) a LEFT JOIN ({MINI_ROWS}) m ON m.region = a.region AND a.region <> 'EUROPE' AND (a.region <> 'ASIA' OR m.lat < 50.1) WHERE a.region <> 'ATLANTIS' GROUP BY a.region""",
    "published_tables": f"""SELECT number, table_name, region, count(*) AS n FROM ({PUBLISHED}), (SELECT unnest([0, 1]) AS number)
WHERE number = 0 OR region NOT IN ('ASIA', 'EUROPE') OR (region = 'ASIA' AND table_name <> 'road_surfaces') OR table_name = 'metadata' GROUP BY number, table_name, region""",
    "published_metadata": f"""SELECT region, unnest(['version', 'region', 'createdAt', 'hasSurfaceData', 'hasWayData']) AS key,
unnest([CASE region WHEN 'ASIA' THEN '2026-02-01' WHEN 'EUROPE' THEN '2026-02-02' ELSE '2026-01-01' END, region, '2026-01-01T00:00:00.000Z',
  CASE WHEN surfaces > 0 AND region NOT IN ('ASIA', 'EUROPE') THEN 'true' ELSE 'false' END, CASE WHEN ways > 0 AND region <> 'EUROPE' THEN 'true' ELSE 'false' END]) AS value
FROM (SELECT a.region, count(*) FILTER (p.table_name = 'road_surfaces') AS surfaces, count(*) FILTER (p.table_name = 'road_ways') AS ways FROM ({ALL_REGIONS}) a LEFT JOIN ({PUBLISHED}) p ON p.region = a.region GROUP BY a.region)""",
    "streamed_tables": f"""WITH ok AS (SELECT * FROM roads WHERE way_id % 10 NOT IN (3, 7)),
made AS (SELECT 'road_ways' AS name, min_lat AS lat FROM ok WHERE open_road UNION ALL SELECT 'road_surfaces', min_lat FROM ok WHERE surface <> '' AND open_road
  UNION ALL SELECT 'traffic_calming', lat FROM ({CALMING_ROWS} UNION ALL {CAMERA_ROWS}) UNION ALL SELECT 'traffic_calming', lat0 FROM ok WHERE bridge = 'yes' OR tunnel = 'yes'
  UNION ALL SELECT 'roundabouts', lat FROM ({MINI_ROWS}) UNION ALL SELECT 'roundabouts', mean_lat FROM ok WHERE junction = 'roundabout')
SELECT name, count(*) AS n, round(min(lat) + 1e-9, 6) AS low, round(max(lat) + 1e-9, 6) AS high FROM made GROUP BY name
UNION ALL SELECT 'counted ' || name, count(*), NULL, NULL FROM made GROUP BY name
UNION ALL SELECT 'counted features', (SELECT count(*) FROM ok) + (SELECT count(*) FROM nodes), NULL, NULL
UNION ALL SELECT 'counted blank', count(*) FILTER (way_id % 10 = 7), NULL, NULL FROM roads
UNION ALL SELECT 'counted rejected', count(*) FILTER (way_id % 10 = 3), NULL, NULL FROM roads
UNION ALL SELECT 'rejected lines', count(*) FILTER (way_id % 10 = 3), NULL, NULL FROM roads""",
}
#: A body that has tables of its own adds them to the common ones.
ORACLE_SQL = {name: CTE + ("," + body[len("WITH") :] if body.startswith("WITH ") else body) for name, body in _BODY.items()}
