"""The registered queries of the library's own operators, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import fixtures as fx
from . import publication, sinks
from .functions import geo, time
from .functions.tags import surface_type, way_id_of
from .operators import features as x
from .operators import filters as f
from .operators.geometry import assemble_geometry, point_features, referenced_nodes, stored_by_node, way_feature_id
from .operators.layout import bbox_query, dedup_segments, read_box, write_file_bounds
from .plans import extract, manifest
from .plans.bundle_tables import bundle_metadata, tables_from_bundles
from .sources import bundles, geojson
from .sources.catalogue import find_region, read_artifacts, read_regions, slim_regions
from .storage import names, saved, scratch_path
from .streaming import geojson as stream

VERSION, CREATED_AT = "2026-01-01", "2026-01-01T00:00:00.000Z"
#: One node table serves all regions of the fixture.
KEY = {"node_key": ("node_id",)}


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return fx.ways(spark, sf_dir), fx.nodes(spark, sf_dir), fx.way_nodes(spark, sf_dir)


def _roads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.road_features(*_tables(spark, sf_dir), **KEY)


def _lines(spark: SparkSession, sf_dir: str, wanted: Column) -> DataFrame:
    ways, nodes, refs = _tables(spark, sf_dir)
    return assemble_geometry(ways.where(wanted), nodes, refs, **KEY)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return point_features(fx.nodes(spark, sf_dir))


def _tidy(df: DataFrame) -> DataFrame:
    """Numbers rounded, arrays and maps turned into plain values."""
    out = df
    for name, kind in df.dtypes:
        if kind == "double":
            # Halves of the last digit are nudged up, whatever the order of a sum was.
            out = out.withColumn(name, F.round(F.col(name) + 1e-9, 6))
    if "coords" in df.columns:
        out = out.withColumn("n_points", (F.size("coords") / 2).cast("bigint")).drop("coords")
    if "tags" in df.columns:
        out = out.withColumn("tags", F.to_json("tags"))
    return out


def road_ways(spark, sf_dir):
    return _tidy(x.road_ways(_roads(spark, sf_dir)))


def road_ways_vertices(spark, sf_dir):
    roads = _roads(spark, sf_dir).where(x.is_road_way())
    return _tidy(roads.select("region", "way_id", F.posexplode("pts").alias("at", "p")).select("region", "way_id", (F.col("at") + 1).cast("bigint").alias("seq"), "p.lon", "p.lat"))


def road_ways_plain(spark, sf_dir):
    return _tidy(x.road_ways(_roads(spark, sf_dir), service_filter=False, with_surface=False))


def road_surfaces(spark, sf_dir):
    return _tidy(x.road_surfaces(_lines(spark, sf_dir, f.drivable() & f.has_surface())))


def road_surfaces_plain(spark, sf_dir):
    return _tidy(x.road_surfaces(_lines(spark, sf_dir, f.drivable() & f.has_surface()), service_filter=False))


def surface_normalization(spark, sf_dir):
    raw = F.col("tags.surface")
    return fx.ways(spark, sf_dir).where(f.tagged("surface")).groupBy(raw.alias("raw"), surface_type(raw).alias("surface")).agg(F.count("*").alias("n"))


def calming_points(spark, sf_dir):
    return _tidy(x.traffic_calming(_points(spark, sf_dir), cameras=False, bridges=False)).select("region", "lat", "lon", "type", "tags")


def speed_cameras(spark, sf_dir):
    return _tidy(x.traffic_calming(_points(spark, sf_dir), calming=False, bridges=False)).select("region", "lat", "lon", "type", "tags")


def bridges_tunnels(spark, sf_dir):
    return _tidy(x.traffic_calming(_lines(spark, sf_dir, f.bridge_or_tunnel()), calming=False, cameras=False))


def way_id_parse(spark, sf_dir):
    ids = fx.ways(spark, sf_dir).select("id").union(fx.nodes(spark, sf_dir).select(F.concat(F.lit("n"), F.col("node_id"))))
    return ids.select("id", way_id_of(F.col("id")).alias("way_id"))


def traffic_calming(spark, sf_dir):
    return _tidy(x.traffic_calming(extract.core_features(*_tables(spark, sf_dir), **KEY)))


def mini_roundabouts(spark, sf_dir):
    return _tidy(x.roundabouts(_points(spark, sf_dir), full=False))


def roundabouts(spark, sf_dir):
    return _tidy(x.roundabouts(_lines(spark, sf_dir, f.roundabout()), mini=False))


def roundabouts_all(spark, sf_dir):
    return _tidy(x.roundabouts(extract.core_features(*_tables(spark, sf_dir), **KEY)))


def way_length(spark, sf_dir):
    return _roads(spark, sf_dir).where(f.is_line()).select("region", "way_id", F.round(geo.length(F.col("pts")), 3).alias("length_m"))


def core_tag_filter(spark, sf_dir):
    ways, nodes, _ = _tables(spark, sf_dir)
    found = f.tag_filter(nodes, "n").select(F.lit("n").alias("kind"), F.col("node_id").alias("element_id"))
    return found.unionByName(f.tag_filter(ways, "w").select(F.lit("w").alias("kind"), F.col("way_id").alias("element_id")))


def referenced(spark, sf_dir):
    ways, nodes, refs = _tables(spark, sf_dir)
    return referenced_nodes(nodes, f.tag_filter(ways, "w"), refs, node_key=("node_id",)).select("region", "node_id")


def _counts(spark, sf_dir):
    ways, nodes, refs = _tables(spark, sf_dir)
    return extract.counted(ways, nodes, refs, **KEY)


def region_counts(spark, sf_dir):
    return _counts(spark, sf_dir).select("region", F.col("table").alias("table_name"), "n", (F.col("n") > 0).cast("string").alias("has_data"))


def metadata_long(spark, sf_dir):
    return extract.metadata(_counts(spark, sf_dir), VERSION, CREATED_AT)


def bbox(spark, sf_dir):
    return _tidy(bbox_query(x.road_ways(_roads(spark, sf_dir)), 50.02, 50.03, -0.9, -0.89))


def dedup(spark, sf_dir):
    """Bridges and tunnels as two overlapping extracts would give them."""
    once = x.traffic_calming(_lines(spark, sf_dir, f.bridge_or_tunnel()), calming=False, cameras=False).drop("tags")
    return _tidy(dedup_segments(once.unionByName(once)))


def slim(spark, sf_dir):
    rows = slim_regions(fx.region_catalogue(spark, sf_dir))
    return rows.select("id", "name", *[F.get("bbox", F.lit(k)).alias(f"b{k}") for k in range(4)], F.col("estimatedSize").alias("estimated_size"))


def checksum16(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return docs.select("doc_id", manifest.checksum16(F.encode("text", "UTF-8")).alias("checksum"))


def _catalogue(spark, sf_dir) -> DataFrame:
    """The catalogue with positions, in the order of its ids."""
    rows = fx.region_catalogue(spark, sf_dir)
    return rows.withColumn("position", F.row_number().over(Window.orderBy("id")) - 1)  # one row a region


def manifest_regions(spark, sf_dir):
    return manifest.manifest_regions(fx.artifacts(spark, sf_dir), _catalogue(spark, sf_dir))


def manifest_totals(spark, sf_dir):
    return manifest.totals(manifest_regions(spark, sf_dir))


def _sequence_lines(spark, sf_dir, tags=("highway", "service", "surface")) -> DataFrame:
    """The fixture's drivable lines as GeoJSON text, some with a separator in front, some broken."""
    roads = _roads(spark, sf_dir).where(f.is_line())
    text = _geojson(tags, "LineString", F.transform("pts", lambda p: F.array(p["lon"], p["lat"])))
    k = F.col("way_id")
    return roads.select("way_id", F.when(k % 10 == 0, F.concat(F.lit("\x1e"), text)).when(k % 10 == 3, F.concat(text, F.lit(" x"))).when(k % 10 == 7, F.lit("  ")).otherwise(text).alias("value"))


def _geojson(tags, kind: str, coordinates: Column) -> Column:
    properties = F.create_map(*[v for t in tags for v in (F.lit(t), F.col(f"tags.{t}"))])
    geometry = F.struct(F.lit(kind).alias("type"), coordinates.alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), "id", F.map_filter(properties, lambda _, v: v.isNotNull()).alias("properties"), geometry.alias("geometry")))


def geojsonseq_scan(spark, sf_dir):
    return geojson.count_lines(_sequence_lines(spark, sf_dir))


def geojsonseq_ways(spark, sf_dir):
    features = geojson.features_of_lines(_sequence_lines(spark, sf_dir), "all")
    return _tidy(x.road_ways(features))


def bundle_roundtrip(spark, sf_dir):
    """Core bundles written as gzip JSON documents and read back."""
    path = scratch_path(spark, "bundles")
    sinks.write_core_bundles(*x.core(extract.core_features(*_tables(spark, sf_dir), **KEY)), VERSION, path)
    heads = bundles.read_header(spark, path)
    counts = [bundles.read_items(spark, path, a).groupBy("region").agg(F.count("*").alias(c)) for a, c in (("trafficCalming", "n_calming"), ("roundabouts", "n_roundabouts"))]
    return heads.join(counts[0], "region", "left").join(counts[1], "region", "left").select("version", "region", F.coalesce("n_calming", F.lit(0)).alias("n_calming"), F.coalesce("n_roundabouts", F.lit(0)).alias("n_roundabouts"))


def collection_roundabouts(spark, sf_dir):
    """Closed ways as polygons of FeatureCollection documents, with heights and holes, read back."""
    path = scratch_path(spark, "collections")
    rings = assemble_geometry(fx.ways(spark, sf_dir).where(f.roundabout()), fx.nodes(spark, sf_dir), fx.way_nodes(spark, sf_dir), closed="polygon", **KEY).where(f.is_polygon())
    outer = F.transform("pts", lambda p: F.array(p["lon"], p["lat"], F.lit(7.5)))
    hole = F.array(F.array(F.lit(0.0), F.lit(0.0)), F.array(F.lit(1.0), F.lit(1.0)))
    geometry = F.struct(F.lit("Polygon").alias("type"), F.array(outer, hole).alias("coordinates"))
    feature = F.struct(F.lit("Feature").alias("type"), F.col("id"), F.struct("tags.junction").alias("properties"), geometry.alias("geometry"))
    # A document for every so many ways; the reader takes one in a task.
    documents = rings.groupBy(F.floor(F.col("way_id") / 4096).alias("part")).agg(F.collect_list(feature).alias("features"))
    documents.select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return _tidy(x.roundabouts(geojson.read_collection(spark, path, "all"), mini=False))


def catalogue_scan(spark, sf_dir):
    """The catalogue written as a document and read back."""
    path = scratch_path(spark, "catalogue")
    entry = F.struct("id", "name", "continent", "bbox", F.col("source_path").alias("geofabrikPath"), "estimatedSize")
    listed = F.transform(F.array_sort(F.collect_list(F.struct("position", entry.alias("entry")))), lambda r: r["entry"])
    sinks.write_document(_catalogue(spark, sf_dir).agg(listed.alias("regions")).select(F.to_json(F.struct("regions")).alias("value")), path)
    return read_regions(spark, path)


def catalogue_rows(spark, sf_dir):
    rows = catalogue_scan(spark, sf_dir)
    return rows.select(F.col("position").cast("bigint").alias("position"), "id", "name", "continent", *[F.get("bbox", F.lit(k)).alias(f"b{k}") for k in range(4)], F.col("geofabrikPath").alias("source_path"), F.col("estimatedSize").alias("estimated_size"))


def region_lookup(spark, sf_dir):
    """Artifacts of one region that the catalogue is asked for."""
    found = find_region(catalogue_scan(spark, sf_dir), "nation_4")
    return fx.artifacts(spark, sf_dir).where(F.col("file").rlike(f"^{found.id}[.-]")).select(F.lit(found.id).alias("id"), F.lit(found.continent).alias("continent"), "file", "size")


def artifact_scan(spark, sf_dir):
    """Files written and read back as artifacts: their sizes and checksums."""
    path = scratch_path(spark, "artifacts")
    fx.artifacts(spark, sf_dir).select(F.decode("content", "UTF-8").alias("value")).write.option("maxRecordsPerFile", 1).text(path)
    return read_artifacts(spark, f"{path}/part-*").select("size", manifest.checksum16(F.col("content")).alias("checksum"))


def manifest_rows(spark, sf_dir):
    """The manifest document, taken apart again."""
    document = manifest.manifest_document(manifest_regions(spark, sf_dir), VERSION, CREATED_AT)
    kind = "version string, generatedAt string, regions map<string, struct<name:string, size:bigint, checksum:string, surfaceSize:bigint, waySize:bigint, sqliteSize:bigint, sqliteChecksum:string>>"
    rows = document.select(F.from_json("value", kind).alias("m")).select("m.version", F.col("m.generatedAt").alias("generated_at"), F.explode("m.regions").alias("region", "r"))
    return rows.select("version", "generated_at", "region", "r.name", "r.size", "r.checksum", F.col("r.surfaceSize").alias("surface_size"), F.col("r.waySize").alias("way_size"), F.col("r.sqliteSize").alias("sqlite_size"), F.col("r.sqliteChecksum").alias("sqlite_checksum"))


def slim_rows(spark, sf_dir):
    """The slim catalogue document, taken apart again."""
    document = manifest.slim_document(slim_regions(_catalogue(spark, sf_dir)), VERSION, CREATED_AT)
    kind = "version string, regions array<struct<id:string, name:string, bbox:array<double>, estimatedSize:bigint, continent:string>>"
    rows = document.select(F.from_json("value", kind).alias("m")).select("m.version", F.posexplode("m.regions").alias("position", "r"))
    return rows.select("version", F.col("position").cast("bigint").alias("position"), "r.id", "r.name", F.get("r.bbox", F.lit(3)).alias("b3"), F.col("r.estimatedSize").alias("estimated_size"), "r.continent")


def feature_ids(spark, sf_dir):
    """Ids made of element kinds and numbers, and the way numbers read from them."""
    ways = way_feature_id(fx.ways(spark, sf_dir).select("way_id")).select("id")
    return ways.unionByName(_points(spark, sf_dir).select("id")).select("id", way_id_of(F.col("id")).alias("way_id"))


def run_stamps(spark, sf_dir):
    """Stamps of runs that name a version, an empty one or none: the given one, or that of the clock."""
    k = F.col("n_nationkey")
    runs = spark.read.parquet(f"{sf_dir}/nation.parquet").select("n_name", F.when(k % 3 == 0, F.concat(F.lit("2026-"), k)).when(k % 3 == 1, F.lit("")).alias("given"))
    clock = F.date_format(F.from_utc_timestamp(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "UTC"), "yyyy-MM-dd")
    stamped = runs.select("n_name", time.version(F.col("given")).alias("v"), time.instant(F.col("given")).alias("i"), time.version(VERSION).alias("fixed"))
    is_iso = F.col("i").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z$")
    return stamped.select("n_name", F.when(F.col("v") == clock, "today").otherwise(F.col("v")).alias("version"), F.when(is_iso & F.col("i").startswith(clock), "now").otherwise(F.col("i")).alias("instant"), "fixed")


def lines_roundtrip(spark, sf_dir):
    """Ways, surfaces and the core written as JSON lines, and the tables made of them."""
    path = scratch_path(spark, "lines")
    tables = extract.extract(*_tables(spark, sf_dir), **KEY)
    sinks.write_lines(tables["road_ways"], f"{path}/ways", VERSION)
    sinks.write_lines(tables["road_surfaces"], f"{path}/surfaces", VERSION)
    core, rounds = sinks.write_core_lines(tables["traffic_calming"], tables["roundabouts"], VERSION, f"{path}/core")
    found = tables_from_bundles(spark, core, f"{path}/ways", f"{path}/surfaces", rounds)
    none = lambda kind: F.lit(None).cast(kind)
    roads = [_tidy(found[t]).select(F.lit(t).alias("table_name"), "region", (F.col("highway") if t == "road_ways" else none("string")).alias("kind"), "surface", F.col("min_lat").alias("lat"), F.col("max_lon").alias("lon"), "n_points") for t in ("road_ways", "road_surfaces")]
    points = [_tidy(found[t]).select(F.lit(t).alias("table_name"), "region", F.col("type").alias("kind"), none("string").alias("surface"), "lat", "lon", none("bigint").alias("n_points")) for t in ("traffic_calming", "roundabouts")]
    return reduce(DataFrame.unionByName, roads + points)


def lines_metadata(spark, sf_dir):
    """Metadata from lines: version and region are read from the lines themselves."""
    path = scratch_path(spark, "lines")
    tables = extract.extract(*_tables(spark, sf_dir), **KEY)
    sinks.write_lines(tables["road_ways"].where("region <> 'ASIA'"), f"{path}/ways", VERSION)
    core, rounds = sinks.write_core_lines(tables["traffic_calming"], tables["roundabouts"], VERSION, f"{path}/core")
    found = tables_from_bundles(spark, core, f"{path}/ways", f"{path}/none", rounds)
    return bundle_metadata(spark, core, found, CREATED_AT)


def _written(spark, sf_dir) -> str:
    path = scratch_path(spark, "tables")
    ways, nodes, refs = _tables(spark, sf_dir)
    tables = extract.extract(ways, nodes, refs, **KEY)
    for name, df in tables.items():
        sinks.write_table(df, name, path)
    # Counted in what is written, so that no table is made again for its counts.
    written = {name: spark.read.schema(df.schema).parquet(f"{path}/{name}") for name, df in tables.items()}
    sinks.write_table(extract.metadata(extract.region_counts(written, ways.select("region")), VERSION, CREATED_AT), "metadata", path)
    # One region of one table is written again; the others stay.
    sinks.write_table(tables["roundabouts"].where("region = 'ASIA' and type = 'mini_roundabout'"), "roundabouts", path)
    return path


def written_tables(spark, sf_dir):
    """All tables written by region in spatial order, with a region replaced, and read back."""
    path = _written(spark, sf_dir)
    parts = [spark.read.parquet(f"{path}/{t}").select(F.lit(t).alias("table_name"), "region", *(["min_lat", "max_lat"] if t.startswith("road_") else [F.col("lat").alias("min_lat"), F.col("lat").alias("max_lat")])) for t in extract.TABLES]
    parts.append(spark.read.parquet(f"{path}/metadata").select(F.lit("metadata").alias("table_name"), "region", F.lit(None).cast("double").alias("min_lat"), F.lit(None).cast("double").alias("max_lat")))
    return _tidy(reduce(DataFrame.unionByName, parts).groupBy("table_name", "region").agg(F.count("*").alias("n"), F.min("min_lat").alias("min_lat"), F.max("max_lat").alias("max_lat")))


def bbox_stored(spark, sf_dir):
    """A box of a table that is written in spatial order, from the files alone that can have rows."""
    path = scratch_path(spark, "ordered")
    sinks.write_table(x.road_ways(_roads(spark, sf_dir)), "road_ways", path)
    write_file_bounds(spark, f"{path}/road_ways")
    return _tidy(read_box(spark, f"{path}/road_ways", 50.02, 50.03, -0.9, -0.89))


def size_report(spark, sf_dir):
    """What a run reports of its files, as the writes counted it: rows, and that the files are
    smaller than the lines in them."""
    path = scratch_path(spark, "sized")
    tables = extract.extract(*_tables(spark, sf_dir), **KEY)
    written = {name: sinks.write_lines(tables[name], f"{path}/{name}", VERSION, REGIONS) for name in ("road_ways", "road_surfaces")}
    found = sinks.write_metrics(spark, path, {name: w.raw_bytes for name, w in written.items()}, 1.5)
    counts = spark.createDataFrame([(name, region, n) for name, w in written.items() for region, n in w.by_region.items()], "folder string, region string, n bigint")
    return found.join(counts, "folder").select("folder", "region", "n", (F.col("files") > 0).alias("some"), F.col("smaller_percent").between(1, 99).alias("smaller"), "seconds")


#: The fixture's regions, and one that has no data at all.
REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
EMPTY_REGION = "ATLANTIS"


def road_ways_by_node(spark, sf_dir):
    """Road ways from nodes and references that are stored in buckets by node."""
    ways, nodes, refs = _tables(spark, sf_dir)
    nodes, refs = stored_by_node(nodes, refs, max(8, int(spark.conf.get("spark.sql.shuffle.partitions"))), **KEY)
    return _tidy(x.road_ways(extract.road_features(ways, nodes, refs, by_node=True, **KEY)))


def header_metadata(spark, sf_dir):
    """Metadata of a run in line form in which EUROPE has no calming points, ASIA no ways, and
    one region nothing at all: the header table names them all."""
    path = scratch_path(spark, "lines")
    points, regions = _points(spark, sf_dir), [*REGIONS, EMPTY_REGION]
    sinks.write_lines(x.road_ways(_roads(spark, sf_dir)).where("region <> 'ASIA'"), f"{path}/ways", VERSION, regions)
    core, rounds = sinks.write_core_lines(x.traffic_calming(points).where("region <> 'EUROPE'"), x.roundabouts(points), VERSION, f"{path}/core", regions)
    header = f"{path}/core/{bundles.HEADER}"
    found = tables_from_bundles(spark, core, f"{path}/ways", f"{path}/none", rounds, header)
    return bundle_metadata(spark, core, found, CREATED_AT, header)


def replaced_region(spark, sf_dir):
    """A table written for all regions, then again for two: of the second one nothing is left."""
    path = scratch_path(spark, "replaced")
    rounds = x.roundabouts(_points(spark, sf_dir), full=False)
    sinks.write_table(rounds, "roundabouts", path, REGIONS)
    again = sinks.write_table(rounds.where("region = 'ASIA' and lat < 50.1"), "roundabouts", path, ["ASIA", "EUROPE"])
    counted = spark.createDataFrame(list(again.by_region.items()), "region string, written bigint")
    return spark.read.parquet(f"{path}/roundabouts").groupBy("region").agg(F.count("*").alias("n")).join(counted, "region", "full").select("region", F.coalesce("n", F.lit(0)).alias("n"), "written")


def _published(spark, sf_dir) -> str:
    """Two runs: all regions and one without data; then EUROPE and ASIA anew, EUROPE without rows."""
    path = scratch_path(spark, "published")
    points, roads = _points(spark, sf_dir), saved(_roads(spark, sf_dir), "roads")
    first = {"traffic_calming": x.traffic_calming(points), "roundabouts": x.roundabouts(points), "road_ways": x.road_ways(roads).drop("way_id"), "road_surfaces": x.road_surfaces(roads).drop("way_id")}
    publication.publish(first, path, [*REGIONS, EMPTY_REGION], VERSION, CREATED_AT)
    second = {name: df.where("region = 'ASIA'" if name != "road_surfaces" else "false") for name, df in first.items()}
    publication.publish(second, path, ["ASIA", "EUROPE"], {"ASIA": "2026-02-01", "EUROPE": "2026-02-02"}, CREATED_AT)
    return path


def published_tables(spark, sf_dir):
    """Rows by table and region after the second run, and after the first."""
    path = _published(spark, sf_dir)
    parts = [publication.read_published(spark, path, t, at).groupBy("region").agg(F.count("*").alias("n")).select(F.lit(at).cast("bigint").alias("number"), F.lit(t).alias("table_name"), "region", "n") for at in (0, 1) for t in publication.TABLES]
    return reduce(DataFrame.unionByName, parts)


def published_metadata(spark, sf_dir):
    """Metadata as the last commit shows it: of either run for its regions."""
    return publication.read_published(spark, _published(spark, sf_dir), "metadata")


def streamed_tables(spark, sf_dir):
    """GeoJSON text files taken in as a stream, in several batches: the four tables, and the
    numbers of good, blank and rejected lines."""
    path = scratch_path(spark, "streamed")
    roads = _sequence_lines(spark, sf_dir, ("highway", "service", "surface", "junction", "bridge", "tunnel", "ref")).select("value")
    points = _points(spark, sf_dir).select(_geojson(("traffic_calming", "highway", "enforcement", "name", "maxspeed"), "Point", F.transform("pts", lambda p: F.array(p["lon"], p["lat"]))[0]).alias("value"))
    # As many files as tasks, in two batches.
    roads.unionByName(points).write.text(f"{path}/in")
    files = sum(n.startswith("part-") for n in names(spark, f"{path}/in"))
    stream.stream_tables(spark, f"{path}/in", "all", f"{path}/out", f"{path}/checkpoint", files_per_trigger=-(-files // 2)).awaitTermination()
    parts = []
    for name in stream.SCHEMAS:
        lat = "min_lat" if name.startswith("road_") else "lat"
        parts.append(stream.read_streamed(spark, f"{path}/out", name).agg(F.count("*").alias("n"), F.min(lat).alias("low"), F.max(lat).alias("high")).select(F.lit(name).alias("name"), "n", "low", "high"))
    seen = stream.read_streamed(spark, f"{path}/out", "counts").agg(*[F.sum(c).alias(c) for c in ("features", "blank", "rejected", *stream.SCHEMAS)])
    pairs = F.explode(F.array(*[F.struct(F.lit(f"counted {c}").alias("name"), F.col(c).alias("n")) for c in seen.columns]))
    counted = seen.select(pairs.alias("p")).select("p.*", *[F.lit(None).cast("double").alias(c) for c in ("low", "high")])
    lines = stream.read_rejected(spark, f"{path}/out").agg(F.count("*").alias("n")).select(F.lit("rejected lines").alias("name"), "n", *[F.lit(None).cast("double").alias(c) for c in ("low", "high")])
    return _tidy(reduce(DataFrame.unionByName, [*parts, counted, lines]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "road_ways": road_ways,
    "road_ways_vertices": road_ways_vertices,
    "road_ways_plain": road_ways_plain,
    "road_surfaces": road_surfaces,
    "road_surfaces_plain": road_surfaces_plain,
    "surface_normalization": surface_normalization,
    "calming_points": calming_points,
    "speed_cameras": speed_cameras,
    "bridges_tunnels": bridges_tunnels,
    "way_id_parse": way_id_parse,
    "traffic_calming": traffic_calming,
    "mini_roundabouts": mini_roundabouts,
    "roundabouts": roundabouts,
    "roundabouts_all": roundabouts_all,
    "way_length": way_length,
    "core_tag_filter": core_tag_filter,
    "referenced_nodes": referenced,
    "region_counts": region_counts,
    "metadata_long": metadata_long,
    "bbox_query": bbox,
    "dedup_segments": dedup,
    "slim_regions": slim,
    "checksum16": checksum16,
    "manifest_regions": manifest_regions,
    "manifest_totals": manifest_totals,
    "geojsonseq_scan": geojsonseq_scan,
    "geojsonseq_ways": geojsonseq_ways,
    "bundle_roundtrip": bundle_roundtrip,
    "collection_roundabouts": collection_roundabouts,
    "catalogue_rows": catalogue_rows,
    "region_lookup": region_lookup,
    "artifact_scan": artifact_scan,
    "manifest_rows": manifest_rows,
    "slim_rows": slim_rows,
    "feature_ids": feature_ids,
    "run_stamps": run_stamps,
    "lines_roundtrip": lines_roundtrip,
    "lines_metadata": lines_metadata,
    "written_tables": written_tables,
    "bbox_stored": bbox_stored,
    "size_report": size_report,
    "road_ways_by_node": road_ways_by_node,
    "header_metadata": header_metadata,
    "replaced_region": replaced_region,
    "published_tables": published_tables,
    "published_metadata": published_metadata,
    "streamed_tables": streamed_tables,
}
