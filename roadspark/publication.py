"""Publication: all tables of a run become visible together, region by region.

A publication is a folder. Each run writes its rows of every table below a folder of its own
(``<table>/run=<run>/region=<region>/``), where no reader looks yet. Only when all of them and
the metadata are written does one commit (``commits/<number>/``, a single file, which Spark
moves into place when its job ends) name what a reader sees from then on: for each region the
run that holds it, in all tables alike. So five tables switch at once, a run that is killed
between two of them changes nothing, and earlier commits stay readable until :func:`vacuum`.

A run names the regions it replaces. What earlier runs had for them is no longer visible, also
where the new run has no rows; regions it does not name stay as they are. Every region of a run
has metadata, without any data too. Rows of a region that the run does not name are an error, as
are a null or empty region and a null in a required column; then nothing is published.

Row counts are taken within the writes. Readers filter on the partition columns, so files of
other runs and regions are never opened. One writer at a time; a second one that commits the
same number fails.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schemas
from .functions import time
from .operators.layout import checked, spatial_order
from .sinks import Written
from .storage import names, remove

TABLES = {"traffic_calming": schemas.TRAFFIC_CALMING, "roundabouts": schemas.ROUNDABOUTS, "road_surfaces": schemas.ROAD_SURFACES, "road_ways": schemas.ROAD_WAYS, "metadata": schemas.METADATA}
_COMMIT = "number bigint, run string, previous bigint, regions array<struct<region:string,run:string>>, counts map<string,map<string,bigint>>"


@dataclass
class Commit:
    """What a reader sees: ``regions`` says which run holds a region, ``counts`` has the rows of
    each table and region that the run wrote."""

    number: int
    run: str
    regions: dict[str, str]
    counts: dict[str, dict[str, int]]


def _numbers(spark: SparkSession, path: str) -> list[int]:
    """Commits that are complete: their folder holds the marker of a job that ended."""
    found = [n for n in names(spark, f"{path}/commits") if n.isdigit()]
    return [int(n) for n in found if "_SUCCESS" in names(spark, f"{path}/commits/{n}")]


def latest(spark: SparkSession, path: str, at: int | None = None) -> Commit | None:
    """The last commit, or that of a number; none if nothing is published yet."""
    numbers = _numbers(spark, path)
    if at is not None and at not in numbers:
        raise LookupError(f"{path} has no commit {at}")
    if not numbers:
        return None
    row = spark.read.schema(_COMMIT).option("mode", "FAILFAST").json(f"{path}/commits/{at if at is not None else max(numbers):08d}").first()
    return Commit(row.number, row.run, {r.region: r.run for r in row.regions}, row.counts)


def publish(tables: dict[str, DataFrame], path: str, regions: list[str], version: str | dict[str, str] | None = None, created_at: str | None = None, run: str | None = None) -> Commit:
    """Write the four tables and their metadata as one run and make them visible together.

    ``regions`` are those that the run replaces; ``version`` is one for all of them or one for
    each. ``run`` names the run's folders; by default it is new.
    """
    missing = set(TABLES) - {"metadata"} - set(tables)
    if missing or not regions or not all(regions):
        raise ValueError(f"a run needs all tables (without {sorted(missing)}) and names of its regions" if missing else "a run needs the names of its regions")
    spark = next(iter(tables.values())).sparkSession
    before = latest(spark, path)
    run = run or uuid.uuid4().hex
    with ThreadPoolExecutor(len(tables)) as pool:  # jobs that do not wait for each other's last tasks
        writes = {name: pool.submit(_write, tables[name], name, path, run, regions) for name in TABLES if name != "metadata"}
    counts = {name: write.result().by_region for name, write in writes.items()}
    stamped = metadata(spark, regions, version, counts, created_at)
    counts["metadata"] = _write(stamped, "metadata", path, run, regions).by_region
    number = before.number + 1 if before else 0
    held = (before.regions if before else {}) | dict.fromkeys(regions, run)
    row = (number, run, before.number if before else None, sorted(held.items()), counts)
    spark.createDataFrame([row], _COMMIT).coalesce(1).write.mode("errorifexists").json(f"{path}/commits/{number:08d}")
    return Commit(number, run, held, counts)


def _write(df: DataFrame, name: str, path: str, run: str, regions: list[str]) -> Written:
    named = F.coalesce(F.col("region").isin(*regions), F.lit(False))
    refused = F.raise_error(F.concat(F.lit(f"{name} has a row of region "), F.coalesce("region", F.lit("null")), F.lit(", which the run does not name"))).cast("boolean")
    rows = checked(df.where(F.when(named, True).otherwise(refused)), name)
    rows = rows.select("region", *[c for c in rows.columns if c != "region"])
    written = Written(regions)
    written.observe(rows if name == "metadata" else spatial_order(rows)).write.mode("overwrite").partitionBy("region").parquet(f"{path}/{name}/run={run}")
    return written.done()


def metadata(spark: SparkSession, regions: list[str], version: str | dict[str, str] | None, counts: dict[str, dict[str, int]], created_at: str | None = None) -> DataFrame:
    """region, key, value of every region of a run, from the counts of its writes."""
    own = version if isinstance(version, dict) else dict.fromkeys(regions, version)
    rows = [(r, own.get(r), bool(counts["road_surfaces"].get(r)), bool(counts["road_ways"].get(r))) for r in dict.fromkeys(regions)]
    heads = spark.createDataFrame(rows, "region string, version string, surfaces boolean, ways boolean")
    pairs = [("version", time.version(F.col("version"))), ("region", F.col("region")), ("createdAt", time.instant(created_at)), ("hasSurfaceData", F.col("surfaces").cast("string")), ("hasWayData", F.col("ways").cast("string"))]
    return heads.select("region", F.explode(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs])).alias("p")).select("region", "p.key", "p.value")


def _visible(commit: Commit) -> Column:
    """Rows of the runs that hold their regions: a filter on partition columns alone."""
    by_run: dict[str, list[str]] = {}
    for region, run in commit.regions.items():
        by_run.setdefault(run, []).append(region)
    return reduce(lambda a, b: a | b, [(F.col("run") == run) & F.col("region").isin(*sorted(own)) for run, own in sorted(by_run.items())], F.lit(False))


def read_published(spark: SparkSession, path: str, table: str, at: int | None = None) -> DataFrame:
    """A table as the last commit shows it, or that of a number; no rows before the first one."""
    schema, commit = TABLES[table], latest(spark, path, at)
    plain = spark.createDataFrame([], schema)
    if commit is None:
        return plain
    # Texts that look like numbers stay texts: the partition columns have a schema too.
    return spark.read.schema(f"{schema}, run string").parquet(f"{path}/{table}").where(_visible(commit)).select(plain.columns)


def vacuum(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Remove the folders of runs that none of the last ``keep`` commits shows, unfinished runs
    among them, and earlier commits. No run may be writing. Returns the runs removed."""
    numbers = _numbers(spark, path)
    kept = numbers[-keep:] if keep > 0 else []
    if not kept:
        raise ValueError("the last commit must be kept")
    used = {run for n in kept for run in latest(spark, path, n).regions.values()}
    gone = set()
    for table in TABLES:
        for folder in names(spark, f"{path}/{table}"):
            if folder.startswith("run=") and folder[len("run=") :] not in used:
                remove(spark, f"{path}/{table}/{folder}")
                gone.add(folder[len("run=") :])
    for n in set(names(spark, f"{path}/commits")) - {f"{n:08d}" for n in kept}:
        remove(spark, f"{path}/commits/{n}")
    return sorted(gone)
