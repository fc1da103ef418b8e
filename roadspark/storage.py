"""The folder that driver and executors share, and files in whatever store a path names."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a local session without it gets its own."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = os.environ.get("ROADSPARK_SHARED") or tempfile.mkdtemp(prefix="roadspark-")
        os.environ["ROADSPARK_SHARED"] = path
    return path.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/roadspark/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    """Is there a file or folder at the path, or anything that its pattern matches?"""
    store, place = _file_system(spark, path)
    return bool(store.globStatus(place))


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, sorted; none if there is no such folder."""
    store, place = _file_system(spark, path)
    return sorted(entry.getPath().getName() for entry in store.listStatus(place)) if store.exists(place) else []


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is below it, if it is there."""
    store, place = _file_system(spark, path)
    store.delete(place, True)


def partition_folder(spark: SparkSession, column: str, value: str) -> str:
    """The name of the folder that holds a partition, as Spark writes it."""
    return f"{column}={spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)}"
