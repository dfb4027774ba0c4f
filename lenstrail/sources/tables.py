"""Parquet tables: typed reads, replacing writes, and lineage cuts for multi-pass jobs."""

from __future__ import annotations

import tempfile
from collections.abc import Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lenstrail.config import ROIS, Roi

# Column names that older tables use for the standard ones.
NAME_VARIANTS = {"roi_name": "roi", "prediction": "cluster", "lat": "latitude", "lon": "longitude"}


def standard_names(df: DataFrame) -> DataFrame:
    """Rename known variants, unless the standard name is there as well."""
    return df.withColumnsRenamed(
        {old: new for old, new in NAME_VARIANTS.items() if old in df.columns and new not in df.columns}
    )


def read_or_empty(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """The Parquet table at `path`, or an empty frame of the same schema if it is missing."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_table(
    df: DataFrame,
    path: str,
    *,
    partition_by: Sequence[str] = (),
    max_records_per_file: int = 0,
    skip_empty: bool = False,
) -> DataFrame | None:
    """Replace the Parquet table at `path` and return a frame that reads it back.

    With `skip_empty` nothing is written for an empty frame and None is returned.  Files
    are bounded by row count, never by forcing the job into one task.  Partitioned tables
    are rebalanced first: few files per value, and a large value is split.
    """
    if skip_empty and df.isEmpty():
        return None
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def own_session(spark: SparkSession) -> SparkSession:
    """Another session of the same application, with the settings of `spark` that results depend on."""
    other = spark.newSession()
    for name in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled", "spark.sql.caseSensitive", "spark.sql.shuffle.partitions"):
        other.conf.set(name, spark.conf.get(name))
    return other


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a scan that has fewer splits than cores."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def _file_system(spark: SparkSession, path: str):
    """Spark's own file system of a path, and the path."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def file_listing(spark: SparkSession, path: str) -> tuple[tuple[str, int, int], ...]:
    """Name, length and time of every file under `path`, in order; none if it is missing."""
    fs, at = _file_system(spark, path)
    if not fs.exists(at):
        return ()
    files, out = fs.listFiles(at, True), []
    while files.hasNext():
        f = files.next()
        out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return tuple(sorted(out))


def remove_at_exit(spark: SparkSession, path: str) -> None:
    """Have the file system remove a folder when the session's JVM ends."""
    fs, at = _file_system(spark, path)
    fs.mkdirs(at)  # a path that is not there would be forgotten
    fs.deleteOnExit(at)


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors see: the one the cluster names in `spark.checkpoint.dir`.

    A temporary folder stands in only in local mode, where nothing is named.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if context.getCheckpointDir() is None:
        if not named and not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = named or tempfile.mkdtemp(prefix="lenstrail-")
        if not named:
            remove_at_exit(spark, folder)
        context.setCheckpointDir(folder)
    return named or context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise a frame that several passes read, in reliable storage."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def roi_table(spark: SparkSession, rois: Sequence[Roi] = ROIS) -> DataFrame:
    """ROI dimension with priority, bounds and centroid.  One row per box of the given list."""
    return spark.createDataFrame(
        pa.table(
            {
                "roi": pa.array([r.name for r in rois], pa.string()),
                "priority": pa.array(range(len(rois)), pa.int32()),
                "lat_min": pa.array([r.lat_min for r in rois], pa.float64()),
                "lat_max": pa.array([r.lat_max for r in rois], pa.float64()),
                "lon_min": pa.array([r.lon_min for r in rois], pa.float64()),
                "lon_max": pa.array([r.lon_max for r in rois], pa.float64()),
                "centre_lat": pa.array([r.centre[0] for r in rois], pa.float64()),
                "centre_lon": pa.array([r.centre[1] for r in rois], pa.float64()),
            }
        )
    )
