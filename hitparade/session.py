"""Session settings and the shared folder for cutting lineage."""

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app_name: str = "hitparade", **settings) -> SparkSession:
    """A local session for tests and measurements; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        # Files are compressed; without this, tables several times over the broadcast threshold pass its size check.
        .config("spark.sql.sources.fileCompressionFactor", "4")
    )
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@cache
def _scratch_folder() -> str:
    return tempfile.mkdtemp(prefix="hitparade-")


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; a scratch folder only for local sessions without one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return _scratch_folder()


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path as its own kind of object."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


#: Whether Spark deletes a step's shuffle files as the step ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Steps in the block leave no shuffle files behind; otherwise those stay until the driver happens to collect its garbage."""
    before = spark.conf.get(SHUFFLE_CLEANUP)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Delete the folder when the application ends: a returned DataFrame may read it until then."""
    system, place = file_system(spark, path)
    system.deleteOnExit(place)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back, so that iterative fits neither redo nor lose earlier work.

    The table goes when the application ends; scratch() deletes it earlier.
    """
    path = f"{shared_folder(df.sparkSession)}/hitparade/{uuid.uuid4()}"
    with shuffles_deleted(df.sparkSession):
        df.write.parquet(path)
    delete_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A new path below the shared folder; what has been written there is deleted at the end."""
    folder = f"{shared_folder(spark)}/hitparade/{uuid.uuid4()}"
    try:
        yield folder
    finally:
        system, path = file_system(spark, folder)
        system.delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A function that cuts lineage as cut_lineage does; what it has written is deleted at the end."""
    with scratch_folder(spark) as folder:

        def cut(df: DataFrame, **options) -> DataFrame:
            path = f"{folder}/{uuid.uuid4()}"
            with shuffles_deleted(spark):
                df.write.options(**options).parquet(path)
            return spark.read.schema(df.schema).parquet(path)

        yield cut
