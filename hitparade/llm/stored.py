"""Intermediate tables in the folder that all executors share."""

import uuid

from pyspark.sql import DataFrame

from hitparade.session import delete_at_end, shared_folder


def new_folder(spark, name: str) -> str:
    """A folder of its own below the shared one."""
    return f"{shared_folder(spark)}/hitparade/{name}-{uuid.uuid4()}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written and read back: later steps neither redo the work nor depend on executors that may be lost. The table goes
    when the application ends, as a returned DataFrame may read it until then."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    delete_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def by_shuffle(df: DataFrame) -> DataFrame:
    """A side of a join that moves both sides by key, whatever size Spark expects. It takes a stored table for its compressed
    files and exploded rows for the rows before, and would send tables of many times its threshold through the driver."""
    return df.hint("merge")
