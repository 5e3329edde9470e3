"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Where it is unset, a folder of our own in local mode, in which all tasks are on this machine; on a cluster an error, as no folder is known that all executors see."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("campuslake.scratch", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: it names the folder that driver and executors share, to which intermediate tables are written")
        found = tempfile.mkdtemp(prefix="campuslake-")
        spark.conf.set("campuslake.scratch", found)
    return found.rstrip("/")


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of user facts."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """df as a table of the shared folder, in a folder for each value of the given columns."""
    path = f"{shared_dir(df.sparkSession)}/campuslake/{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a small side that is broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 100_000
