"""Keyed state in a folder: batches of changes, and now and then a base that holds all before it.

Each batch is written under its own number, so a batch that is run again after a
failure overwrites itself: the state after it is the same. A reader takes, of each
key, the row of the last batch; compact() folds what is there into a new base, so
that reading does not get slower with the number of batches. A base counts once
it has been written whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _children(spark: SparkSession, folder: str, whole: bool = False) -> list[int]:
    """The numbers n of the folders <folder>/<name>=n; whole: of those that a job has finished."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = [str(f.getPath().getName()) for f in fs.listStatus(path) if f.isDirectory()]
    done = lambda name: not whole or fs.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}/_SUCCESS"))
    return sorted(int(name.split("=")[1]) for name in found if "=" in name and done(name))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def upsert(folder: str) -> Callable[[DataFrame, int], None]:
    """What foreachBatch takes: the batch's rows replace those of their keys. A batch without rows writes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        if not batch.isEmpty():
            batch.write.mode("overwrite").parquet(f"{folder}/changes/batch={number}")

    return write


def _parts(spark: SparkSession, folder: str) -> tuple[int, list[int]]:
    """The last whole base (-1: none), and the batches after it."""
    base = max(_children(spark, f"{folder}/base", True), default=-1)
    return base, [n for n in _children(spark, f"{folder}/changes", True) if n > base]


def read_state(spark: SparkSession, folder: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """The rows of the schema as they are now, one a key (a null is a key too); empty where nothing has been written."""
    base, changes = _parts(spark, folder)
    parts = [(base, f"{folder}/base/upto={base}")] if base >= 0 else []
    parts += [(n, f"{folder}/changes/batch={n}") for n in changes]
    if not parts:
        return spark.createDataFrame([], schema)
    rows = None
    for n, path in parts:
        part = spark.read.schema(schema).parquet(path).withColumn("_batch", F.lit(n).cast("long"))
        rows = part if rows is None else rows.unionByName(part)
    if len(parts) == 1:
        return rows.drop("_batch")
    rest = [c for c in schema.names if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_batch").alias("_x"))
    return last.select(*[f"_x.{c}" if c in rest else c for c in schema.names])


def compact(spark: SparkSession, folder: str, schema: T.StructType, keys: list[str]) -> None:
    """Fold the base and the batches after it into one base, then delete what it replaces. Run between batches, by whoever writes."""
    base, changes = _parts(spark, folder)
    if not changes:
        return
    read_state(spark, folder, schema, keys).write.mode("overwrite").parquet(f"{folder}/base/upto={changes[-1]}")
    for n in changes:
        _delete(spark, f"{folder}/changes/batch={n}")
    if base >= 0:
        _delete(spark, f"{folder}/base/upto={base}")
