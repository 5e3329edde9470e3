"""Live checklist progress and windowed event counts, from file streams."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.replay import checklist_masks
from ..operators.visa import mask_json
from ..sources.scratch import shared_dir
from .state import compact, read_state, upsert


def read_stream(spark: SparkSession, folder: str, name: str, files: int | None = None) -> DataFrame:
    """The table as a stream of its files, so many to a batch; event times become timestamps, which watermarks need."""
    schema = spark.read.parquet(f"{folder}/{name}.parquet").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet")
    if files:
        source = source.option("maxFilesPerTrigger", files)
    rows = source.parquet(f"{folder}/{name}.parquet*")
    return rows.withColumn("ts", F.col("ts").cast("timestamp")) if "ts" in rows.columns else rows


def checked_stream(toggles: DataFrame) -> DataFrame:
    """Whether each (user_id, item_id) is checked, by the parity of its toggles: late rows change nothing. Update mode; at most an item's state for each user."""
    return toggles.groupBy("user_id", "item_id").agg((F.count("*") % 2 == 1).alias("checked"))


def event_counts_stream(events: DataFrame, late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counts by window, category and label; append mode, so that a window comes out once it is closed."""
    w = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_category", "event_label").agg(F.count("*").alias("n"))
    return w.select(F.col("window.start").alias("window_start"), "event_category", "event_label", "n")


def run_to_table(stream: DataFrame, mode: str) -> DataFrame:
    """Run the stream over what is there, and read what it has written to the shared folder.

    Updates are written batch by batch, and the last batch to tell of a key wins.
    """
    spark = stream.sparkSession
    folder = f"{shared_dir(spark)}/campuslake/stream-{uuid.uuid4().hex}"
    schema = T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])
    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{folder}/state").trigger(availableNow=True)
    query = query.foreachBatch(lambda b, n: b.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")).start()
    query.awaitTermination()
    return spark.read.schema(schema).option("basePath", f"{folder}/out").parquet(f"{folder}/out")


def latest(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key the row of the last batch."""
    rest = [c for c in rows.columns if c not in (*keys, "batch")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "batch").alias("x")).select(*keys, "x.*")


# ---------------------------------------------------------------- live state that outlives its process

#: What the state of a checklist holds of each user.
CHECKLIST = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("mask", T.LongType()), T.StructField("json", T.StringType()), T.StructField("n_checked", T.LongType())])


def checklist_stream(toggles: DataFrame) -> DataFrame:
    """user_id, mask, json and n_checked of each user whose checklist a batch changes. Update mode; the state that Spark keeps is one long a user."""
    mask = F.col("mask")
    masks = checklist_masks(toggles)
    return masks.select(F.col("user_id").cast("long").alias("user_id"), "mask", mask_json(mask).alias("json"), F.bit_count(mask).cast("long").alias("n_checked"))


def run_checklists(toggles: DataFrame, folder: str, every: int = 20) -> int:
    """Take in the toggles that have arrived, and go on later from there: offsets and state are in the folder. Returns how many batches ran.

    The state that readers see (checklists()) is replaced user by user, batch by
    batch; after `every` batches it is folded.
    """
    write = upsert(f"{folder}/state")
    query = checklist_stream(toggles).writeStream.outputMode("update").option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True)
    done = []

    def batch(rows: DataFrame, number: int) -> None:
        write(rows, number)
        done.append(number)
        if (number + 1) % every == 0:
            compact(rows.sparkSession, f"{folder}/state", CHECKLIST, ["user_id"])

    query.foreachBatch(batch).start().awaitTermination()
    return len(done)


def checklists(spark: SparkSession, folder: str) -> DataFrame:
    """The checklists as the last batch has left them."""
    return read_state(spark, f"{folder}/state", CHECKLIST, ["user_id"])


# ---------------------------------------------------------------- windows with late rows

_RUN = "run long, watermark_us long, n_rows long, n_late long"


def run_windows(events: DataFrame, folder: str, late_s: int = 3600, width_s: int = 86_400) -> None:
    """Count the events that have arrived by window, category and label, and go on later from there; what comes too late is counted apart.

    A window is written once it is closed: once an event has been seen that is
    late_s seconds past its end. The watermark moves between runs; an event whose
    window was closed when its run began is dropped by Spark, and counted here by
    observing the rows that come in. Events: ts, event_category, event_label.
    """
    spark = events.sparkSession
    before = spark.read.schema(_RUN).parquet(f"{folder}/runs") if _exists(spark, f"{folder}/runs") else spark.createDataFrame([], _RUN)
    run, mark = before.agg(F.max("run"), F.max("watermark_us")).first()
    run, mark = (-1 if run is None else run) + 1, 0 if mark is None else mark
    end = (F.floor(F.unix_micros("ts") / F.lit(width_s * 1_000_000)) + 1) * width_s * 1_000_000
    late = F.coalesce(F.count_if(end <= F.lit(mark)), F.lit(0).cast("long"))
    seen = events.observe("arrivals", F.count(F.lit(1)).alias("n_rows"), late.alias("n_late"), F.max(F.unix_micros("ts")).alias("last"))
    counts = event_counts_stream(seen, f"{late_s} seconds", f"{width_s} seconds")
    query = counts.writeStream.outputMode("append").option("checkpointLocation", f"{folder}/offsets").trigger(availableNow=True)
    query = query.foreachBatch(lambda rows, n: rows.write.mode("overwrite").parquet(f"{folder}/out/batch={n}")).start()
    query.awaitTermination()
    found = [p.observedMetrics["arrivals"] for p in query.recentProgress if p.numInputRows > 0 and "arrivals" in (p.observedMetrics or {})]
    last = max((m["last"] for m in found if m["last"] is not None), default=None)
    # Spark keeps the watermark in whole milliseconds, and never takes it back
    mark = mark if last is None else max(mark, (last // 1000 - late_s * 1000) * 1000)
    row = (run, mark, sum(m["n_rows"] for m in found), sum(m["n_late"] for m in found))
    spark.createDataFrame([row], _RUN).write.mode("overwrite").parquet(f"{folder}/runs/part={run}")


def _exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def closed_windows(spark: SparkSession, folder: str) -> DataFrame:
    """window_start, event_category, event_label and n of all windows that are closed."""
    return spark.read.schema("window_start timestamp, event_category string, event_label string, n long").parquet(f"{folder}/out")


def window_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Of each run how many rows came in, how many of them too late, and the watermark after it."""
    return spark.read.schema(_RUN).parquet(f"{folder}/runs")
