"""Append logs as Structured Streams: windows with late rows, exactly-once appends, and per-key state.

A log is read from a folder of Parquet files. Results go to files with a checkpoint, both in the shared folder, so a
restarted query goes on where it stopped and no row is written twice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

from sightline.operators.relational import first_per_key
from sightline.session import scratch_path


def read_log(spark: SparkSession, folder: str, name: str, schema: StructType, files_per_batch: int = 64) -> DataFrame:
    """The table ``name`` of ``folder`` (a file or a folder of files) as a stream."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", str(files_per_batch))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
    if status.isDirectory():
        return reader.parquet(f"{folder}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def drain(stream: DataFrame, label: str, keys: list[str] | None = None, folder: str | None = None) -> DataFrame:
    """Runs ``stream`` over all that is there now, batch by batch, and returns what its sink holds.

    Without ``keys`` rows are appended once. With ``keys`` each batch gives the new versions of the keys it touched, and of
    every key the last one counts. Every batch of updates is a folder of its own, written anew if the batch is run again.
    ``folder`` keeps output and checkpoint beyond this call: the next one goes on after the last finished batch.
    """
    spark = stream.sparkSession
    base = folder or scratch_path(spark, label)
    out, checkpoint = f"{base}/out", f"{base}/checkpoint"
    writer = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if keys is None:
        writer.outputMode("append").format("parquet").option("path", out).start().awaitTermination()
        return spark.read.schema(stream.schema).parquet(out)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer.outputMode("update").foreachBatch(keep).start().awaitTermination()
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(out)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(at)  # an empty log gives no batch
    versions = spark.read.schema(stream.schema.add("batch", "long")).parquet(out)
    return first_per_key(versions, keys, [F.desc("batch")]).drop("batch")


def windowed_counts(log: DataFrame, at: str, key: str, length: str, lateness: str) -> DataFrame:
    """Rows per tumbling window and key. Windows that end ``lateness`` before the newest row of earlier batches are closed:
    their state is dropped, and with it the rows that come for them later."""
    w = F.window(at, length)
    return log.withWatermark(at, lateness).groupBy(w.alias("w"), key).agg(F.count("*").alias("rows")).select(F.col("w.start").alias("window_start"), key, "rows")


def once_per_key(log: DataFrame, keys: list[str], at: str, lateness: str) -> DataFrame:
    """The first row to arrive of each key; state is dropped once rows that old can no longer come."""
    return log.withWatermark(at, lateness).dropDuplicatesWithinWatermark(keys)


_STATE = "step bigint, committed bigint, last_request bigint"


def progress_states(log: DataFrame) -> DataFrame:
    """Per image the number of log rows, of committed ones, and the newest request: a state that only moves forward.

    Each batch emits the new state of the images it touched.
    """

    def advance(key: tuple[Any, ...], batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        step, committed, last = state.get if state.exists else (0, 0, -1)
        for b in batches:
            step += len(b)
            committed += int(b["committed"].sum())
            last = max(last, int(b["request_id"].max()))
        state.update((step, committed, last))
        yield pd.DataFrame({"image_id": [key[0]], "step": [step], "committed": [committed], "last_request": [last]})

    return log.groupBy("image_id").applyInPandasWithState(advance, "image_id bigint, " + _STATE, _STATE, "update", GroupStateTimeout.NoTimeout)
