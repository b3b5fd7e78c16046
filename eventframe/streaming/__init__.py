"""Streams of newly arrived event files."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.api import register


def stream_events(spark: SparkSession, path: str, schema, tree: str = "Events", **options) -> DataFrame:
    """Rows of the files under path, and of those that arrive later, each file once."""
    register(spark)
    return spark.readStream.format("root").schema(schema).options(tree=tree, **{k: str(v) for k, v in options.items()}).load(path)


def with_time(stream: DataFrame, micros: str, delay: str = "10 minutes") -> DataFrame:
    """Adds ts from a column of microseconds, with a watermark."""
    return stream.withColumn("ts", F.timestamp_micros(micros)).withWatermark("ts", delay)


def tumbling(stream: DataFrame, width: str, *keys: str) -> DataFrame:
    return stream.groupBy(F.window("ts", width), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(stream: DataFrame, gap: str, *keys: str) -> DataFrame:
    return stream.groupBy(F.session_window("ts", gap), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def running_totals(stream: DataFrame, key: str, value: str) -> DataFrame:
    """Per key the count and total so far, emitted at each batch: a stateful operator over Arrow-batched state."""
    import pandas as pd

    def update(keys, batches, state):
        n, total = state.get if state.exists else (0, 0.0)
        for b in batches:
            n, total = n + len(b), total + float(b[value].sum())
        state.update((n, total))
        yield pd.DataFrame({key: [keys[0]], "n": [n], "total": [total]})

    kind = stream.schema[key].dataType.simpleString()
    return stream.groupBy(key).applyInPandasWithState(update, f"{key} {kind}, n long, total double", "n long, total double", "update", "NoTimeout")


def shared_folder(spark: SparkSession) -> str:
    """A new folder in the one that the cluster names in spark.checkpoint.dir, or, in local mode, a temporary one."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("streams need a folder that all executors share; name one in spark.checkpoint.dir")
    return f"{named.rstrip('/')}/stream-{uuid.uuid4().hex}" if named else "file://" + tempfile.mkdtemp(prefix="eventframe-stream-")


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Runs a stream over all that is there now; returns what it has emitted, which the executors have written to the shared folder,
    batch by batch (a batch that is run again overwrites its own). In complete mode that is the last batch's table."""
    spark, folder, batches = stream.sparkSession, shared_folder(stream.sparkSession), []

    def keep(rows: DataFrame, number: int) -> None:
        batches.append(f"{folder}/rows/{number}")
        rows.write.mode("overwrite").parquet(batches[-1])

    q = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/state").outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    if not batches:
        return spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(*(batches[-1:] if mode == "complete" else dict.fromkeys(batches)))
